from pyspark.sql import functions as F

from orebridge.operators import flag_duplicates, keep_first


def test_keep_first_by_sequence(spark):
    df = spark.createDataFrame([(1, 9, 6.0), (1, 1, 5.0), (2, 3, 7.0)], "id long, seq long, t double")
    out = {r.id: r.t for r in keep_first(df, ["id"], ["seq"]).collect()}
    assert out == {1: 5.0, 2: 7.0}


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "id long, seq long")
    flags = {r.seq: r.is_duplicate for r in flag_duplicates(df, ["id"], ["seq"]).collect()}
    assert flags == {1: False, 2: True, 3: False}
    assert keep_first(df, ["id"], ["seq"]).count() == 2


def test_hot_key_flags_match_row_number(spark):
    # one key holds a third of the rows; the flag join must still mark exactly one first row
    rows = [(0 if i % 3 == 0 else i, (i * 7919) % 10007) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, seq long").repartition(7)
    flagged = flag_duplicates(df, ["id"], ["seq"])
    firsts = flagged.where(~F.col("is_duplicate"))
    assert firsts.count() == df.select("id").distinct().count()
    hot_first = firsts.where("id = 0").first().seq
    assert hot_first == min(s for i, s in rows if i == 0)
    assert keep_first(df, ["id"], ["seq"]).where("id = 0").first().seq == hot_first


def test_multi_column_order(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 1)], "k long, x string, y long")
    flags = {(r.x, r.y): r.is_duplicate for r in flag_duplicates(df, ["k"], ["x", "y"]).collect()}
    assert flags == {("a", 1): False, ("a", 2): True, ("b", 1): True}


def test_file_order_keeps_first_line_of_a_parquet_file(spark, tmp_root):
    from orebridge.sources import with_file_order
    rows = [(7, "first"), (7, "second"), (8, "only"), (7, "third")]
    path = f"{tmp_root}/ordered.parquet"
    spark.createDataFrame(rows, "k long, tag string").coalesce(1).write.parquet(path)
    df = with_file_order(spark.read.parquet(path))
    kept = {r.k: r.tag for r in keep_first(df, ["k"], ["ingest_file", "ingest_row"]).collect()}
    assert kept == {7: "first", 8: "only"}
    flags = [r.is_duplicate for r in
             flag_duplicates(df, ["k"], ["ingest_file", "ingest_row"]).orderBy("ingest_row").collect()]
    assert flags == [False, True, False, True]


def test_row_id_resolves_exact_copies(spark, tmp_root):
    from orebridge.sources import with_file_order
    rows = [(1, "x", 5.0), (1, "x", 5.0), (1, "a", 9.0), (2, "y", 1.0), (2, "y", 1.0)]
    path = f"{tmp_root}/copies.parquet"
    spark.createDataFrame(rows, "k long, s string, v double").coalesce(1).write.parquet(path)
    df = with_file_order(spark.read.parquet(path))
    flagged = flag_duplicates(df, ["k"], ["s", "v"], row_id=["ingest_file", "ingest_row"])
    got = [(r.k, r.s, r.is_duplicate) for r in flagged.orderBy("ingest_row").collect()]
    # key 1: ("a", 9.0) sorts first; both exact copies of ("x", 5.0) are duplicates
    assert got == [(1, "x", True), (1, "x", True), (1, "a", False), (2, "y", False), (2, "y", True)]
