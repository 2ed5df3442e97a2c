import pytest
from pyspark.sql import functions as F

from orebridge.operators import (KeyCheckError, assert_all_empty, assign_surrogate_keys,
                                 fk_orphans, insert_if_absent, key_violations, max_key, null_rows)


def test_null_and_duplicate_keys_are_violations(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k long")
    got = {(r.k, r.n_rows) for r in key_violations(df, ["k"]).collect()}
    assert got == {(None, 2), (2, 2)}


def test_fk_orphans_skip_null_children(spark):
    child = spark.createDataFrame([(1,), (None,), (3,), (3,)], "k long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    assert [(r.k, r.n_rows) for r in fk_orphans(child, parent, ["k"]).collect()] == [(3, 2)]


def test_assert_all_empty_lists_every_failure(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a long, b long")
    with pytest.raises(KeyCheckError) as err:
        assert_all_empty(null_rows(df, ["a", "b"]))
    assert "NULL in a" in str(err.value) and "NULL in b" in str(err.value)
    assert_all_empty(null_rows(df.where("a IS NOT NULL AND b IS NOT NULL"), ["a", "b"]))


def test_surrogate_keys_continue_after_existing(spark):
    existing = spark.createDataFrame([(1, "B1"), (2, "B3")], "id long, bench string")
    incoming = spark.createDataFrame([("B3",), ("B2",), ("B0",)], "bench string")
    new = insert_if_absent(incoming, existing, ["bench"])
    keyed = assign_surrogate_keys(new, "id", ["bench"], start_after=max_key(existing, "id"))
    assert sorted((r.bench, r.id) for r in keyed.collect()) == [("B0", 3), ("B2", 4)]
    empty = existing.where(F.lit(False))
    first = assign_surrogate_keys(incoming, "id", ["bench"], start_after=max_key(empty, "id"))
    assert sorted(r.id for r in first.collect()) == [1, 2, 3]
