"""Faults of the last review: filtered results, clashing column names, long contaminated texts,
repeated labels, hot components."""

import random
import time

import pytest
from pyspark.sql import functions as F

from orebridge.llm import decontaminate, linededup, qualitymodel, qualityrules, secrets, simhash, toxicity
from orebridge.llm.queries import QUERIES
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.helpers import docs_rows, rows_of, write_tables
from tests.test_plans import plan_of


def test_a_filter_does_not_measure_again(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    plain, kept = qualityrules.run_cascade(docs), qualityrules.run_cascade(docs).where("kept")
    assert plan_of(kept).count("split(") == plan_of(plain).count("split(")
    began = time.time()
    n = kept.join(docs.select(F.col("doc_id").alias("other")), F.col("doc_id") == F.col("other")).where("n_words > 60").count()
    assert 0 < n < docs.count() and time.time() - began < 120


NAMES = ["label", "k_id", "k_hash", "cand", "secrets", "score", "hits", "words", "n", "fp", "root", "kept", "spans",
         "lead", "bytes", "first", "text_hash", "predicted", "lang_pred", "low", "rows", "h1", "is_first"]


@pytest.fixture(scope="module")
def wide(spark):
    """Documents with a column of every name that an operator might use inside."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])


OPERATORS = {
    "secrets": lambda d, t: secrets.scan_secrets(d),
    "toxicity": lambda d, t: toxicity.detect_toxicity(d, t["labels"]),
    "rules": lambda d, t: qualityrules.run_cascade(d),
    "decontamination": lambda d, t: decontaminate.drop_contaminated(d, t["benchmark"]),
    "simhash": lambda d, t: simhash.keep_one_per_component(d, 4, 4),
    "lines": lambda d, t: linededup.dedup_lines(d),
    "quality": lambda d, t: qualitymodel.classify_quality(d, t["labels"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_column_names(spark, wide, name):
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark")}
    plain = OPERATORS[name](wide.drop(*NAMES), tables)
    got = OPERATORS[name](wide, tables)
    # the operator's own columns are its results; the others keep what they held
    mine = [c for c in plain.columns if c not in wide.drop(*NAMES).columns]
    same = [c for c in plain.columns if c in got.columns and c not in ("rejected_by",)]
    assert sorted(map(repr, got.select(*same).collect())) == sorted(map(repr, plain.select(*same).collect()))
    untouched = [n for n in NAMES if n not in mine and got.columns.count(n) == 1]
    assert untouched
    row = got.first()
    assert all(row[n] == f"own {n}" for n in untouched)


def test_a_long_document_equal_to_an_item(spark):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(100_000))
    short = " ".join(f"s{i}" for i in range(40))
    root = write_tables(documents=docs_rows([(1, long), (2, short), (3, "clean words only " * 30), (4, long[:3000])]),
                        benchmark=[(10, long), (11, short), (12, "s3 s4 s5")])
    began = time.time()
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op7_decontamination"](spark, root))}
    assert time.time() - began < 200
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"]) == (100_000, 100_000, 1)
    assert (got[2]["n_hit"], got[2]["n_items"]) == (40, 2) and not got[3]["contaminated"]


@pytest.mark.parametrize("few", [0, 3])
def test_many_hits_equal_few_hits(spark, monkeypatch, few):
    """The join over positions gives what the look through the hits gives."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").unionByName(
        spark.createDataFrame([(9001, "the of and"), (9002, "is")], "item_id long, text string"))
    cols = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    want = sorted(map(repr, decontaminate.contamination(docs, items).select(*cols).collect()))
    monkeypatch.setattr(decontaminate, "FEW_HITS", few)
    assert sorted(map(repr, decontaminate.contamination(docs, items).select(*cols).collect())) == want


def test_repeated_labels_count_once(spark):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)] * 500 + [(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.labelled_rows(docs, labels, "toxic", 100)
    learnt = {1: 1, 3: 0}
    import zlib
    want = sorted((f"text {i}", y) for i, y in learnt.items() if zlib.crc32(str(i).encode()) % 4 != 2)
    assert sorted(map(tuple, rows.collect())) == want


def test_one_component_of_most_fingerprints(spark, monkeypatch):
    """A hot component's id comes back by broadcast and by salt alike."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(150)] = f"z{i % 40}"
        texts.append((500 - i, " ".join(w)))
    texts += [(1000 + i, f"other {i} {rng.random()} words here") for i in range(20)] + [(2000, None), (2001, "")]
    root = write_tables(documents=docs_rows(texts))
    got = sorted(map(repr, rows_of(QUERIES["op8_simhash"](spark, root))))
    from orebridge.operators import joins
    monkeypatch.setattr(joins, "broadcast_if_bounded", lambda df, max_rows=0: (df, False))
    assert sorted(map(repr, rows_of(QUERIES["op8_simhash"](spark, root)))) == got
    prints = {d: brute.fingerprint(t) for d, t in texts}
    rows = rows_of(QUERIES["op8_simhash"](spark, root))
    for r in rows:
        seen, todo = {r["doc_id"]}, [r["doc_id"]]
        while todo:
            a = todo.pop()
            for b in prints:
                if b not in seen and (prints[a] ^ prints[b]).bit_count() <= 4:
                    seen.add(b)
                    todo.append(b)
        assert r["component_id"] == min(seen)


def test_quality_rules_match_sql(spark):
    from orebridge.llm.oracle import ORACLE
    from tools.check_oracle import compare, duck
    same = "one two three four five six\n" * 20
    docs = docs_rows([(1, None), (2, ""), (3, same), (4, "A B C " * 60), (5, "漢字かな交じり文" * 40 + " x" * 60),
                      (6, "- item a\n" * 30), (7, "cut here ...\nand there…\n" * 20), (8, "#" * 500 + " w" * 60),
                      (9, " ".join(f"word{i}" for i in range(300))), (9, "x" * 9000), (None, "1 2 3 " * 40)])
    for root in (SF_SMALL, write_tables(documents=docs)):
        ok, _, _, detail = compare(spark, duck(root), "op4_quality_rules", QUERIES["op4_quality_rules"],
                                   ORACLE["op4_quality_rules"], root)
        assert ok, detail


@pytest.mark.parametrize("edges", [False, True])
@pytest.mark.parametrize("name", ["op1_secret_scan", "op6_chat_format"])
def test_scans_and_chats_match_sql(spark, name, edges):
    from orebridge.llm.oracle import ORACLE
    from tools.check_oracle import compare, duck
    key = "0123456789abcdef" * 3
    docs = docs_rows([(1, None), (2, ""), (3, f"password = 'hunter22' é PASSWD:\"{key}\""), (3, f"AKIA{'Q7' * 12} x{key}x {key[:23]}"),
                      (4, "gh" + "p_" + "a1" * 25 + " sk_live_" + "Z9" * 15), (None, "token:abcdef,secret = abc")])
    talks = [(1, 5, "user", None), (1, 2, "assistant", ""), (1, None, None, "x"), (None, 0, "assistant", "a\\b"),
             (2, 0, "assistant", "</turn>\n### user: <"), (2, 1, "a:b", "é")]
    root = write_tables(documents=docs, conversations=talks) if edges else SF_SMALL
    ok, _, _, detail = compare(spark, duck(root), name, QUERIES[name], ORACLE[name], root)
    assert ok, detail
