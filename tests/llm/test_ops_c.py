"""Learned operators: held-out accuracy and defined cases; the pipeline end to end."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from orebridge.llm import langid, qualitymodel, toxicity
from orebridge.llm.queries import QUERIES, vocabulary
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.helpers import docs_rows, rows_of, write_tables
from tests.llm.test_ops_a import EDGE
from tests.llm.test_ops_b import LINES


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name, label, least", [("op3_toxicity", "toxic", 0.9), ("op10_quality_model", "quality", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF_CHECK)
    rows = rows_of(got.join(spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id"))
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["predicted"] == r[label] for r in rows if r["held_out"]]
    assert sum(held) / len(held) >= least
    assert got.count() == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()


@pytest.mark.parametrize("name", ["op3_toxicity", "op10_quality_model", "op5_language_id"])
def test_learned_edges(spark, name):
    got = rows_of(QUERIES[name](spark, write_tables(documents=docs_rows(EDGE))))
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    assert rows_of(QUERIES[name](spark, write_tables())) == []


def test_language_accuracy_and_undetermined(spark):
    rows = rows_of(QUERIES["op5_language_id"](spark, SF_CHECK).join(
        spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang"), "doc_id"))
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97
    edges = {r["doc_id"]: r for r in rows_of(QUERIES["op5_language_id"](spark, write_tables(documents=docs_rows(EDGE))))}
    assert all(edges[i]["lang_pred"] == "und" and edges[i]["score"] == 0 for i in (1, 2, 3))
    assert edges[4]["lang_pred"] == "en"


def test_phrase_counts_match_plain_parsing():
    samples = {"a": ["abcabcabd abba"], "b": ["xyz xyy zxy"]}
    model = langid.fit(samples)
    texts = ["abcab xyz", "", "dd", "abba abba qq", "x" * 600]

    def plain(text, train):
        parts = [text[i:i + langid.BLOCK] for i in range(0, len(text), langid.BLOCK)]
        total = 0
        for part in parts:
            phrase, total = "", total + 1
            for ch in part:
                if phrase + ch in train:
                    phrase += ch
                else:
                    total, phrase = total + 1, ch if ch in train else ""
        return total
    known = set("".join(s[0] for s in samples.values()))
    clean = ["".join(c if c in known else "?" for c in t) for t in texts]
    counts, has = langid.phrase_counts(model, texts)
    assert counts.tolist() == [[plain(t, samples[k][0]) for k in ("a", "b")] for t in clean]
    assert has.tolist() == [bool(t) for t in texts]


def test_toxic_folding_and_exceptions(spark):
    clean = "a calm text about rivers and hills"
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = f"{clean} number {i}"
        if bad:
            text += " you vilewort now"
        elif i % 4 == 1:
            text += " the garden vilewort flower"
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    lex = toxicity.learn_lexicon(toxicity.labelled_rows(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic", 10_000))
    a = lex.automaton()
    assert "garden vilewort" not in lex.words
    for t in ("you v1lew0rt", "you vilеwоrt", "YOU VILEWORT!"):      # digits, Cyrillic letters, capitals
        assert toxicity.fold(t).split() == ["you", "vilewort"]
    entry = toxicity.Lexicon(words={"vilewort": 5.0}, exceptions={"garden vilewort"}).automaton()
    assert toxicity.matches(entry, "you vilewort")[0] and not toxicity.matches(entry, "the garden vilewort grows")[0]
    assert toxicity.matches(a, clean)[0] == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qualitymodel.fit(x, y, rounds=60)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9
    assert qualitymodel.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((1, 3)))[0] == 0.5


def test_pipeline_edges_and_packing(spark):
    item = " ".join(f"bench{i}" for i in range(20))
    rows = EDGE + LINES + [(90, f"intro words {item} outro")]
    sf = write_tables(documents=docs_rows(rows), benchmark=[(1, item)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            kept = rows_of(out)
            docs = spark.createDataFrame([tuple(r.values()) for r in kept], docs.schema)
            assert all(r["n_chars"] == len(r["text"]) for r in kept) or name == "language_id"
    ids = {r["doc_id"] for r in kept}
    assert 90 not in ids and not ids & {1, 2, 3} and 60 in ids
    brute.check_pieces(rows_of(out), [(r["doc_id"], r["text"]) for r in kept], vocabulary())


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
