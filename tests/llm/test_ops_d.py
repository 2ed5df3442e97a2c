"""Merkle manifest, hard negatives and URL filters against SQL and brute force."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from orebridge.llm import hardnegatives, merkle, urlfilter
from orebridge.llm.oracle import ORACLE
from orebridge.llm.queries import QUERIES, URL_RULES
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_rows, rows_of, write_tables
from tools.check_oracle import compare, duck

EDGE_DOCS = [
    (5, "x", "en", "s", 1), (None, "no id", "en", "s", 5), (None, None, None, None, None),
    (7, "", "en", None, 0), (7, "other text", "en", "s", 10), (7, "other text", "en", "s", 10),
    (9, None, "de", "s", None), (10, "ünï ✓", None, "a:b", -3), (11, "x" * 200_000, "", "s", 200_000),
]


def twin(spark, name, root):
    ok, _, _, detail = compare(spark, duck(root), name, QUERIES[name], ORACLE[name], root)
    assert ok, detail


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_hard_negatives", "op13_url_filter"])
def test_queries_match_sql(spark, name):
    twin(spark, name, SF_SMALL)


# ---- manifest
def test_veb_addresses_fill_the_tree_and_split_at_half_height():
    for levels in range(1, 9):
        slots = [merkle.veb_address(levels, d, i) for d in range(levels) for i in range(1 << d)]
        assert sorted(slots) == list(range((1 << levels) - 1))
    # four levels: a top tree of three nodes, then four bottom trees of three
    assert [merkle.veb_address(4, 2, i) for i in range(4)] == [3, 6, 9, 12]
    assert [merkle.veb_address(4, 3, i) for i in range(8)] == [4, 5, 7, 8, 10, 11, 13, 14]


def _naive_root(digests):
    while len(digests) > 1:
        digests = [hashlib.sha256("".join(digests[i:i + 2]).encode()).hexdigest() for i in range(0, len(digests), 2)]
    return digests[0]


@pytest.mark.parametrize("n", [1, 2, 3, 31, 63, 64])
def test_layout_root_and_paths(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    height = merkle.block_height(n)
    layout = merkle.build_layout(leaves, height)
    root = _naive_root([d.hex() for d in leaves])
    assert layout[:32].hex() == root
    assert {merkle.fold_path(d, merkle.read_path(layout, height, n, i)) for i, d in enumerate(leaves)} == {root}


def test_manifest_edges_match_sql(spark):
    twin(spark, "op11_merkle_manifest", write_tables(documents=EDGE_DOCS))
    assert QUERIES["op11_merkle_manifest"](spark, write_tables()).collect() == []


def test_manifest_of_many_levels_and_copies(spark):
    """Parts around the block size and above two block levels; 300 copies of one row."""
    rng = random.Random(4)
    rows = [(i, f"t{rng.random()}", "aa" if i < 4200 else "bb" if i < 4265 else "cc", "s", 3) for i in range(4300)]
    rows += [(-1, "same", "bb", "s", 4)] * 300
    rng.shuffle(rows)
    twin(spark, "op11_merkle_manifest", write_tables(documents=rows))


def test_tampering_shows(spark):
    root = write_tables(documents=docs_rows([(i, f"text {i}") for i in range(60)]))
    rows = rows_of(QUERIES["op11_merkle_manifest"](spark, root))
    import zlib
    for r in rows:
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0)
        assert (r["folded_root"] == r["root"]) == r["verified"]


def test_extra_columns_do_not_disturb_the_manifest(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1, "x", "y", "z")],
                                 "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos string, k string")
    row = merkle.prove_documents(docs).first()
    assert row.verified and row.path == [] and row.leaf == row.subroot == row.root


# ---- hard negatives
def _brute(rows, positives=5, negatives=3):
    """Rows (id, vector, label) with the query's anchors; ids distinct."""
    took = []
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        took.append((i, [math.floor(256 * float(np.float32(x))) for x in vec],
                     (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    place = lambda i: (i is None, i or 0)                       # noqa: E731
    out = []
    for a in took:
        if a[0] is None or a[0] % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in took
                  if b is not a and len(b[1]) == len(a[1])]
        scored.sort(key=lambda s: (-s[0], place(s[1])))
        for ps, pid, _ in [s for s in scored if s[2] == a[2]][:positives]:
            inside = [s for s in scored if s[2] != a[2] and 50 * ps <= 100 * s[0] <= 95 * ps][:negatives]
            out += [(a[0], pid, n + 1, s[1], ps, s[0]) for n, s in enumerate(inside)]
    return sorted(out, key=repr)


def _mined(spark, rows):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    found = rows_of(QUERIES["op12_hard_negatives"](spark, write_tables(embeddings=rows)))
    return sorted([tuple(r[n] for n in names) for r in found], key=repr)


def _vectors(n, dim, seed, ties=False):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) / 8 + 0.15
    if ties:
        v = np.round(v * 4) / 4
    return v.astype(np.float32)


@pytest.mark.parametrize("n,dim,ties", [(400, 64, False), (400, 13, True), (300, 1, True)])
def test_hard_negatives_match_brute_force(spark, n, dim, ties):
    rows = [(i, v.tolist(), i * 7 % 10) for i, v in enumerate(_vectors(n, dim, n + dim, ties))]
    want = _brute(rows)
    assert want and _mined(spark, rows) == want


def test_hard_negative_edges(spark):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(_vectors(120, 6, 3, True))]
    rows[50] = (50, [0.0] * 6, 1)                               # scores of nothing but zero
    rows += [(200, None, 1), (250, [1.0] * 6, None), (300, [1.0, None, 1, 1, 1, 1], 1), (350, [float("nan")] * 6, 1),
             (400, [float("inf")] * 6, 1), (450, [], 1), (500, [1.0, 2.0], 1), (501, [1.0, 1.0], 1), (502, [1.0, 0.8], 2),
             (None, [0.5] * 6, 2), (None, [0.75] * 6, 0), (-50, [0.5] * 6, 2)]
    want = _brute(rows)
    assert any(r[0] == 500 for r in want) and _mined(spark, rows) == want
    assert _mined(spark, rows + rows[:30]) == want              # equal rows count once
    assert _mined(spark, []) == []
    huge = [(0, [1e30] * 3, 1), (50, [3e9] * 3, 1), (51, [1e6] * 3, 1), (52, [2e6] * 3, 1), (53, [1e6] * 3, 2), (100, [1e6] * 3, 1)]
    assert all(r[0] == 100 for r in _mined(spark, huge))        # too long vectors take no part


def test_hard_negatives_over_several_blocks(spark, monkeypatch):
    rows = [(i, v.tolist(), 1 if i % 3 else i % 10) for i, v in enumerate(_vectors(700, 8, 9))]
    want = _brute(rows)
    monkeypatch.setattr(hardnegatives, "ROW_BLOCK", 64)
    monkeypatch.setattr(hardnegatives, "ANCHOR_BLOCK", 4)
    assert _mined(spark, rows) == want


def _side(vectors, labels):
    q = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    means, devs = hardnegatives.summarise(q.astype(float))
    n = len(q)
    table = pa.table({"id": pa.array(range(n), pa.int64()), "label": pa.array(labels, pa.int64()),
                      "row": pa.array(range(n), pa.int64()), "q": pa.array(q.tolist(), pa.list_(pa.int64())),
                      "means": pa.array(means.tolist(), pa.list_(pa.float64())),
                      "devs": pa.array(devs.tolist(), pa.list_(pa.float64()))})
    return hardnegatives._Side(table, np.arange(n), q.shape[1])


def test_segment_bounds_hold_and_discard_pairs():
    """On vectors with smooth segments the summaries decide most pairs before exact scoring."""
    rng = np.random.default_rng(1)
    steps = np.repeat(rng.normal(size=(300, 8)), 8, axis=1) + rng.normal(size=(300, 64)) * 0.05
    side = _side(steps, [0] * 300)
    exact = hardnegatives._exact(side, side)
    for segments in hardnegatives.LEVELS:
        mean, dev = hardnegatives.coarsen(side.means, side.devs, segments)
        width = side.width * hardnegatives.SEGMENTS // segments
        centre, spread = width * mean @ mean.T, width * dev @ dev.T
        assert (exact <= centre + spread + 1).all() and (exact >= centre - spread - 1).all()
    low = np.sort(exact, axis=1)[:, -5]
    high = np.full(300, 1 << 60)
    i, j, scores, scored = hardnegatives.survivors(side, side, low, high, np.ones((300, 300), bool))
    assert len(i) == (exact >= low[:, None]).sum() and (scores == exact[i, j]).all()
    assert scored < 0.05 * exact.size


def test_window_is_exact_for_large_scores():
    for p in (0, 1, -1, 7, 99, 101, -350, (1 << 62) - 3):
        lo, hi = hardnegatives._window(np.array([p]), 50, 95)
        assert (lo[0], hi[0]) == (-(-50 * p // 100), 95 * p // 100)


# ---- url filters
def _page(text):
    body = text.replace("&", "&amp;").replace("<", "&lt;")
    return f"<html><body><nav>menu</nav><article><h1>{body[:10]}</h1><p><b>{body}</p></article></body></html>"


def test_hosts_with_bad_outcomes_are_blocked(spark):
    docs, labels, pages = [], [], []
    for i in range(400):
        bad = i < 120
        docs.append((i, f"text <{i}> & more", "en", "s", 3))
        labels.append((i, 0 if bad else 1, 0))
        host = "spam.bad.net" if bad else f"site{i % 8}.good.com"
        pages.append((i, f"https://{host}/en/{i}", _page(docs[-1][1])))
    pages += [(1000, "http://spam.bad.net/unlabelled", None), (1001, "http://new.unseen.net/", None),
              (1002, "http://one.good.com/x", _page(docs[5][1])),            # a single bad outcome
              (1003, "http://SPAM.bad.NET/es/1?q=http://a.org/", None)]
    root = write_tables(documents=docs, labels=labels, pages=pages)
    twin(spark, "op13_url_filter", root)
    got = {r["page_id"]: r for r in rows_of(QUERIES["op13_url_filter"](spark, root))}
    assert {got[i]["verdict"] for i in (*range(120), 1000, 1003)} == {"block"}
    assert {got[i]["verdict"] for i in (*range(120, 400), 1002)} == {"allow"}


URLS = [None, "", "no scheme", "://", "HTTP://EXAMPLE.Org/es/a", "http://a.example.org/en/12?x#y", "http://notexample.org/es/",
        "http://x.com/de/", "http://x.com/de", "http://x.com?/de/", "http://com/fr/#", "http://org", "http://org/",
        "http://Ä.ORG/È", "a://b://c/d", "http://u@h:80/p?q", "http://x.com/FR/", "http://example.org/en/2", "http://" + "a" * 100_000 + ".org/",
        "line\nbreak://h.org/p\nq?r"]


def test_url_edges_match_sql(spark):
    pages = [(n, u, None) for n, u in enumerate(URLS)] + [(None, "http://a.org/", ""), (3, "http://x.de/1", "<article></article>")] * 2
    docs = EDGE_DOCS + [(12, "x", "en", "s", 1)]
    labels = [(5, 0, None), (5, 1, 1), (12, 1, 0), (None, 0, 0), (9, 0, 1), (77, 0, 0), (11, None, None)]
    pages.append((40, "http://x.de/2", _page("x")))
    root = write_tables(documents=docs, labels=labels, pages=pages)
    twin(spark, "op13_url_filter", root)
    rows = {r["page_id"]: r for r in rows_of(QUERIES["op13_url_filter"](spark, root))}
    assert (rows[0]["host"], rows[0]["path"], rows[2]["host"]) == ("", "", "")
    assert (rows[4]["host"], rows[4]["rule"], rows[4]["verdict"]) == ("example.org", "example.org/es/", "block")
    assert rows[5]["rule"] == "example.org/en/1" and rows[6]["rule"] == "org/" and rows[9]["rule"] is None
    assert QUERIES["op13_url_filter"](spark, write_tables()).collect() == []


def test_rules_and_suffixes(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("shop.a.co.uk",), ("a.co.uk",), ("co.uk",), ("uk",), ("",)], "h string")
    domain, suffix = urlfilter.registered_parts(F.col("h"), ["co.uk"])
    got = [tuple(r) for r in df.select(domain, suffix).collect()]
    assert got == [("a.co.uk", "co.uk"), ("a.co.uk", "co.uk"), ("co.uk", "co.uk"), ("uk", "uk"), ("", "")]
    assert urlfilter.Rule("allow", "org", "/") == URL_RULES[0]


def test_large_tables_join_salted(spark, monkeypatch):
    """With nothing small enough to broadcast, the verdicts are the same."""
    root = write_tables(documents=docs_rows([(i, f"t {i % 30}") for i in range(90)]),
                        labels=[(i, i % 2, 0) for i in range(60)],
                        pages=[(i, f"http://h{i % 4}.net/{i}", _page(f"t {i % 40}")) for i in range(120)])
    monkeypatch.setattr(urlfilter, "broadcast_if_bounded", lambda df: (df, False))
    twin(spark, "op13_url_filter", root)
