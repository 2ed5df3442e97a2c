"""Operators against brute force: near-duplicates, decontamination, packing."""

import random

import numpy as np
import pytest

from orebridge.llm import decontaminate, packing, simhash
from orebridge.llm.queries import QUERIES, vocabulary
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.helpers import docs_rows, read_pairs, rows_of, write_tables

LONG = "the quick brown fox jumps over a lazy dog near the old river bank at dawn while birds sing " * 300
EDGE = [(1, None), (2, ""), (3, "  \t\n "), (4, "one two"), (5, "ONE two"), (6, LONG), (6, LONG),
        (None, "a b c d e f g h i j k l m n o"), (7, "a b c d e f g h i j k l m n o"), (8, "Ünï çödé É é"),
        (9, "x" * 30_000), (None, None)]


def near_copies(seed=5, words=120, copies=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(copies):
        w = list(base)
        w[rng.randrange(words)] = f"z{i}"
        out.append((1000 + i, " ".join(w)))
    return out


def components_of(df, rows):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in rows_of(df))
    want = brute.components(rows)
    return got, sorted((d is None, d or 0, *want[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("extra", [EDGE, EDGE + near_copies()])
def test_simhash_edges(spark, extra):
    sf = write_tables(documents=docs_rows(extra))
    got, want = components_of(QUERIES["op8_simhash"](spark, sf), extra)
    assert got == want


def test_simhash_whole_table(spark):
    got, want = components_of(QUERIES["op8_simhash"](spark, SF_CHECK), read_pairs(SF_CHECK))
    assert got == want


def test_simhash_empty(spark):
    assert rows_of(QUERIES["op8_simhash"](spark, write_tables())) == []


@pytest.mark.parametrize("cell_rows", [3, 2048])
def test_hot_cells_lose_no_link(spark, cell_rows):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = {base}
    while len(values) < 120:
        v = base
        for b in rng.sample(range(64), rng.randrange(1, 7)):
            v ^= 1 << b
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(60)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in sorted(values)]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.fingerprint_links(nodes, 4, cell_rows)
    from orebridge.llm.common import connected_components
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: got.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_keep_one_per_component(spark):
    rows = EDGE + near_copies()
    docs = spark.read.parquet(write_tables(documents=docs_rows(rows)) + "/documents.parquet")
    kept = rows_of(simhash.keep_one_per_component(docs))
    want = brute.components(rows)
    assert len(kept) == len({c if c is not None else f for f, c in want.values()})
    for r in kept:
        assert any(c == r["doc_id"] for _, c in want.values())


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
ITEMS = [(1, ITEM), (2, "Short Item here"), (3, ""), (4, None), (5, ITEM), (6, "É one é two"), (7, "solo"),
         (8, " ".join(f"r{i % 3}" for i in range(40)))]
CONTAMINATED = [
    (20, f"xx {ITEM.upper()} yy"), (21, "pad " * 400 + ITEM), (22, " ".join(ITEM.split()[:12])),
    (23, " ".join(ITEM.split()[1:14]) + " tail"), (24, "some SHORT, item; here and solo"), (25, "é one É two"),
    (26, "É ONE é two"), (27, " ".join(f"r{i % 3}" for i in range(60))), (28, f"{ITEM} {ITEM}"), (28, f"{ITEM} {ITEM}"),
    (28, "other text"), (None, ITEM)]


def contamination_rows(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"],
                    r["items_sha256"], r["contaminated"]) for r in rows_of(df)))


def want_contamination(docs, items):
    return sorted((d is None, d or 0, *rest) for d, *rest in brute.contamination(docs, items))


@pytest.mark.parametrize("broadcast_rows", [0, decontaminate.BROADCAST_ROWS])
def test_decontamination_edges(spark, broadcast_rows):
    docs = EDGE + CONTAMINATED
    sf = write_tables(documents=docs_rows(docs), benchmark=ITEMS)
    rows = decontaminate.contamination(spark.read.parquet(f"{sf}/documents.parquet"),
                                       spark.read.parquet(f"{sf}/benchmark.parquet"),
                                       broadcast_rows=broadcast_rows)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], len(r["items"]),
                  brute.sha(",".join(r["items"])), r["contaminated"]) for r in rows_of(rows))
    assert got == want_contamination(docs, ITEMS)


def test_decontamination_empty_sides(spark):
    docs = docs_rows(EDGE)
    got = contamination_rows(QUERIES["op7_decontamination"](spark, write_tables(documents=docs)))
    assert got == want_contamination(EDGE, [])
    assert rows_of(QUERIES["op7_decontamination"](spark, write_tables(benchmark=ITEMS))) == []


def test_decontamination_whole_table(spark):
    got = contamination_rows(QUERIES["op7_decontamination"](spark, SF_CHECK))
    assert got == want_contamination(read_pairs(SF_CHECK), read_pairs(SF_CHECK, "benchmark", "item_id"))


def test_packing_edges(spark):
    odd = EDGE + [(30, "İstanbul ΟΔΟΣ é ́x J̌ a\x1cb 3.14 it's DON'T... <|endoftext|>, ,.,. _., ½² ǅ"),
                  (31, "word " * 9000), (32, "nostop" * 4000)]
    sf = write_tables(documents=docs_rows(odd))
    brute.check_pieces(rows_of(QUERIES["op2_packing"](spark, sf)), odd, vocabulary())
    assert rows_of(QUERIES["op2_packing"](spark, write_tables())) == []


def test_packing_whole_table(spark):
    share = brute.check_pieces(rows_of(QUERIES["op2_packing"](spark, SF_SMALL)), read_pairs(SF_SMALL), vocabulary())
    assert share < 0.03


def test_packing_blocks_and_bounded_cache():
    docs = read_pairs(SF_CHECK)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])],
                                       ["doc_id", "text"])
    enc = packing.encoder(vocabulary())
    enc.entries, enc.young, enc.old, enc.marks = 500, {}, {}, {}
    try:
        out = [r for b in packing.pack_partition([batch], vocabulary(), 512, 2, 1, block_tokens=5000)
               for r in b.to_pylist()]
    finally:
        enc.entries = packing.CACHE_ENTRIES
    assert brute.check_pieces(out, docs, vocabulary(), 512) < 0.08


def test_cached_words_equal_the_tokenizer():
    """A small cache gives the tokenizer's ids for any characters."""
    rng = random.Random(1)
    signs = [chr(i) for i in range(0x20, 0x250)] + list(" .,' \t\n\x1c\xa0\u0301\u0307\u200bΣςıſ’“中文字漢カ가ß" * 3)
    latin = [c for c in map(chr, range(0x41, 0x180)) if c.isalpha()]
    texts = ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choices(latin, k=rng.randint(1, 9))) + rng.choice(["", ".", ",", "!?", "'s"])
                       for _ in range(20)) for _ in range(500)]
    texts += ["ŉ ª º", "ΑΣ ΣΑΣ", "x" * 500, "A" * 70 + ". " + "b" * 70, "it's I'LL <|endoftext|>"]
    enc = packing.WordCachedEncoder(vocabulary(), 300)
    want = [e.ids for e in enc.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in enc.ids(texts)] == want
    assert max(map(len, enc.young)) <= packing.LONG_WORD


def test_cuts_are_optimal():
    """The monotone queue finds the cost of the plain quadratic recurrence."""
    rng = random.Random(11)
    for _ in range(30):
        at = np.array(sorted(rng.sample(range(1, 400), 60) + [400]))
        pen = np.array([rng.choice([0, 4]) for _ in at])
        cap = 64
        at, pen = at[np.concatenate(([True], np.diff(at) > 0))], pen[:len(set(at.tolist()))]
        if np.diff(np.concatenate(([0], at))).max() > cap:
            continue
        cuts = packing.best_cuts(at, pen, cap)
        pos, cost = [0, *at.tolist()], [0.0]
        penalty = dict(zip(at.tolist(), pen.tolist()))
        def window(n):
            return 0 if n & (n - 1) == 0 else cap - n
        for j in range(1, len(pos)):
            cost.append(min(cost[i] + window(pos[j] - pos[i]) for i in range(j) if pos[j] - pos[i] <= cap)
                        + penalty[pos[j]] + packing.PER_SEQUENCE)
        got = sum(window(b - a) + penalty[b] + packing.PER_SEQUENCE for a, b in zip([0, *cuts], cuts))
        assert got == cost[-1]
