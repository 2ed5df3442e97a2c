"""SimHash near-duplicates through pivot distance tables.

A fingerprint has one bit per position that is set in over half of the XXH64 (seed 42)
hashes of the text's word shingles. Two fingerprints link when they differ in at most
`max_bits` bits; documents of linked fingerprints form one component.

Search, without forming all pairs:
1. Fingerprints are made distinct first, so exact copies (however many) are one node.
2. Every node gets a table of Hamming distances to `PIVOTS` reference fingerprints.
3. Cells: bits are cut into max_bits + 2 groups; at most max_bits differing bits leave two
   groups untouched, so a linked pair has the same coordinates against the one-bit
   references of some two groups. Nodes meet only inside such a cell, which loses no link.
   A cell above `CELL_ROWS` nodes is cut into blocks, and every pair of blocks is a
   separate unit of work, so a hot cell is spread out and nothing is capped.
4. Inside a cell, a pair whose pivot tables differ by more than max_bits in any coordinate
   is discarded (triangle inequality); survivors are verified bit by bit.
5. Each cell reports a spanning forest (at most one row per member), not its pairs;
   components are joined globally.

Defined cases: null or wordless text has fingerprint zero and links like any other; fewer
words than a shingle hash as one sequence; repeated rows get the same component; a
component whose ids are all null has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orebridge.llm.common import connected_components, same_row, ship_code, text_hash, whole_text
from orebridge.operators import attach
from orebridge.session import reliable_checkpoint

HASH_SEED = 42
PIVOTS = 16                 # reference fingerprints of the distance table
CELL_ROWS = 2048            # nodes of a cell handled as one block
SLICE = 1 << 16             # shingles turned into bits at once


def _one_fingerprint(text: str, k: int) -> int:
    from xxhash import xxh64_intdigest as digest
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return 0
    buf = b" ".join(words)
    if n <= k:
        hashes = np.array([digest(buf, HASH_SEED)], dtype="<u8")
    else:
        stops = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
        starts = np.concatenate(([0], stops[:n - k] + 1))
        hashes = np.fromiter((digest(buf[a:b], HASH_SEED) for a, b in
                              zip(starts.tolist(), stops[k - 1:].tolist())),
                             dtype="<u8", count=n - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at:at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle_words: int):
    @F.pandas_udf("long")
    def fingerprint(texts):
        import pandas as pd
        return pd.Series([_one_fingerprint(t, shingle_words) for t in texts], dtype="int64")
    return fingerprint


def reference_fingerprints(count: int = PIVOTS) -> list[int]:
    """Fixed pseudo-random 64-bit references (signed), from a hash of their number."""
    from xxhash import xxh64_intdigest as digest
    return [int(np.uint64(digest(f"pivot-{i}".encode(), HASH_SEED)).astype(np.int64))
            for i in range(count)]


def _group_masks(max_bits: int) -> list[int]:
    """Masks (signed) of the bit-group pairs that define the cells."""
    groups = np.array_split(np.arange(64), max_bits + 2)
    masks = []
    for a, b in combinations(groups, 2):
        m = sum(1 << int(j) for j in (*a, *b))
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _cells(nodes: DataFrame, max_bits: int) -> DataFrame:
    table = F.concat(*[F.unhex(F.lpad(F.hex(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long")), 2, "0"))
                       for p in reference_fingerprints()])
    masks = F.array(*[F.lit(m) for m in _group_masks(max_bits)])
    return (nodes.select("fp", table.alias("table"))
            .select("fp", "table", F.posexplode(masks).alias("cell", "mask"))
            .select("fp", "table", F.col("cell").cast("short").alias("cell"),
                    F.col("fp").bitwiseAND(F.col("mask")).alias("at")))


def _split_hot(cells: DataFrame, cell_rows: int) -> DataFrame:
    """Add `block`: 0 for ordinary cells; rows of a cell above `cell_rows` are dealt to
    blocks and repeated once per other block, so that every two rows meet in some block."""
    hot = (cells.groupBy("cell", "at").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
           .withColumn("parts", F.ceil(F.col("n") / cell_rows).cast("int")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    split = (cells.join(hot, ["cell", "at"], "left").withColumn("own", own)
             .withColumn("block", F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
                 F.transform(other, lambda o: F.least(F.col("own"), o).cast("long") * F.col("parts")
                             + F.greatest(F.col("own"), o)))))
    return split.select("fp", "table", "cell", "at", F.explode("block").alias("block"))


def _local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of `count` local nodes under edges a-b."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def linked_forest(fp: np.ndarray, table: np.ndarray, run: np.ndarray, max_bits: int):
    """Links between members of the same run (`run` = sorted run number per row), reported
    as (node, smaller node) rows that connect the same nodes."""
    ends = np.searchsorted(run, run, side="right")
    at, lag = np.arange(len(fp)), 0
    left, right, kept = [], [], 0
    while True:
        lag += 1
        at = at[at + lag < ends[at]]
        if not len(at):
            break
        near = np.abs(table[at] - table[at + lag]).max(axis=1) <= max_bits
        a = at[near]
        a = a[np.bitwise_count(fp[a] ^ fp[a + lag]) <= max_bits]
        left.append(a)
        right.append(a + lag)
        kept += len(a)
        if kept > 1 << 20:
            root = _local_roots(len(fp), np.concatenate(left), np.concatenate(right))
            left, right = [np.flatnonzero(root != np.arange(len(fp)))], []
            right, kept = [root[left[0]]], len(left[0])
    if not kept:
        return fp[:0], fp[:0]
    values, inverse = np.unique(fp, return_inverse=True)
    root = _local_roots(len(values), inverse[np.concatenate(left)], inverse[np.concatenate(right)])
    member = np.flatnonzero(root != np.arange(len(values)))
    return values[member], values[root[member]]


def _forest_batches(batches, max_bits: int):
    """Runs of equal (cell, at, block) from sorted rows; a run that continues in the next
    batch is carried over, so at most one run (bounded by the block size) waits."""
    import pyarrow as pa
    rest = None

    def out(fp, table, key):
        edge = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        run = np.zeros(len(fp), dtype=np.int64)
        run[edge] = 1
        u, v = linked_forest(fp, table, np.cumsum(run), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(u.view("i8")), pa.array(v.view("i8"))], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view("u8")
        column = batch.column("table")
        table = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(fp), -1).astype(np.int16)
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                        for c in ("cell", "at", "block")], axis=1)
        if rest is not None:
            fp, table, key = (np.concatenate(x) for x in zip(rest, (fp, table, key)))
        whole = np.flatnonzero((key != key[-1]).any(axis=1))
        cut = whole[-1] + 1 if len(whole) else 0
        rest = fp[cut:], table[cut:], key[cut:]
        if cut:
            yield out(fp[:cut], table[:cut], key[:cut])
    if rest is not None:
        yield out(*rest)


def fingerprint_links(nodes: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v) rows that connect exactly the distinct fingerprints `nodes.fp` linked at
    `max_bits` or fewer differing bits."""
    ship_code(nodes.sparkSession)
    units = _split_hot(_cells(nodes, max_bits), cell_rows)
    keys = ("cell", "at", "block")
    return (units.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda it: _forest_batches(it, max_bits), "u long, v long"))


def fingerprint_components(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4,
                           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, __llm_hash (text hash), fp (long), component_id."""
    ship_code(docs.sparkSession)
    fingerprint = fingerprint_udf(shingle_words)
    rows = reliable_checkpoint(docs.select(
        F.col(id_col).alias("doc_id"), text_hash(text).alias("__llm_hash"),
        fingerprint(whole_text(text)).alias("fp")))
    nodes = reliable_checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    parts = connected_components(fingerprint_links(nodes, max_bits))
    linked = nodes.join(parts.withColumnRenamed("node", "fp"), "fp")
    # a component may hold most fingerprints: its smallest id comes back by broadcast or salt
    least = linked.groupBy("root").agg(F.min("low").alias("least"))
    found = attach(linked, least, ["root"], "inner").select("fp", "root", "least")
    # every other fingerprint is a component of its own
    of = nodes.join(found, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id"))
    return rows.join(of, "fp").select("doc_id", "__llm_hash", "fp", "root", "component_id")


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    parts = fingerprint_components(docs, shingle_words, max_bits)
    return parts.select("doc_id", fingerprint_hex().alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the
    smallest doc_id stays (null ids last; equal ids by text hash, then by row hash)."""
    parts = fingerprint_components(docs, shingle_words, max_bits)
    first = (parts.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "__llm_hash")).alias("keep"))
        .select(F.col("keep.doc_id").alias("doc_id"), F.col("keep.__llm_hash").alias("__llm_hash")))
    marked = docs.withColumn("__llm_hash", text_hash())
    kept = marked.alias("d").join(first.alias("f"), same_row("d", "f", ("doc_id", "__llm_hash")), "left_semi")
    order = W.partitionBy("doc_id", "__llm_hash").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return kept.withColumn("__llm_n", F.row_number().over(order)).where("__llm_n = 1").select(*docs.columns)
