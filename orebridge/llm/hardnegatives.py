"""Hard-negative mining: per anchor and positive, the best rows of other labels inside a
window of the positive's score, found by segment summary filtering.

A vector is cut into SEGMENTS segments; of each the mean and the deviation are stored. For
two vectors, a segment's part of the inner product lies within width * (product of the means
+- product of the deviations), so the sums over the segments bound the score. Coarser
summaries (1, 2, 4 segments) follow exactly from the stored ones: a pair is bounded by one
segment first, what survives by two, and so on; only pairs left at the finest level are
scored exactly.

Anchors and rows are dealt into blocks by hash, and every pair of blocks is one bounded
Spark group, so a hot label or a vector with many copies spreads over all of them. Each
group returns its best few, which windows merge. The work is anchors x rows by the task's
nature; what a group holds is not.

Rows: a null label, a null vector or a null or non-finite component takes no part, nor does
a vector whose quantised squared length exceeds 2**62 (its scores might not fit a long).
Only vectors of equal length are compared. Rows equal in id, label and vector count once;
ids may be null (sorted last, never an anchor unless the caller's condition says so) or
repeated with other vectors. Ties go to the smaller id. No anchors or an empty table give an
empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from orebridge.llm.common import ship_code
from orebridge.session import reliable_checkpoint

# Stored segments per vector; summaries of 1, 2 and 4 segments are derived from them.
SEGMENTS = 8
LEVELS = (1, 2, 4, 8)
# Rows and anchors per block (expected, by hash).
ROW_BLOCK = ANCHOR_BLOCK = 1024
# Anchors bounded against one row block at a time: 8 MB a matrix.
CHUNK = 256
# Above this share of surviving pairs, whole matrices are cheaper than single pairs.
DENSE = 0.1
# Longest quantised vector (squared) whose inner products surely fit a long.
MAX_SQUARE = float(1 << 62)
NO_ID = (1 << 63) - 1


# ---- summaries
def _matrix(lists: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """Equally long lists as a matrix."""
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, len(flat) // n if n else 0)


def summarise(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each of SEGMENTS segments; short vectors are filled up with
    zeros, which changes no inner product."""
    n, dim = q.shape
    width = max(-(-dim // SEGMENTS), 1)
    cut = np.zeros((n, SEGMENTS * width))
    cut[:, :dim] = q
    cut = cut.reshape(n, SEGMENTS, width)
    return cut.mean(axis=2), cut.std(axis=2)


def coarsen(means: np.ndarray, devs: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of `segments` longer segments from the stored ones."""
    if segments == SEGMENTS:
        return means, devs
    shape = (len(means), segments, SEGMENTS // segments)
    mean = means.reshape(shape).mean(axis=2)
    square = (devs ** 2 + means ** 2).reshape(shape).mean(axis=2)
    return mean, np.sqrt(np.maximum(square - mean ** 2, 0.0))


def _summaries(batches):
    for batch in batches:
        vectors = batch.column("q")
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        means, devs = np.zeros((len(sizes), SEGMENTS)), np.zeros((len(sizes), SEGMENTS))
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            means[at], devs[at] = summarise(_matrix(vectors.take(pa.array(at))).reshape(len(at), dim))
        for name, values in (("means", means), ("devs", devs)):
            offsets = pa.array(np.arange(0, values.size + 1, SEGMENTS), pa.int32())
            batch = batch.append_column(name, pa.ListArray.from_arrays(offsets, pa.array(values.ravel())))
        yield batch


def summarised_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str,
                    anchors: Column, scale: int) -> DataFrame:
    """Rows that take part, once each: id, label, anchor?, q = floor(scale * component), the
    segment summaries and a row hash. Materialised."""
    ship_code(rows.sparkSession)
    vec = F.col(vector_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    took = rows.where(F.col(label_col).isNotNull() & vec.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("q"))
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    once = (took.where(square <= MAX_SQUARE).groupBy("id", "label", "q").agg(F.max("is_anchor").alias("is_anchor"))
            .select("id", "label", "q", "is_anchor", F.xxhash64("id", "label", "q").alias("row")))
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*once.schema.fields, T.StructField("means", doubles), T.StructField("devs", doubles)])
    return reliable_checkpoint(once.mapInArrow(_summaries, schema))


# ---- one pair of blocks
class _Side:
    """The anchors or rows of one group with one vector length."""

    def __init__(self, table: pa.Table, at: np.ndarray, dim: int):
        part = table.take(pa.array(at)).combine_chunks()

        def whole(name):
            return part.column(name).combine_chunks()

        self.ids = whole("id").fill_null(NO_ID).to_numpy()
        self.known = whole("id").is_valid().to_numpy(zero_copy_only=False)
        self.rows, self.labels = whole("row").to_numpy(), whole("label").to_numpy()
        self.q = _matrix(whole("q"), np.int64).reshape(len(at), dim)
        self.means, self.devs = _matrix(whole("means")), _matrix(whole("devs"))
        self.width = max(-(-dim // SEGMENTS), 1)
        self.norms = np.sqrt((self.q.astype(np.float64) ** 2).sum(axis=1))
        self.part = part

    def some(self, at):
        new = object.__new__(_Side)
        for name in ("ids", "known", "rows", "labels", "q", "means", "devs", "norms"):
            setattr(new, name, getattr(self, name)[at])
        new.width = self.width
        return new


def _exact(a: _Side, r: _Side, i=None, j=None) -> np.ndarray:
    """Exact integer scores of all pairs, or of the pairs (i, j)."""
    small = len(a.norms) and len(r.norms) and a.norms.max() * r.norms.max() < 1 << 52
    x, y = (a.q.astype(np.float64), r.q.astype(np.float64)) if small else (a.q, r.q)
    scores = x @ y.T if i is None else np.einsum("ij,ij->i", x[i], y[j])
    return scores.astype(np.int64)


def survivors(a: _Side, r: _Side, low: np.ndarray, high: np.ndarray, allowed: np.ndarray):
    """(i, j, score) of allowed pairs whose score lies within the anchor's low .. high, and the
    number of pairs scored exactly. Pairs leave as soon as a level's bounds exclude them."""
    slack = 1.0 + 1e-9 * a.norms * (r.norms.max() if len(r.norms) else 0.0)
    lo, hi = low - slack, high + slack
    keep = allowed
    i = j = None                                    # pair lists, once few pairs are left
    for segments in LEVELS:
        (ma, da), (mr, dr) = coarsen(a.means, a.devs, segments), coarsen(r.means, r.devs, segments)
        width = a.width * SEGMENTS // segments
        if i is None:
            centre, spread = width * (ma @ mr.T), width * (da @ dr.T)
            keep &= (centre + spread >= lo[:, None]) & (centre - spread <= hi[:, None])
            if keep.sum() <= DENSE * keep.size:
                i, j = np.nonzero(keep)
        else:
            centre = width * np.einsum("ij,ij->i", ma[i], mr[j])
            spread = width * np.einsum("ij,ij->i", da[i], dr[j])
            kept = (centre + spread >= lo[i]) & (centre - spread <= hi[i])
            i, j = i[kept], j[kept]
    if i is None:
        i, j = np.nonzero(keep)
        scores = _exact(a, r)[i, j]
    else:
        scores = _exact(a, r, i, j)
    inside = (scores >= low[i]) & (scores <= high[i])
    return i[inside], j[inside], scores[inside], len(i)


def _ordered(r: _Side, i, j, scores):
    """Pairs by anchor, best score first, ties by the smaller id (null last)."""
    at = np.lexsort((r.rows[j], r.ids[j], ~r.known[j], -scores, i))
    return i[at], j[at], scores[at]


def _first(groups: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first k entries of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, int)
    place = np.arange(len(groups)) - np.repeat(starts, np.diff(np.r_[starts, len(groups)]))
    return place < k


def _best_of_label(a: _Side, r: _Side, k: int):
    """(i, j, score): the best k rows of the anchor's label in this block, itself left out."""
    found = []
    for label in np.unique(a.labels):
        rows = np.flatnonzero(r.labels == label)
        if not len(rows):
            continue
        mine, sub = np.flatnonzero(a.labels == label), r.some(rows)
        for start in range(0, len(mine), CHUNK):
            at = mine[start:start + CHUNK]
            b = a.some(at)
            other = b.rows[:, None] != sub.rows[None, :]
            low = np.full(len(at), np.iinfo(np.int64).min // 2, np.int64)
            if len(rows) > k:                       # the k likeliest give a first limit
                centre = np.where(other, b.means @ sub.means.T, -np.inf)
                likely = np.argpartition(-centre, k - 1, axis=1)[:, :k]
                i = np.repeat(np.arange(len(at)), k)
                seen = _exact(b, sub, i, likely.ravel()).reshape(len(at), k)
                full = np.take_along_axis(other, likely, axis=1).all(axis=1)
                low[full] = seen.min(axis=1)[full]
            i, j, s, _ = survivors(b, sub, low, np.full(len(at), np.iinfo(np.int64).max // 2, np.int64), other)
            i, j, s = _ordered(sub, i, j, s)
            top = _first(i, k)
            found.append((at[i[top]], rows[j[top]], s[top]))
    return found


def _window(scores: np.ndarray, low: int, high: int):
    """Least and greatest integer score between low % and high % of a positive's score."""
    def share(p):
        return p * (scores // 100), p * (scores % 100)      # no product of a whole score
    (lo, lo_rest), (hi, hi_rest) = share(low), share(high)
    return lo - (-lo_rest // 100), hi + hi_rest // 100


def _best_in_windows(a: _Side, r: _Side, positives: np.ndarray, k: int, low: int, high: int):
    """(i, positive number, j, score): the best k rows of other labels inside each positive's
    window. `positives`: scores per anchor, filled up with 0 and masked by `has`."""
    scores, has = positives
    lo, hi = _window(scores, low, high)
    has = has & (lo <= hi)
    found = []
    for start in range(0, len(a.ids), CHUNK):
        at = np.arange(start, min(start + CHUNK, len(a.ids)))
        at = at[has[at].any(axis=1)]
        if not len(at):
            continue
        b = a.some(at)
        least = np.where(has[at], lo[at], np.iinfo(np.int64).max // 2).min(axis=1)
        most = np.where(has[at], hi[at], np.iinfo(np.int64).min // 2).max(axis=1)
        i, j, s, _ = survivors(b, r, least, most, b.labels[:, None] != r.labels[None, :])
        i, j, s = _ordered(r, i, j, s)
        for number in range(scores.shape[1]):
            mine = at[i]
            inside = has[mine, number] & (s >= lo[mine, number]) & (s <= hi[mine, number])
            top = _first(i[inside], k)
            found.append((at[i[inside][top]], np.full(int(top.sum()), number), j[inside][top], s[inside][top]))
    return found


def _sides(left: pa.Table, right: pa.Table):
    """Anchors and rows of equal vector length."""
    if not left.num_rows or not right.num_rows:
        return
    sizes = [np.array([len(v) for v in t.column("q")], int) for t in (left, right)]
    for dim in np.unique(sizes[0]):
        rows = np.flatnonzero(sizes[1] == dim)
        if len(rows):
            yield _Side(left, np.flatnonzero(sizes[0] == dim), dim), _Side(right, rows, dim)


_POSITIVES = "anchor_row long, positive_id long, positive_row long, positive_score long"
_NEGATIVES = ("anchor_row long, anchor_id long, positive_no int, positive_id long, positive_score long, "
              "negative_id long, negative_row long, negative_score long")


def _ids(side: _Side, at) -> pa.Array:
    return pa.array(side.ids[at], pa.int64(), mask=~side.known[at])


def _empty(names: list[str]) -> pa.Table:
    return pa.table({n: pa.array([], pa.int32() if n == "positive_no" else pa.int64()) for n in names})


def _positive_groups(k: int):
    names = [c.split()[0] for c in _POSITIVES.split(", ")]

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [_empty(names)]
        for a, r in _sides(left, right):
            for i, j, s in _best_of_label(a, r, k):
                out.append(pa.table([pa.array(a.rows[i]), _ids(r, j), pa.array(r.rows[j]), pa.array(s)], names=names))
        return pa.concat_tables(out)
    return group


def _negative_groups(k: int, low: int, high: int):
    names = [c.split()[0] for c in _NEGATIVES.split(", ")]

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [_empty(names)]
        for a, r in _sides(left, right):
            lists = a.part.column("positives").to_pylist()
            widest = max(map(len, lists), default=0)
            scores, has = np.zeros((len(lists), widest), np.int64), np.zeros((len(lists), widest), bool)
            for n, found in enumerate(lists):
                scores[n, :len(found)], has[n, :len(found)] = [p["score"] for p in found], True
            for i, no, j, s in _best_in_windows(a, r, (scores, has), k, low, high):
                chosen = [lists[x][y] for x, y in zip(i, no)]
                out.append(pa.table([
                    pa.array(a.rows[i]), _ids(a, i), pa.array(no, pa.int32()),
                    pa.array([p["id"] for p in chosen], pa.int64()), pa.array(scores[i, no]),
                    _ids(r, j), pa.array(r.rows[j]), pa.array(s)], names=names))
        return pa.concat_tables(out)
    return group


# ---- the jobs
def _in_blocks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, group, schema: str) -> DataFrame:
    """`group` over every pair of an anchor block and a row block. Each anchor goes once to
    every row block and each row once to every anchor block."""
    a_blocks, r_blocks = -(-n_anchors // ANCHOR_BLOCK) or 1, -(-n_rows // ROW_BLOCK) or 1

    def dealt(df, mine, n_mine, theirs, n_theirs):
        return df.withColumns({mine: F.pmod(F.xxhash64("row"), F.lit(n_mine)),
                               theirs: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_theirs - 1).cast("long")))})

    left = dealt(anchors, "a_block", a_blocks, "r_block", r_blocks)
    right = dealt(rows, "r_block", r_blocks, "a_block", a_blocks)
    keys = ["a_block", "r_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(group, schema)


def _ranked(df: DataFrame, keys: list[str], side: str, k: int, out: str) -> DataFrame:
    """The best k of each key: score first, then id (null last), then the row hash."""
    w = W.partitionBy(*keys).orderBy(F.col(f"{side}_score").desc(), F.col(f"{side}_id").asc_nulls_last(), f"{side}_row")
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def mine_hard_negatives(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column,
                        positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                        scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor
    and each of its best `positives` rows of its label, the best `negatives` rows of other
    labels whose score lies between `low` and `high` percent of the positive's."""
    table = summarised_rows(rows, id_col, vector_col, label_col, anchors, scale)
    n_rows, n_anchors = table.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    picked = table.where("is_anchor")
    found = _in_blocks(picked, table, n_anchors, n_rows, _positive_groups(positives), _POSITIVES)
    best = _ranked(found, ["anchor_row"], "positive", positives, "no")
    lists = best.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct(
        "no", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    armed = reliable_checkpoint(picked.join(lists.withColumnRenamed("anchor_row", "row"), "row"))
    pairs = _in_blocks(armed, table, n_anchors, n_rows, _negative_groups(negatives, low, high), _NEGATIVES)
    ranked = _ranked(pairs, ["anchor_row", "positive_no"], "negative", negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
