"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Every
text's k-gram hashes are winnowed: in each run of `W` consecutive k-grams the smallest hash
is kept. Two texts that share `WINDOW` = K + W - 1 words share all the k-grams of that span
and therefore its minimum, so joining document and benchmark fingerprints misses no shared
window. Hits are then extended: each window of 13 words around a hit is compared word for
word with the benchmark's windows, which also removes hash collisions.

An item shorter than a window (but not wordless) is one window of its own length; winnowing
guarantees nothing there, so the document windows of each such length are hashed without
selection, joined by hash and compared in the same way.

Joins carry slim rows; the benchmark side is broadcast only if its fingerprints, counted,
number at most `BROADCAST_ROWS`, and shuffled otherwise. Whole texts are shuffled once, to
meet their hits.

Defined cases: null or wordless text has no words and is never contaminated; wordless items
count nowhere; repeated rows get equal answers; items repeated under other ids all count;
null item ids are left out of the item list; an empty benchmark or table gives zeros or no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orebridge.llm.common import hint_if_small, text_hash, whole_text
from orebridge.operators import broadcast_if_bounded, join_on
from orebridge.session import reliable_checkpoint

K, W = 5, 9
WINDOW = K + W - 1          # 13 words
BROADCAST_ROWS = 500_000    # narrow fingerprint rows (16 bytes each)
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
KEY = ("doc_id", "__llm_hash")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
            .otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: str = "text") -> Column:
    return F.array_remove(F.split(lower_ascii(whole_text(text)), NOT_WORD, -1), "")


def _windows(words: Column, n: int) -> Column:
    """0-based start positions of all n-word windows (empty where there are fewer words)."""
    return F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)) \
            .otherwise(F.array().cast("array<int>"))


def _gram_hash(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(n)])


def gram_hashes(words: Column, n: int) -> Column:
    return F.transform(_windows(words, n), lambda i: _gram_hash(words, i, n))


def winnowed(grams: str) -> Column:
    """The smallest hash of every W consecutive k-grams (null below W k-grams: such a text
    has no window of 13 words)."""
    lows = F.transform(F.sequence(F.lit(1), F.size(grams) - (W - 1)),
                       lambda i: F.array_min(F.slice(grams, i, W)))
    return F.when(F.size(grams) >= W, F.array_distinct(lows))


def _fingerprints(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Distinct winnowed hashes per row of `rows` (column `words`)."""
    grams = rows.select(*keep, gram_hashes(F.col("words"), K).alias("grams"))
    return grams.select(*keep, F.explode(winnowed("grams")).alias("fp"))


def _item_windows(items: DataFrame) -> DataFrame:
    """One row per distinct window: n, win (its words, space-joined), ids of its items."""
    n = F.least(F.lit(WINDOW), F.size("words"))
    at = F.sequence(F.lit(1), F.size("words") - n + 1)
    return (items.where(F.size("words") > 0)
            .select("item_id", n.alias("n"), F.explode(F.transform(     # the words are not repeated per window
                at, lambda i: F.array_join(F.slice("words", i, n), " "))).alias("win"))
            .groupBy("n", "win").agg(F.collect_set("item_id").alias("ids")))


def _prefiltered(rows: DataFrame, items: DataFrame, windows: DataFrame, lengths: list[int],
                 broadcast_rows: int) -> DataFrame | None:
    """Per row key, the (window length, hash) pairs it shares with the benchmark."""
    found = []
    for n in lengths:
        if n == WINDOW:
            prints = _fingerprints(items.where(F.size("words") >= WINDOW), []).distinct()
            own = _fingerprints(rows, list(KEY))
        else:
            prints = windows.where(F.col("n") == n).select(
                _gram_hash(F.split("win", " "), F.lit(0), n).alias("fp")).distinct()
            own = rows.select(*KEY, F.explode(F.array_distinct(gram_hashes(F.col("words"), n))).alias("fp"))
        prints = hint_if_small(reliable_checkpoint(prints), broadcast_rows)
        found.append(own.join(prints, "fp").select(*KEY, F.lit(n).alias("n"), "fp"))
    hits = None
    for part in found:
        hits = part if hits is None else hits.unionByName(part)
    return hits if hits is None else hits.groupBy(*KEY).agg(F.collect_set(F.struct("n", "fp")).alias("hits"))


# Up to this many hits a row's positions are found by looking each word's hash up among them.
FEW_HITS = 64


def _gram_length(n: int) -> int:
    return K if n == WINDOW else n


def _few_positions(n: int) -> Column:
    """Positions of the row's hits of length n, by a look through the hits for every word."""
    fps = F.transform(F.filter("hits", lambda x: x["n"] == n), lambda x: x["fp"])
    k = _gram_length(n)
    return F.filter(F.transform(_windows(F.col("words"), k), lambda i: F.when(
        F.array_contains(fps, _gram_hash(F.col("words"), i, k)), i)), lambda i: i.isNotNull())


def _many_positions(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, positions by window length) of rows with many hits: their words' hashes and their
    hits meet in a join, so the work grows with the words, not with words times hits."""
    found = None
    for n in lengths:
        at = F.posexplode(gram_hashes(F.col("words"), _gram_length(n))).alias("at", "fp")
        part = rows.select(*KEY, at).withColumn("n", F.lit(n))
        found = part if found is None else found.unionByName(part)
    hits = rows.select(*KEY, F.explode(F.array_distinct("hits")).alias("hit")).select(*KEY, "hit.n", "hit.fp").distinct()
    same = join_on(found, hits, [*KEY, "n", "fp"], "inner", null_safe=True)
    lists = same.groupBy(*KEY, "n").agg(F.sort_array(F.collect_set("at")).alias("at"))
    return lists.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("n", "at"))).alias("__llm_at"))


def _candidate_windows(at: Column, n: int) -> Column:
    """(n, pos, win) of the document windows of length n around the row's hits."""
    starts = F.array_distinct(F.flatten(F.transform(
        at, lambda i: F.sequence(F.greatest(i - (n - _gram_length(n)), F.lit(0)), i))))
    return F.transform(F.filter(starts, lambda s: s + n <= F.size("words")), lambda s: F.struct(
        F.lit(n).alias("n"), s.alias("pos"),
        F.array_join(F.slice("words", s + 1, n), " ").alias("win")))


def _widest(spans: Column) -> Column:
    """Of (pos, reach) spans sorted by position and reach, the last of each position."""
    return F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["pos"] != s["pos"], F.lit(True)))


def _covered(spans: Column) -> Column:
    """Words covered by (pos, reach) spans sorted by position, one per position. No window is
    longer than 13 words, so only the 12 spans before one can reach further than it does;
    with reaches made non-decreasing, each span adds the words up to the next one's position."""
    reach = F.transform(spans, lambda s, i: F.array_max(F.transform(
        F.slice(spans, F.greatest(i + 2 - WINDOW, F.lit(1)), F.least(i + 1, F.lit(WINDOW))),
        lambda x: x["reach"])))

    def added(far: Column) -> Column:
        return F.transform(spans, lambda s, i: F.least(
            F.get(far, i), F.coalesce(F.get(spans, i + 1)["pos"], F.get(far, i))) - s["pos"])
    # bound by a lambda, the reaches are computed once and not for every span
    lists = F.transform(F.array(reach), added)
    return F.aggregate(F.get(lists, F.lit(0)), F.lit(0).cast("long"), lambda acc, x: acc + x)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text",
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, __llm_hash, n_words, n_hit, items (sorted as strings),
    spans (hit windows as word position and the position behind), contaminated."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(item_text).alias("words"))
    windows = reliable_checkpoint(_item_windows(items))
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())   # at most 13 values
    rows = docs.select(F.col(id_col).alias("doc_id"), text_hash(text).alias("__llm_hash"),
                       words_of(text).alias("words"))
    hits = _prefiltered(rows, items, windows, lengths, broadcast_rows)
    if hits is None:
        marked, wins = rows, F.lit(None).cast("array<struct<n:int,pos:int,win:string>>")
    else:
        # narrow rows of the few documents that share something; read two or three times
        hits = reliable_checkpoint(hits)
        h = hits.select(F.col("doc_id").alias("__llm_k_id"), F.col("__llm_hash").alias("__llm_k_hash"), "hits")
        marked = rows.join(h, F.col("doc_id").eqNullSafe(F.col("__llm_k_id"))
                           & (F.col("__llm_hash") == F.col("__llm_k_hash")), "left")
        many = hits.where(F.size("hits") > FEW_HITS)
        if many.limit(1).count():
            # by broadcast (size checked) or a shuffle, only these rows' texts are split into words
            keys, _ = broadcast_if_bounded(many)
            texts = docs.select(F.col(id_col).alias("doc_id"), text_hash(text).alias("__llm_hash"),
                                whole_text(text).alias("__llm_text"))
            found = join_on(texts, keys, list(KEY), "inner", null_safe=True)
            many = _many_positions(found.select(*KEY, words_of("__llm_text").alias("words"), "hits"), lengths)
        else:
            many = many.select(*KEY, F.lit(None).cast("map<int,array<int>>").alias("__llm_at"))
        m = many.select(F.col("doc_id").alias("__llm_m_id"), F.col("__llm_hash").alias("__llm_m_hash"), "__llm_at")
        marked = marked.join(m, F.col("doc_id").eqNullSafe(F.col("__llm_m_id"))
                             & (F.col("__llm_hash") == F.col("__llm_m_hash")), "left")
        none = F.array().cast("array<int>")
        wins = F.when(F.col("hits").isNotNull(), F.concat(*[_candidate_windows(
            F.when(F.size("hits") <= FEW_HITS, _few_positions(n))
            .otherwise(F.coalesce(F.element_at("__llm_at", F.lit(n)), none)), n) for n in lengths]))
    each = (marked.select(*KEY, F.size("words").cast("long").alias("n_words"), wins.alias("wins"))
            .select(*KEY, "n_words", F.posexplode_outer("wins").alias("i", "w"))
            .select(*KEY, "n_words", F.when(F.coalesce("i", F.lit(0)) == 0, 1).otherwise(0).alias("row"),
                    F.coalesce("w.n", F.lit(0)).alias("n"), F.col("w.pos").alias("pos"),
                    # rows without a window must not meet in one task of a shuffled join
                    F.coalesce("w.win", F.concat(F.lit("\x01"), F.col("__llm_hash").cast("string"))).alias("win")))
    matched = each.join(hint_if_small(windows, broadcast_rows // 10), ["n", "win"], "left")
    span = F.when(F.col("ids").isNotNull(), F.struct("pos", (F.col("pos") + F.col("n")).alias("reach")))
    per_doc = matched.groupBy(*KEY, "n_words").agg(
        F.sum("row").cast("int").alias("rows"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.transform(F.flatten(F.collect_set("ids")),
                                                  lambda i: i.cast("string")))).alias("items"))
    out = (per_doc.withColumn("__llm_widest", _widest(F.col("spans")))
           .withColumn("n_hit", _covered(F.col("__llm_widest"))))
    return (out.withColumn("__llm_copy", F.explode(F.array_repeat(F.lit(0), F.col("rows"))))   # repeated rows
            .select(*KEY, "n_words", "n_hit", "items", "spans",
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text: str = "text", **options) -> DataFrame:
    """`docs` without contaminated rows."""
    bad = (contamination(docs, benchmark, id_col, text, **options).where("contaminated")
           .select(F.col("doc_id").alias("__llm_k_id"), F.col("__llm_hash").alias("__llm_k_hash")).distinct())
    return (docs.withColumn("__llm_hash", text_hash(text))
            .join(bad, F.col(id_col).eqNullSafe(F.col("__llm_k_id")) & (F.col("__llm_hash") == F.col("__llm_k_hash")),
                  "left_anti").drop("__llm_hash"))
