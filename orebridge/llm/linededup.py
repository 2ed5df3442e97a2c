"""Line dedup by content-defined line chunks and word-counted line windows.

A text is split at \\n. A rolling hash over the last `WINDOW` line hashes decides after
which lines a chunk ends, so boundaries depend on nearby lines only and settle again after
an insertion or deletion. A line of `LONG_LINE` words or more (an unwrapped paragraph) is a
chunk of its own. Chunks of two or more lines that carry words, and long lines, are
eligible. Chunk edges depend on the lines around a passage, so windows join the chunks: from
every line with words the fewest lines onwards, and up to every line with words the fewest
lines back, that hold `PASSAGE_WORDS` words. These depend on their own lines only, and those
inside a passage of that many words cover all of it, however it is wrapped and whatever
stands around it.

Of every chunk or window that occurs more than once in the corpus, the first occurrence
(smallest doc_id, nulls last; then text hash; then line number) is no ground to remove
anything; the lines of the others are removed, each only after the bytes were compared with
the first occurrence's. Windows overlap: a line goes if any repeated window or chunk that is
not a first occurrence holds it. An equal line then stands at an earlier place, so every
removed line stays somewhere; of a passage repeated back to back in one text one copy stays.

Spark plan, for chunks and windows alike: (1) slim rows (128-bit hash, row key, line
numbers), (2) partial counts per hash, so a chunk that a third of all documents share
travels as one row per task,
(3) occurrences of repeated chunks go back to their documents (the only shuffle of whole
texts), (4) only repeated chunks' bytes are shuffled for the comparison: all occurrences
of one chunk meet its single first occurrence in a join that adaptive execution can split.
Repeated lines of few words are compared once per window that holds them.

Defined cases: null text stays null with nothing removed; empty text has no chunk; repeated
rows (same id and text) are occurrences like any other in their chunks' first appearance
order but cannot be told apart, so none of them loses a chunk to its own twin; a text all
of whose lines were removed becomes empty; an empty table gives no rows; other columns pass
through.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from orebridge.llm.common import same_row, ship_code, text_hash

WINDOW = 2                  # lines in the rolling hash
DIVISOR = 2                 # one line in two may end a chunk
MIN_LINES = 2
MAX_LINES = 16
LONG_LINE = 40              # words from which a line is a chunk of its own
PASSAGE_WORDS = 50          # words from which repeated lines are found however they are wrapped
KEY = ("doc_id", "__llm_hash")
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def word_count(line: bytes) -> int:
    return len((line if line.isascii() else line.decode("utf-8", "surrogatepass")).split())


def passage_windows(words: list[int]) -> set[tuple[int, int]]:
    """The shortest windows of PASSAGE_WORDS words from, and up to, every line with words."""
    out, total, end = set(), 0, 0
    for i, n in enumerate(words):                   # total: words of lines i to end
        while end < len(words) and total < PASSAGE_WORDS:
            total += words[end]
            end += 1
        if total < PASSAGE_WORDS:
            break
        if n:
            out.add((i, end))
        total -= n
    total, begin = 0, 0
    for j, n in enumerate(words):                   # total: words of lines begin to j
        total += n
        while total - words[begin] >= PASSAGE_WORDS:
            total -= words[begin]
            begin += 1
        if n and total >= PASSAGE_WORDS:
            out.add((begin, j + 1))
    return out


def line_chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """Eligible chunks and windows, sorted, as (first line, line behind the last)."""
    words = [word_count(line) for line in lines]
    return sorted(passage_windows(words).union(_content_chunks(lines, words)))


def _content_chunks(lines: list[bytes], words: list[int]) -> list[tuple[int, int]]:
    from xxhash import xxh64_intdigest as digest
    out, begin, worded, recent = [], 0, 0, [0] * WINDOW

    def close(stop: int) -> None:
        if worded >= MIN_LINES:
            out.append((begin, stop))

    for i, line in enumerate(lines):
        if words[i] >= LONG_LINE:
            close(i)
            out.append((i, i + 1))
            begin, worded, recent = i + 1, 0, [0] * WINDOW
            continue
        recent = [*recent[1:], digest(line)]
        worded += bool(line.strip())
        rolling = 0
        for h in recent:
            rolling = (rolling * _MIX + h) & _MASK
        if worded >= MIN_LINES and ((rolling >> 40) % DIVISOR == 0 or i + 1 - begin >= MAX_LINES):
            close(i + 1)
            begin, worded = i + 1, 0
    close(len(lines))
    return out


def _chunk_rows(batches):
    """(text) rows with their key -> one slim row per eligible chunk."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_128_intdigest as digest
    for batch in batches:
        rows, high, low, first, stop = [], [], [], [], []
        for n, text in enumerate(batch.column("__llm_text").to_pylist()):
            if not text:
                continue
            body = text.encode("utf-8", "surrogatepass")
            lines, view = body.split(b"\n"), memoryview(body)
            at = list(accumulate((len(line) + 1 for line in lines), initial=0))
            for a, b in line_chunks(lines):
                h = digest(view[at[a]:at[b] - 1])
                rows.append(n)
                high.append(h >> 64)
                low.append(h & _MASK)
                first.append(a)
                stop.append(b)
        take = pa.array(rows, type=pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column(KEY[0]).take(take), batch.column(KEY[1]).take(take),
            pa.array(np.array(high, dtype="<u8").view("<i8")), pa.array(np.array(low, dtype="<u8").view("<i8")),
            pa.array(first, type=pa.int32()), pa.array(stop, type=pa.int32())],
            [*KEY, "h1", "h2", "first", "stop"])


def _chunk_texts(batches):
    """Rows with candidate chunks -> one row per candidate with its bytes."""
    import pyarrow as pa
    for batch in batches:
        rows, texts, cands = [], [], []
        for n, (text, cand) in enumerate(zip(batch.column("__llm_text").to_pylist(),
                                             batch.column("__llm_cand").to_pylist())):
            lines = text.encode("utf-8", "surrogatepass").split(b"\n")
            for c in cand:
                rows.append(n)
                cands.append(c)
                texts.append(b"\n".join(lines[c["first"]:c["stop"]]))
        take = pa.array(rows, type=pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column("__llm_id").take(take), batch.column(KEY[1]).take(take),
            *[pa.array([c[k] for c in cands], type=t) for k, t in
              (("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int32()), ("stop", pa.int32()),
               ("is_first", pa.bool_()))],
            pa.array(texts, type=pa.binary())], [*KEY, "h1", "h2", "first", "stop", "is_first", "bytes"])


def _without_lines(text: str, removed) -> str:
    lines, gone = text.split("\n"), set()
    for r in removed:
        gone.update(range(r["first"], r["stop"]))
    return "\n".join(line for i, line in enumerate(lines) if i not in gone)


def _marked(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """Input rows keyed, with `__llm_cand`: their chunks whose hash repeats in the corpus."""
    ship_code(docs.sparkSession)
    # repeated rows share the key; their chunks are counted once per key
    keyed = docs.withColumn("__llm_hash", text_hash(text)) \
                .withColumn("__llm_id", F.col(id_col)).withColumn("__llm_text", F.col(text))
    slim = keyed.select(F.col("__llm_id").alias("doc_id"), "__llm_hash", "__llm_text")
    chunks = slim.mapInArrow(_chunk_rows, "doc_id long, __llm_hash long, h1 long, h2 long, first int, stop int")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__llm_hash", "first")
    repeated = (chunks.groupBy("h1", "h2").agg(F.min(place).alias("lead"), F.max(place).alias("tail"))
                .where("lead <> tail").drop("tail"))
    occur = chunks.join(repeated, ["h1", "h2"]).withColumn("is_first", place == F.col("lead"))
    cand = occur.groupBy(*KEY).agg(F.collect_set(F.struct("h1", "h2", "first", "stop", "is_first")).alias("__llm_cand"))
    cand = cand.select(F.col("doc_id").alias("__llm_k_id"), F.col("__llm_hash").alias("__llm_k_hash"), "__llm_cand")
    return keyed.join(cand, F.col("__llm_id").eqNullSafe(F.col("__llm_k_id"))
                      & (F.col("__llm_hash") == F.col("__llm_k_hash")), "left").drop("__llm_k_id", "__llm_k_hash")


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated chunks removed from `text`, plus __llm_removed: the removed
    chunks as an array of (first, stop) line numbers (null where nothing was removed)."""
    marked = _marked(docs, text, id_col)
    # Every column goes along, read or not: both uses of `marked` then need the same shuffle
    # of the documents, which Spark writes once and reads twice.
    pieces = (marked.where(F.col("__llm_cand").isNotNull()).drop(text)
              .mapInArrow(_chunk_texts, "doc_id long, __llm_hash long, h1 long, h2 long, first int, "
                                        "stop int, is_first boolean, bytes binary"))
    lead = pieces.where("is_first").groupBy("h1", "h2").agg(F.min("bytes").alias("lead_bytes"))
    same = (pieces.where("not is_first").join(lead, ["h1", "h2"])
            .where(F.col("bytes") == F.col("lead_bytes")))
    removed = (same.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("first", "stop"))).alias("__llm_removed"))
               .select(F.col("doc_id").alias("__llm_k_id"), F.col("__llm_hash").alias("__llm_k_hash"), "__llm_removed"))
    out = marked.join(removed, F.col("__llm_id").eqNullSafe(F.col("__llm_k_id"))
                      & (F.col("__llm_hash") == F.col("__llm_k_hash")), "left")

    @F.pandas_udf("string")
    def without(texts, gone):
        import pandas as pd
        return pd.Series([_without_lines(t, g) if g is not None else None for t, g in zip(texts, gone)], dtype=object)

    # so marked, a filter on the cleaned text is not pushed below it, which would clean twice
    without = without.asNondeterministic()
    touched = F.when(F.col("__llm_removed").isNotNull(), F.col("__llm_text"))   # only these go to Python
    cleaned = F.when(F.col("__llm_removed").isNull(), F.col("__llm_text")).otherwise(
        without(touched, F.col("__llm_removed")))
    return out.select(*[cleaned.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns],
                      "__llm_removed")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with cleaned texts; documents that lost every word to removal go."""
    out = remove_repeated_chunks(docs, id_col, text)
    gone = F.col("__llm_removed").isNotNull() & ~F.col(text).rlike("[^\\x20\\x09-\\x0D]")
    return out.where(~F.coalesce(gone, F.lit(False))).select(*docs.columns)


def with_length(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """`docs` with the length column, where there is one, brought up to the text."""
    if length not in docs.columns:
        return docs
    kind = docs.schema[length].dataType
    return docs.select(*[F.length(text).cast(kind).alias(c) if c == length else F.col(f"`{c}`")
                         for c in docs.columns])
