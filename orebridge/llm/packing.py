"""Packing documents into token sequences by order-preserving dynamic programming.

The token stream of a partition (documents in the order the partition delivers them, each
followed by an end id) is cut into windows of at most `capacity` ids. Cuts may fall at
document ends (free) or sentence ends (a truncation penalty); a sentence longer than a
window also gets emergency cuts (a higher penalty). Cost of a window = its padding + a
constant per sequence + the penalty of the cut that ends it. The recurrence
f(j) = pen(j) + min over i with p(j) - p(i) <= capacity of f(i) + capacity - (p(j) - p(i))
needs only the minimum of f(i) + p(i) over a sliding window, kept in a monotone queue, so
the work is linear in the number of possible cuts. Windows whose length is a power of two
need no padding and are looked up directly.

Memory: a task holds one block of `block_tokens` ids; windows are settled block by block,
the last two windows of a block are re-opened with the next one. The last window of a
partition is cut at powers of two where that costs less than its padding.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each;
a null doc_id stays null; an empty table gives no rows; text of any length is tokenised
whole (a document longer than a block is cut at a block's edge only if the programme puts
a cut there; blocks grow to hold at least one window).
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orebridge.llm.common import ship_code, whole_text

CAPACITY = 4096
END_ID = 2
SENTENCE_CUT = 4            # tokens of padding that a cut inside a document is worth
EMERGENCY_CUT = 64          # the same for a cut inside a sentence
PER_SEQUENCE = 16           # keeps short power-of-two windows from replacing full ones
BLOCK_TOKENS = 1 << 20
CACHE_ENTRIES = 120_000     # words whose ids a Python worker remembers, per generation
LONG_WORD = 64              # longer words are encoded each time, so the cache stays small
LATIN_END = "\u0180"        # letters below keep their form when the tokenizer composes them
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")

_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]
_ENCODERS: dict[str, "WordCachedEncoder"] = {}


class WordCachedEncoder:
    """Ids of a text through a bounded cache of its white-space words.

    The tokenizer never merges across white space, so a text's ids are those of its words
    in order. Texts with control separators that Python and the tokenizer judge
    differently are encoded whole.
    """

    _UNUSUAL = "\x1c\x1d\x1e\x1f"
    # Texts of these characters are lower-cased before they are split; the dotted capital I is
    # left out, as its small form is two characters.
    _LATIN = re.compile(f"[^\x00-\u012f\u0131-{chr(ord(LATIN_END) - 1)}]")
    # Anything but Latin letters, digits and white space may share a token with a stop.
    _OTHER_MARK = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(ord(LATIN_END)))
                                           if not (c.isalnum() or c.isspace() or c in ".,")) + "]")

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # the merging model reads UTF-8 bytes as characters: the spelling of each letter
        self.spelling = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, ord(LATIN_END))}
        self.entries = entries
        self.young: dict[str, bytes] = {}       # white-space words
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}       # punctuation behind letters
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.ends_sentence = np.zeros(len(self.ends_word), dtype=bool)
        self.ends_sentence[[i for t, i in vocab.items() if t.removesuffix("</w>")
                            and not t.removesuffix("</w>").strip(".!?")]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                        dtype="<u4")

    def _known(self, word: str) -> bytes | None:
        return self.young.get(word) or self.old.get(word)

    def _letters(self, run: str) -> bytes:
        """Ids of one lower-case run of Latin letters: it is one unit of the tokenizer's
        merging model, given to it as the tokenizer would (UTF-8 bytes as characters)."""
        ids = [token.id for token in self.model.tokenize(run if run.isascii() else run.translate(self.spelling))]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _other_runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of letter runs of any script in one call; a run's last id, and no other,
        ends a word."""
        ids = self._encode(" ".join(runs))
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) == len(runs) and stops[-1] == len(ids):
            raw, stops = ids.tobytes(), (4 * stops).tolist()
            return {r: raw[a:b] for r, a, b in zip(runs, [0, *stops], stops)}
        return {r: self._encode(r).tobytes() for r in runs}

    def _learn(self, words: set[str], lowered: bool) -> dict[str, bytes]:
        """Ids of words the young cache lacks; those of usual length are remembered there.
        The letters and the mark behind them are looked up apart. `lowered`: the words come
        from a lower-cased Latin text, so a run of letters goes straight to the model."""
        fresh, other, young, old = {}, {}, self.young, self.old
        for w in words:
            ids = old.get(w)
            if ids is None:
                if lowered and w.isalpha():
                    ids = self._letters(w)
                else:
                    ids = self._marked(w, other)
                    if ids is None:
                        continue
            fresh[w] = ids
            if len(w) <= LONG_WORD:
                young[w] = ids
        if other:
            found = self._other_runs(list({core for core, _ in other.values()}))
            for w, (core, tail) in other.items():
                fresh[w] = ids = found[core] + tail
                if len(w) <= LONG_WORD:
                    young[w] = ids
        return fresh

    def _marked(self, w: str, other: dict[str, tuple[str, bytes]]) -> bytes | None:
        """Ids of a word that may be capital or end in marks; a run of letters beyond Latin is
        put into `other` with the ids of its marks."""
        core = w.rstrip(string.punctuation)
        mark, run = w[len(core):], core.lower()
        if not (core.isalpha() and run.isalpha()):
            return self._encode(w).tobytes()
        if mark and mark not in self.marks:
            if len(self.marks) > self.entries:
                self.marks = {}
            self.marks[mark] = self._encode(mark).tobytes()
        tail = self.marks[mark] if mark else b""
        if max(core) < LATIN_END:
            return (mark and self._known(run) or self._letters(run)) + tail
        other[w] = core, tail
        return None

    def _words(self, t: str) -> tuple[list[str], bool]:
        """White-space words; in plain Latin text (True) lower-cased and, where stops and
        commas are the only marks and never meet, with these apart. The tokenizer does both
        anyway; done first, there are fewer distinct words to remember."""
        if self._LATIN.search(t):
            return t.split(), False
        t = t.lower()
        if not self._OTHER_MARK.search(t) and not any(m in t for m in ("..", ",,", ".,", ",.")):
            t = t.replace(".", " . ").replace(",", " , ")
        return t.split(), True

    def _ids(self, t: str) -> bytes:
        if any(c in t for c in self._UNUSUAL):
            return self._encode(t).tobytes()
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        words, lowered = self._words(t)
        found = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            fresh = self._learn({words[i] for i in missing}, lowered)
            for i in missing:
                found[i] = fresh[words[i]]
        return b"".join(found)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._ids(t), dtype="<u4") for t in texts]


def encoder(path: str) -> WordCachedEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordCachedEncoder(path)
    return _ENCODERS[path]


def possible_cuts(ends: np.ndarray, sentences: np.ndarray, total: int, capacity: int):
    """Sorted cut positions in (0, total] and their penalties. `ends`: positions behind
    documents; `sentences`: positions behind sentences."""
    kind = np.full(total + 1, -1, dtype=np.int8)
    kind[sentences] = SENTENCE_CUT
    kind[ends] = 0
    kind[total] = 0 if len(ends) and ends[-1] == total else SENTENCE_CUT
    at = np.flatnonzero(kind[1:] >= 0) + 1
    gaps = np.diff(np.concatenate(([0], at)))
    for j in np.flatnonzero(gaps > capacity):
        begin = at[j] - gaps[j]
        extra = np.arange(begin + capacity, at[j], capacity)
        kind[extra] = EMERGENCY_CUT
    at = np.flatnonzero(kind[1:] >= 0) + 1
    return at, kind[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, capacity: int) -> list[int]:
    """Positions of the cheapest cuts up to the last position, by the recurrence above."""
    starts = np.concatenate(([0], at))
    pos, pen = starts.tolist(), [0, *penalty.tolist()]
    # for each cut, the earlier ones a power of two below the capacity away: a window between
    # them has no padding
    exact: list[tuple[int, ...]] = [()] * len(pos)
    for k in range((capacity - 1).bit_length()):
        near = np.searchsorted(starts, starts - (1 << k))
        hit = np.flatnonzero(starts[near] == starts - (1 << k))
        for j, i in zip(hit.tolist(), near[hit].tolist()):
            exact[j] = (*exact[j], i)
    cost, prev = [0.0] * len(pos), [0] * len(pos)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(pos)):
        p = pos[j]
        while pos[queue[0][1]] < p - capacity:
            queue.popleft()
        base, i = queue[0]
        best = base + capacity - p
        for k in exact[j]:
            if cost[k] < best:
                best, i = cost[k], k
        cost[j] = value = best + pen[j] + PER_SEQUENCE
        prev[j] = i
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(pos) - 1
    while j:
        cuts.append(pos[j])
        j = prev[j]
    return cuts[::-1]


def _tail_cuts(length: int, capacity: int) -> list[int]:
    """Lengths of the last window: whole, or its powers of two where cheaper."""
    parts = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    if (len(parts) - 1) * (EMERGENCY_CUT + PER_SEQUENCE) < capacity - length:
        return parts
    return [length]


def pack_partition(batches, path: str, capacity: int, end_id: int, partition: int,
                   block_tokens: int = BLOCK_TOKENS):
    """Arrow batches of (doc_id, text) -> batches of pieces."""
    import gc
    gc.disable()                # nothing here is cyclic; the collector only walks the caches
    try:
        yield from _packed(batches, path, capacity, end_id, partition, block_tokens)
    finally:
        gc.enable()


def _packed(batches, path: str, capacity: int, end_id: int, partition: int, block_tokens: int):
    import pyarrow as pa
    enc = encoder(path)
    block_tokens = max(block_tokens, 4 * capacity)
    docs: list[list] = []        # [doc_id, ids, done]: open documents and ids already packed
    waiting, number = 0, partition << 32

    def settle(last: bool):
        nonlocal docs, waiting, number
        stream = np.concatenate([ids[done:] for _, ids, done in docs])
        ends = np.cumsum([len(ids) - done for _, ids, done in docs])
        sentences = np.flatnonzero(enc.ends_sentence[stream]) + 1
        at, pen = possible_cuts(ends, sentences, len(stream), capacity)
        cuts = best_cuts(at, pen, capacity)
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            for part in _tail_cuts(cuts[-1] - begin, capacity):
                cuts.insert(len(cuts) - 1, begin := begin + part)
            cuts.pop()
        else:
            cuts = cuts[:-2]
        rows = []
        # Walk documents and windows together; both are sorted by position.
        d, doc_at, begin = 0, 0, 0
        for cut in cuts:
            here = begin
            while here < cut:
                doc_id, ids, done = docs[d]
                stop = min(cut, int(ends[d]))
                first = done + here - doc_at
                piece = ids[first:first + stop - here]
                rows.append((doc_id, first, stop - here, zlib.crc32(piece.tobytes()), len(ids),
                             number, here - begin))
                here = stop
                if stop == ends[d]:
                    doc_at = int(ends[d])
                    d += 1
            number += 1
            begin = cut
        if d < len(docs):
            docs[d][2] += begin - doc_at
        docs = docs[d:]
        waiting = len(stream) - begin
        return rows

    def out(rows):
        columns = list(zip(*rows)) if rows else [[]] * 7
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names)

    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        for at in range(0, len(keys), 256):
            part = texts.slice(at, 256).to_pylist()
            for key, ids in zip(keys[at:at + 256], enc.ids(part)):
                docs.append([key, np.concatenate((ids, end)), 0])
                waiting += len(ids) + 1
                if waiting >= block_tokens:
                    yield out(settle(False))
    if docs:
        yield out(settle(True))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
                   end_id: int = END_ID, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence at which
    offset. `vocabulary`: path of a tokenizers JSON file, present on every executor.
    Sequence ids are unique: partition number, then a counter inside the partition."""
    ship_code(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        return pack_partition(batches, vocabulary, capacity, end_id, TaskContext.get().partitionId())

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return slim.mapInArrow(run, SCHEMA)
