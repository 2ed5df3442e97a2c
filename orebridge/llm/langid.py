"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled text is built. A text is parsed greedily
into the longest phrases that occur in a language's training text; the expected length of
such phrases is log2(n) / (cross entropy), so phrases * log2(n) estimates the bits the text
costs under that language. For short n the estimate is too low: a phrase ends without naming
what follows. So each phrase costs `PHRASE_BITS` more, and each letter (or gap) that the
language's training text never has costs the bits of one letter of the whole alphabet.
Labels without any letter in their sample are left out. The language needing fewest bits wins
(ties: the first name in order).

Training is a bounded sample: for each language, whole labelled texts in hash order until
`TRAIN_CHARS` normalised characters are reached (the last text is cut there). Only rows
whose crc32(doc_id as text) mod 4 is not 2 are read. The automata are then bounded tables
(states <= 2 * TRAIN_CHARS per language), which are broadcast.

Parsing is done in numpy, many text blocks in step: a text is normalised (lower case, runs
of other characters become one space) and cut into blocks of `BLOCK` characters, which are
parsed side by side; no phrase crosses a block, for any language.

Defined cases: null or letterless text (also the empty text) is `und` with score 0; no
training text at all makes every answer `und` with score 0; repeated rows get equal
answers; very long texts are parsed whole; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orebridge.llm.common import learnable, ship_code, whole_text

TRAIN_CHARS = 24_000
MAX_LETTERS = 120           # letters with a column of their own; the rest share one
BLOCK = 256
PHRASE_BITS = 4.0           # per phrase besides log2 of the training length
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letter_flags() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _normalised(codes: np.ndarray, column: np.ndarray, starts: np.ndarray):
    """Letter columns (0 = other) of concatenated texts with runs of 0 collapsed, and the
    new start of each text."""
    c = column[codes]
    again = np.zeros(len(c), dtype=bool)
    again[1:] = (c[1:] == 0) & (c[:-1] == 0)
    again[starts[starts < len(c)]] = False
    kept = np.concatenate(([0], np.cumsum(~again)))
    return c[~again], kept[starts]


@dataclass
class Model:
    languages: list[str]
    column: np.ndarray      # code point -> column
    width: int
    table: np.ndarray       # state * width + column -> next state, or ~(state after a restart)
    roots: np.ndarray       # root state per language
    weight: np.ndarray      # bits per phrase and language
    unseen: float           # bits of a letter that a language never had


def _suffix_automaton(seq: list[int], width: int) -> np.ndarray:
    """Transition table (states x width, -1 = none) accepting every substring of `seq`."""
    nxt, link, length = [[-1] * width], [-1], [0]
    last = 0
    for c in seq:
        cur = len(nxt)
        nxt.append([-1] * width)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and nxt[p][c] < 0:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(nxt[q][:])
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p][c] == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return np.array(nxt, dtype=np.int32)


def fit(samples: dict[str, list[str]], train_chars: int = TRAIN_CHARS) -> Model:
    """Automata from bounded training text per language."""
    languages = sorted(samples)
    letters = np.zeros(0x110000, dtype=np.int64)
    codes = {}
    for lang in languages:
        codes[lang] = _codes(" ".join(samples[lang]))
        np.add.at(letters, codes[lang], 1)
    letters[~_letter_flags()] = 0
    common = np.argsort(-letters, kind="stable")[:MAX_LETTERS]
    common = np.sort(common[letters[common] > 0])
    other = len(common) + 1
    column = np.where(_letter_flags(), other, 0).astype(np.uint8)
    column[common] = np.arange(1, other)
    width = other + 1
    tables, roots, weight, base = [], [], [], 0
    sequences = {lang: _normalised(codes[lang], column, np.array([0]))[0][:train_chars] for lang in languages}
    languages = [lang for lang in languages if sequences[lang].any()]
    for lang in languages:
        seq = sequences[lang]
        t = _suffix_automaton(seq.tolist(), width)
        restart = np.where(t[0] >= 0, t[0], 0) + base
        tables.append(np.where(t >= 0, t + base, ~restart[None, :]).astype(np.int32))
        roots.append(base)
        weight.append(np.log2(max(2, len(seq))) + PHRASE_BITS)
        base += len(t)
    table = np.concatenate(tables).ravel() if tables else np.zeros(0, dtype=np.int32)
    return Model(languages, column, width, table, np.array(roots, dtype=np.int32), np.array(weight),
                 float(np.log2(width)))


def phrase_counts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text under each language (texts x languages), and whether the text
    has any letter."""
    counts, _, has = parse(model, texts)
    return counts, has


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As phrase_counts, with the characters each language never had between the two."""
    parts = [_codes(t) for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    c, starts = _normalised(np.concatenate(parts) if parts else np.zeros(0, "<u4"), model.column, starts)
    lens = np.diff(starts)
    has = np.add.reduceat(np.concatenate(((c > 0), [0])).astype(np.int64), np.minimum(starts[:-1], len(c))) > 0 \
        if len(texts) else np.zeros(0, bool)
    has &= lens > 0
    blocks = -(-lens // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    first = np.concatenate(([0], np.cumsum(blocks)))[:-1]
    begin = starts[:-1][owner] + BLOCK * (np.arange(len(owner)) - first[owner])
    size = np.minimum(BLOCK, starts[1:][owner] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    langs = len(model.languages)
    counts, unseen = np.zeros((2, len(texts), langs), dtype=np.int64)
    for l in range(langs):
        nowhere = ~model.roots[l]       # the step of a character that no phrase has
        state = np.full(len(begin), model.roots[l], dtype=np.int32)
        phrases = np.ones(len(begin), dtype=np.int32)
        strange = np.zeros(len(begin), dtype=np.int32)
        live = len(begin)
        for t in range(BLOCK):
            while live and size[live - 1] <= t:
                live = int(np.searchsorted(-size, -t, side="left"))
            if not live:
                break
            s = state[:live]
            step = model.table.take(s.astype(np.int64) * model.width + c[begin[:live] + t])
            cut = step < 0
            phrases[:live] += cut
            strange[:live] += step == nowhere
            state[:live] = np.where(cut, ~step, step)
        counts[:, l] = np.bincount(owner, weights=phrases, minlength=len(texts))
        unseen[:, l] = np.bincount(owner, weights=strange, minlength=len(texts))
    return counts, unseen, has


def classify(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether there is any letter, per text; score = the winner's share
    when each language weighs 2 ** -(bits above the winner / 4)."""
    counts, unseen, has = parse(model, texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), has
    bits = counts * model.weight[None, :] + unseen * model.unseen
    win = bits.argmin(axis=1)
    gap = bits - bits.min(axis=1, keepdims=True)
    score = 1.0 / np.exp2(-np.minimum(gap / 4.0, 60.0)).sum(axis=1)
    names = [model.languages[w] if h else UNKNOWN for w, h in zip(win.tolist(), has.tolist())]
    return names, np.where(has, score, 0.0), has


def training_sample(docs: DataFrame, train_chars: int = TRAIN_CHARS, id_col: str = "doc_id",
                    text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """Bounded labelled text per language: hash-ordered whole texts whose total length just
    passes `train_chars`. Rows are thinned by hash first, with the rate each language's
    size allows, so only about twice the bound per language reaches the driver."""
    rows = docs.where(learnable(id_col) & F.col(lang).isNotNull() & whole_text(text).rlike("\\p{L}")).select(
        F.col(lang).cast("string").alias("lang"), whole_text(text).alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), whole_text(text)).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    sample: dict[str, list[str]] = {}
    if not sizes:
        return sample
    span = 1 << 32
    rate = F.create_map(*[x for k, n in sizes.items()
                          for x in (F.lit(k), F.lit(min(span, int(4 * train_chars / n * span) + 1)))])
    room = {k: 0 for k in sizes}
    thinned = rows.where(F.pmod("h", F.lit(span)) < F.element_at(rate, F.col("lang"))) \
                  .select("lang", F.substring("text", 1, train_chars).alias("text"), "h")
    for r in sorted(thinned.collect(), key=lambda r: (r["lang"], r["h"])):
        if room[r["lang"]] < train_chars:
            room[r["lang"]] += len(r["text"])
            sample.setdefault(r["lang"], []).append(r["text"])
    if len(sample) < len(sizes):        # a language whose few texts all hash above the rate
        late = [k for k in sizes if k not in sample]
        few = (rows.where(F.col("lang").isin(late)).groupBy("lang")
               .agg(F.min(F.struct("h", F.substring("text", 1, train_chars).alias("text"))).alias("r")))
        for r in few.collect():
            sample[r["lang"]] = [r["r"]["text"]]
    return sample


def predict_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and has_letters. A score above 0 tells a learned label,
    also one spelled `und`, from no answer."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, letters boolean")
    def answer(texts):
        import pandas as pd
        names, scores, letters = [], [], []
        values = texts.tolist()
        at = 0
        while at < len(values):         # groups of about a million characters bound the memory
            stop, chars = at, 0
            while stop < len(values) and (stop == at or chars + len(values[stop]) <= 1_000_000):
                chars += len(values[stop])
                stop += 1
            n, s, has = classify(shared.value, values[at:stop])
            names.extend(n)
            scores.extend(s.tolist())
            letters.extend(has.tolist())
            at = stop
        return pd.DataFrame({"lang": names, "score": scores, "letters": pd.Series(letters, dtype=bool)})

    # so marked, a filter on the answer is not pushed below it, which would parse twice
    once = answer.asNondeterministic()
    return docs.withColumn("__llm_lang", once(whole_text(text))) \
               .withColumn("lang_pred", F.col("__llm_lang.lang")) \
               .withColumn("score", F.col("__llm_lang.score")) \
               .withColumn("has_letters", F.col("__llm_lang.letters")).drop("__llm_lang")


def identify_language(docs: DataFrame, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """Learn from the labelled rows of `docs` and predict every row."""
    return predict_language(docs, fit(training_sample(docs, train_chars), train_chars))
