"""Toxicity by a weighted lexicon.

Texts are folded (lower case, homoglyphs to Latin letters, digit and sign substitutions
undone, everything else a space) and matched with one Aho-Corasick automaton. Lexicon
entries are whole words or word beginnings, learned with their log-odds weights from
labelled rows; exception phrases (an entry with the word before or after it that labelled
clean texts use) cancel the match they contain. The weights found in a text are summed and
normalised by its length, and a two-feature logistic curve, fitted on the same rows, turns
them into a score.

Learning reads at most about `TRAIN_ROWS` labelled rows (chosen by hash) whose
crc32(doc_id as text) mod 4 is not 2. Counting is done by Spark; the driver receives at most
`MAX_ENTRIES` entries and phrases and three numbers per sampled row.

Defined cases: null and empty texts have no match and get the curve's lowest score; without
labelled toxic rows every score is 0; repeated rows get equal scores; an empty table gives
no rows; texts of any length are matched whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orebridge.llm.common import bounded_sample, learnable, ship_code, whole_text
from orebridge.session import reliable_checkpoint

TRAIN_ROWS = 40_000
MAX_ENTRIES = 50_000
MIN_WEIGHT = 3.0            # log-odds an entry needs
SHORTEST, LONGEST = 4, 12   # letters of word beginnings
THRESHOLD = 0.3

# Characters that stand in for Latin letters.
HOMOGLYPHS = {
    "а": "a", "α": "a", "в": "b", "β": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e", "ё": "e",
    "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ι": "i", "ї": "i", "ı": "i", "ј": "j", "к": "k", "κ": "k",
    "ӏ": "l", "м": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "р": "p", "ρ": "p", "ԛ": "q",
    "г": "r", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ν": "v", "ѵ": "v", "ԝ": "w", "ω": "w", "х": "x",
    "χ": "x", "у": "y", "γ": "y", "ʏ": "y",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}


class _Fold(dict):
    """str.translate table filled on demand: stand-ins to letters, full-width forms to
    ASCII, other letters stay, anything else becomes a space."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if 0xFF01 <= code <= 0xFF5E:
            ch = chr(code - 0xFEE0).lower()
        out = HOMOGLYPHS.get(ch) or (ch if ch.isalpha() else " ")
        if code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF):
            out = ""                    # invisible marks inside words
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)        # whole words
    beginnings: dict[str, float] = field(default_factory=dict)   # word beginnings
    exceptions: set[str] = field(default_factory=set)            # "word entry" or "entry word"
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    fitted: bool = False

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for w, v in self.words.items():
            a.add_word(f" {w} ", (0, len(w), v))
        for w, v in self.beginnings.items():
            if w not in self.words:
                a.add_word(f" {w}", (1, len(w), v))
        for p in self.exceptions:
            a.add_word(f" {p} ", (2, len(p), 0.0))
        if len(a):
            a.make_automaton()
        return a


def matches(automaton, text: str) -> tuple[list[tuple[int, int, float]], int]:
    """(start, stop, weight) in the folded text, one per word, without those inside an
    exception phrase; and the number of folded words."""
    words = fold(text).split()
    if not words or not len(automaton):
        return [], len(words)
    line = f" {' '.join(words)} "
    found, spared = {}, []
    for end, (kind, size, weight) in automaton.iter(line):
        start = end - size if kind != 1 else end - size + 1     # first letter
        if kind == 2:
            spared.append((start, end))
        elif start not in found or (kind == 0, size) > found[start][:2]:
            found[start] = (kind == 0, size, weight)
    out, n, reach = [], 0, 0
    spared.sort()
    for start, (_, size, weight) in sorted(found.items()):
        while n < len(spared) and spared[n][0] <= start:     # reach: how far a phrase begun here or before goes
            reach = max(reach, spared[n][1])
            n += 1
        if start + size > reach:
            out.append((start, start + size, weight))
    return out, len(words)


def features(automaton, text: str) -> tuple[float, float]:
    """Total weight, and weight per word (both damped)."""
    hits, words = matches(automaton, text)
    total = sum(w for _, _, w in hits)
    return float(np.log1p(total)), float(np.log1p(1000.0 * total / max(1, words)))


def _grams(batches):
    import pyarrow as pa
    for batch in batches:
        entries, toxic = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            seen = set()
            for w in set(fold(text).split()):
                if len(w) >= 3:
                    seen.add(w + " ")
                    seen.update(w[:n] for n in range(SHORTEST, min(len(w), LONGEST + 1)))
            entries.extend(seen)
            toxic.extend([label] * len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(toxic, pa.int32())],
                                         ["entry", "label"])


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(text, label) of a bounded hash sample of the labelled rows one may learn from,
    materialised. An id with several labels counts once, with the greatest."""
    known = (labels.where(learnable(id_col) & F.col(label).isNotNull())
             .groupBy(F.col(id_col).alias("__llm_id")).agg(F.max(F.col(label).cast("int")).alias("label")))
    # one row per id, at most about max_rows narrow ones: safe to broadcast
    known = F.broadcast(bounded_sample(known, max_rows, "__llm_id"))
    rows = docs.select(F.col(id_col).alias("__llm_id"), whole_text(text).alias("text"))
    return reliable_checkpoint(rows.join(known, "__llm_id").select("text", "label"))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Entries, exceptions and curve from (text, label) rows, which are read four times (a
    checkpoint)."""
    ship_code(rows.sparkSession)
    sums = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sums.get(1, 0), sums.get(0, 0)
    if not toxic:
        return Lexicon()
    counts = (rows.mapInArrow(_grams, "entry string, label int").groupBy("entry")
              .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")))
    counts = reliable_checkpoint(counts.where(F.col("t") >= 2))
    tried = max(1, counts.count())
    weight = (F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0)))
    # evidence against chance: the log-likelihood ratio of the entry's own toxic share to the
    # sample's must outweigh the number of entries tried
    rate, seen = toxic / (toxic + clean), F.col("t") + F.col("c")
    evidence = (F.col("t") * F.log(F.col("t") / seen / F.lit(rate))
                + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / seen / F.lit(1 - rate))).otherwise(0.0)
                if clean else F.lit(float("inf")))
    kept = (counts.withColumn("w", weight).where(F.col("w") >= MIN_WEIGHT)
            .where((F.col("t") > 2 * F.col("c")) & (evidence >= float(np.log(tried))))
            .orderBy(F.desc(F.col("t") * F.col("w")), "entry").limit(MAX_ENTRIES).collect())
    lexicon = Lexicon()
    by_entry = {r["entry"]: r for r in kept}
    for entry, r in by_entry.items():
        if entry.endswith(" "):
            lexicon.words[entry[:-1]] = r["w"]
        elif not any(entry[:n] in by_entry for n in range(SHORTEST, len(entry))):
            # the shortest beginning that stays toxic and is more than one word's own
            family = by_entry.get(entry + " ")
            if family is None or r["t"] > family["t"]:
                lexicon.beginnings[entry] = r["w"]
    lexicon.exceptions = _learn_exceptions(rows, lexicon)
    lexicon.curve, lexicon.fitted = _fit_curve(rows, lexicon, clean), True
    return lexicon


def _learn_exceptions(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    """Phrases of two words around matches that at least three clean rows and no toxic row
    hold."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def phrases(batches):
        import pyarrow as pa
        automaton = shared.value.automaton()
        for batch in batches:
            found, label = [], []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                hits, _ = matches(automaton, text)
                if not hits:
                    continue
                line = f" {' '.join(fold(text).split())} "
                seen = set()
                for start, stop, _ in hits:
                    word_end = line.index(" ", stop) if stop < len(line) else len(line)
                    word = line[start:word_end]
                    before = line[:start - 1].rpartition(" ")[2]
                    after = line[word_end + 1:].partition(" ")[0]
                    seen |= {p for p in (f"{before} {word}" if before else "", f"{word} {after}" if after else "") if p}
                found.extend(seen)
                label.extend([y] * len(seen))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(label, pa.int32())],
                                             ["phrase", "label"])
    counts = (rows.mapInArrow(phrases, "phrase string, label int").groupBy("phrase")
              .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")))
    kept = counts.where("t = 0 AND c >= 3").orderBy(F.desc("c"), "phrase").limit(MAX_ENTRIES).collect()
    return {r["phrase"] for r in kept}


def _feature_udf(shared):
    @F.pandas_udf("total double, density double")
    def of(texts):
        import pandas as pd
        automaton = shared.value.automaton()
        return pd.DataFrame([features(automaton, t) for t in texts], columns=["total", "density"])
    return of


def _fit_curve(rows: DataFrame, lexicon: Lexicon, clean: int) -> tuple[float, float, float]:
    """Logistic curve over (total, density), by Newton steps with a small ridge."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    data = rows.select("label", _feature_udf(shared)("text").alias("f")).select("label", "f.*").toPandas()
    x = np.column_stack([np.ones(len(data)), data["total"], data["density"]])
    y = data["label"].to_numpy(dtype=float)
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag([1e-3, 0.5, 0.5])
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - np.array([1e-3, 0.5, 0.5]) * beta)
    return tuple(float(b) for b in beta)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from `THRESHOLD` on)."""
    ship_code(docs.sparkSession)
    if not lexicon.fitted:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    a, b, c = lexicon.curve

    out = docs.withColumn("__llm_f", _feature_udf(shared)(whole_text(text)))
    z = F.lit(a) + F.lit(b) * F.col("__llm_f.total") + F.lit(c) * F.col("__llm_f.density")
    score = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
    return out.withColumn("score", score).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)).drop("__llm_f")


def detect_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Learn from the labelled rows and score every document."""
    return score_toxicity(docs, learn_lexicon(labelled_rows(docs, labels, "toxic", train_rows)))
