"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a Boolean column that is true for a text to reject. On a bounded sample of
rows (`SAMPLE_ROWS`, chosen by hash) every rule's selectivity is counted and its cost
timed; the rules then run in descending order of rejection per cost, and a text stops at
the first rule that rejects it. The order decides only how much work is done and which rule
is named first, never the verdict.

Words are runs of anything but white space (0x20, 0x09-0x0D). Repeated three-word windows
are found by 64-bit hashes inside one text.

Defined cases: null text counts as empty (no words, rejected by the word count); repeated
rows get equal answers; an empty table gives no rows, with the rules in their listed order;
other columns pass through; texts of any length are measured whole.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orebridge.llm.common import WORD_SPLIT, bounded_sample, whole_text
from orebridge.session import reliable_checkpoint

SAMPLE_ROWS = 2_000
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
_WORDS, _LINES, _TEXT = "__llm_words", "__llm_lines", "__llm_text"


def _size(c) -> Column:
    return F.size(c).cast("long")


def repeated_words(words: str) -> Column:
    """Words inside three-word windows that occur twice or more, first occurrence included.

    Equal windows stand side by side when (hash, position) pairs are sorted; a repeated
    window at p covers p, p + 1 and p + 2, so it adds at most the distance to the next one.
    """
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(sorted_grams):
        twice = F.filter(sorted_grams, lambda x, j: (F.get(sorted_grams, j + 1)["h"].eqNullSafe(x["h"]))
                         | (F.when(j > 0, F.get(sorted_grams, j - 1)["h"]).eqNullSafe(x["h"])))
        at = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                           lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                           lambda a: a["n"])
    none = F.lit(0).cast("long")
    some = F.size(F.array_distinct(hashes)) < F.size(words) - 2
    # the sort runs only where some window repeats; let() binds the sorted array once
    return F.when((F.size(words) >= 4) & some, _let(F.array_sort(grams), covered)).otherwise(none)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    and the internal columns that rules read."""
    t = F.col(_TEXT)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = (docs.withColumn(_TEXT, whole_text(text))
           .withColumns({_WORDS: F.array_remove(F.split(t, WORD_SPLIT, -1), ""), _LINES: lines}))
    out = out.withColumns({
        "n_words": _size(_WORDS),
        "word_chars": F.length(F.array_join(_WORDS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _size(_LINES) - _size(F.array_distinct(_LINES)),
        "n_repeat_words": repeated_words(_WORDS),
    })
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[], Column]


def _removed_chars(pattern: str) -> Column:
    return F.length(_TEXT) - F.length(F.regexp_replace(F.col(_TEXT), pattern, ""))


# Scripts written without spaces between words: a run between white space is no word there.
UNSPACED = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}\\p{IsTibetan}]"

# Rules beyond the base test; thresholds leave ordinary prose of any script alone.
RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words"))
         | ((F.col("word_chars") > 15 * F.col("n_words"))
            & (2 * _removed_chars(UNSPACED) <= F.col("word_chars")))),
    Rule("repeated_lines", lambda: (2 * F.col("n_dup_lines") > _size(_LINES)) & (F.col("n_dup_lines") >= 3)),
    Rule("capitals", lambda: 2 * _removed_chars("\\p{Lu}") > F.col("word_chars")),
    Rule("no_letters", lambda: 2 * _removed_chars("\\p{L}") < F.col("word_chars")),
    Rule("few_distinct_words", lambda: 20 * _size(F.array_distinct(_WORDS)) < F.col("n_words")),
    Rule("list_lines", lambda: (_size(_LINES) >= 5) & (10 * _size(F.filter(
        _LINES, lambda x: x.rlike("^\\s*([-*•|]|[0-9]+[.)])\\s"))) > 9 * _size(_LINES))),
    Rule("cut_lines", lambda: (_size(_LINES) >= 5) & (10 * _size(F.filter(
        _LINES, lambda x: x.rlike("(\\.\\.\\.|…)\\s*$"))) > 3 * _size(_LINES))),
)


def rule_order(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS,
               text: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds) on the sample, best rejection per cost first."""
    sample = reliable_checkpoint(measured(
        bounded_sample(docs.select(whole_text(text).alias("text")), sample_rows, "text")))
    rows = sample.count()
    if not rows:
        return [(r, 0.0, 0.0) for r in rules]
    shares = sample.agg(*[F.avg(F.coalesce(r.rejects(), F.lit(False)).cast("int")).alias(r.name)
                          for r in rules]).first()

    def seconds(value: Column) -> float:
        spent = []
        for _ in range(2):      # the first run also compiles
            began = time.perf_counter()
            sample.agg(F.count_if(value)).first()
            spent.append(time.perf_counter() - began)
        return min(spent)

    idle = seconds(F.col("n_words") < 0)
    timed = [(r, float(shares[r.name]), max(1e-3, seconds(r.rejects()) - idle)) for r in rules]
    return sorted(timed, key=lambda x: -x[1] / x[2])


def run_cascade(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS,
                text: str = "text") -> DataFrame:
    """`docs` with the base measures, base_failed, kept and rejected_by (the first rule in
    cascade order that rejects, `base` for the base test)."""
    ordered = [r for r, _, _ in rule_order(docs, rules, sample_rows, text)]
    first = F.coalesce(F.when(F.col("base_failed"), F.lit("base")),
                       *[F.when(r.rejects(), F.lit(r.name)) for r in ordered])
    out = measured(docs, text).withColumn("rejected_by", first)
    out = out.withColumn("kept", F.col("rejected_by").isNull()).drop(_TEXT, _WORDS, _LINES)
    # Counted verdicts must see every row, so a later filter stays above this point; pushed
    # below, it would compute every measure anew for each place that reads it.
    return out.observe(f"quality rules {uuid.uuid4().hex}", F.count_if("kept").alias("kept"),
                       F.count(F.lit(1)).alias("rows"))
