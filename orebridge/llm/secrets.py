"""Secret scans through a trigram inverted index, in DataFrame operations only.

From each rule's regex a Boolean query over trigrams is derived (an OR of clauses, each an
AND of trigrams every match must contain; letters lower-cased, as is the indexed text).
The index holds a posting (trigram, row) for every trigram some rule asks for; no other
trigram is ever looked up. Postings are intersected per clause, candidates are verified by
the regex, and a rule without a mandatory trigram scans every text.

Matches are leftmost and do not overlap within a rule; a match whose secret is too short is
dropped after matching. Spans count code points, the end is exclusive.

Defined cases: null text is empty and has no span; repeated rows get equal answers; an
empty table gives no rows; other columns pass through. Text of any length is scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orebridge.llm.common import text_hash, whole_text

KEY = ("__llm_id", "__llm_hash")
SPAN = "array<struct<start:int,stop:int>>"
_MAX_ALTERNATIVES = 256
_MAX_CLASS = 8              # character classes up to this size are spelled out


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str              # in the syntax that Java and Python share
    group: int = 0          # the group whose length counts
    least: int = 1          # code points it needs


# The base kinds, then the added ones.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("map_key", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("payment_key", r"(?:sk|rk)_live_[A-Za-z0-9]+", 0, 24),
)
RULES = BASE_RULES + ADDED_RULES


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """Clauses of which every match satisfies one (all its trigrams occur in the lower-cased
    match), or None if some match needs no trigram at all."""
    import re._constants as c
    import re._parser as parser

    def exact(op, arg) -> list[str] | None:
        """The few strings a node can match, or None."""
        if op is c.LITERAL:
            return [chr(arg).lower()]
        if op is c.IN:
            if all(o is c.LITERAL for o, _ in arg) and len(arg) <= _MAX_CLASS:
                return sorted({chr(v).lower() for _, v in arg})
            return None
        if op is c.SUBPATTERN:
            return sequence(arg[-1])
        if op is c.BRANCH:
            parts = [sequence(p) for p in arg[1]]
            return None if None in parts else [s for p in parts for s in p]
        if op is c.MAX_REPEAT and arg[1] <= 8 and arg[1] is not c.MAXREPEAT:
            one = sequence(arg[2])
            if one is None:
                return None
            out, tail = [], [""]
            for n in range(arg[1] + 1):
                out += tail if n >= arg[0] else []
                tail = [a + b for a in tail for b in one]
                if len(out) + len(tail) > _MAX_ALTERNATIVES:
                    return None
            return out
        return None

    def sequence(items) -> list[str] | None:
        out = [""]
        for op, arg in items:
            part = exact(op, arg)
            if part is None or len(out) * len(part) > _MAX_ALTERNATIVES:
                return None
            out = [a + b for a in out for b in part]
        return out

    def needs(items) -> set[tuple[frozenset[str], str]]:
        """(trigrams so far, text just before the end) for each way through `items`."""
        ways = {(frozenset(), "")}

        def flush(ways):
            return {(t | _trigrams(tail), "") for t, tail in ways}
        for op, arg in items:
            part = exact(op, arg)
            if part is not None and len(ways) * len(part) <= _MAX_ALTERNATIVES:
                ways = {(t, tail + s) for t, tail in ways for s in part}
                continue
            ways = flush(ways)
            inner = None
            if op is c.SUBPATTERN:
                inner = needs(arg[-1])
            elif op is c.BRANCH:
                inner = set().union(*(needs(p) for p in arg[1]))
            elif op is c.MAX_REPEAT and arg[0] >= 1:
                inner = needs(arg[2])
            if inner and len(ways) * len(inner) <= _MAX_ALTERNATIVES:
                ways = {(t | u, "") for t, _ in ways for u, _ in flush(inner)}
        return flush(ways)

    clauses = {t for t, _ in needs(parser.parse(regex))}
    if frozenset() in clauses:
        return None
    return sorted((t for t in clauses if not any(o < t for o in clauses)), key=sorted)


def _candidates(keyed: DataFrame, rules) -> DataFrame | None:
    """Per row key, the kinds whose trigram query the row satisfies."""
    clauses = [(r.kind, n, sorted(t)) for r in rules for n, t in enumerate(trigram_query(r.regex) or [])]
    if not clauses:
        return None
    vocabulary = sorted({t for _, _, ts in clauses for t in ts})
    low = F.lower("__llm_text")
    postings = (keyed.select(*KEY, low.alias("low")).select(*KEY, F.explode(F.array_compact(F.array(
        *[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))).alias("trigram")))
    # as many rows as the rules have trigrams: a fixed size
    asked = keyed.sparkSession.createDataFrame(
        [(t, kind, n, 1 << i, (1 << len(ts)) - 1) for kind, n, ts in clauses for i, t in enumerate(ts)],
        "trigram string, kind string, clause int, bit long, full long")
    return (postings.join(F.broadcast(asked), "trigram")
            .groupBy(*KEY, "kind", "clause", "full").agg(F.bit_or("bit").alias("bits"))
            .where("bits = full").groupBy(*KEY).agg(F.collect_set("kind").alias("kinds")))


def _spans(rule: Rule) -> Column:
    """Spans of one rule in __llm_text: the pieces between matches and the matches give the
    positions; only spans that pass are kept."""
    text, regex = F.col("__llm_text"), F.lit(rule.regex)
    pieces = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"),
                          F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        stop = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(F.length(x["part"]) >= rule.least,
                                                 F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))
    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def _labelled(spans: Column, number: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"),
        s["stop"].alias("stop")))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _worth_matching(rule: Rule) -> Column:
    """For a rule that scans fully: one look for a match that is long enough. A lone class
    repeated at least once is a run, so its least length can stand in the regex."""
    if rule.group == 0 and rule.regex.endswith("]+") and rule.regex.count("[") == 1 and rule.regex[0] == "[":
        return F.col("__llm_text").rlike(f"{rule.regex[:-1]}{{{rule.least}}}")
    return F.col("__llm_text").rlike(rule.regex)


def scan_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `secrets`: array of (start, kind_no, kind, stop) sorted by start, then by
    the rules' order."""
    keyed = docs.withColumn("__llm_id", F.col(id_col)).withColumn("__llm_hash", text_hash(text)) \
                .withColumn("__llm_text", whole_text(text))
    found = _candidates(keyed, rules)
    if found is None:
        joined = keyed.withColumn("__llm_kinds", F.array().cast("array<string>"))
    else:
        f = found.select(F.col("__llm_id").alias("__llm_k_id"), F.col("__llm_hash").alias("__llm_k_hash"),
                         F.col("kinds").alias("__llm_kinds"))
        joined = keyed.join(f, F.col("__llm_id").eqNullSafe(F.col("__llm_k_id"))
                            & (F.col("__llm_hash") == F.col("__llm_k_hash")), "left").drop("__llm_k_id", "__llm_k_hash")
    parts = []
    for n, rule in enumerate(rules):
        if trigram_query(rule.regex) is None:
            wanted = _worth_matching(rule)
        else:
            wanted = F.coalesce(F.array_contains("__llm_kinds", rule.kind), F.lit(False))
        spans = F.when(wanted, _spans(rule)).otherwise(F.array().cast(SPAN))
        parts.append(_labelled(spans, n, rule.kind))
    return joined.withColumn("secrets", F.array_sort(F.concat(*parts))) \
                 .select(*[F.col(f"`{c}`") for c in docs.columns], "secrets")


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
