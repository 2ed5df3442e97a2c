"""URL filters: rules first, then empirical-Bayes reputation of the host.

A page whose shown text is that of a labelled document has an outcome, good or bad. Outcomes
are summed per host and shrunk through three beta-binomial priors: the suffix's rate towards
the rate of all pages, the registered domain's towards its suffix's, the host's towards its
domain's. The weight of each prior (its pseudo-count) comes from the data: the spread of the
rates around the parent's, beyond what chance explains, by the method of moments. A host is
blocked where even the lower posterior bound of its bad rate is above MAX_BAD_RATE, so few or
no outcomes never block one.

The suffix of a host is its last label, or the longest of `suffixes` it ends with; the
registered domain has one label more. Counts are summed before any join, so a host or text
with a large share of the pages moves as one row per task; tables per host or text are
broadcast behind a check of their size, else joined salted.

Rows: a null url or one without `://` has an empty host and path; rules do not fit it and
the empty host has a reputation like any other. Pages keep their rows, repeated ids and ties
too. Null html, a null or empty text and documents without a label give no outcome. Equal
texts with different labels count as bad where half or more are. Empty tables give an empty
result, or verdicts from the even prior alone. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orebridge.operators.joins import broadcast_if_bounded, salted_join
from orebridge.session import reliable_checkpoint

# A host goes where the lower bound of its bad rate lies above this rate; the bound is this
# many posterior deviations below the mean.
MAX_BAD_RATE, DEVIATIONS = 0.5, 1.645
# Pseudo-counts of a prior stay within these limits: (1 / rho) - 1 for the share rho of
# variance between groups.
LEAST_RHO, MOST_RHO = 1e-4, 0.5

_HOST, _PATH, _TEXT = "__llm_host", "__llm_path", "__llm_text"


# ---- urls and rules
def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    """`action` (allow or block) for a host, all its subdomains and the paths below `path`."""
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | host.endswith("." + self.host)
        return below & path.startswith(self.path)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """`value` (a function of a rule) of the longest fitting rule, else null; of equally long
    ones the first in text order, block before allow. Rules are configuration: a short list."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.action != "block"))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))


# ---- outcomes
# White space that texts are compared without: controls 0x09-0x0D, space, no-break space.
WHITE = r"[\x09-\x0D\x20\x{A0}]+"


def text_key(text: Column) -> Column:
    """Digest of a text without its white space; null for none."""
    bare = F.regexp_replace(text, WHITE, "")
    return F.when(F.length(bare) > 0, F.md5(bare))


# The character entities of HTML text.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def shown_text(html: Column) -> Column:
    """The text of a page's article after its heading, without tags."""
    body = F.regexp_extract(html, r"(?s)<article[^>]*>(?:.*?</h1>)?(.*?)</article>", 1)
    text = F.regexp_replace(body, r"<[^>]*>", " ")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text key, bad 0/1) of documents with a label: bad where half or more of the labelled
    documents with that text are of low quality or toxic. Documents are hashed before they
    meet the labels, so no text is shuffled."""
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))      # skips a null one
    marked = (labels.select(F.col("doc_id").alias("__llm_id"), bad.alias("__llm_bad"))
              .where("__llm_id is not null and __llm_bad is not null")
              .groupBy("__llm_id").agg(F.max("__llm_bad").alias("__llm_bad")))
    keyed = (docs.select(F.col("doc_id").alias("__llm_id"), text_key(F.col("text").cast("string")).alias(_TEXT))
             .where(F.col(_TEXT).isNotNull())
             .groupBy("__llm_id", _TEXT).agg(F.count(F.lit(1)).alias("__llm_n")))
    return (keyed.join(marked, "__llm_id").groupBy(_TEXT)
            .agg((2 * F.sum(F.col("__llm_bad") * F.col("__llm_n")) >= F.sum("__llm_n")).cast("long").alias("bad")))


def _attached(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """`big` with the columns of `small` (one row per key): broadcast if its measured size
    allows it, else a salted join, so a hot key is spread over many tasks."""
    table, bounded = broadcast_if_bounded(small)
    return big.join(table, keys, how) if bounded else salted_join(big, table, keys, how)


def host_outcomes(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """Per host: n pages with an outcome and k bad ones; hosts without any have 0 and 0."""
    counted = (pages.select(url_host(F.col("url").cast("string")).alias(_HOST),
                            text_key(shown_text(F.col("html").cast("string"))).alias(_TEXT))
               .groupBy(_HOST, _TEXT).agg(F.count(F.lit(1)).alias("__llm_n")))
    found = _attached(counted, texts, [_TEXT])
    known = F.col("bad").isNotNull()
    return found.groupBy(_HOST).agg(
        F.sum(F.when(known, F.col("__llm_n")).otherwise(0)).alias("n"),
        F.sum(F.when(known, F.col("__llm_n") * F.col("bad")).otherwise(0)).alias("k"))


# ---- reputation
def registered_parts(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    n = F.lit(1)
    for s in sorted(suffixes, key=len):
        n = F.when((host == s) | host.endswith("." + s), F.lit(s.count(".") + 1)).otherwise(n)
    return _last_labels(host, n + 1), _last_labels(host, n)


def _last_labels(host: Column, n: Column) -> Column:
    parts = F.split(host, "\\.")
    first = F.greatest(F.size(parts) - n + 1, F.lit(1))
    return F.array_join(F.slice(parts, first, n), ".")


def _pseudo_count(groups: DataFrame, prior: str) -> Column:
    """The weight of the parent's rate (column `prior`) in the groups' rates: (1 / rho) - 1,
    where rho is the variance of the counts beyond the binomial one, by moments. A scalar
    subquery over `groups` (n, k, prior)."""
    n, k, m = F.col("n").cast("double"), F.col("k").cast("double"), F.col(prior)
    chance = m * (1 - m)
    rho = F.sum((k - n * m) * (k - n * m) - n * chance) / F.nullif(F.sum(n * (n - 1) * chance), F.lit(0.0))
    limited = F.least(F.greatest(F.coalesce(rho, F.lit(LEAST_RHO)), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    return groups.select((1 / limited - 1).alias("weight")).scalar()


def _shrunk(groups: DataFrame, prior: str, out: str) -> DataFrame:
    """Adds `out`, the posterior mean of each group's rate, and its weight."""
    w = _pseudo_count(groups, prior)
    return groups.withColumn("weight", w).withColumn(
        out, (F.col("k") + F.col("weight") * F.col(prior)) / (F.col("n") + F.col("weight")))


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """Per host: n, k, the prior and posterior mean of its bad rate and the posterior's lower
    bound, DEVIATIONS below the mean."""
    domain, suffix = registered_parts(F.col(_HOST), suffixes)
    hosts = reliable_checkpoint(outcomes.withColumns({"domain": domain, "suffix": suffix}))
    domains = reliable_checkpoint(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    overall = ends.agg((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).scalar()
    ends = reliable_checkpoint(ends.withColumn("overall", overall))
    ends = reliable_checkpoint(_shrunk(ends, "overall", "suffix_rate")).select("suffix", "suffix_rate")
    domains = reliable_checkpoint(_attached(domains, ends, ["suffix"]))
    domains = reliable_checkpoint(_shrunk(domains, "suffix_rate", "domain_rate")).select("domain", "domain_rate")
    hosts = reliable_checkpoint(_attached(hosts, domains, ["domain"]))
    rated = _shrunk(hosts, "domain_rate", "rate")
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("weight") + 1))
    return rated.select(_HOST, "domain", "suffix", "n", "k", "domain_rate", "rate",
                        (F.col("rate") - DEVIATIONS * spread).alias("low"))


def judge_pages(pages: DataFrame, docs: DataFrame, labels: DataFrame, rules: Sequence[Rule],
                suffixes: Sequence[str] = (), max_bad_rate: float = MAX_BAD_RATE) -> DataFrame:
    """page_id, host, path, rule, verdict and the reputation behind it, a row per page."""
    reputation = host_reputation(host_outcomes(pages, labelled_texts(docs, labels)), suffixes)
    url = F.col("url").cast("string")
    rows = pages.select("page_id", url_host(url).alias(_HOST), url_path(url).alias(_PATH))
    judged = _attached(rows, reputation.select(_HOST, "n", "rate", "low"), [_HOST])
    host, path = F.col(_HOST), F.col(_PATH)
    own = F.when(F.col("low") > max_bad_rate, "block").otherwise("allow")
    return judged.select(
        "page_id", host.alias("host"), path.alias("path"),
        longest_rule(rules, host, path, lambda r: r.text).alias("rule"),
        F.coalesce(longest_rule(rules, host, path, lambda r: r.action), own).alias("verdict"),
        F.col("n").alias("host_outcomes"), F.col("rate").alias("bad_rate"), F.col("low").alias("bad_rate_bound"))
