"""DuckDB SQL twins of the operator queries that SQL can express."""

from __future__ import annotations

_OP7 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
i AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, list_aggregate(words[s:s + n - 1], 'string_agg', ' ') AS win
  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
        FROM (SELECT item_id, words, least(13, len(words)) AS n FROM i WHERE len(words) > 0))),
dw AS (
  SELECT rid, n, s, list_aggregate(words[s:s + n - 1], 'string_agg', ' ') AS win
  FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS s
        FROM d JOIN (SELECT DISTINCT n FROM iw) AS lens ON len(words) >= n)),
hits AS (SELECT rid, n, s, item_id FROM dw JOIN iw USING (n, win)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, n, s FROM hits))
  GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

# CRC-32 of a decimal id: polynomial division bit by bit over its ASCII bytes.
_CRC = """(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(_field(f) for f in fields) + ")"


_OP11 = f"""
WITH RECURSIVE crc AS (
  SELECT *, doc_id IS NOT NULL AND xor({_CRC.format("doc_id::VARCHAR")}, 4294967295) % 7 = 0 AS tampered FROM documents),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_leaf()} AS leaf,
         CASE WHEN tampered THEN {_leaf("n_chars::HUGEINT + 1")} END AS other
  FROM crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM d),
lv AS (
  SELECT lang, 0 AS k, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lang, k + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM lv WHERE n > 1 GROUP BY lang, k, pos // 2),
parts AS (
  SELECT lang, digest, k AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS k, pos, digest, n FROM parts
  UNION ALL
  SELECT k + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM tv WHERE n > 1 GROUP BY k, pos // 2),
root AS (SELECT digest AS root, k AS height FROM tv WHERE n = 1),
steps AS (
  SELECT l.rid, w.k, l.pos >> w.k AS at, s.digest AS sibling
  FROM (SELECT l.rid, l.lang, l.pos, unnest(range(p.height)) AS k FROM leaves l JOIN parts p ON l.lang IS NOT DISTINCT FROM p.lang) w
  JOIN leaves l USING (rid)
  LEFT JOIN lv s ON s.lang IS NOT DISTINCT FROM w.lang AND s.k = w.k AND s.pos = xor(w.pos >> w.k, 1)
  UNION ALL
  SELECT w.rid, w.height + w.k, w.pos >> w.k, s.digest
  FROM (SELECT l.rid, p.height, p.pos, unnest(range(root.height)) AS k
        FROM leaves l JOIN parts p ON l.lang IS NOT DISTINCT FROM p.lang, root) w
  LEFT JOIN tv s ON s.k = w.k AND s.pos = xor(w.pos >> w.k, 1)),
folded AS (
  SELECT rid, 0 AS k, coalesce(other, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.node WHEN s.at % 2 = 0 THEN f.node || s.sibling
                                     ELSE s.sibling || f.node END)
  FROM folded f JOIN steps s ON f.rid = s.rid AND f.k = s.k),
ends AS (SELECT rid, arg_max(node, k) AS folded_root FROM folded GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM steps GROUP BY rid)
SELECT l.doc_id, l.leaf, p.digest AS subroot, root.root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = root.root AS verified
FROM leaves l JOIN parts p ON l.lang IS NOT DISTINCT FROM p.lang JOIN ends USING (rid) LEFT JOIN proofs USING (rid), root
"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.other)::INTEGER AS rank,
       n.other AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.other) <= 3
"""


def _text_key(text: str) -> str:
    bare = rf"regexp_replace({text}, '[\x09-\x0D\x20\x{{A0}}]+', '', 'g')"
    return f"CASE WHEN length({bare}) > 0 THEN md5({bare}) END"


def _shrink(table: str, prior: str, out: str, cols: str) -> str:
    """Rates of `table` (n, k) shrunk to column `prior`; the weight by the method of moments."""
    return f"""
  SELECT {cols}, n, k, {prior}, weight, (k + weight * {prior}) / (n + weight) AS {out}
  FROM {table}, (
    SELECT 1 / least(greatest(coalesce(
        sum((k - n * {prior}) * (k - n * {prior}) - n * {prior} * (1 - {prior}))
        / nullif(sum(n * (n - 1) * {prior} * (1 - {prior})), 0), 0.0001), 0.0001), 0.5) - 1 AS weight
    FROM {table})"""


_SHOWN = r"""
  replace(replace(replace(replace(replace(replace(replace(regexp_replace(
    regexp_extract(html, '(?s)<article[^>]*>(?:.*?</h1>)?(.*?)</article>', 1), '<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"""

_OP13 = rf"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         {_text_key("shown")} AS key
  FROM (SELECT *, {_SHOWN} AS shown FROM pages)),
marked AS (
  SELECT doc_id, max(greatest(1 - quality, toxic)) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND greatest(1 - quality, toxic) IS NOT NULL GROUP BY doc_id),
texts AS (
  SELECT key, (2 * sum(bad) >= count(*))::BIGINT AS bad
  FROM (SELECT doc_id, {_text_key("text")} AS key FROM documents) JOIN marked USING (doc_id)
  WHERE key IS NOT NULL GROUP BY key),
hosts0 AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         string_split(host, '.')[-1] AS suffix
  FROM p LEFT JOIN texts USING (key) GROUP BY host),
domains0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts0 GROUP BY domain, suffix),
ends0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains0 GROUP BY suffix),
ends1 AS (SELECT ends0.*, (all_k + 1) / (all_n + 2) AS overall FROM ends0, (SELECT sum(n) AS all_n, sum(k) AS all_k FROM ends0)),
ends AS ({_shrink("ends1", "overall", "suffix_rate", "suffix")}),
domains1 AS (SELECT domains0.*, suffix_rate FROM domains0 JOIN ends USING (suffix)),
domains AS ({_shrink("domains1", "suffix_rate", "domain_rate", "domain")}),
hosts1 AS (SELECT hosts0.*, domain_rate FROM hosts0 JOIN domains USING (domain)),
hosts AS ({_shrink("hosts1", "domain_rate", "rate", "host")}),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                 WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (n + weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN hosts USING (host)
"""

_OP4 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
grams AS (
  SELECT rid, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM w)),
twice AS (SELECT rid, g FROM grams GROUP BY rid, g HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT q) AS n
  FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM grams JOIN twice USING (rid, g)) GROUP BY rid),
m AS (
  SELECT w.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(lines) AS n_lines,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]', '', 'g')) AS unspaced,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS capitals,
         length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS letters,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*([-*•|]|[0-9]+[.)])\s'))) AS list_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS cut_lines
  FROM w LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words
            OR word_chars < 2 * n_words OR (word_chars > 15 * n_words AND 2 * unspaced <= word_chars)
            OR (2 * n_dup_lines > n_lines AND n_dup_lines >= 3)
            OR 2 * capitals > word_chars OR 2 * letters < word_chars
            OR 20 * len(list_distinct(words)) < n_words
            OR (n_lines >= 5 AND 10 * list_lines > 9 * n_lines)
            OR (n_lines >= 5 AND 10 * cut_lines > 3 * n_lines)) AS kept
FROM b
"""

# Kinds, patterns, the group whose length counts and its least length, as the operator lists them.
_KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("forge_token", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("map_key", r"AIza[A-Za-z0-9_-]+", 0, 39),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
    ("payment_key", r"(?:sk|rk)_live_[A-Za-z0-9]+", 0, 24),
]


def _kind_spans(number: int, kind: str, regex: str, group: int, least: int) -> str:
    """Spans of one kind: the pieces between matches and the matches give the positions."""
    pattern = regex.replace("'", "''")
    return f"""
  SELECT rid, {number} AS no, '{kind}' AS kind, before + hits_before AS first, before + hits_before + length(hit) AS stop
  FROM (SELECT rid, hits[k] AS hit, parts[k] AS part,
               list_sum(list_transform(gaps[1:k], lambda g: length(g)))::BIGINT AS before,
               coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0)::BIGINT AS hits_before
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k
              FROM (SELECT rid, regexp_extract_all(t, '{pattern}', 0) AS hits,
                           regexp_extract_all(t, '{pattern}', {group}) AS parts,
                           regexp_split_to_array(t, '{pattern}') AS gaps
                    FROM d WHERE regexp_matches(t, '{pattern}'))))
  WHERE length(part) >= {least}"""


_OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_kind_spans(n, *k) for n, k in enumerate(_KINDS))}),
g AS (
  SELECT rid, count(*) FILTER (WHERE no = 0) AS n_assign, count(*) FILTER (WHERE no = 1) AS n_access,
         count(*) FILTER (WHERE no = 2) AS n_hex,
         string_agg(kind || ':' || first || ':' || stop, ',' ORDER BY first, no) FILTER (WHERE no < 3) AS base,
         string_agg(kind || ':' || first || ':' || stop, ',' ORDER BY first, no) AS spans
  FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""

_OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         -- '### ', the escaped role, ': ', the escaped text, ' </turn>' and a line end
         15 + 2 * length(role) - length(translate(role, '\<#:', '')) + 2 * length(text) - length(translate(text, '\<#', '')) AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLE: dict[str, str] = {
    "op1_secret_scan": _OP1,
    "op6_chat_format": _OP6,
    "op4_quality_rules": _OP4,
    "op7_decontamination": _OP7,
    "op11_merkle_manifest": _OP11,
    "op12_hard_negatives": _OP12,
    "op13_url_filter": _OP13,
}
