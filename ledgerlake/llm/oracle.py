"""DuckDB twins of the queries that SQL can state."""

from . import pii_scan as _pii


def _pii_sql() -> str:
    """Every proposal of every pattern as a row; positions are sums of the lengths of pieces and matches before."""
    def text(s: str) -> str:
        return "'" + s.replace("\\x20", " ").replace("'", "''") + "'"

    def luhn(x: str) -> str:
        doubled = f"CAST(substr({x}, length({x}) - i, 1) AS INTEGER) * (1 + i % 2)"
        return f"coalesce(list_sum(list_transform(range(length({x})), lambda i: CASE WHEN {doubled} > 9 THEN {doubled} - 9 ELSE {doubled} END)) % 10 = 0, false)"

    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    iban = "replace(value, ' ', '')"
    turned = f"string_split(substr({iban}, 5) || substr({iban}, 1, 4), '')"
    checks = {
        ("email", True): "true", ("ip", True): f"regexp_matches(value, {text(_pii.IP_RANGES)})", ("card", True): f"length({digits}) BETWEEN 16 AND 19 AND {luhn(digits)}",
        ("phone", True): f"length({digits}) BETWEEN 8 AND 15", ("ip", False): "true", ("card", False): f"regexp_matches({digits}, {text(_pii.ISSUERS)}) AND {luhn(digits)}",
        ("phone", False): f"regexp_matches({digits}, {text(_pii.PHONE_RANGES)})", ("ssn", False): f"regexp_matches(value, {text(_pii.SSN_RANGES)})",
        ("iban", False): f"list_reduce({turned}, lambda r, s: CASE WHEN ascii(s) < 58 THEN (CAST(r AS INTEGER) * 10 + ascii(s) - 48) % 97 ELSE (CAST(r AS INTEGER) * 100 + ascii(s) - 55) % 97 END, 0) = 1",
    }
    patterns = [(k, True, p, 0) for k, p in _pii.BASE_PATTERNS.items()] + [("card", False, _pii.BASE_PATTERNS["card"], 0)] + [(k, False, p, 1) for k, p in _pii.ADDED_PATTERNS.items()]
    parts = []
    for kind, base, pattern, group in patterns:
        points = (_pii.BASE_POINTS if base else _pii.ADDED_POINTS)[kind]
        goes_on = f" AND NOT regexp_matches(after, {text(_pii.GOES_ON[kind])})" if group else ""
        parts.append(f"""
  SELECT rid, {_pii.KINDS.index(kind)} AS ord, '{kind}' AS kind, {base} AS base, stop - length(value) AS start, stop,
         {points} + CASE WHEN regexp_matches(near, {text(_pii.near_pattern(_pii.CONTEXT_WORDS[kind]))}) THEN {_pii.CONTEXT} ELSE 0 END
         - CASE WHEN regexp_matches(near, {text(_pii.near_pattern(_pii.OTHER_WORDS))}) THEN {_pii.OTHER} ELSE 0 END AS points
  FROM (SELECT *, translate(before || ' ' || chr(10) || ' ' || after, '{_pii.UPPER}', '{_pii.LOWER}') AS near
        FROM (SELECT rid, g[i] AS value, right(p[i], {_pii.NEAR}) AS before, left(p[i + 1], {_pii.NEAR}) AS after,
                     CAST(list_sum(list_transform(p[1:i], lambda s: length(s))) + list_sum(list_transform(m[1:i], lambda s: length(s))) AS BIGINT) AS stop
              FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
                    FROM (SELECT rid, regexp_extract_all(t, {text(pattern)}) AS m, regexp_extract_all(t, {text(pattern)}, {group}) AS g,
                                 string_split_regex(t, {text(pattern)}) AS p FROM d) a) b) c) e
  WHERE {checks[kind, base]}{goes_on}""")
    n = ", ".join(f"CAST(count(*) FILTER (WHERE s.base AND s.kind = '{k}') AS BIGINT) AS n_{k}" for k in _pii.BASE_PATTERNS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t FROM documents),
proposals AS ({" UNION ALL ".join(parts)}),
kept AS (SELECT * FROM proposals a WHERE base OR points >= 60 AND NOT EXISTS (
           SELECT 1 FROM proposals b WHERE b.base AND b.rid = a.rid AND a.start < b.stop AND b.start < a.stop)),
spans AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM kept)
SELECT d.doc_id, {n},
       sha256(coalesce(string_agg(s.span, ',' ORDER BY s.ord, s.start) FILTER (WHERE s.base), '')) AS base_sha256,
       coalesce(string_agg(s.span, ',' ORDER BY s.ord, s.start, s.stop), '') AS spans
FROM d LEFT JOIN spans s ON s.rid = d.rid GROUP BY d.rid, d.doc_id
"""


ORACLE_SQL: dict[str, str] = {
    "op11_pii_scan": _pii_sql(),
    "op9_block_neighbours": """
WITH v AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.id AS query_id, c.id AS vec_id, max(list_dot_product(q.e, c.e)) AS score
  FROM v q JOIN v c ON q.id <> c.id AND len(q.e) = len(c.e)
  WHERE q.id % 20 = 0
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
""",
    "op12_prefix_trie": """
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS r,
         substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS dt,
         CAST(length(coalesce(text, '')) AS BIGINT) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, dt) AS p, dt, chars FROM t),
ids AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, b)),
      4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM t) d),
opening AS (SELECT i.c, o.p, o.dt, o.chars FROM ids i JOIN own o ON o.c = i.base AND o.p <= i.h),
taken AS (SELECT i.c, i.h, count(o.p) AS n FROM ids i LEFT JOIN opening o ON o.c = i.c GROUP BY i.c, i.h),
rebuilt AS (SELECT * FROM opening UNION ALL
            SELECT o.c, o.p - k.h + k.n, o.dt, o.chars FROM own o JOIN taken k ON o.c = k.c AND o.p > k.h),
paths AS (SELECT c, p, chars, list(dt) OVER (PARTITION BY c ORDER BY p) AS pre FROM rebuilt
          UNION ALL SELECT c, 0, 0, [] FROM ids),
nodes AS (SELECT pre, p AS depth, min(c) AS conv_id, count(*) AS n, min(chars) AS chars FROM paths GROUP BY pre, p),
steps AS (SELECT a.c, a.p, n.conv_id AS node FROM paths a JOIN nodes n ON a.pre = n.pre AND a.p = n.depth),
linked AS (SELECT n.*, s.node AS parent FROM nodes n LEFT JOIN steps s ON s.c = n.conv_id AND s.p = n.depth - 1),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
tree AS (SELECT l.*, coalesce(k.n_children, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.parent = l.conv_id AND k.depth = l.depth),
totals AS (SELECT s.node, s.p, sum(CASE WHEN y.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((y.n - 1) * y.chars) AS saved
           FROM tree y JOIN steps s ON s.c = y.conv_id AND s.p <= y.depth GROUP BY s.node, s.p),
last AS (SELECT c, max(p) AS p FROM paths GROUP BY c),
ends AS (SELECT s.node, s.p, sha256(string_agg(CAST(l.c AS VARCHAR), ',' ORDER BY l.c)) AS digest FROM last l JOIN steps s ON s.c = l.c AND s.p = l.p GROUP BY s.node, s.p)
SELECT y.conv_id, CAST(y.depth AS BIGINT) AS depth, y.parent AS parent_conv_id, CAST(y.n AS BIGINT) AS n_convs, CAST(y.n_children AS BIGINT) AS n_children,
       CAST(g.n_leaves AS BIGINT) AS n_leaves, CAST(g.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM tree y JOIN totals g ON g.node = y.conv_id AND g.p = y.depth LEFT JOIN ends e ON e.node = y.conv_id AND e.p = y.depth
""",
}
