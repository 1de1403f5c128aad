"""The SQL that queries of this subpackage are checked against, where SQL can express them."""

from __future__ import annotations

from rivulet.llm.secret_scan import ACCESS, ASSIGN, ASSIGN_VALUE, CLASSES, HEX, WINDOW, highest_sum, weights

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""

_RULES = [("www.example.com", "/en/", "www.example.com/en/", "allow"),
          ("example.com", "/en/", "example.com/en/", "block"), ("net", "/es/", "net/es/", "block"),
          ("net", "/fr/", "net/fr/", "block"), ("com", "/", "com/", "allow")]


def _first_rule(column: int) -> str:
    return "CASE " + " ".join(
        f"WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') "
        f"THEN '{r[column]}'" for r in _RULES) + " END"


URLS_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id, {LOWER.format("regexp_extract(coalesce(r, ''), '^[^/?#]*')")} AS host,
    regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
)
SELECT page_id, host, path, {_first_rule(2)} AS rule, coalesce({_first_rule(3)}, 'allow') AS verdict
FROM parts
"""

DEDUP_SQL = f"""
WITH d AS (
  SELECT doc_id, sha256({LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  coalesce(doc_id = max(doc_id) OVER same, false) AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matches(pattern: str, extra: str = "0") -> str:
    """Rows (doc_id, s, e, x, m) of all matches of a pattern; x is ``extra`` of match i."""
    return f"""
  SELECT doc_id, s, s + length(m) AS e, x, m FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{
      's': CAST(list_sum(list_transform(gs[1:i], lambda y: length(y)))
        + coalesce(list_sum(list_transform(ms[1:i - 1], lambda y: length(y))), 0) AS BIGINT),
      'm': ms[i], 'x': {extra}}}), recursive := true)
    FROM (SELECT doc_id, t, regexp_extract_all(t, {_text(f"({pattern})")}, 1) AS ms,
            string_split_regex(t, {_text(pattern)}) AS gs FROM d))"""


#: Candidates that match one of these as a whole hold no secret; windows that meet a placeholder word or a
#: base span do not count. Fixed values.
_WHOLE = ("^[^0-9]*$", "^[^A-Za-z]*$", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
          "^[A-Za-z]{0,24}([-_/+]+([A-Za-z]{1,24}|[0-9]{1,12}))+[-_/+]*$")
_WORDS = "((?i)example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefgh)"


def _windows(letters: str, bits: float) -> str:
    pattern = f"{letters}{{{WINDOW},}}"
    allowed = " OR ".join(f"regexp_matches(m, {_text(p)})" for p in _WHOLE)
    window = f"m[o + 1:o + {WINDOW}]"
    counted = f"""list_sum(list_transform(list_distinct(string_split({window}, '')),
        lambda c: (SELECT_W)[len({window}) - len(replace({window}, c, '')) + 1]))"""
    counted = counted.replace("(SELECT_W)", "[" + ", ".join(map(str, weights())) + "]")
    return f"""
  SELECT doc_id, s + o AS s FROM (
    SELECT doc_id, s, m, words, gaps, unnest(range(0, length(m) - {WINDOW} + 1)) AS o
    FROM (SELECT *, regexp_extract_all(m, {_text(_WORDS)}) AS words, string_split_regex(m, {_text(_WORDS)}) AS gaps
          FROM ({_matches(pattern)}) q WHERE NOT ({allowed})) c) w
  WHERE {counted} <= {highest_sum(bits)}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s < w.s + o + {WINDOW} AND w.s + o < b.e)
    AND (len(words) = 0 OR len(list_filter(range(1, len(words) + 1), lambda i:
      len(array_to_string(gaps[1:i], '')) + len(array_to_string(words[1:i - 1], '')) < o + {WINDOW}
      AND o < len(array_to_string(gaps[1:i], '')) + len(array_to_string(words[1:i], '')))) = 0)"""


SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (
  SELECT doc_id, s, e, 0 AS k, 'assign' AS kind FROM (
    {_matches(ASSIGN, f"length(regexp_extract_all(t, {_text(ASSIGN)}, 2)[i])")}) WHERE x >= {ASSIGN_VALUE}
  UNION ALL SELECT doc_id, s, e, 1, 'access' FROM ({_matches(ACCESS[1:-1])})
  UNION ALL SELECT doc_id, s, e, 2, 'hex' FROM ({_matches(HEX[1:-1])})
), hot AS (
  {" UNION ALL ".join(_windows(*c) for c in CLASSES)}
), opened AS (
  SELECT doc_id, s, CASE WHEN s <= max(s) OVER before + {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hot
  WINDOW before AS (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), islands AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM opened
), spans AS (
  SELECT * FROM base
  UNION ALL SELECT doc_id, min(s), max(s) + {WINDOW}, 3, 'entropy' FROM islands GROUP BY doc_id, island
), digests AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN digests USING (doc_id)
"""


#: Levels that the SQL of the manifest can climb; 16^9 rows are more than it will meet.
_LEVELS = 9


def _field(column: str, text: str | None = None) -> str:
    value = text or f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [_field("text", text)]
    return f"sha256({' || '.join(fields)})"


def _climb(name: str) -> str:
    """CTEs <name>0 to <name>9 (grp, pos, h, total) and their runs (grp, run, t): a node stays where it is alone."""
    parts = []
    for level in range(_LEVELS):
        here = f"{name}{level}"
        parts.append(f"""{name}_runs{level} AS MATERIALIZED (
  SELECT grp, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS t FROM {here} WHERE total > 1 GROUP BY ALL
), {name}{level + 1} AS MATERIALIZED (
  SELECT grp, pos, h, count(*) OVER (PARTITION BY grp) AS total FROM (
    SELECT grp, run AS pos, sha256(t) AS h FROM {name}_runs{level}
    UNION ALL SELECT grp, pos, h FROM {here} WHERE total = 1)
)""")
    return ", ".join(parts)


def _fold(state: str, name: str, grp: str, pos: str) -> str:
    """CTEs that carry (proof, folded) of every leaf over the levels of <name>; the last is <state>9."""
    parts = []
    for level in range(_LEVELS):
        at = f"({pos} // {16 ** level} % 16)"
        parts.append(f"""{state}{level + 1} AS MATERIALIZED (
  SELECT s.* REPLACE (
    CASE WHEN t IS NULL THEN proof ELSE proof || t[1:64 * {at}] || t[64 * {at} + 65:] END AS proof,
    CASE WHEN t IS NULL THEN folded ELSE sha256(t[1:64 * {at}] || folded || t[64 * {at} + 65:]) END AS folded)
  FROM {state}{level} s LEFT JOIN {name}_runs{level} r ON s.{grp} = r.grp AND s.{pos} // {16 ** (level + 1)} = r.run
)""")
    return ", ".join(parts)


#: crc32 from its polynomial: a register is divided bit by bit, over the bytes of a short text.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ord(c) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

MERKLE_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, '') AS grp, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(LOWER.format("text"))} END AS other
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY grp) AS total FROM d
), n0 AS MATERIALIZED (SELECT grp, pos, leaf AS h, total FROM leaves), {_climb("n")},
g0 AS MATERIALIZED (
  SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, h, count(*) OVER () AS total, grp AS name FROM n{_LEVELS}
), {_climb("g")},
a0 AS MATERIALIZED (
  SELECT doc_id, leaf, l.grp, l.pos, g0.pos AS gpos, g0.grp AS everything, g0.h AS subroot, '' AS proof,
    coalesce(other, leaf) AS folded
  FROM leaves l JOIN g0 ON l.grp = g0.name
), {_fold("a", "n", "grp", "pos")},
b0 AS MATERIALIZED (SELECT * FROM a{_LEVELS}), {_fold("b", "g", "everything", "gpos")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM b{_LEVELS}, (SELECT h AS root FROM g{_LEVELS})
"""
