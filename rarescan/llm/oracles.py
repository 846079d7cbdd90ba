"""DuckDB SQL of the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]+"

# ---- op2: sets by word, links by join, components by reachability ---------------------

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i : i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

# ---- op7: counts, and levels by the exact binomial tail --------------------------------

_SHARES = {
    "n_symbols / n": (2.0, 1.0, 0.4, 0.3, 0.2, 0.1),
    "n_repeat_words / n": (0.18, 0.15, 0.12, 0.1, 0.08, 0.05),
    "n_dup_lines / greatest(n_lines, 1)": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "upper / greatest(word_chars, 1)": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "stress / n": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
}
_BY_LEVEL = [
    " OR ".join(f"{share} > {cuts[level]}" for share, cuts in _SHARES.items()) for level in range(6)
]
_RISK, _LEVEL = 0.02, 0.05

QUALITY = rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, w[i : i + 4] AS five FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS c FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS c FROM twice, range(5) AS five(k) GROUP BY doc_id),
f AS (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
  CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words, greatest(len(w), 1) AS n,
  length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS upper,
  length(text) - length(translate(text, '!?', '')) AS stress
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
v AS (SELECT *, [{', '.join(_BY_LEVEL)}] AS above FROM b),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
c AS (SELECT lang, count(*) AS n, {', '.join(f'count(*) FILTER (above[{i + 1}]) AS k{i}' for i in range(6))}
  FROM v SEMI JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY lang),
p AS (SELECT *, [{', '.join(f'k{i}' for i in range(6))}] AS ks, {_LEVEL} / count(*) OVER () AS allowed FROM c),
tail AS (SELECT lang, level, allowed, k < {_RISK} * n AND list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({_RISK}) + (n - i) * ln({1 - _RISK})) FOR i IN range(0, k + 1)]) <= allowed AS ok
  FROM (SELECT *, unnest(ks) AS k, unnest(range(1, 7)) AS level FROM p)),
passed AS (SELECT lang, coalesce(min(level) FILTER (NOT ok), 7) - 1 AS passed FROM tail GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(above[nullif(passed, 0)], FALSE) AS kept
FROM v LEFT JOIN passed ON passed.lang IS NOT DISTINCT FROM v.lang"""

# ---- op9: hashes of the turns, and the length of the escaped and marked text -----------

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS text2,
  replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') AS role2,
  CASE role WHEN 'assistant' THEN 'a' WHEN 'user' THEN 'u' WHEN 'system' THEN 's' ELSE '?' END AS r FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  string_agg('<|im_start|>' || role2 || chr(10) || text2 || '<|im_end|>' || chr(10), '') AS formatted,
  string_agg(r, '' ORDER BY turn NULLS FIRST, role, text) AS roles FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(length(formatted) AS BIGINT) AS formatted_chars,
  regexp_full_match(roles, 's?(ua)+') AS valid FROM g"""

# ---- op10: matches by place, and who owns their values ---------------------------------

_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = (
    ("assign", _ASSIGN, 6),
    ("access", "AKIA[A-Z0-9]+", 20),
    ("hex", "[0-9a-f]{24,}", 24),
    ("bearer", "[Bb]earer\\x20+[A-Za-z0-9._~+/=-]{20,}", 27),
    ("vendor", "\\b(?:gh[opsu]_|sk_live_|xox[abp]-)[A-Za-z0-9_-]{16,}", 20),
    ("opaque", "[A-Za-z0-9+/_-]{32,}={0,2}", 32),
)


def _kind_sql(rank: int, name: str, pattern: str, least: int) -> str:
    value = "regexp_extract(m, p, 2)" if name == "assign" else "m"
    mixed = (
        " AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]')"
        if name == "opaque"
        else ""
    )
    return f"""SELECT doc_id, source, {rank} AS rank, '{name}' AS kind, start, start + length(m) AS stop, v FROM (
  SELECT *, {value} AS v, list_sum([length(x) FOR x IN list_concat(gaps[1 : i], ms[1 : i - 1])]) AS start FROM (
    SELECT *, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT doc_id, source, '{pattern}' AS p, regexp_extract_all(text, '{pattern}') AS ms,
        regexp_split_to_array(text, '{pattern}') AS gaps FROM documents WHERE regexp_matches(text, '{pattern}'))))
  WHERE length(v) >= {least}{mixed}"""


SECRETS = f"""
WITH s AS ({' UNION ALL '.join(_kind_sql(r, *k) for r, k in enumerate(_KINDS))}),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners FROM s GROUP BY v),
j AS (SELECT s.*, owners < 5 AS live FROM s JOIN o USING (v)),
k AS (SELECT *, rank < 3 AS base, NOT EXISTS (SELECT 1 FROM s b WHERE b.doc_id = j.doc_id AND b.rank < 3
  AND b.start < j.stop AND j.start < b.stop) AS apart FROM j),
d AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (base), '') AS base,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (base OR (live AND apart)), '') AS spans,
  count(*) FILTER (base AND live) AS n_live, count(*) FILTER (base AND NOT live) AS n_copied FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied FROM documents LEFT JOIN d USING (doc_id)"""

# ---- crc32, byte by byte ---------------------------------------------------------------

_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
# of one byte; a query's first CTE
CRC_TABLE = (
    f"crc AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, k: {_BIT}, i) ORDER BY i) AS t FROM range(256) r(i))"
)


def crc_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; needs CRC_TABLE joined as ``crc``."""
    codes = f"[CAST('0x' || substr(hex({text}), 2 * CAST(k AS INT) + 1, 2) AS BIGINT) FOR k IN range(strlen({text}))]"
    step = "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce({codes}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


# ---- op11: levels by recursion, one row per leaf and level -----------------------------

_FIELD = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
_FIELDS = " || ".join(
    _FIELD.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")
)


def _levels(name: str, start: str) -> str:
    """All nodes (tree, level, node, n, hash) above the leaves of ``start`` (tree, node, n, hash)."""
    return f"""{name} AS (SELECT tree, 0 AS level, node, n, hash FROM {start} UNION ALL
  SELECT tree, level + 1, node // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY node))
  FROM {name} WHERE n > 1 GROUP BY tree, level, node // 3, n)"""


MANIFEST = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT source AS tree, doc_id, sha256({_FIELDS} || {_FIELD.format('text')}) AS hash,
  sha256({_FIELDS} || {_FIELD.format("replace(text, chr(10), '')")}) AS other,
  {crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS even FROM documents, crc),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS node, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_levels('a', 'l')},
s AS (SELECT tree AS own, hash, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS node, count(*) OVER () AS n, 0 AS tree
  FROM a WHERE n = 1),
{_levels('b', 's')},
u AS (SELECT coalesce(tree, chr(0)) AS tree, level, node, n, hash FROM a),
p AS (SELECT doc_id, coalesce(tree, chr(0)) AS tree, 0 AS level, node, n, '' AS proof,
  CASE WHEN even THEN other ELSE hash END AS folded FROM l UNION ALL
  SELECT doc_id, p.tree, p.level + 1, p.node // 3, (any_value(p.n) + 2) // 3,
  any_value(proof) || coalesce(string_agg(u.hash, '' ORDER BY u.node) FILTER (u.node <> p.node), ''),
  sha256(string_agg(CASE WHEN u.node = p.node THEN folded ELSE u.hash END, '' ORDER BY u.node))
  FROM p JOIN u ON u.tree = p.tree AND u.level = p.level AND u.node // 3 = p.node // 3 WHERE p.n > 1
  GROUP BY doc_id, p.tree, p.level, p.node),
q AS (SELECT doc_id, p.tree, 0 AS level, s.node, s.n, proof, folded FROM p JOIN s ON coalesce(own, chr(0)) = p.tree WHERE p.n = 1 UNION ALL
  SELECT doc_id, q.tree, q.level + 1, q.node // 3, (any_value(q.n) + 2) // 3,
  any_value(proof) || coalesce(string_agg(b.hash, '' ORDER BY b.node) FILTER (b.node <> q.node), ''),
  sha256(string_agg(CASE WHEN b.node = q.node THEN folded ELSE b.hash END, '' ORDER BY b.node))
  FROM q JOIN b ON b.level = q.level AND b.node // 3 = q.node // 3 WHERE q.n > 1 GROUP BY doc_id, q.tree, q.level, q.node)
SELECT l.doc_id, l.hash AS leaf, s.hash AS subroot, b.hash AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = b.hash AS verified
FROM l JOIN s ON own IS NOT DISTINCT FROM l.tree JOIN b ON b.n = 1 JOIN q ON q.doc_id = l.doc_id AND q.n = 1"""

# ---- op12: counts by word, one weight per context ---------------------------------------

_TIMES = ", ".join(f"count(*) FILTER (c = {r}) AS n{r}" for r in range(1, 7))
_TURING = ", ".join(f"{r + 1} * n{r + 1} / ({r} * n{r})" for r in range(1, 6))


def _keeps(counts: str, name: str) -> str:
    """``name`` (t, slope): Turing's estimates if all are below 1, and the slope of the counts of counts."""
    points = ", ".join(f"(ln({r}), ln(nullif(n{r}, 0)))" for r in range(1, 7))
    slope = f"(SELECT CASE WHEN count(y) < 2 THEN -2 ELSE least(regr_slope(y, x), -1.1) END FROM (VALUES {points}) v(x, y))"
    return f"""{name} AS (SELECT CASE WHEN least(n1, n2, n3, n4, n5, n6) > 0 THEN [{_TURING}] END AS t, {slope} AS slope
  FROM (SELECT {_TIMES} FROM {counts}))"""


_KEEP = "c * CASE WHEN c <= 5 AND list_max(t) < 1 THEN t[c] ELSE (1 + 1e0 / c) ** (slope + 1) END"

KATZ = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, {crc_sql("CAST(doc_id AS VARCHAR)")} % 7 = 2 AS held_out,
  list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{SPACE}'), lambda x: x <> '') || [''] AS w FROM documents, crc),
k AS (SELECT doc_id, held_out, CASE WHEN i = 1 THEN ' ' ELSE w[i - 1] END AS v, w[i] AS w
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)),
c1 AS (SELECT w, count(*) AS c FROM k WHERE NOT held_out GROUP BY w),
c2 AS (SELECT v, w, count(*) AS c FROM k WHERE NOT held_out GROUP BY v, w),
{_keeps('c1', 'k1')}, {_keeps('c2', 'k2')},
n AS (SELECT sum(c) AS n, count(*) AS v FROM c1),
p1 AS (SELECT w, c, {_KEEP} / n AS p FROM c1, k1, n),
u AS (SELECT sum(c - p * n) / any_value(n) AS unknown FROM p1, n),
x AS (SELECT v, sum(c) AS size FROM c2 GROUP BY v),
p2 AS (SELECT v, w, {_KEEP} AS kept, c, size FROM c2 JOIN x USING (v), k2),
a AS (SELECT v, sum(p2.c - kept) / any_value(size) / (1 - sum(p)) AS weight FROM p2 JOIN p1 USING (w) GROUP BY v),
s AS (SELECT doc_id, held_out, p1.c IS NOT NULL AS known, log10((coalesce(p1.c, 0) + 1) / (n + v.v + 1)) AS base,
  CASE WHEN p2.c IS NOT NULL THEN log10(kept / size)
    ELSE log10(CASE WHEN p1.c IS NULL THEN unknown ELSE p END) + coalesce(log10(weight), 0) END AS score
  FROM k LEFT JOIN p1 USING (w) LEFT JOIN p2 ON p2.v = k.v AND p2.w = k.w LEFT JOIN a ON a.v = k.v, n AS v, u)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (known) AS n_known,
  (SELECT CAST(n AS BIGINT) FROM n) AS train_tokens,
  round(fsum(base), 6) AS base_score, round(fsum(score), 6) AS score FROM s GROUP BY doc_id, held_out"""

# ---- op13: words without one letter join their neighbours -------------------------------

VARIANTS = rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS word FROM documents) GROUP BY ALL),
h AS (SELECT word, n, {crc_sql("(doc_id || ':' || word)")} AS h FROM r, crc),
e AS (SELECT CASE WHEN h % 199 = 0 THEN word[: h % length(word)] || word[h % length(word) + 2 :] ELSE word END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
o AS (SELECT word, n, i, word[: i - 1] AS head, word[i + 1 :] AS tail FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM o a JOIN o b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT o.word, w.word, w.n FROM o JOIN w ON w.word = head || tail
  UNION SELECT w.word, o.word, o.n FROM o JOIN w ON w.word = head || tail),
b AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM near GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
  CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
c AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL
  SELECT c.word, f.form, step + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, step) AS root FROM c GROUP BY word) USING (word)"""
