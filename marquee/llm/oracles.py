"""DuckDB SQL for the queries that SQL can express.

Mixing (random rounding), token files, the trained classifiers, mined url
rules and edit distances have none; tests compare them with brute force.
"""

from __future__ import annotations

from marquee.llm import chat, quality

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = rf"list_filter(regexp_split_to_array(coalesce({{0}}, ''), '{_SPACE}+'), lambda x: x <> '')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(m.b, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""


def _op2() -> str:
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    listed = lambda ws: "[" + ", ".join(map(quote, ws)) + "]"
    common = ("CASE " + " ".join(f"WHEN lang = {quote(k)} THEN {listed(v)}" for k, v in quality.COMMON_WORDS.items())
              + f" ELSE {listed(quality._ALL_COMMON)} END")
    rest, counts = f"regexp_replace(t, '[a-z{_SPACE[1:-1]}]+', '', 'g')", []
    for pattern in quality.CLASS_PATTERNS.values():
        step = f"regexp_replace({rest}, '{pattern}', '', 'g')"
        counts.append(f"length({rest}) - length({step})")
        rest = step
    classes = ", ".join([f"length(t) - length(regexp_replace(t, '{_SPACE}+', '', 'g'))",
                         f"length(regexp_replace(t, '{_SPACE}+', '', 'g')) - length(regexp_replace(t, '[a-z{_SPACE[1:-1]}]+', '', 'g'))",
                         *counts, f"length({rest})"])
    js = lambda p, q: (
        f"round(sqrt(greatest(list_sum([CASE WHEN x[1] > 0 THEN x[1] * log2(x[1] / ((x[1] + x[2]) / 2)) / 2 ELSE 0 END"
        f" + CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / ((x[1] + x[2]) / 2)) / 2 ELSE 0 END"
        f" FOR x IN [[{p}[i] / list_sum({p}), {q}[i] / list_sum({q})] FOR i IN range(1, len({p}) + 1)]]), 0)), {quality.DIGITS})")
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS.format('text')} AS ws FROM documents),
b AS (SELECT doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, length(t) AS n_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE[1:-1]}]')) AS lines,
        [{classes}] AS chars, {common} AS cw, ws FROM d),
c AS (SELECT *, [len(list_filter(ws, lambda y: y = x)) FOR x IN cw] AS hits FROM b),
f AS (SELECT * EXCLUDE (hits), list_concat(hits, [n_words - list_sum(hits)]) AS common FROM c),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM
        (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
q AS (SELECT lang, list(s ORDER BY i) AS qc FROM (SELECT lang, i, sum(chars[i]) AS s FROM f, range(1, {len(quality.CHAR_CLASSES) + 1}) x(i) GROUP BY ALL) GROUP BY lang),
qw AS (SELECT lang, list(s ORDER BY i) AS qw FROM (SELECT lang, i, sum(common[i]) AS s FROM (SELECT lang, common, unnest(range(1, len(common) + 1)) AS i FROM f) GROUP BY ALL) GROUP BY lang),
j AS (SELECT f.*, coalesce(r.n, 0) AS n_repeat_words,
        CASE WHEN n_chars >= {quality.LEAST_CHARS} THEN {js('chars', 'qc')} END AS js_chars,
        CASE WHEN n_words >= {quality.LEAST_WORDS} THEN {js('common', 'qw')} END AS js_words
      FROM f JOIN q ON q.lang IS NOT DISTINCT FROM f.lang JOIN qw ON qw.lang IS NOT DISTINCT FROM f.lang LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(js_chars, 0) <= {quality.MOST_CHAR_DISTANCE}
         AND coalesce(js_words, 0) <= {quality.MOST_WORD_DISTANCE} AS kept, js_chars, js_words
FROM j
"""


_ESCAPED = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
_ROLE = rf"replace({_ESCAPED.format('role')}, chr(10), '<\N>')"
_OP6 = f"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{chat.LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       sum({len(chat.TURN_START) + 1 + len(chat.TURN_END)} + length({_ROLE}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

_OP9 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, count(*) OVER (PARTITION BY md5(h[2 * i - 1:2 * i + 398])) AS c
      FROM (SELECT doc_id, h, unnest(range(1, octet_length(b) - 198)) AS i FROM d WHERE octet_length(b) >= 200)),
m AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM w WHERE c > 1),
s AS (SELECT doc_id, i, sum(CASE WHEN prev IS NULL OR i > prev + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 199 AS z FROM s GROUP BY ALL),
x AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last,
        string_agg(h[2 * before + 1:2 * (a - 1)], '' ORDER BY a) AS head FROM x JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || h[2 * last + 1:] END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_CENTROIDS = """
{b} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM {a} c LEFT JOIN (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
  FROM (SELECT c, i, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM {near}) GROUP BY ALL) GROUP BY c) m USING (c)),"""
_NEAREST = """
{near} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT v.*, c.c, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, {a} c) GROUP BY rid),"""
_OP12 = ("""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, x) - 1 AS c, x FROM v QUALIFY c < 16),"""
         + "".join(_NEAREST.format(near=f"n{r}", a=f"k{r}") + _CENTROIDS.format(a=f"k{r}", b=f"k{r + 1}", near=f"n{r}") for r in range(3))
         + _NEAREST.format(near="n3", a="k3") + """
sizes AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM n3 GROUP BY c)
SELECT vec_id, n3.c::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM n3) AS inertia,
       sha256(array_to_string(k3.x, ',')) AS centroid_sha256
FROM n3 JOIN sizes USING (c) JOIN k3 USING (c)""")

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
#: crc32 (reflected polynomial 0xEDB88320), byte by byte over the digits.
_CRC = """xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
  lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))))"""
_LEVELS = """
{name} AS (SELECT tree, 0 AS level, idx, node, n FROM {leaves} UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3),
{name}_steps AS (SELECT tree, level, idx, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, idx // 3 ORDER BY idx)),"""
_FOLD = """
{name} AS (SELECT * FROM {start} UNION ALL
  SELECT rid, f.tree, f.level + 1, f.idx // 3, sha256(l || acc || r), proof || l || r FROM {name} f JOIN {steps} s USING (tree, level, idx)),
{name}_end AS (SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1),"""
_OP13 = (f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, {_LEAF.format(text='text')} AS node,
  CASE WHEN {_CRC} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text='text')} END AS copy FROM documents),
leaves AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS idx FROM d),"""
         + _LEVELS.format(name="low", leaves="leaves") + """
tops AS (SELECT -1 AS tree, tree AS idx, node, count(*) OVER () AS n FROM low WHERE low.n = 1),"""
         + _LEVELS.format(name="high", leaves="tops") + """
below AS (SELECT rid, tree, 0 AS level, idx, copy AS acc, '' AS proof FROM leaves),""" + _FOLD.format(name="up", start="below", steps="low_steps") + """
above AS (SELECT rid, -1 AS tree, 0 AS level, leaves.tree AS idx, acc, proof FROM up_end JOIN leaves USING (rid)),"""
         + _FOLD.format(name="over", start="above", steps="high_steps") + """
top AS (SELECT node AS root FROM high WHERE n = 1)
SELECT doc_id, leaves.node AS leaf, tops.node AS subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM leaves JOIN over_end USING (rid) JOIN tops ON tops.idx = leaves.tree, top""")

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": _OP1,
    "op2_quality_rules": _op2(),
    "op6_chat_format": _OP6,
    "op9_substring_dedup": _OP9,
    "op12_centroid_clustering": _OP12,
    "op13_merkle_manifest": _OP13,
}
