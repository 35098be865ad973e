"""DuckDB SQL for the queries that SQL can express."""
from __future__ import annotations

from . import mixing

_TEXT = "coalesce(text, '')"

OP4 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS escaped,
  length(regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS role_chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + role_chars + 1 + escaped + 10 + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP5 = f"""
WITH n AS (SELECT doc_id, length({_TEXT}) AS cp, regexp_replace({_TEXT}, '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, first(doc_id ORDER BY cp DESC, doc_id ASC NULLS LAST) AS keep_id FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)"""


OP13 = """
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h FROM documents),
p AS (SELECT doc_id, t, h, CAST(length(t) AS BIGINT) AS n_chars, row_number() OVER (ORDER BY doc_id NULLS FIRST, h) AS pos, count(*) OVER () AS n FROM d),
e AS (SELECT p.*, left(p.t, p.n_chars - p.n_chars // 2) || left(q.t, p.n_chars // 2) AS edited, q.pos AS next_pos FROM p JOIN p q ON q.pos = p.pos % p.n + 1),
x AS (SELECT pos, 0 AS kind, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM e
  UNION ALL SELECT pos, 1, regexp_extract_all(edited, '[^\\x20\\x09-\\x0D]+') FROM e),
m AS (SELECT pos, kind, list_transform(w, lambda x: CAST('0x' || left(md5(x), 7) AS BIGINT)) AS w FROM x),
k AS (SELECT pos, kind, i - 1 AS place, (w[i] * 1566083941 + coalesce(w[i + 1], 0) * 1812433253 + coalesce(w[i + 2], 0) * 2083697861) % 2147483647 AS kmer
  FROM (SELECT pos, kind, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM m WHERE len(w) > 0)),
r AS (SELECT pos, kind, place, (kmer * 1284865837 + 981584591 * (row_number() OVER (PARTITION BY pos, kind, kmer ORDER BY place) - 1)) % 2147483647 AS rank FROM k),
l AS (SELECT *, rank // 33554432 AS section FROM r QUALIFY row_number() OVER (PARTITION BY pos, kind, rank // 33554432 ORDER BY rank, place) <= 2),
o AS (SELECT *, row_number() OVER (PARTITION BY pos, kind, section ORDER BY place) AS nth FROM l),
g AS (SELECT pos, kind, section, printf('%02X%08X', section,
  CAST(sum(rank * CASE nth WHEN 1 THEN 1099087573 ELSE 1812433259 END % 2147483647) % 2147483647 AS BIGINT)) AS entry FROM o GROUP BY pos, kind, section),
f AS (SELECT pos, kind, list(entry ORDER BY section) AS entries, list(section) AS sections FROM g GROUP BY pos, kind),
a AS (SELECT e.doc_id, e.t, e.n_chars, e.pos, e.next_pos, sha256(edited) AS edited_sha256,
  coalesce(o.entries, []) AS fo, coalesce(o.sections, []) AS so, coalesce(c.entries, []) AS fc, coalesce(c.sections, []) AS sc
  FROM e LEFT JOIN f o ON o.pos = e.pos AND o.kind = 0 LEFT JOIN f c ON c.pos = e.pos AND c.kind = 1),
z AS (SELECT a.*, b.fo AS fn, b.so AS sn FROM a JOIN a b ON b.pos = a.next_pos)
SELECT documents.doc_id, z.n_chars, edited_sha256, array_to_string(fo, ',') AS fingerprint, array_to_string(fc, ',') AS edited_fingerprint,
  CASE WHEN len(so) + len(sc) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(fo, fc))::DOUBLE / len(list_distinct(so || sc)) END AS near_edited,
  CASE WHEN len(so) + len(sn) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(fo, fn))::DOUBLE / len(list_distinct(so || sn)) END AS near_next
FROM documents JOIN z ON z.doc_id IS NOT DISTINCT FROM documents.doc_id AND z.t = coalesce(documents.text, '')"""


OP11 = """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, row_number() OVER () AS piece, w FROM (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d) WHERE len(w) > 0),
o AS (SELECT lang, piece, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM o),
f1 AS (SELECT lang, a, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM g WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
x AS (SELECT lang, a, b, max(f) AS most FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
s AS (SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, 1 AS k, l.f AS l, r.f AS r FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.a = f2.a
    JOIN f1 r ON r.lang = f2.lang AND r.a = f2.b LEFT JOIN x ON x.lang = f2.lang AND x.a = f2.a AND x.b = f2.b WHERE most IS NULL OR 100 * most < 50 * f2.f
  UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 1, l.f, r.f FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.a = f3.a
    JOIN f2 r ON r.lang = f3.lang AND r.a = f3.b AND r.b = f3.c
  UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, l.f, r.f FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.a = f3.a AND l.b = f3.b
    JOIN f1 r ON r.lang = f3.lang AND r.a = f3.c),
c AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY
  (1000000::HUGEINT * a * a) // (l::HUGEINT * r), k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000"""

OP12 = """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
t AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
e AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
  FROM g JOIN k USING (lang) JOIN t USING (lang, source) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n)::HUGEINT + 5)) // (sum(sum(n)) OVER (PARTITION BY lang)::HUGEINT + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM c GROUP BY lang, term),
x AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b USING (lang) WHERE a.source <> b.source),
y AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM e a JOIN e b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM x LEFT JOIN y USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, p - q FROM e JOIN q USING (lang, term) WHERE n > 0 AND p > q),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM s WHERE part = 'pair' OR rank <= 50"""


def _op2() -> str:
    weight = {level: "CAST(CASE " + " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in mixing.WEIGHTS.get(level, {"": 1}).items())
              + " ELSE 1 END AS DOUBLE)" for level in mixing.LEVELS}
    parts = [f"""
WITH r AS (SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % 4) AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
s AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply FROM r GROUP BY ALL),
b0 AS (SELECT CAST(least(floor(sum(supply) * {mixing.SHARE_PERCENT} / 100), sum(supply) * {mixing.MAX_EPOCHS}) AS BIGINT) AS budget FROM s)"""]
    for k, own in enumerate(mixing.LEVELS):
        keys = ", ".join(mixing.LEVELS[:k + 1])
        parents = ", ".join(mixing.LEVELS[:k])
        over = f"PARTITION BY {parents}" if parents else ""
        join = f"JOIN b{k} USING ({parents})" if parents else "CROSS JOIN b0"
        parts.append(f""",
n{k} AS (SELECT q.*, budget, {weight[own]} AS w FROM (SELECT {keys}, CAST(sum(supply) * {mixing.MAX_EPOCHS} AS BIGINT) AS cap FROM s GROUP BY ALL) q {join}),
l{k} AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_before,
  sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest
  FROM n{k} WHERE w > 0 AND cap > 0 WINDOW o AS ({over} ORDER BY cap / w, {own})),
f{k} AS (SELECT *, CAST(cap AS DOUBLE) * w_rest <= w * CAST(budget - c_before AS DOUBLE) AS filled FROM l{k}),
g{k} AS (SELECT *, budget - coalesce(sum(CASE WHEN filled THEN cap END) OVER ({over}), 0) AS rest_tokens,
  CASE WHEN filled THEN 0.0::DOUBLE ELSE w END AS w_open_own, sum(CASE WHEN filled THEN 0.0::DOUBLE ELSE w END) OVER ({over}) AS w_open FROM f{k}),
h{k} AS (SELECT *, sum(w_open_own) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w_to,
  coalesce(sum(w_open_own) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_from FROM g{k} WINDOW p AS ({over} ORDER BY filled, {own})),
b{k + 1} AS (SELECT {keys}, CAST(CASE WHEN filled THEN cap ELSE floor(w_to * CAST(rest_tokens AS DOUBLE) / w_open)
  - floor(w_from * CAST(rest_tokens AS DOUBLE) / w_open) END AS BIGINT) AS budget FROM h{k})""")
    keys = ", ".join(mixing.LEVELS)
    parts.append(f""",
p AS (SELECT s.*, coalesce(budget, 0) AS budget, CASE WHEN supply > 0 THEN coalesce(budget, 0) // supply ELSE 0 END AS whole
  FROM s LEFT JOIN b{len(mixing.LEVELS)} USING ({keys})),
d AS (SELECT r.*, budget, whole, budget - whole * supply AS rest,
  md5('{mixing.SEED}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM r JOIN p USING ({keys})),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY {keys} ORDER BY place, doc_id NULLS FIRST, tokens ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT doc_id, domain, lang, source, tokens, budget, CAST(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM c""")
    return "".join(parts)


ORACLES: dict[str, str] = {"op2_mix_hierarchical": _op2(), "op4_chat_tokens": OP4, "op5_exact_dedup": OP5,
                           "op11_phrases_setm": OP11, "op12_source_spimi": OP12, "op13_order_minhash": OP13}
