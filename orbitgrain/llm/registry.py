"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from orbitgrain.llm.decontamination import op4_decontamination
from orbitgrain.llm.importance_resampling import op13_importance_resampling
from orbitgrain.llm.language_id import op10_language_id
from orbitgrain.llm.license_scan import op3_license_scan
from orbitgrain.llm.lm_scoring import op1_lm_scoring
from orbitgrain.llm.near_dedup import op9_near_dedup
from orbitgrain.llm.periodic_runs import op11_periodic_runs
from orbitgrain.llm.quality_rules import op6_quality_rules
from orbitgrain.llm.sentence_pieces import op5_sentence_pieces
from orbitgrain.llm.sharding import op2_sharding
from orbitgrain.llm.suffix_dedup import op7_suffix_dedup
from orbitgrain.llm.token_counts import op8_token_counts
from orbitgrain.llm.token_files import op12_token_files

QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_sharding, op3_license_scan, op4_decontamination, op5_sentence_pieces, op6_quality_rules, op7_suffix_dedup, op8_token_counts, op9_near_dedup, op10_language_id, op11_periodic_runs, op12_token_files, op13_importance_resampling)}

#: Bytes as pairs of hexadecimal digits: windows of 100 bytes are 200 digits.
OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(greatest(length(h) // 2 - 99, 0))) AS s, h FROM d),
k AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS m FROM w),
r AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS nth FROM k) x WHERE nth > 1),
g AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
u AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM u),
c AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept, max(b) AS last FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
 sha256(unhex(CASE WHEN c.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)"""

#: CRC-32 of the bytes behind hexadecimal digits ``h``, by the table that ``CRC_TABLE`` makes of the polynomial.
CRC_TABLE = "ct AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tt)"
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: (instr('0123456789ABCDEF', h[2*i+1]) * 16 + instr('0123456789ABCDEF', h[2*i+2]) - 17)::BIGINT)), lambda c, b: xor(c >> 8, tt[(xor(c, b) & 255) + 1])), 4294967295)"

#: A run of 24 words and three periods holds two equal stretches of 12 words at its period: pairs of equal stretches of 12 that stand next to each other at one distance make a run.
OP11 = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(CAST(doc_id AS VARCHAR), ''))) AS h, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
c AS (SELECT r, doc_id, ws, len(ws) AS n, {CRC} AS h FROM d, ct),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS ws FROM p),
g AS (SELECT r, i, n, md5(array_to_string(ws[i + 1 : i + 12], ' ')) AS m FROM (SELECT r, n, ws, unnest(range(greatest(n - 11, 0))) AS i FROM t) x),
e AS (SELECT x.r, y.i - x.i AS q, x.i FROM g x JOIN g y ON x.r = y.r AND x.m = y.m AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
k AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM e),
s AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 12 + q AS length FROM k GROUP BY r, q, isle),
f AS (SELECT r, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q) GROUP BY 1, 2, 3),
b AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines, min({{'x': -length / period, 'start': start, 'period': period, 'length': length}}) AS best FROM f GROUP BY r),
o AS (SELECT r, unnest(ws) AS w, unnest(range(n)) AS i FROM t),
z AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS kept FROM o WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.r = o.r AND o.i >= f.start + f.period AND o.i < f.start + f.length) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best['start'] AS start, best['length'] AS length, best['period'] AS period, 1000 * best['length'] // best['period'] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (r) LEFT JOIN z USING (r)"""

OP13 = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
v AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
o AS (SELECT r, unnest(ws) AS w FROM d),
u AS (SELECT w, {CRC} % 10000 AS bucket FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM o UNION SELECT w FROM v) x) y, ct),
s AS (SELECT bucket, count(*) AS s FROM o JOIN u USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM v JOIN u USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, sum(gain)::BIGINT AS weight FROM o JOIN u USING (w) JOIN g USING (bucket) GROUP BY r),
h AS (SELECT r, doc_id, len(ws) AS n_words, coalesce(weight, 0) AS weight, list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: (instr('0123456789abcdef', sha256('2024:' || doc_id)[i + 1]) - 1)::BIGINT)), lambda x, y: 16 * x + y) AS h FROM d LEFT JOIN w USING (r)),
c AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score, n_words >= 20 AS fits FROM h),
k AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS nth FROM c)
SELECT doc_id, n_words AS n_features, weight, score, CASE WHEN fits AND nth <= (SELECT 10 * count(*) // 100 FROM c WHERE fits) THEN nth END AS rank, n_words FROM k"""

#: Of the other ten, results are ordered packings, sampled or learned verdicts, library tokens or classes of links.
ORACLES: dict[str, str] = {"op7_suffix_dedup": OP7, "op11_periodic_runs": OP11, "op13_importance_resampling": OP13}
