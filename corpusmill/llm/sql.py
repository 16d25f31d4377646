"""DuckDB SQL of the operators that SQL can express."""

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source),
level AS (
  SELECT *, 2.0::DOUBLE * source_size AS ceiling, (2.0::DOUBLE * source_size) / weight AS ratio FROM per),
filled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(ceiling) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS lvl
  FROM level WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT lvl AS final FROM filled WHERE ceiling > weight * lvl ORDER BY ratio, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, least(ceiling, coalesce(weight * (SELECT final FROM final), ceiling))::DOUBLE AS target FROM filled),
cut AS (
  SELECT *, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / nullif(sum(target) OVER (), 0) AS high FROM targets),
spans AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low FROM cut),
size AS (SELECT sum(target) AS words, greatest(32, floor(sum(target))::BIGINT // (greatest(1, count(*)) * 4000)) AS block FROM targets),
slots AS (SELECT (i % 1836311903 * 1134903170 % 1836311903)::DOUBLE / 1836311903::DOUBLE AS u FROM range((SELECT ceil(words / block)::BIGINT FROM size)) AS r(i)),
counts AS (SELECT source, count(*) AS n FROM spans, slots WHERE u >= low AND u < high GROUP BY source),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(c.n, 0) * (SELECT block FROM size) AS upto,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY ('0x' || substr(digest, 1, 7))::BIGINT % (1 + (SELECT count(*) FROM d) // 20000), digest, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS a
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN counts c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(a + size, upto) - a) + greatest(0, least(a + source_size + size, upto) - (a + source_size)))::BIGINT AS taken
FROM placed
"""
