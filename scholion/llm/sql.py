"""DuckDB SQL for those queries of this folder that SQL can express."""

from __future__ import annotations

from scholion.llm import mixing

#: The contract's order of sources, weights and caps, and the seeded order of documents.
MIXING = f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{", ".join(map(str, mixing.WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS w
  FROM docs GROUP BY source),
levels AS (
  SELECT *, sum(source_size) OVER () * {mixing.SHARE}::DOUBLE AS mix,
         {mixing.EPOCHS} * coalesce(sum(source_size) OVER before, 0) AS capped,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weight
  FROM sources
  WINDOW before AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT min_by((mix - capped) / weight, capped) AS level FROM levels
  WHERE (mix - capped) / weight * w <= source_size * {mixing.EPOCHS}),
targets AS (
  SELECT source, source_size,
         least(coalesce(level * w, source_size * {mixing.EPOCHS}::DOUBLE), source_size * {mixing.EPOCHS}::DOUBLE) AS target
  FROM levels, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
keys AS (
  SELECT source, key, sum(size) AS size,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs GROUP BY source, key),
cuts AS (
  SELECT k.source, max(k.key) AS cut
  FROM keys k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
  WHERE k.before + k.size / 2.0::DOUBLE <= p.target - p.whole * p.source_size
  GROUP BY k.source)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.whole + CASE WHEN d.size > 0 AND d.key <= coalesce(c.cut, '') THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON c.source IS NOT DISTINCT FROM d.source
"""

#: Tokens listed by the contract's pattern; cuts are the lengths of the first so many.
FILL_IN_MIDDLE = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, list_transform(
           regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda t: length(t)) AS sizes,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS h
  FROM hashed),
cuts AS (
  SELECT *, len(sizes) AS n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50
              THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
pieces AS (
  SELECT doc_id, text, n, form, CAST(coalesce(list_sum(sizes[1:least(h[1] % (n + 1), h[2] % (n + 1))]), 0) AS BIGINT) AS a,
         CAST(coalesce(list_sum(sizes[1:greatest(h[1] % (n + 1), h[2] % (n + 1))]), 0) AS BIGINT) AS b
  FROM cuts),
made AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM pieces)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM made
"""

#: The first record of each payload by window; sizes and digests straight from the texts.
WARC = """
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM payloads)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN size >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

#: All pairs of groups and kept terms of a language, scored in 128-bit integers.
SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY lang),
grouped AS (SELECT DISTINCT lang, source FROM docs),
sized AS (
  SELECT g.lang, g.source, coalesce(any_value(l.v), 0) AS v, coalesce(any_value(l.lang_size), 0) AS lang_size, coalesce(sum(c.n), 0) AS size
  FROM grouped g LEFT JOIN langs l USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.size + s.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (s.lang_size + s.v) AS q
  FROM sized s JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
scored AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM scored
QUALIFY part = 'pair' OR rank <= 200
"""

STATEMENTS = {
    "op5_mixing": MIXING,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_warc": WARC,
}
