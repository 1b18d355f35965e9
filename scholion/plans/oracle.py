"""The expected result of every job as SQL over the driver tables. The statements work on
the text lines the inputs are built from and never parse markup."""

from __future__ import annotations

WS = r"[\s\x0b\x{85}\p{Z}]+"


def normal(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def gap(x: str) -> str:
    return rf"regexp_replace({x}, '\.([A-Z])', '. \1', 'g')"


def escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


DOCS = f"""
docs AS (
  SELECT doc_id, lang, source, n_chars, text,
    list_filter(list_transform(string_split(text, chr(10)),
      lambda x: {normal("x")}), lambda x: x <> '') AS ls
  FROM documents)"""
GOOD = f"""{DOCS},
good AS (SELECT *, len(ls) AS n, (len(ls) + 2) // 3 AS chunks FROM docs WHERE doc_id % 97 NOT IN (5, 6, 7)),
lines AS (SELECT doc_id, t.i AS i, t.line AS line FROM good, unnest(ls) WITH ORDINALITY AS t(line, i))"""
TITLE = (
    "CASE c % 5 WHEN 0 THEN 'Introduction' WHEN 1 THEN 'Methods' WHEN 2 THEN 'Results' "
    "WHEN 4 THEN 'Results' END"
)
CHUNKS = f"""
chunked AS (
  SELECT doc_id, (i - 1) // 3 AS c, list(line ORDER BY i) AS cl FROM lines GROUP BY 1, 2),
secs AS (
  SELECT doc_id, c, {TITLE} AS title, cl, (c % 2 = 1 AND len(cl) = 3) AS nested FROM chunked)"""
XML_SECTIONS = f"""{GOOD}, {CHUNKS},
sections AS (
  SELECT doc_id, c, title,
    concat_ws(chr(10), title, cl[1], cl[2], CASE WHEN nested THEN 'Detail' END, cl[3]) AS txt
  FROM secs),
keyed AS (
  SELECT doc_id, c + 1 AS ord,
    CASE WHEN c < 3 THEN title WHEN title IS NULL THEN 'section_' || (c - 2)
      ELSE title || '_' || (c - 2) END AS key,
    {gap("txt")} AS txt
  FROM sections)"""
XML_TABLES = """
tables AS (
  SELECT doc_id, 1 AS table_no, 'Table 1' AS name, 'Lines of ' || source || ' End.' AS description,
    '{"TableName":"Table 1","Description":' || to_json('Lines of ' || source || ' End.')
    || ',"Colmuns":["n","line"],"Data":['
    || coalesce((SELECT string_agg('["' || i || '",' || to_json(line) || ']', ',' ORDER BY i) || ','
                 FROM lines l WHERE l.doc_id = good.doc_id), '')
    || '["all","' || n || '"]]}' AS json
  FROM good
  UNION ALL
  SELECT doc_id, 2, 'Results', 'Results',
    '{"TableName":"Results","Description":"Results","Colmuns":["k"],"Data":[["v"]]}'
  FROM good WHERE doc_id % 3 = 0)"""
MERGED = f"""{XML_SECTIONS}, {XML_TABLES},
merged AS (
  SELECT doc_id, ord, key, txt FROM keyed
  UNION ALL
  SELECT t.doc_id, g.chunks + t.table_no,
    CASE WHEN t.table_no = 2 AND g.chunks >= 3 THEN 'Results_1' ELSE t.name END, t.json
  FROM tables t JOIN good g USING (doc_id))"""
DATES = """
dates AS (
  SELECT doc_id, 'epub' AS source, make_timestamp(doc_id % 20 + 2000, greatest(1, least(12, doc_id % 14)),
    greatest(1, least(28, doc_id % 32)), 0, 0, 0.0) AS ts FROM good
  UNION ALL
  SELECT doc_id, 'ppub', make_timestamp(doc_id % 20 + 2001, greatest(1, least(12, doc_id % 14)),
    greatest(1, least(28, doc_id % 32)), 0, 0, 0.0) FROM good
  UNION ALL
  SELECT doc_id, 'history', make_timestamp(doc_id % 20 + 2000, 6, 1, 0, 0, 0.0) FROM good)"""

MONTHS = (
    "['January','February','March','April','May','June','July','August','September',"
    "'October','November','December']"
)
HTML_DATE = f"""CASE doc_id % 4
    WHEN 0 THEN (doc_id % 20 + 2000) || ' ' || ({MONTHS}[doc_id % 12 + 1])[1:3] || ' ' || (doc_id % 28 + 1)
    WHEN 1 THEN (doc_id % 20 + 2000) || ' ' || {MONTHS}[doc_id % 12 + 1]
    WHEN 2 THEN (doc_id % 20 + 2000) || ' ' || (doc_id % 12 + 1) || ' ' || (doc_id % 28 + 1)
    ELSE CAST(doc_id % 20 + 2000 AS VARCHAR) END"""
HTML_TS = """make_timestamp(doc_id % 20 + 2000,
    CASE WHEN doc_id % 4 = 3 THEN 1 ELSE doc_id % 12 + 1 END,
    CASE WHEN doc_id % 4 IN (0, 2) THEN doc_id % 28 + 1 ELSE 1 END, 0, 0, 0.0)"""
HTML_TITLE = f"CASE WHEN doc_id % 11 <> 0 THEN {escaped("coalesce(ls[1], '')")} END"
TAB = f"{gap('x')} || ' '"
HTML_SECTIONS = f"""{DOCS},
good AS (SELECT *, len(ls) AS n, (len(ls) + 2) // 3 AS chunks FROM docs),
lines AS (SELECT doc_id, t.i AS i, t.line AS line FROM good, unnest(ls) WITH ORDINALITY AS t(line, i)),
{CHUNKS},
groups AS (
  SELECT doc_id, -1 AS seq, 'Lead' AS title, {gap("ls[1]")} AS txt FROM good WHERE n > 0
  UNION ALL
  SELECT doc_id, 2 * c, title, array_to_string(list_transform(
    CASE WHEN nested THEN cl[1:2] ELSE cl END, lambda x: {TAB}), chr(10)) FROM secs
  UNION ALL
  SELECT doc_id, 2 * c + 1, NULL, 'Detail' || chr(10) || {gap("cl[3]")} FROM secs WHERE nested
  UNION ALL
  SELECT doc_id, 1000000, CASE WHEN chunks < 3 THEN 'Results' ELSE 'Results?' END, {gap("ls[n]")}
  FROM good WHERE n > 0),
numbered AS (
  SELECT doc_id, seq, title, {trimmed("txt")} AS txt,
    count(*) FILTER (title IS NULL) OVER (PARTITION BY doc_id ORDER BY seq) AS untitled
  FROM groups),
named AS (
  SELECT doc_id, seq, txt, CASE WHEN title IS NULL THEN 'section_' || untitled
    WHEN title = 'Results?' THEN 'Results_' || (untitled + 1) ELSE title END AS key FROM numbered),
final AS (
  SELECT doc_id, key, min(seq) AS seq, arg_max(txt, seq) AS txt FROM named GROUP BY 1, 2)"""

# Tokens of a set with one article of a section of nine tokens per line, and one empty article.
# kind: 1 opens, 2 is empty, 3 closes; a and b are the places of its element's two tags.
LINE_TOKENS = f"""{DOCS},
shape AS (SELECT doc_id, ls, len(ls) AS n FROM docs),
listed AS (SELECT doc_id, n, 9 * i - 5 AS base, i, line FROM shape, unnest(ls) WITH ORDINALITY AS t(line, i)),
tokens AS (
  SELECT doc_id, n, base + k AS pos, kind, qname, CASE WHEN qname = 'sec' THEN ' n="' || i || '"' ELSE '' END AS attrs,
    CASE k WHEN 1 THEN 'T' WHEN 3 THEN line WHEN 4 THEN '9' ELSE '' END AS text, depth, base + a AS a, base + b AS b, k
  FROM listed, (VALUES (0, 1, 'sec', 4, 0, 8), (1, 1, 'title', 5, 1, 2), (2, 3, 'title', 5, 1, 2), (3, 1, 'p', 5, 3, 6),
    (4, 1, 'xref', 6, 4, 5), (5, 3, 'xref', 6, 4, 5), (6, 3, 'p', 5, 3, 6), (7, 2, 'br', 5, 7, 7), (8, 3, 'sec', 4, 0, 8))
    AS t(k, kind, qname, depth, a, b)
  UNION ALL
  SELECT doc_id, n, CASE WHEN k < 4 THEN k ELSE 9 * n + k END, kind, qname, '', '', depth,
    CASE WHEN k = 6 THEN 9 * n + 6 ELSE a END, CASE WHEN b < 4 THEN b ELSE 9 * n + b END, NULL
  FROM shape, (VALUES (0, 1, 'set', 1, 0, 7), (1, 1, 'article', 2, 1, 5), (2, 2, 'front', 3, 2, 2), (3, 1, 'body', 3, 3, 4),
    (4, 3, 'body', 3, 3, 4), (5, 3, 'article', 2, 1, 5), (6, 2, 'article', 2, 6, 6), (7, 3, 'set', 1, 0, 7))
    AS t(k, kind, qname, depth, a, b))"""

VERSIONS = f"""{DOCS},
versions AS (
  SELECT doc_id, CAST(doc_id // 3 AS INTEGER) AS pmc_id, ls, lang, source, n_chars,
    '10.0/' || doc_id AS doi, doc_id % 5 <> 0 AS has_map,
    CASE WHEN doc_id % 5 <> 0 THEN greatest((len(ls) + 2) // 3, 1) ELSE 0 END AS n_sections,
    coalesce(length(ls[1]), 0) AS alen,
    make_timestamp(2000 + doc_id % 20, 6, 15, 0, 0, 0.0) AS publish_date
  FROM docs),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pmc_id
    ORDER BY n_sections DESC, alen DESC, doc_id) AS rn FROM versions) WHERE rn = 1)"""
MAP_TEXT = """CASE WHEN has_map THEN (SELECT string_agg(k || '=' || array_to_string(ls[(k - 1) * 3 + 1:k * 3], chr(10)), '|'
    ORDER BY CAST(k AS VARCHAR)) FROM range(1, n_sections + 1) r(k)) END"""

BATCHES = """
claims AS (SELECT DISTINCT doc_id // 50 AS batch, 'w' || (doc_id // 50 % 8) AS usr, doc_id AS id FROM labels),
found AS (SELECT doc_id // 50 AS batch, doc_id AS id, doc_id % 5 <> 0 AS has_text FROM documents
  WHERE doc_id % 97 NOT IN (5, 6, 7))"""
REGISTRY = """
registry AS (
  SELECT CAST(o_orderkey AS INTEGER) AS pmc_id, o_orderstatus <> 'O' AS scraped,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS scraped_at,
    o_orderstatus = 'F' AS success, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS success_at,
    CASE WHEN o_orderstatus = 'P' THEN 'Extraction failed (Xml)' END AS error,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS error_at,
    CASE WHEN o_orderstatus <> 'O' THEN 'w' || (o_custkey % 8) END AS usr,
    o_orderstatus = 'F' AND o_totalprice > 250000 AS full_text
  FROM orders)"""
LOG = """
raw_log AS (
  SELECT CAST(user_id % 8 AS INTEGER) AS worker, CAST(user_id AS INTEGER) AS pmc_id, event_id, ts,
    CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 5 = 0 THEN 429 WHEN event_id % 5 = 1 THEN 503
      WHEN event_id % 5 = 2 THEN 500 WHEN event_id % 5 = 3 THEN 404 END AS status,
    event_type IN ('view', 'click', 'purchase') AS titled, event_id * 37 % 1000 AS body_len,
    CAST(event_id % 1300 + 900 AS INTEGER) AS delay_ms
  FROM events),
log AS (
  SELECT *,
    CASE WHEN status IS NULL THEN 'Timeout' WHEN status = 429 THEN 'HttpBan' WHEN status <> 200 THEN 'HttpError'
      WHEN titled THEN 'Success' ELSE 'EmptyResponse' END AS web,
    CASE WHEN status IS NULL THEN 'timeout' WHEN status IN (429, 503) THEN 'throttled'
      WHEN status >= 500 THEN 'server_error' WHEN status <> 200 THEN 'http_error'
      WHEN body_len < 200 THEN 'truncated' ELSE 'ok' END AS xml
  FROM raw_log),
weighed AS (
  SELECT *, CASE web WHEN 'Success' THEN 0 WHEN 'EmptyResponse' THEN 50 WHEN 'Timeout' THEN 85
    WHEN 'HttpError' THEN 100 WHEN 'HttpBan' THEN 200 END AS weight FROM log),
rolling AS (
  SELECT *, sum(weight) OVER w AS total, count(*) OVER w AS size FROM weighed
  WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
islands AS (
  SELECT *, sum(CASE WHEN web = 'Success' THEN 1 ELSE 0 END)
    OVER (PARTITION BY worker ORDER BY ts, event_id) AS island FROM weighed),
streaks AS (
  SELECT *, sum(CASE WHEN web = 'Success' THEN 0 ELSE 1 END)
    OVER (PARTITION BY worker, island ORDER BY ts, event_id) AS streak FROM islands),
own AS (
  SELECT *, CASE WHEN web = 'HttpBan' THEN ts + INTERVAL 60 SECOND
    WHEN streak >= 5 THEN ts + INTERVAL 20 SECOND END AS own_pause FROM streaks)"""
DELAYS = "coalesce(min(delay_ms) FILTER (size >= 30 AND total < size * 12), 0)"


def _plain(cte: str, select: str) -> str:
    return f"WITH {cte.strip()}\n{select.strip()}"


def rate_gaps(least_us: int, cap: int) -> str:
    return _plain(f"""{LOG},
        calls AS (SELECT worker, event_id, make_timestamp(epoch_us(TIMESTAMP '2024-01-01')
          + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') + 1000) // 2000) AS ts FROM log),
        gaps AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY worker ORDER BY ts, event_id)) AS gap,
          count(*) OVER (PARTITION BY worker ORDER BY ts RANGE BETWEEN INTERVAL 999999 MICROSECOND PRECEDING
            AND CURRENT ROW) AS last_second FROM calls)""", f"""
        SELECT worker, event_id, ts, gap // 1000 AS gap_ms, last_second,
          coalesce(gap < {least_us}, FALSE) OR last_second > {cap} AS violation FROM gaps""")


def statements() -> dict[str, str]:
    xml_article = f"""
      SELECT g.doc_id, CAST(1000000 + g.doc_id AS INTEGER) AS pmc_id, CAST(g.doc_id AS INTEGER) AS pm_id,
        '10.0/' || g.doc_id AS doi, ls[1] AS title,
        CASE WHEN g.doc_id % 4 <> 0 THEN lang ELSE 'Other' END AS category, g.source AS journal,
        'The ' || lang || ' Press' AS publisher, CAST(n_chars % 50 AS VARCHAR) AS volume,
        CAST(NULL AS VARCHAR) AS issue, CAST(g.doc_id % 9000 + 1000 AS VARCHAR) AS issn,
        CAST(n_chars % 900 AS VARCHAR) AS f_page, CAST(NULL AS VARCHAR) AS l_page,
        (SELECT min(ts) FROM dates d WHERE d.doc_id = g.doc_id) AS publish_date,
        'Background: ' || ls[1] AS abstract_text, lang || ' ' || g.source || '|' || g.source AS authors,
        lang || '|' || g.source AS keywords, m.sections
      FROM good g JOIN (SELECT doc_id, string_agg(key || '=' || txt, '|' ORDER BY key) AS sections
        FROM merged GROUP BY 1) m USING (doc_id)"""
    null_text = "CAST(NULL AS VARCHAR)"
    html_article = f"""
      SELECT g.doc_id, CAST(g.doc_id AS INTEGER) AS pmc_id, CAST(g.doc_id AS INTEGER) AS pm_id,
        '10.0/' || g.doc_id AS doi, {HTML_TITLE.replace("doc_id", "g.doc_id")} AS title,
        {null_text} AS category, source AS journal, {null_text} AS publisher,
        CAST(n_chars % 50 AS VARCHAR) AS volume, {null_text} AS issue, {null_text} AS issn,
        CAST(n_chars % 900 AS VARCHAR) AS f_page, {null_text} AS l_page,
        {HTML_TS.replace("doc_id", "g.doc_id")} AS publish_date, coalesce(ls[1], '') AS abstract_text,
        lang || ' ' || source || '|' || source AS authors, lang || '|' || source || '|x&y' AS keywords,
        CASE WHEN g.doc_id % 7 <> 0 THEN coalesce(m.sections, '') END AS sections
      FROM good g LEFT JOIN (SELECT doc_id, string_agg(key || '=' || txt, '|' ORDER BY key) AS sections
        FROM final GROUP BY 1) m USING (doc_id)"""
    meta_nulls = ", ".join(
        f"{null_text} AS {c}"
        for c in ("citation_title", "issue", "ncbi_domain", "ncbi_pcid", "fulltext_url", "pdf_url", "og_title", "og_type")
    )
    best_select = "SELECT pmc_id, doc_id AS arrival, doi, CAST(n_sections AS INTEGER) AS n_sections FROM best"
    per_batch = """
      SELECT batch, count(*) FILTER (c) AS claimed, count(*) FILTER (f) AS extracted,
        count(*) FILTER (c AND NOT f) AS errors, count(*) FILTER (f) AS "unique",
        count(*) FILTER (c AND f AND has_text) AS full_text
      FROM (SELECT coalesce(c.batch, f.batch) AS batch, c.id IS NOT NULL AS c, f.id IS NOT NULL AS f, has_text
        FROM claims c FULL JOIN found f ON c.id = f.id) GROUP BY 1"""
    wire = f"""
      SELECT pmc_id, '{{"pmc_id":' || pmc_id || ',"pm_id":' || doc_id || ',"doi":"' || doi || '","title":"' || source
        || '","journal":"' || source || '","volume":"' || (n_chars % 50) || '","authors":["' || lang || '","' || source
        || '"],"publish_date":"' || strftime(publish_date, '%Y-%m-%dT%H:%M:%S') || '"'
        || coalesce(',"abstract_text":' || to_json(ls[1]), '') || ',"keywords":["' || lang || '"]'
        || CASE WHEN has_map THEN ',"sections":{{' || (SELECT string_agg('"' || k || '":'
             || to_json(array_to_string(ls[(k - 1) * 3 + 1:k * 3], chr(10))), ',' ORDER BY k)
             FROM range(1, n_sections + 1) r(k)) || '}}' ELSE '' END || '}}' AS json
      FROM best"""
    stats = """SELECT count(*) AS "Total_List", count(*) FILTER (scraped) AS "Total_Scraped",
        count(*) FILTER (success) AS "Total_Success", count(*) FILTER (full_text) AS "Total_Full_Text",
        count(error) AS "Total_Error" FROM registry"""
    line_tokens = f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, kind = 1 AS is_open, kind = 3 AS is_close,
        kind = 2 AS is_selfclosing, qname, qname AS tag, attrs, text, depth, CASE WHEN kind < 3 THEN CAST(b AS INTEGER) END AS end_pos,
        CAST(a AS INTEGER) AS start_pos, FALSE AS bad, {null_text} AS fault FROM tokens"""
    faults = """SELECT doc_id, CASE doc_id % 97 WHEN 5 THEN 'no root' WHEN 6 THEN 'element without end' ELSE 'no article' END AS fault,
        CASE doc_id % 97 WHEN 6 THEN 3 ELSE 0 END AS fault_pos FROM documents WHERE doc_id % 97 IN (5, 6, 7)"""
    no_fault = f"{null_text} AS fault, CAST(NULL AS INTEGER) AS fault_pos"
    applied = """
            SELECT CAST(coalesce(r.pmc_id, c.id) AS INTEGER) AS pmc_id,
              c.id IS NOT NULL OR scraped AS scraped,
              CASE WHEN c.id IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE scraped_at END AS scraped_at,
              CASE WHEN c.id IS NOT NULL THEN f.id IS NOT NULL ELSE success END AS success,
              CASE WHEN f.id IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE success_at END AS success_at,
              CASE WHEN f.id IS NOT NULL THEN NULL WHEN c.id IS NOT NULL THEN 'Extraction failed (Xml)' ELSE error END AS error,
              CASE WHEN f.id IS NOT NULL THEN NULL WHEN c.id IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE error_at END AS error_at,
              coalesce(c.usr, r.usr) AS "user", coalesce(f.has_text, FALSE) OR coalesce(full_text, FALSE) AS full_text
            FROM registry r FULL JOIN claims c ON c.id = r.pmc_id LEFT JOIN found f ON f.id = c.id"""
    return {
        "src_xml_payloads": f"""SELECT doc_id,
            md5('<article><body>' || {escaped("text")} || '</body></article>') AS payload_md5 FROM documents""",
        "src_html_files": """SELECT CAST(CASE WHEN page_id % 10 = 3 THEN 0 ELSE page_id END AS INTEGER) AS pmc_id,
            md5(html) AS html_md5 FROM pages""",
        "src_id_list": """SELECT 'txt' AS form, CAST(o_orderkey AS INTEGER) AS pmc_id FROM orders
            WHERE o_orderkey % 100 <> 7
            UNION ALL SELECT 'json', CAST(o_orderkey AS INTEGER) FROM orders""",
        "sink_articles_json": _plain(VERSIONS, f"""SELECT pmc_id, CAST(doc_id AS INTEGER) AS pm_id, doi,
            source AS title, source AS journal, CAST(n_chars % 50 AS VARCHAR) AS volume, lang || '|' || source AS authors,
            lang AS keywords, ls[1] AS abstract_text, {MAP_TEXT} AS sections, doc_id AS arrival FROM versions"""),
        "sink_update_payload": _plain(VERSIONS, wire),
        "submit_bundle": _plain(BATCHES, """
            SELECT b.usr AS "user", CAST(b.batch AS INTEGER) AS batch, count(f.id) AS n_articles,
              coalesce(string_agg(CAST(f.id AS VARCHAR), ',' ORDER BY f.id), '') AS article_ids,
              string_agg(CAST(f.id AS VARCHAR), ',' ORDER BY f.id) FILTER (c.id IS NOT NULL AND has_text) AS full_text_ids,
              coalesce(string_agg(CAST(f.id AS VARCHAR), ',' ORDER BY f.id) FILTER (c.id IS NOT NULL), '') AS success_ids,
              max(e.ids) AS error_ids
            FROM (SELECT DISTINCT usr, batch FROM claims) b
            LEFT JOIN found f ON f.batch = b.batch LEFT JOIN claims c ON c.id = f.id
            JOIN (SELECT c.batch, coalesce(string_agg(CAST(c.id AS VARCHAR), ',' ORDER BY c.id)
                    FILTER (f.id IS NULL), '') AS ids
                  FROM claims c LEFT JOIN found f ON f.id = c.id GROUP BY 1) e ON e.batch = b.batch
            GROUP BY 1, 2"""),
        "markup_tokens": _plain(f"""{GOOD}, {CHUNKS},
            parts AS (SELECT g.doc_id, n, chunks, count(*) FILTER (title IS NOT NULL) AS titled,
              count(*) FILTER (nested) AS nests FROM good g LEFT JOIN secs s USING (doc_id) GROUP BY 1, 2, 3)""", """
            SELECT doc_id, 178 + 14 * n + 12 * chunks + 2 * titled + 4 * nests
                + CASE WHEN doc_id % 3 = 0 THEN 18 ELSE 0 END + CASE WHEN doc_id % 4 <> 0 THEN 4 ELSE 0 END AS n_tokens,
              87 + 7 * n + 6 * chunks + titled + 2 * nests
                + CASE WHEN doc_id % 3 = 0 THEN 9 ELSE 0 END + CASE WHEN doc_id % 4 <> 0 THEN 2 ELSE 0 END AS n_open,
              87 + 7 * n + 6 * chunks + titled + 2 * nests
                + CASE WHEN doc_id % 3 = 0 THEN 9 ELSE 0 END + CASE WHEN doc_id % 4 <> 0 THEN 2 ELSE 0 END AS n_close,
              1 AS n_selfclosing, CASE WHEN n > 0 THEN 9 ELSE 8 END AS max_depth, 4 + n + chunks AS n_p
            FROM parts
            UNION ALL SELECT doc_id, 6, 3, 0, 0, 3, 0 FROM documents WHERE doc_id % 97 = 6
            UNION ALL SELECT doc_id, 7, 2, 2, 0, 2, 0 FROM documents WHERE doc_id % 97 = 7"""),
        "markup_tokens_columns": _plain(LINE_TOKENS, line_tokens),
        "markup_tokens_ranges": _plain(LINE_TOKENS, line_tokens),
        "xml_first_article_scopes": _plain(LINE_TOKENS, """SELECT doc_id, CAST(pos AS INTEGER) AS pos, qname,
              1 AS article_pos, CAST(9 * n + 5 AS INTEGER) AS article_end_pos, 2 AS front_pos, 2 AS front_end_pos, 3 AS body_pos,
              CAST(9 * n + 4 AS INTEGER) AS body_end_pos, 0 AS front_level, 0 AS wrap_level,
              CASE WHEN k < 8 THEN 1 ELSE 0 END AS secs, CASE WHEN k = 4 THEN 1 ELSE 0 END AS hidden,
              coalesce(k NOT IN (4, 5), FALSE) AS structural
            FROM tokens WHERE pos BETWEEN 1 AND 9 * n + 5"""),
        "xml_prose_lines": _plain(LINE_TOKENS, "SELECT doc_id, CAST(pos AS INTEGER) AS element, text FROM tokens WHERE qname = 'p' AND kind = 1"),
        "xml_first_article": _plain(f"{GOOD}, {CHUNKS}", """
            SELECT g.doc_id, 1 + chunks + count(*) FILTER (nested) AS n_sec, 1 AS n_article
            FROM good g LEFT JOIN secs s USING (doc_id) GROUP BY g.doc_id, chunks"""),
        "xml_prose_text": _plain(GOOD, """
            SELECT g.doc_id, 2 * n + 2 + CASE WHEN g.doc_id % 3 = 0 THEN 1 ELSE 0 END AS n_cells,
              coalesce(sum(length(CAST(i AS VARCHAR)) + length(line)), 0) + 3 + length(CAST(n AS VARCHAR))
                + CASE WHEN g.doc_id % 3 = 0 THEN 1 ELSE 0 END AS n_chars
            FROM good g LEFT JOIN lines l USING (doc_id) GROUP BY g.doc_id, n"""),
        "xml_title": _plain(GOOD, "SELECT doc_id, ls[1] AS value FROM good"),
        "xml_ids": _plain(GOOD, """SELECT doc_id, CAST(1000000 + doc_id AS INTEGER) AS pmc_id,
            CAST(doc_id AS INTEGER) AS pm_id, '10.0/' || doc_id AS doi FROM good"""),
        "xml_journal": _plain(GOOD, f"""SELECT doc_id, source AS journal, 'The ' || lang || ' Press' AS publisher,
            CAST(doc_id % 9000 + 1000 AS VARCHAR) AS issn, CAST(n_chars % 50 AS VARCHAR) AS volume,
            {null_text} AS issue, CAST(n_chars % 900 AS VARCHAR) AS f_page, {null_text} AS l_page FROM good"""),
        "xml_category": _plain(GOOD, "SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN lang ELSE 'Other' END AS value FROM good"),
        "xml_date_candidates": _plain(f"{GOOD}, {DATES}", "SELECT doc_id, source, ts FROM dates"),
        "xml_publish_date": _plain(f"{GOOD}, {DATES}", "SELECT doc_id, min(ts) AS publish_date FROM dates GROUP BY 1"),
        "xml_authors": _plain(GOOD, """SELECT doc_id, 1 AS ord, lang || ' ' || source AS value FROM good
            UNION ALL SELECT doc_id, 2, source FROM good"""),
        "xml_keywords": _plain(GOOD, """SELECT doc_id, 1 AS ord, lang AS value FROM good
            UNION ALL SELECT doc_id, 2, source FROM good"""),
        "xml_abstract": _plain(GOOD, "SELECT doc_id, 'Background: ' || ls[1] AS value FROM good"),
        "xml_sections": _plain(XML_SECTIONS, "SELECT doc_id, c + 1 AS ord, coalesce(title, '') AS title, txt AS text FROM sections"),
        "xml_section_keys": _plain(XML_SECTIONS, "SELECT doc_id, ord, key, txt AS text FROM keyed"),
        "xml_tables": _plain(f"{GOOD}, {XML_TABLES}", "SELECT doc_id, table_no, name, description FROM tables"),
        "xml_table_columns": _plain(GOOD, """SELECT doc_id, 1 AS table_no, 1 AS ord, 'n' AS header FROM good
            UNION ALL SELECT doc_id, 1, 2, 'line' FROM good
            UNION ALL SELECT doc_id, 2, 1, 'k' FROM good WHERE doc_id % 3 = 0"""),
        "xml_table_rows": _plain(GOOD, """SELECT doc_id, 1 AS table_no, i AS row_no, 1 AS col_no, CAST(i AS VARCHAR) AS cell FROM lines
            UNION ALL SELECT doc_id, 1, i, 2, line FROM lines
            UNION ALL SELECT doc_id, 1, n + 1, 1, 'all' FROM good
            UNION ALL SELECT doc_id, 1, n + 1, 2, CAST(n AS VARCHAR) FROM good
            UNION ALL SELECT doc_id, 2, 1, 1, 'v' FROM good WHERE doc_id % 3 = 0"""),
        "xml_table_json": _plain(f"{GOOD}, {XML_TABLES}", "SELECT doc_id, table_no, name, json FROM tables"),
        "xml_merge_tables": _plain(MERGED, "SELECT doc_id, ord, key, txt AS text FROM merged"),
        "xml_full_text_fallback": _plain(DOCS, """SELECT doc_id, 'full_text' AS key, array_to_string(ls, ' ') AS text
            FROM docs WHERE doc_id % 2 = 0 AND len(ls) > 0"""),
        "xml_article_results": _plain(f"{MERGED}, {DATES}", f"SELECT *, {no_fault} FROM ({xml_article}) UNION ALL BY NAME {faults}"),
        "xml_fragment_tables": _plain(DOCS, """
            SELECT doc_id, 1 AS table_no, 'a' AS name, '{"TableName":"a","Description":' || to_json('Outer ' || lang)
              || ',"Colmuns":[],"Data":[' || coalesce((SELECT string_agg('["' || i || '",' || to_json(line) || ']', ',' ORDER BY i)
                || ',' FROM unnest(ls) WITH ORDINALITY AS t(line, i)), '') || '["with"]]}' AS json FROM docs
            UNION ALL SELECT doc_id, 2, 'Inner',
              '{"TableName":"Inner","Description":null,"Colmuns":[],"Data":[[' || to_json(source) || ']]}' FROM docs"""),
        "xml_articles": _plain(f"{MERGED}, {DATES}", xml_article),
        "html_title": _plain(DOCS, f"SELECT doc_id, {HTML_TITLE} AS value FROM docs"),
        "html_meta": _plain(DOCS, f"""SELECT doc_id, source AS journal, {HTML_DATE} AS publication_date,
            CAST(n_chars % 50 AS VARCHAR) AS volume, CAST(n_chars % 900 AS VARCHAR) AS first_page,
            '10.0/' || doc_id AS doi, CAST(doc_id AS VARCHAR) AS pmid,
            CASE WHEN doc_id % 7 = 0 THEN 'Scan-pages' ELSE 'fulltext' END AS ncbi_type, {meta_nulls} FROM docs"""),
        "html_authors": """SELECT doc_id, 1 AS ord, lang || ' ' || source AS value FROM documents
            UNION ALL SELECT doc_id, 2, source FROM documents""",
        "html_publish_date": f"SELECT doc_id, {HTML_TS} AS publish_date FROM documents",
        "html_abstract": _plain(DOCS, "SELECT doc_id, coalesce(ls[1], '') AS value FROM docs"),
        "html_keywords": """SELECT doc_id, 1 AS ord, lang AS value FROM documents
            UNION ALL SELECT doc_id, 2, source FROM documents UNION ALL SELECT doc_id, 3, 'x&y' FROM documents""",
        "html_full_text_flag": "SELECT doc_id, doc_id % 7 <> 0 AS is_full_text FROM documents",
        "html_sections": _plain(HTML_SECTIONS, """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS ord,
            key, txt AS text FROM final"""),
        "html_pages_title": rf"""SELECT page_id AS doc_id, CASE WHEN html LIKE '%<h1%' THEN
            {trimmed("regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")}
            END AS value FROM pages""",
        "html_pages_texts": r"""WITH plain AS (
              SELECT page_id, regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') AS html FROM pages),
            texts AS (
              SELECT page_id, 'h1' AS tag, regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS found FROM plain
              UNION ALL SELECT page_id, 'p', regexp_extract_all(html, '<p>(?:<b>)?([^<]*)', 1) FROM plain
              UNION ALL SELECT page_id, 'b', regexp_extract_all(html, '<b>([^<]*)', 1) FROM plain
              UNION ALL SELECT page_id, 'li', regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) FROM plain
              UNION ALL SELECT page_id, 'article', regexp_extract_all(html, '(?s)<article>(.*?)</article>', 1) FROM plain
              UNION ALL SELECT page_id, 'footer', regexp_extract_all(html, '(?s)<footer>(.*?)</footer>', 1) FROM plain)
            SELECT page_id AS doc_id, tag, CAST(ord AS INTEGER) AS ord, md5(regexp_replace(text, '<[^>]*>', '', 'g')) AS text_md5
            FROM texts, unnest(found) WITH ORDINALITY AS u(text, ord)""",
        "html_full_text_fallback": "SELECT doc_id, 'full_text' AS key, '' AS text FROM documents WHERE doc_id % 2 = 0",
        "html_articles": _plain(HTML_SECTIONS, html_article),
        "html_require_title": _plain(DOCS, f"""SELECT doc_id, CAST(doc_id AS INTEGER) AS pmc_id, {HTML_TITLE} AS title
            FROM docs WHERE coalesce({HTML_TITLE}, '') <> ''"""),
        "distinct_ids": "SELECT DISTINCT l_orderkey AS pmc_id FROM lineitem",
        "drop_failed": """SELECT CAST(doc_id AS INTEGER) AS pmc_id, '10.0/' || doc_id AS doi FROM documents
            WHERE doc_id % 97 NOT IN (5, 6, 7) AND doc_id % 4 <> 0""",
        "claimed_success": _plain(BATCHES, "SELECT CAST(id AS INTEGER) AS pmc_id, TRUE AS success FROM claims WHERE id IN (SELECT id FROM found)"),
        "extraction_errors": _plain(BATCHES, """SELECT CAST(id AS INTEGER) AS pmc_id, 'Extraction failed (Xml)' AS error
            FROM claims WHERE id NOT IN (SELECT id FROM found)"""),
        "best_version": _plain(VERSIONS, best_select),
        "full_text_ids": _plain(BATCHES, """SELECT CAST(id AS INTEGER) AS pmc_id FROM claims
            WHERE id IN (SELECT id FROM found WHERE has_text)"""),
        "update_items": _plain(VERSIONS, f"""SELECT pmc_id, CAST(doc_id AS INTEGER) AS pm_id, doi, source AS title,
            {null_text} AS category, source AS journal, {null_text} AS publisher, CAST(n_chars % 50 AS VARCHAR) AS volume,
            {null_text} AS issue, {null_text} AS issn, {null_text} AS f_page, {null_text} AS l_page, publish_date,
            ls[1] AS abstract_text, lang || '|' || source AS authors, lang AS keywords, {MAP_TEXT} AS sections FROM best"""),
        "batch_summary": _plain(BATCHES, per_batch),
        "batch_running_totals": _plain(BATCHES, f"""SELECT batch, "unique" AS processed,
            sum("unique") OVER (ORDER BY batch) AS total_processed FROM ({per_batch})"""),
        "batch_running_totals_elapsed": """WITH batches AS (SELECT event_id // 50 AS batch, count(DISTINCT user_id) AS processed,
              min(ts) AS s, max(ts) AS e FROM events GROUP BY 1)
            SELECT batch, processed, CAST(sum(processed) OVER (ORDER BY batch) AS BIGINT) AS total_processed,
              (epoch_us(e) - epoch_us(s)) / 1e6::DOUBLE AS batch_seconds,
              (epoch_us(e) - epoch_us(min(s) OVER ())) / 6e7::DOUBLE AS elapsed FROM batches""",
        "registry_insert": _plain(REGISTRY, """SELECT pmc_id, scraped, scraped_at, success, success_at, error, error_at,
              usr AS "user", full_text FROM registry
            UNION ALL SELECT DISTINCT CAST(l_orderkey * 2 AS INTEGER), FALSE, CAST(NULL AS TIMESTAMP), FALSE,
              CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), FALSE
            FROM lineitem WHERE l_orderkey * 2 NOT IN (SELECT pmc_id FROM registry)"""),
        "registry_insert_count": """SELECT count(DISTINCT l_orderkey) AS inserted FROM lineitem
            WHERE l_orderkey * 2 NOT IN (SELECT o_orderkey FROM orders)""",
        "registry_after_claim": _plain(f"""{REGISTRY},
            first AS (SELECT pmc_id, row_number() OVER (ORDER BY pmc_id) AS rn FROM registry WHERE usr IS NULL AND NOT scraped)""", """
            SELECT r.pmc_id, scraped, scraped_at, success, success_at, error, error_at,
              CASE WHEN rn <= 800 THEN 'w' || ((rn - 1) // 100) ELSE usr END AS "user", full_text
            FROM registry r LEFT JOIN first f ON f.pmc_id = r.pmc_id"""),
        "registry_insert_file": """SELECT (o_orderkey * 2 // 1000) || '.json' AS filename,
            count(*) FILTER (o_orderkey * 2 NOT IN (SELECT o_orderkey FROM orders)) AS inserted FROM orders GROUP BY 1""",
        "registry_claim": _plain(REGISTRY, """SELECT pmc_id, 'w' || ((rn - 1) // 100) AS "user", scraped, full_text
            FROM (SELECT *, row_number() OVER (ORDER BY pmc_id) AS rn FROM registry WHERE usr IS NULL AND NOT scraped)
            WHERE rn <= 800"""),
        "registry_claim_sizes": _plain(f"""{REGISTRY},
            free AS (SELECT *, row_number() OVER (ORDER BY pmc_id) AS rn FROM registry WHERE usr IS NULL AND NOT scraped),
            workers AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS w, CASE WHEN c_custkey % 3 = 0 THEN 50 ELSE 10 END AS size
              FROM customer),
            spans AS (SELECT w, size, sum(size) OVER (ORDER BY w) AS upto FROM workers)""", """
            SELECT pmc_id, w AS "user", scraped, full_text FROM free JOIN spans ON rn > upto - size AND rn <= upto"""),
        "registry_apply_results": _plain(f"{REGISTRY}, {BATCHES}", applied),
        "registry_upsert": _plain(f"{REGISTRY}, {BATCHES}", applied),
        "registry_stats": _plain(REGISTRY, stats),
        "classify_xml_attempt": _plain(LOG, "SELECT event_id, worker, xml AS outcome, xml <> 'ok' AS retryable FROM log"),
        "classify_html_attempt": _plain(LOG, "SELECT event_id, worker, web AS outcome, web <> 'Success' AS retryable FROM log"),
        "rolling_pressure": _plain(LOG, """SELECT event_id, worker, weight, size AS window_size,
            CAST(total AS DOUBLE) / (size * 100) AS pressure,
            CAST(total - size * 8 AS DOUBLE) / (size * 100) AS pressure_error FROM rolling"""),
        "error_streaks": _plain(LOG, "SELECT event_id, worker, CAST(streak AS BIGINT) AS streak FROM streaks"),
        "pause_windows": _plain(LOG, """SELECT event_id, worker, max(own_pause) OVER
            (PARTITION BY worker ORDER BY ts, event_id) AS pause_until FROM own"""),
        "paused_attempts": _plain(LOG, """SELECT event_id, worker, coalesce(ts < max(own_pause) OVER (PARTITION BY worker
            ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS is_paused FROM own"""),
        "best_sustained_delay": _plain(LOG, f"SELECT worker, {DELAYS} AS best_delay FROM rolling GROUP BY 1"),
        "worker_status": _plain(LOG, f"""SELECT r.*, coalesce(last_ts < pause_until, FALSE) AS paused FROM (
              SELECT worker, arg_max(delay_ms, (ts, event_id)) AS delay, {DELAYS} AS best_delay,
                arg_max(CAST(total AS DOUBLE) / (size * 100), (ts, event_id)) AS pressure FROM rolling GROUP BY 1) r
            JOIN (SELECT worker, max(ts) AS last_ts, max(own_pause) AS pause_until FROM own GROUP BY 1) p USING (worker)
            """).replace("SELECT r.*, coalesce", "SELECT worker, delay, best_delay, pressure, coalesce"),
        "fetch_resolution": _plain(f"""{LOG},
            tries AS (SELECT pmc_id, web, xml, row_number() OVER (PARTITION BY pmc_id ORDER BY ts, event_id) AS attempt FROM log),
            web AS (SELECT *, sum(CASE WHEN web = 'EmptyResponse' THEN 1 ELSE 0 END) OVER
              (PARTITION BY pmc_id ORDER BY attempt) AS empties FROM tries WHERE attempt <= 5),
            ends AS (
              SELECT pmc_id, 'Web' AS method, least(max(attempt), min(attempt) FILTER (web = 'Success'),
                min(attempt) FILTER (web = 'EmptyResponse' AND empties = 2)) AS attempts FROM web GROUP BY 1
              UNION ALL
              SELECT pmc_id, 'Xml', least(max(attempt), min(attempt) FILTER (xml = 'ok'))
              FROM tries WHERE attempt <= 8 GROUP BY 1)""", """
            SELECT e.pmc_id, CAST(attempts AS INTEGER) AS attempts, CAST(attempts - 1 AS INTEGER) AS retries,
              CASE WHEN method = 'Web' THEN web ELSE xml END AS final_outcome, method
            FROM ends e JOIN tries t ON t.pmc_id = e.pmc_id AND t.attempt = e.attempts"""),
        "outcome_of_result": _plain(LOG, """SELECT event_id, worker,
            CASE WHEN titled THEN 'Success' ELSE 'OtherError' END AS outcome FROM log"""),
        "rate_gap_audit": rate_gaps(2_000_000, 1),
        "rate_gap_audit_live": rate_gaps(110_000, 3),
        "rate_gap_audit_keyed": rate_gaps(110_000, 10),
        "stream_extract": _plain(DOCS, f"""
            SELECT doc_id, CAST(1000000 + doc_id AS INTEGER) AS pmc_id, ls[1] AS title, {null_text} AS error
            FROM docs WHERE doc_id % 97 NOT IN (5, 6, 7)
            UNION ALL SELECT doc_id, NULL, NULL, 'Extraction failed (Xml)' FROM docs WHERE doc_id % 97 IN (5, 6, 7)"""),
        "stream_extract_fields": _plain(f"{MERGED}, {DATES}", f"""SELECT *, {null_text} AS error, {no_fault} FROM ({xml_article})
            UNION ALL BY NAME SELECT *, 'Extraction failed (Xml)' AS error FROM ({faults})"""),
        "stream_extract_web": _plain(HTML_SECTIONS, f"""SELECT *, {null_text} AS error, {no_fault} FROM ({html_article})
              WHERE coalesce(title, '') <> ''
            UNION ALL BY NAME SELECT doc_id, 'Extraction failed (Web)' AS error, 'no title' AS fault, 0 AS fault_pos
              FROM docs WHERE coalesce({HTML_TITLE}, '') = ''"""),
        "stream_best_version": _plain(VERSIONS, best_select),
        "stream_registry_stats": _plain(REGISTRY, stats),
        # a row without a time never wins against the claimed one
        "stream_registry_latest": _plain(REGISTRY, stats.replace("count(*) FILTER (scraped)", "count(*)")),
        "normalize_ws": f"SELECT doc_id, {normal('text')} AS value FROM documents",
        "null_if_blank": f"SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN nullif({normal('text')}, '') END AS value FROM documents",
        "digits_to_id": """SELECT doc_id, CAST(doc_id AS INTEGER) AS a, CAST(replace(source, 'src', '') AS INTEGER) AS b,
            0 AS c, 0 AS d FROM documents""",
        "try_int": "SELECT doc_id, CAST(doc_id AS INTEGER) AS a, CAST(NULL AS INTEGER) AS b, CAST(NULL AS INTEGER) AS c FROM documents",
        "clamped_date": """SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN make_timestamp(doc_id % 30 + 1990,
            CASE WHEN doc_id % 5 = 0 THEN 1 ELSE greatest(1, least(12, doc_id % 15)) END,
            CASE WHEN doc_id % 3 = 0 THEN 1 ELSE greatest(1, least(28, doc_id % 40)) END, 0, 0, 0.0) END AS value FROM documents""",
        "sentence_gap": f"SELECT doc_id, {gap("replace(text, '. ', '.')")} AS value FROM documents",
        "html_unescape": """SELECT doc_id, replace(text, 'e', 'é') || '<' || chr(8217) || chr(128512) || '&nope; & &lt;' AS value
            FROM documents""",
        "strip_boilerplate": "SELECT doc_id, ' ' || text || ' ' AS value FROM documents",
        "split_keywords": f"""SELECT doc_id, array_to_string(list_filter(list_transform(
            regexp_split_to_array(replace(text, ' ', '; '), '[;,]'), lambda x: {trimmed("x")}), lambda x: x <> ''), '|')
            AS value FROM documents""",
        "full_name": """SELECT doc_id, nullif(concat_ws(' ', CASE WHEN doc_id % 3 <> 0 THEN lang END,
            CASE WHEN doc_id % 2 = 0 THEN source END), '') AS value FROM documents""",
        "article_url": """SELECT doc_id, 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id || '/' AS page,
            'https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi?db=pmc&id=PMC' || doc_id || '&rettype=xml' AS efetch
            FROM documents""",
        "iso_seconds": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS value FROM events",
    }
