"""Inputs for the jobs, derived by Spark from the driver tables: JATS and HTML markup
over ``documents``, claims over ``labels``, a registry over ``orders`` and a fetch log
over ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.functions.scalars import normalize_ws, xml_escape

LINES_PER_SECTION = 3
PMC_OFFSET = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


def _cat(*parts) -> Column:
    return F.concat(*[_text(p) for p in parts])


def element(name: str, *content, attrs: str = "") -> Column:
    return _cat(f"<{name}{' ' + attrs if attrs else ''}>", *content, f"</{name}>")


def with_lines(documents: DataFrame, markup: bool = True) -> DataFrame:
    """Add ``lines``: the non-blank lines, white space normalized, escaped for markup."""
    escape = xml_escape if markup else (lambda x: x)
    normal = F.transform(F.split("text", "\n"), lambda x: escape(normalize_ws(x)))
    return documents.select(
        "doc_id", "lang", "source", "n_chars", F.filter(normal, lambda x: x != "").alias("lines")
    )


def _sections(section) -> Column:
    """Markup of all chunks of lines; ``section(no, lines)`` gives that of one chunk."""
    count = F.ceil(F.size("lines") / LINES_PER_SECTION).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    parts = F.transform(
        numbers,
        lambda c: section(c, F.slice("lines", c * LINES_PER_SECTION + 1, LINES_PER_SECTION)),
    )
    return F.array_join(parts, "")


def _section_title(c: Column) -> Column:
    kind = c % 5
    return (
        F.when(kind == 0, "Introduction")
        .when(kind == 1, "Methods")
        .when(kind.isin(2, 4), "Results")
    )


def _each(lines: Column, markup) -> Column:
    return F.array_join(F.transform(lines, markup), "")


def _jats_section(c: Column, lines: Column) -> Column:
    paragraph = lambda x: element("p", x, "<xref>[1]</xref>")
    title = F.coalesce(element("title", _section_title(c)), F.lit(""))
    # In odd sections the third line goes into a subsection.
    nested = ((c % 2) == 1) & (F.size(lines) == 3)
    outer = F.when(nested, F.slice(lines, 1, 2)).otherwise(lines)
    inner = F.when(
        nested, element("sec", "<title>Detail</title>", paragraph(F.get(lines, F.lit(2))))
    ).otherwise("")
    figure = "<fig><label>F</label><caption><p>not prose</p></caption></fig>"
    return element("sec", "<label>1</label>", title, _each(outer, paragraph), figure, inner)


def _jats_date(tag: str, attrs: str, year: Column, month: Column, day=None) -> Column:
    parts = [element("month", month.cast("string")), element("year", year.cast("string"))]
    if day is not None:
        parts.insert(0, element("day", day.cast("string")))
    return element(tag, *parts, attrs=attrs)


def jats_payloads(documents: DataFrame) -> DataFrame:
    """(doc_id, payload). Of every 97 documents one has a blank payload, one is cut off
    and one holds no article."""
    first = F.coalesce(F.get("lines", F.lit(0)), F.lit(""))
    n = F.col("doc_id")
    year = n % 20 + 2000
    journal = element(
        "journal-meta",
        element("journal-title-group", element("journal-title", F.col("source"))),
        element("issn", "1111-1111", attrs='pub-type="ppub"'),
        element("issn", (n % 9000 + 1000).cast("string"), attrs='pub-type="epub"'),
        element("publisher", element("publisher-name", " The ", F.col("lang"), "\n Press ")),
    )
    heading = F.when(
        n % 4 != 0,
        element("subj-group", element("subject", F.col("lang")), attrs='subj-group-type="heading"'),
    ).otherwise("")
    authors = element(
        "contrib-group",
        element(
            "contrib",
            element("name", element("surname", F.col("source")), element("given-names", F.col("lang"))),
            attrs='contrib-type="author"',
        ),
        element("contrib", element("name", element("surname", F.col("source"))), attrs="contrib-type='author'"),
        '<contrib contrib-type="author"><collab>Group</collab></contrib>'
        '<contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib>',
    )
    dates = _cat(
        _jats_date("pub-date", 'pub-type="ppub"', year + 1, n % 14, n % 32),
        _jats_date("pub-date", 'pub-type="epub"', year, n % 14, n % 32),
        element("pub-history", element("event", _jats_date("date", "", year, F.lit(6)))),
    )
    meta = element(
        "article-meta",
        element("article-id", n.cast("string"), attrs='pub-id-type="pmid"'),
        element("article-id", "PMC", (n + PMC_OFFSET).cast("string"), attrs='pub-id-type="pmcaid"'),
        element("article-id", "10.0/", n.cast("string"), attrs='pub-id-type="doi"'),
        element(
            "article-categories",
            "<subj-group><subject>Other</subject></subj-group>",
            heading,
        ),
        element("title-group", element("article-title", first)),
        authors,
        dates,
        element("volume", (F.col("n_chars") % 50).cast("string")),
        element("fpage", (F.col("n_chars") % 900).cast("string")),
        "<abstract abstract-type='short'><p>In short.</p></abstract>",
        element("abstract", element("sec", "<title>Background</title>", element("p", first))),
        element(
            "kwd-group",
            "<title>Keywords</title>",
            element("kwd", F.col("lang")),
            "<kwd> </kwd>",
            element("kwd", element("italic", F.col("source"))),
        ),
    )
    rows = F.array_join(
        F.transform(
            "lines",
            lambda x, i: element(
                "tr",
                element("th", "row"),
                element("td", (i + 1).cast("string")),
                element("td", x, "<xref>2</xref>"),
            ),
        ),
        "",
    )
    table_1 = element(
        "table-wrap",
        "<label>Table 1</label>",
        element("caption", "<title>Lines</title>", element("p", "Lines of ", F.col("source"))),
        element(
            "table",
            "<thead><tr><th>n</th><th/><th>line</th></tr></thead>",
            element("tbody", rows),
            element("tfoot", element("tr", "<td>all</td>", element("td", F.size("lines").cast("string")))),
        ),
        "<table-wrap-foot><fn><p>End.</p></fn></table-wrap-foot>",
    )
    table_2 = F.when(
        n % 3 == 0,
        '<table-wrap id="t2"><caption><title>Results</title></caption><table><tbody><tr><th>k</th></tr>'
        "<tr><td>v</td></tr></tbody></table></table-wrap>",
    ).otherwise("")
    back = (
        "<back><ref-list><ref><article-title>Cited</article-title><volume>999</volume>"
        "<lpage>77</lpage></ref></ref-list></back>"
    )
    article = element(
        "article",
        element("front", journal, meta),
        element("body", _sections(_jats_section)),
        back,
        element("floats-group", table_1, table_2),
    )
    head = '<?xml version="1.0"?><!DOCTYPE pmc-articleset PUBLIC "-//NLM" "x.dtd"><!-- set -->'
    whole = _cat(head, element("pmc-articleset", article, "<article><body>no</body></article>"))
    kind = n % 97
    payload = (
        F.when(kind == 5, " ")
        .when(kind == 6, _cat(head, "<pmc-articleset><article><front>"))
        .when(kind == 7, _cat(head, element("pmc-articleset", element("error", "none"))))
        .otherwise(whole)
    )
    return with_lines(documents).select("doc_id", payload.alias("payload"))


# --- HTML --------------------------------------------------------------------------

# English month names, for date texts.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)


def _html_date_text(n: Column) -> Column:
    year = (n % 20 + 2000).cast("string")
    month, day = n % 12, (n % 28 + 1).cast("string")
    name = F.array(*[F.lit(m) for m in MONTHS])[month.cast("int")]
    return (
        F.when(n % 4 == 0, _cat(year, " ", F.substring(name, 1, 3), " ", day))
        .when(n % 4 == 1, _cat(year, " ", name))
        .when(n % 4 == 2, _cat(year, " ", (month + 1).cast("string"), " ", day))
        .otherwise(year)
    )


def _html_section(c: Column, lines: Column) -> Column:
    paragraph = lambda x: element("p", x, " <a href='#'>Open in a new tab</a>")
    title = F.coalesce(element("h2", _section_title(c), attrs='class="pmc_sec_title"'), F.lit(""))
    nested = ((c % 2) == 1) & (F.size(lines) == 3)
    outer = F.when(nested, F.slice(lines, 1, 2)).otherwise(lines)
    inner = F.when(
        nested, element("section", "<h3>Detail</h3>", paragraph(F.get(lines, F.lit(2))))
    ).otherwise("")
    return element("section", title, _each(outer, paragraph), inner)


def html_payloads(documents: DataFrame) -> DataFrame:
    """(doc_id, payload): article pages with citation meta tags. One page in seven is a
    scan; one in eleven has no heading and thus no title."""
    n = F.col("doc_id")
    first = F.coalesce(F.get("lines", F.lit(0)), F.lit(""))
    last = F.coalesce(F.try_element_at("lines", F.lit(-1)), F.lit(""))

    def meta(name: str, content) -> Column:
        return _cat(f'<meta name="{name}" content="', content, '">')

    head = element(
        "head",
        "<title>page</title><script>var t = '</p><h1>no</h1>';</script>",
        meta("ncbi_type", F.when(n % 7 == 0, "Scan-pages").otherwise("fulltext")),
        meta("citation_journal_title", F.col("source")),
        meta("citation_publication_date", _html_date_text(n)),
        meta("citation_volume", (F.col("n_chars") % 50).cast("string")),
        meta("citation_firstpage", (F.col("n_chars") % 900).cast("string")),
        meta("citation_doi", _cat("10.0/", n.cast("string"))),
        meta("citation_pmid", n.cast("string")),
        meta("citation_author", _cat(F.col("lang"), " ", F.col("source"))),
        meta("citation_author", " "),
        meta("citation_author", F.col("source")),
    )
    title = F.when(n % 11 == 0, "").otherwise(element("h1", " ", first, "\n"))
    abstract = element(
        "section",
        "<h2>Abstract</h2>",
        element("p", first),
        element(
            "section",
            element("p", "<strong>Keywords:</strong> ", F.col("lang"), "; ", F.col("source"), ",, x&amp;y"),
            attrs='class="kwd-group"',
        ),
        attrs='class="abstract" id="abstract1"',
    )
    body = element(
        "section",
        abstract,
        element("h2", "Lead"),
        element("p", first),
        _sections(_html_section),
        element("h2", "Results"),
        element("p", last),
        "<section class='ref-list'><p>cited</p></section>",
        attrs='class="body main-article-body"',
    )
    html = _cat("<!DOCTYPE html>\n<html>", head, element("body", title, body), "</html>")
    return with_lines(documents).select("doc_id", html.alias("payload"))


# --- batches, registry, log --------------------------------------------------------


def versions(documents: DataFrame) -> DataFrame:
    """Article records in several versions per id: doc_id, pmc_id, arrival, sections,
    abstract_text and the rest of the record, without any markup work."""
    d = with_lines(documents, markup=False)
    count = F.ceil(F.size("lines") / LINES_PER_SECTION).cast("int")
    entries = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.struct(
            i.cast("string").alias("k"),
            F.array_join(F.slice("lines", (i - 1) * LINES_PER_SECTION + 1, LINES_PER_SECTION), "\n").alias("v"),
        ),
    )
    return d.select(
        (F.floor(F.col("doc_id") / 3)).cast("int").alias("pmc_id"),
        F.col("doc_id").cast("int").alias("pm_id"),
        _cat("10.0/", F.col("doc_id").cast("string")).alias("doi"),
        F.col("source").alias("title"),
        F.lit(None).cast("string").alias("category"),
        F.col("source").alias("journal"),
        F.lit(None).cast("string").alias("publisher"),
        (F.col("n_chars") % 50).cast("string").alias("volume"),
        F.lit(None).cast("string").alias("issue"),
        F.lit(None).cast("string").alias("issn"),
        F.lit(None).cast("string").alias("f_page"),
        F.lit(None).cast("string").alias("l_page"),
        F.array("lang", "source").alias("authors"),
        F.expr("make_timestamp_ntz(2000 + cast(doc_id % 20 as int), 6, 15, 0, 0, 0)").alias("publish_date"),
        F.get("lines", F.lit(0)).alias("abstract_text"),
        F.array("lang").alias("keywords"),
        F.when(F.col("doc_id") % 5 != 0, F.map_from_entries(entries)).alias("sections"),
        F.col("doc_id").alias("arrival"),
        F.col("n_chars"),
    )


def claims(labels: DataFrame) -> DataFrame:
    """(batch, user, pmc_id): the labelled ids, in batches of fifty ids."""
    n = F.col("doc_id")
    return labels.select(
        F.floor(n / 50).cast("int").alias("batch"),
        _cat("w", (F.floor(n / 50) % 8).cast("string")).alias("user"),
        n.cast("int").alias("pmc_id"),
    )


def extracted(documents: DataFrame, payloads: DataFrame) -> DataFrame:
    """Articles that came out of the claims: one per document whose payload holds a whole
    article. The builder makes some payloads blank, cut off or without an article."""
    whole = payloads.where(F.col("payload").contains("</article>")).select(F.col("doc_id").alias("arrival"))
    kept = versions(documents).join(whole, "arrival", "left_semi")
    return kept.withColumn("pmc_id", F.col("arrival").cast("int")).withColumn(
        "batch", F.floor(F.col("arrival") / 50).cast("int")
    )


def registry(orders: DataFrame) -> DataFrame:
    done = F.col("o_orderstatus") != "O"
    ok, failed = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"
    at = F.col("o_orderdate").cast("timestamp_ntz")
    return orders.select(
        F.col("o_orderkey").cast("int").alias("pmc_id"),
        done.alias("scraped"),
        F.when(done, at).alias("scraped_at"),
        ok.alias("success"),
        F.when(ok, at).alias("success_at"),
        F.when(failed, "Extraction failed (Xml)").alias("error"),
        F.when(failed, at).alias("error_at"),
        F.when(done, _cat("w", (F.col("o_custkey") % 8).cast("string"))).alias("user"),
        (ok & (F.col("o_totalprice") > 250000)).alias("full_text"),
    )


def fetch_log(events: DataFrame) -> DataFrame:
    """(worker, pmc_id, event_id, ts, status, timed_out, failed, body_len, title, delay_ms)"""
    kind, n = F.col("event_type"), F.col("event_id")
    broken = n % 5
    status = (
        F.when(kind != "error", 200)
        .when(broken == 0, 429)
        .when(broken == 1, 503)
        .when(broken == 2, 500)
        .when(broken == 3, 404)
    )
    return events.select(
        (F.col("user_id") % 8).cast("int").alias("worker"),
        F.col("user_id").cast("int").alias("pmc_id"),
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        status.cast("int").alias("status"),
        ((kind == "error") & (broken == 4)).alias("timed_out"),
        (n * 37 % 1000).cast("int").alias("body_len"),
        F.when(kind.isin("view", "click", "purchase"), kind).alias("title"),
        (n % 1300 + 900).cast("int").alias("delay_ms"),
    )


def with_attempts(log: DataFrame) -> DataFrame:
    """Add ``attempt``: the number of the try per id, in time order."""
    order = W.partitionBy("pmc_id").orderBy("ts", "event_id")
    return log.withColumn("attempt", F.row_number().over(order))
