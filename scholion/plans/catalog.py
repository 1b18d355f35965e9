"""All registered jobs: name to a function of (session, data folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.functions import scalars as S
from scholion.operators import fetch_log as L
from scholion.operators import html_articles as H
from scholion.operators import reconcile as R
from scholion.operators import registry as G
from scholion.operators import xml_articles as X
from scholion.operators.tokens import large_markup_tokens, markup_tokens, tasks_for
from scholion.plans import corpus as C
from scholion.session import checkpoint_root, tuned
from scholion.sources import readers, writers
from scholion.streaming import streams

SUBMITTED_AT = "2024-02-01 00:00:00"
CLAIM_USERS = [f"w{i}" for i in range(8)]


def work_folder(spark: SparkSession) -> str:
    """A new path for files that a job writes and reads back; the writers make the folder."""
    return f"{checkpoint_root(spark)}/work-{uuid.uuid4()}"


#: Where the payloads of a data folder were written, by session, folder and builder.
_PAYLOADS: dict[tuple[str, str, str], str] = {}


def _payloads(spark, sf, build) -> DataFrame:
    """Payloads built from the documents, written once per session: as for anyone who has payloads,
    the jobs begin with reading them and not with making them."""
    key = (spark.sparkContext.applicationId, sf, build.__name__)
    if key not in _PAYLOADS:
        folder = work_folder(spark)
        build(C.table(spark, sf, "documents")).write.parquet(folder)
        _PAYLOADS[key] = folder
    return spark.read.parquet(_PAYLOADS[key])


def _jats(spark, sf):
    return _payloads(spark, sf, C.jats_payloads)


def _html(spark, sf):
    return _payloads(spark, sf, C.html_payloads)


#: Tasks for the payloads of a data folder, by session, folder and what is dealt.
_TASKS: dict[tuple[str, str, str], int] = {}


def _tasks(spark, sf, name, read, column="payload") -> int:
    """Lengths are read once per session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _TASKS:
        _TASKS[key] = tasks_for(read(spark, sf), column)
    return _TASKS[key]


def _jats_tasks(spark, sf):
    return _tasks(spark, sf, "jats", _jats)


def _html_tasks(spark, sf):
    return _tasks(spark, sf, "html", _html)


def _line_tasks(spark, sf):
    """For payloads that are built from the documents' lines and are not written: two or three times
    as long as the texts."""
    return 3 * _tasks(spark, sf, "documents", lambda spark, sf: C.table(spark, sf, "documents"), "text")


def _xml_tokens(spark, sf):
    return X.xml_tokens(_jats(spark, sf), tasks=_jats_tasks(spark, sf))


def _html_tokens(spark, sf):
    return markup_tokens(_html(spark, sf), "html", tasks=_html_tasks(spark, sf))


def _on_xml(operator):
    return lambda spark, sf: operator(_xml_tokens(spark, sf))


def _on_html(operator):
    return lambda spark, sf: operator(_html_tokens(spark, sf))


def _flat(articles: DataFrame) -> DataFrame:
    """Arrays and maps as texts that compare alike everywhere."""
    keys = F.array_sort(F.map_keys("sections"))
    pairs = F.transform(keys, lambda k: F.concat(k, F.lit("="), F.try_element_at("sections", k)))
    return articles.select(
        *[c for c in articles.columns if c not in ("authors", "keywords", "sections")],
        F.array_join("authors", "|").alias("authors"),
        F.array_join("keywords", "|").alias("keywords"),
        F.array_join(pairs, "|").alias("sections"),
    )


# --- markup ------------------------------------------------------------------------


def _token_counts(spark, sf):
    t = _xml_tokens(spark, sf)
    return t.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"),
        F.count_if("is_open").alias("n_open"),
        F.count_if("is_close").alias("n_close"),
        F.count_if("is_selfclosing").alias("n_selfclosing"),
        F.max("depth").alias("max_depth"),
        F.count_if(F.col("is_open") & (F.col("tag") == "p")).alias("n_p"),
    )


def _line_payloads(spark, sf):
    """Article sets of one section per line of a document, where the place of every token follows
    from the line's number."""
    def section(line, i):
        inside = F.concat(F.lit("<title>T</title>"), C.element("p", line, "<xref>9</xref>"), F.lit("<br/></sec>"))
        return F.concat(F.lit('<sec n="'), (i + 1).cast("string"), F.lit('">'), inside)

    secs = F.array_join(F.transform("lines", section), "")
    article = C.element("article", "<front/>", C.element("body", secs))
    return C.with_lines(C.table(spark, sf, "documents")).select("doc_id", C.element("set", article, "<article/>").alias("payload"))


def _all_tokens(spark, sf):
    return markup_tokens(_line_payloads(spark, sf), tasks=_line_tasks(spark, sf))


def _range_tokens(spark, sf):
    """The same by ranges of 300 characters, so that nearly every payload has several."""
    return large_markup_tokens(_line_payloads(spark, sf), 300)


def _scoped_tokens(spark, sf):
    t = X.xml_first_article(_all_tokens(spark, sf))
    place = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("article", "front", "body") for c in ("pos", "end_pos")]
    return t.select("doc_id", "pos", "qname", *place, "front_level", "wrap_level", "secs", "hidden", "structural")


def _first_article(spark, sf):
    t = X.xml_first_article(_xml_tokens(spark, sf))
    return t.groupBy("doc_id").agg(
        F.count_if(F.col("is_open") & (F.col("tag") == "sec")).alias("n_sec"),
        F.count_if(F.col("is_open") & (F.col("tag") == "article")).alias("n_article"),
    )


def _prose(spark, sf):
    found = X.xml_prose_text(_xml_tokens(spark, sf), "td")
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n_cells"), F.sum(F.length("text")).alias("n_chars")
    )


def _fallback_payloads(spark, sf, mode):
    """Articles whose body is bare text, next to articles with elements in it."""
    d = C.with_lines(C.table(spark, sf, "documents"))
    text = F.array_join("lines", "\n")
    bare = F.col("doc_id") % 2 == 0
    if mode == "xml":
        body = F.when(bare, text).otherwise(C.element("p", text))
        doc = C.element("article", C.element("body", body))
    else:
        body = F.when(bare, "").otherwise(C.element("p", text))
        doc = C.element("html", C.element("section", body, attrs=f'class="{H.BODY_CLASS}"'))
    return d.select("doc_id", doc.alias("payload"))


def _fragments(spark, sf):
    """Payloads without an article: a table of the lines, with a table in its last row."""
    d = C.with_lines(C.table(spark, sf, "documents"))
    cell = lambda *x: C.element("td", *x)
    rows = F.array_join(F.transform("lines", lambda x, i: C.element("tr", cell((i + 1).cast("string")), cell(x))), "")
    inner = C.element("table-wrap", "<label>Inner</label><table><tbody><tr>", cell(F.col("source")), "</tr></tbody></table>")
    body = C.element("tbody", rows, C.element("tr", cell("with ", inner)))
    caption = C.element("caption", C.element("p", "Outer ", F.col("lang")))
    wrap = C.element("table-wrap", caption, C.element("table", body), attrs='id="a"')
    return d.select("doc_id", C.element("div", wrap).alias("payload"))


def _fragment_tables(spark, sf):
    tokens = markup_tokens(_fragments(spark, sf), tasks=_line_tasks(spark, sf))
    return X.xml_table_json(X.xml_fragment(tokens))


def _page_tokens(spark, sf):
    pages = C.table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("payload")
    )
    return markup_tokens(pages, "html", tasks=_tasks(spark, sf, "pages", lambda *_: pages))


def _pages_title(spark, sf):
    return H.html_title(_page_tokens(spark, sf))


#: Elements whose texts are listed; some of the given pages leave the ends of p and b out.
PAGE_TAGS = ("h1", "p", "b", "li", "article", "footer")


def _pages_texts(spark, sf):
    found = H.html_element_texts(_page_tokens(spark, sf), *PAGE_TAGS)
    place = W.partitionBy("doc_id", "tag").orderBy("pos")
    return found.select("doc_id", "tag", F.row_number().over(place).alias("ord"), F.md5("text").alias("text_md5"))


# --- files -------------------------------------------------------------------------


def _named_files(df: DataFrame, name, content) -> DataFrame:
    return df.select(name.alias("name"), content.alias("content"))


def _src_xml(spark, sf):
    folder = work_folder(spark)
    documents = C.table(spark, sf, "documents")
    payload = C.element("article", C.element("body", S.xml_escape(F.col("text"))))
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".xml"))
    writers.write_files(_named_files(documents, name, payload), folder)
    read = readers.src_xml_payloads(spark, folder)
    number = F.regexp_extract("path", r"([0-9]+)\.xml$", 1).cast("bigint")
    return read.select(number.alias("doc_id"), F.md5("payload").alias("payload_md5"))


def _src_html(spark, sf):
    folder = work_folder(spark)
    pages = C.table(spark, sf, "pages")
    # One page in ten has a name without a number.
    name = F.when(F.col("page_id") % 10 == 3, F.concat(F.lit("pmcx"), F.col("page_id"))).otherwise(
        F.concat(F.lit("pmc"), F.col("page_id"))
    )
    writers.write_files(
        _named_files(pages, F.concat(name.cast("string"), F.lit(".html")), F.col("html")), folder
    )
    read = readers.src_html_files(spark, folder)
    return read.select("pmc_id", F.md5("html").alias("html_md5"))


def _id_files(spark, sf, form, times=1):
    """Folder with multiples of the order keys as id lists, with some lines that are no ids."""
    folder = work_folder(spark)
    orders = C.table(spark, sf, "orders").select((F.col("o_orderkey") * times).alias("id"))
    if form == "txt":
        line = F.when(F.col("id") % 100 == 7, "x").otherwise(F.col("id").cast("string"))
        orders.select(line.alias("value")).write.mode("overwrite").text(f"{folder}/ids")
    else:
        batches = orders.groupBy(F.floor(F.col("id") / 1000).alias("g")).agg(
            F.to_json(F.sort_array(F.collect_list("id"))).alias("content")
        )
        named = batches.select(F.concat(F.col("g").cast("string"), F.lit(".json")).alias("name"), "content")
        writers.write_files(named, folder)
        return folder
    return f"{folder}/ids"


def _src_ids(spark, sf):
    text = readers.src_id_list(spark, _id_files(spark, sf, "txt"), "txt")
    arrays = readers.src_id_list(spark, _id_files(spark, sf, "json"), "json")
    tagged = text.withColumn("form", F.lit("txt")).unionByName(arrays.withColumn("form", F.lit("json")))
    return tagged.select("form", "pmc_id")


def _sink_json(spark, sf):
    folder = work_folder(spark)
    writers.sink_articles_json(C.versions(C.table(spark, sf, "documents")), f"{folder}/articles")
    schema = (
        "pmc_id int, pm_id int, doi string, title string, journal string, volume string, authors array<string>, "
        "keywords array<string>, abstract_text string, sections map<string,string>, arrival bigint"
    )
    return _flat(spark.read.schema(schema).json(f"{folder}/articles"))


def _update_payload(spark, sf):
    best = R.best_version(C.versions(C.table(spark, sf, "documents")))
    return writers.sink_update_payload(best)


# --- reconciliation ----------------------------------------------------------------


def _claims(spark, sf):
    return C.claims(C.table(spark, sf, "labels"))


def _extracted(spark, sf):
    return C.extracted(C.table(spark, sf, "documents"), _jats(spark, sf))


def _best(spark, sf):
    best = R.best_version(C.versions(C.table(spark, sf, "documents")))
    return best.select("pmc_id", "arrival", "doi", R.section_count().alias("n_sections"))


def _update_items(spark, sf):
    best = R.best_version(C.versions(C.table(spark, sf, "documents")))
    return _flat(R.update_items(best))


def _bundles(spark, sf) -> DataFrame:
    claims = _claims(spark, sf)
    keys = ("user", "batch")
    batches = claims.select(*keys).distinct()
    articles = _extracted(spark, sf).join(batches, "batch", "left_semi")
    owner = F.concat(F.lit("w"), (F.col("batch") % 8).cast("string"))
    # Four readers follow: the articles are made once, as a table that outlives executors.
    folder = work_folder(spark)
    R.best_version(articles.withColumn("user", owner), "batch", "user").write.parquet(folder)
    articles = spark.read.parquet(folder)
    ids = articles.select(*keys, "pmc_id").distinct()
    claimed = claims.select(*keys, "pmc_id").distinct()
    on = [*keys, "pmc_id"]
    success = claimed.join(ids, on, "left_semi").withColumn("success", F.lit(True))
    errors = claimed.join(ids, on, "left_anti").withColumn("error", F.lit("Extraction failed (Xml)"))
    texts = articles.where(F.size("sections") > 0).select(*on).join(claimed, on, "left_semi")
    return R.submit_bundle(R.update_items(articles, *keys), success, errors, texts, *keys)


def _submit_bundle(spark, sf):
    return _bundles(spark, sf).select(
        "user",
        "batch",
        F.size("articles").cast("bigint").alias("n_articles"),
        F.array_join(F.transform("articles", lambda a: a["pmc_id"].cast("string")), ",").alias("article_ids"),
        F.array_join(F.transform("full_text_ids", lambda i: i.cast("string")), ",").alias("full_text_ids"),
        F.array_join(F.transform(F.array_sort(F.map_keys("success_dict")), lambda i: i.cast("string")), ",").alias("success_ids"),
        F.array_join(F.transform(F.array_sort(F.map_keys("error_dict")), lambda i: i.cast("string")), ",").alias("error_ids"),
    )


def _batch_summary(spark, sf):
    return R.batch_summary(_claims(spark, sf), _extracted(spark, sf))


def _timed_batches(spark, sf):
    """Batches of fifty events: an id counts once per batch, the first and last event are its times."""
    events = C.table(spark, sf, "events").withColumn("batch", F.floor(F.col("event_id") / 50))
    by_batch = events.groupBy("batch")
    summaries = by_batch.agg(F.countDistinct("user_id").alias("unique"))
    at = F.col("ts").cast("timestamp_ntz")
    times = by_batch.agg(F.min(at).alias("started_at"), F.max(at).alias("ended_at"))
    return R.batch_running_totals(summaries, times)


# --- registry ----------------------------------------------------------------------


def _registry(spark, sf):
    return C.registry(C.table(spark, sf, "orders"))


def _new_ids(spark, sf):
    """Line items' order keys, shifted so that half of them are unknown."""
    items = C.table(spark, sf, "lineitem")
    return items.select((F.col("l_orderkey") * 2).cast("int").alias("pmc_id"))


def _registry_insert(spark, sf):
    return G.registry_insert(_registry(spark, sf), _new_ids(spark, sf))


def _registry_insert_file(spark, sf):
    ids = readers.src_id_list(spark, _id_files(spark, sf, "json", 2), "json")
    return G.registry_insert_file(_registry(spark, sf), ids)


def _registry_claim(spark, sf):
    claimed = G.registry_claim(_registry(spark, sf), CLAIM_USERS, 100)
    return claimed.select("pmc_id", "user", "scraped", "full_text")


def _registry_claim_sizes(spark, sf):
    """Every customer is a worker: two in three take web pages, ten at a time, the others fifty
    articles."""
    key = F.col("c_custkey")
    workers = C.table(spark, sf, "customer").select(
        F.lpad(key.cast("string"), 9, "0").alias("user"), F.when(key % 3 == 0, 50).otherwise(10).alias("size")
    )
    claimed = G.registry_claim_sizes(_registry(spark, sf), workers)
    return claimed.select("pmc_id", "user", "scraped", "full_text")


def _registry_after_claim(spark, sf):
    registry = _registry(spark, sf)
    return G.registry_after_claim(registry, G.registry_claim(registry, CLAIM_USERS, 100))


def _registry_apply(spark, sf):
    at = F.lit(SUBMITTED_AT).cast("timestamp_ntz")
    return G.registry_apply_results(
        _registry(spark, sf), _bundles(spark, sf).withColumn("submitted_at", at)
    )


def _registry_upsert(spark, sf):
    """Bundles in two rounds, by the user, on a stored registry."""
    folder = work_folder(spark)
    G.store_registry(_registry(spark, sf), folder, 1000)
    at = F.lit(SUBMITTED_AT).cast("timestamp_ntz")
    bundles = _bundles(spark, sf).withColumn("submitted_at", at)
    for batch_id, even in ((1, True), (2, False)):
        part = bundles.where((F.substring("user", 2, 9).cast("int") % 2 == 0) == even)
        G.registry_upsert(spark, folder, part, batch_id, 1000)
    return G.stored_registry(spark, folder)


# --- fetch log ---------------------------------------------------------------------


def _log(spark, sf):
    return C.fetch_log(C.table(spark, sf, "events"))


def _web_log(spark, sf):
    return L.classify_html_attempt(_log(spark, sf))


def _dense_log(spark, sf):
    """The log in a two-thousandth of its time."""
    start = "timestamp_ntz'2024-01-01'"
    return _log(spark, sf).withColumn("ts", F.expr(f"{start} + (ts - {start}) / 2000"))


def _picked(df: DataFrame, *columns) -> DataFrame:
    return df.select("event_id", "worker", *columns)


def _resolution(spark, sf):
    log = C.with_attempts(_log(spark, sf))
    web = L.fetch_resolution(L.classify_html_attempt(log), 5, 2)
    xml = L.fetch_resolution(L.classify_xml_attempt(log), 8)
    return web.withColumn("method", F.lit("Web")).unionByName(xml.withColumn("method", F.lit("Xml")))


# --- streams -----------------------------------------------------------------------


def _staged_stream(spark, df: DataFrame, folder: str, files: int = 1) -> DataFrame:
    """The rows as a stream of two batches, each of so many files."""
    df.repartition(2 * files).write.mode("overwrite").parquet(f"{folder}/in")
    return (
        spark.readStream.schema(df.schema)
        .option("maxFilesPerTrigger", files)
        .parquet(f"{folder}/in")
    )


def _streamed(spark, payloads, method, tasks):
    """Articles and errors of a stream of payloads, with a file for each of the tasks that the
    payloads ask for."""
    folder = work_folder(spark)
    stream = _staged_stream(spark, payloads, folder, max(1, tasks // 2))
    streams.stream_extract(stream, f"{folder}/out", f"{folder}/state", method).awaitTermination()
    return spark.read.parquet(f"{folder}/out/articles"), spark.read.parquet(f"{folder}/out/errors")


def _stream_extract(spark, sf):
    done, failed = _streamed(spark, _jats(spark, sf), "Xml", _jats_tasks(spark, sf))
    return done.select("doc_id", "pmc_id", "title", F.lit(None).cast("string").alias("error")).unionByName(
        failed.select("doc_id", F.lit(None).cast("int").alias("pmc_id"), F.lit(None).cast("string").alias("title"), "error")
    )


def _stream_extract_fields(spark, sf):
    """Whole records and whole error rows."""
    done, failed = _streamed(spark, _jats(spark, sf), "Xml", _jats_tasks(spark, sf))
    return _flat(done.drop("batch_id")).unionByName(failed.drop("batch_id"), allowMissingColumns=True)


def _stream_extract_web(spark, sf):
    done, failed = _streamed(spark, _html(spark, sf), "Web", _html_tasks(spark, sf))
    return _flat(done.drop("batch_id")).unionByName(failed.drop("batch_id"), allowMissingColumns=True)


def _article_results(spark, sf):
    return _flat(X.xml_article_results(_jats(spark, sf), _jats_tasks(spark, sf)))


def _stream_best(spark, sf):
    folder = work_folder(spark)
    stream = _staged_stream(spark, C.versions(C.table(spark, sf, "documents")), folder)
    streams.stream_best_version(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    best = streams.current_best(spark, f"{folder}/out")
    return best.select("pmc_id", "arrival", "doi", R.section_count().alias("n_sections"))


def _arriving_registry(spark, sf):
    """Registry rows as they changed: each id as a free row, as a claimed one and as it is now. The
    three of an id lie in different files, some late and some twice."""
    now = _registry(spark, sf)
    free = now.select("pmc_id").transform(G.new_rows)
    claimed = free.withColumn("user", F.lit("w")).withColumn("scraped", F.lit(True)).withColumn(
        "scraped_at", F.lit("1990-01-01").cast("timestamp_ntz")
    )
    kinds = (now.withColumn("place", F.col("pmc_id") % 3), claimed.withColumn("place", F.col("pmc_id") % 2 + 1), free.withColumn("place", F.lit(2)))
    again = now.where("pmc_id % 4 = 1").withColumn("place", F.lit(3))
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(again)


def _stream_latest(spark, sf):
    folder = work_folder(spark)
    rows = _arriving_registry(spark, sf)
    rows.repartitionByRange(4, "place").drop("place").write.parquet(f"{folder}/in")
    schema = rows.drop("place").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    streams.stream_registry_stats(stream, f"{folder}/out", f"{folder}/state", bucket_size=1000).awaitTermination()
    return streams.latest_stats(spark, f"{folder}/out")


def _stream_stats(spark, sf):
    folder = work_folder(spark)
    stream = _staged_stream(spark, _registry(spark, sf), folder)
    streams.stream_registry_stats(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    return streams.latest_stats(spark, f"{folder}/out")


# --- scalars -----------------------------------------------------------------------


def _scalars(spark, sf, columns):
    d = C.table(spark, sf, "documents")
    return d.select("doc_id", *[c.alias(n) for n, c in columns.items()])


SCALARS = (
    "normalize_ws", "null_if_blank", "digits_to_id", "try_int", "clamped_date",
    "sentence_gap", "html_unescape", "strip_boilerplate", "split_keywords", "full_name",
    "article_url",
)


def _scalar_columns() -> dict:
    text, n = F.col("text"), F.col("doc_id")
    padded = F.concat(F.lit("  "), F.replace(text, F.lit(" "), F.lit(" \t ")), F.lit("\n"))
    blank = F.when(n % 3 == 0, "  \t").otherwise(text)
    return {
        "normalize_ws": {"value": S.normalize_ws(padded)},
        "null_if_blank": {"value": S.null_if_blank(blank)},
        "digits_to_id": {
            "a": S.digits_to_id(F.concat(F.lit("PMC"), n.cast("string"), F.lit("."))),
            "b": S.digits_to_id(F.col("source")),
            "c": S.digits_to_id(F.col("lang")),
            "d": S.digits_to_id(F.concat(F.lit("99999999999"), n.cast("string"))),
        },
        "try_int": {
            "a": S.try_int(F.concat(F.lit(" "), n.cast("string"))),
            "b": S.try_int(F.concat(n.cast("string"), F.lit(".0"))),
            "c": S.try_int(F.col("source")),
        },
        "clamped_date": {
            "value": S.clamped_date(
                F.when(n % 7 == 0, "x").otherwise((n % 30 + 1990).cast("string")),
                F.when(n % 5 == 0, "Dec").otherwise((n % 15).cast("string")),
                F.when(n % 3 != 0, (n % 40).cast("string")),
            )
        },
        "sentence_gap": {"value": S.sentence_gap(F.replace(text, F.lit(". "), F.lit(".")))},
        "html_unescape": {
            "value": S.html_unescape(
                F.concat(
                    F.replace(text, F.lit("e"), F.lit("&eacute;")),
                    F.lit("&lt;&#8217;&#x1F600;&nope; & &amp;lt;"),
                )
            )
        },
        "strip_boilerplate": {
            "value": S.strip_boilerplate(F.concat(F.lit("Keywords: "), text, F.lit(" Open in a new tab")))
        },
        "split_keywords": {
            "value": F.array_join(S.split_keywords(F.replace(text, F.lit(" "), F.lit("; "))), "|")
        },
        "full_name": {
            "value": S.full_name(
                F.when(n % 3 == 0, " ").otherwise(F.col("lang")), F.when(n % 2 == 0, F.col("source"))
            )
        },
        "article_url": {"page": S.article_url(n), "efetch": S.efetch_url(n)},
    }


def _scalar(name):
    return lambda spark, sf: _scalars(spark, sf, _scalar_columns()[name])


def _iso_seconds(spark, sf):
    return C.table(spark, sf, "events").select("event_id", S.iso_seconds(F.col("ts")).alias("value"))


# --- catalog -----------------------------------------------------------------------


def jobs() -> dict:
    keyed = lambda t: X.xml_section_keys(X.xml_sections(t))
    xml = {
        "xml_title": X.xml_title,
        "xml_ids": X.xml_ids,
        "xml_journal": X.xml_journal,
        "xml_category": X.xml_category,
        "xml_date_candidates": lambda t: X.xml_date_candidates(t).select("doc_id", "source", "ts"),
        "xml_publish_date": lambda t: X.xml_publish_date(X.xml_date_candidates(t)),
        "xml_authors": X.xml_authors,
        "xml_keywords": X.xml_keywords,
        "xml_abstract": X.xml_abstract,
        "xml_sections": X.xml_sections,
        "xml_section_keys": keyed,
        "xml_tables": X.xml_tables,
        "xml_table_columns": X.xml_table_columns,
        "xml_table_rows": X.xml_table_rows,
        "xml_table_json": X.xml_table_json,
        "xml_merge_tables": lambda t: X.xml_merge_tables(keyed(t), X.xml_table_json(t)),
    }
    html = {
        "html_title": H.html_title,
        "html_meta": H.html_meta,
        "html_authors": H.html_authors,
        "html_publish_date": lambda t: H.html_publish_date(H.html_meta(t)),
        "html_abstract": H.html_abstract,
        "html_keywords": H.html_keywords,
        "html_full_text_flag": lambda t: H.html_full_text_flag(H.html_meta(t)),
        "html_sections": H.html_sections,
    }
    found = {
        "src_xml_payloads": _src_xml,
        "src_html_files": _src_html,
        "src_id_list": _src_ids,
        "sink_articles_json": _sink_json,
        "sink_update_payload": _update_payload,
        "submit_bundle": _submit_bundle,
        "markup_tokens": _token_counts,
        "markup_tokens_columns": _all_tokens,
        "markup_tokens_ranges": _range_tokens,
        "xml_first_article": _first_article,
        "xml_first_article_scopes": _scoped_tokens,
        "xml_prose_lines": lambda spark, sf: X.xml_prose_text(_all_tokens(spark, sf), "p"),
        "xml_prose_text": _prose,
        **{k: _on_xml(v) for k, v in xml.items()},
        "xml_full_text_fallback": lambda spark, sf: X.xml_full_text_fallback(
            markup_tokens(_fallback_payloads(spark, sf, "xml"), "xml", tasks=_line_tasks(spark, sf))
        ),
        "xml_article_results": _article_results,
        "xml_fragment_tables": _fragment_tables,
        "xml_articles": lambda spark, sf: _flat(X.xml_articles(_jats(spark, sf), _jats_tasks(spark, sf))),
        **{k: _on_html(v) for k, v in html.items()},
        "html_pages_title": _pages_title,
        "html_pages_texts": _pages_texts,
        "html_full_text_fallback": lambda spark, sf: H.html_full_text_fallback(
            markup_tokens(_fallback_payloads(spark, sf, "html"), "html", tasks=_line_tasks(spark, sf))
        ),
        "html_articles": lambda spark, sf: _flat(H.html_articles(_html(spark, sf), tasks=_html_tasks(spark, sf))),
        "html_require_title": lambda spark, sf: H.html_require_title(
            H.html_articles(_html(spark, sf), tasks=_html_tasks(spark, sf))
        ).select("doc_id", "pmc_id", "title"),
        "distinct_ids": lambda spark, sf: R.distinct_ids(
            C.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pmc_id"))
        ),
        "drop_failed": lambda spark, sf: R.drop_failed(
            _extracted(spark, sf).withColumn("pmc_id", F.when(F.col("arrival") % 4 != 0, F.col("pmc_id")))
        ).select("pmc_id", "doi"),
        "claimed_success": lambda spark, sf: R.claimed_success(_extracted(spark, sf), _claims(spark, sf)),
        "extraction_errors": lambda spark, sf: R.extraction_errors(_extracted(spark, sf), _claims(spark, sf)),
        "best_version": _best,
        "full_text_ids": lambda spark, sf: R.full_text_ids(
            R.best_version(_extracted(spark, sf)), _claims(spark, sf)
        ),
        "update_items": _update_items,
        "batch_summary": _batch_summary,
        "batch_running_totals": lambda spark, sf: R.batch_running_totals(_batch_summary(spark, sf)),
        "batch_running_totals_elapsed": _timed_batches,
        "registry_insert": _registry_insert,
        "registry_insert_file": _registry_insert_file,
        "registry_insert_count": lambda spark, sf: G.registry_insert_count(_registry(spark, sf), _new_ids(spark, sf)),
        "registry_claim": _registry_claim,
        "registry_claim_sizes": _registry_claim_sizes,
        "registry_after_claim": _registry_after_claim,
        "registry_apply_results": _registry_apply,
        "registry_upsert": _registry_upsert,
        "registry_stats": lambda spark, sf: G.registry_stats(_registry(spark, sf)),
        "classify_xml_attempt": lambda spark, sf: _picked(
            L.classify_xml_attempt(_log(spark, sf)), "outcome", "retryable"
        ),
        "classify_html_attempt": lambda spark, sf: _picked(_web_log(spark, sf), "outcome", "retryable"),
        "rolling_pressure": lambda spark, sf: _picked(
            L.rolling_pressure(_web_log(spark, sf)), "weight", "window_size", "pressure", "pressure_error"
        ),
        "error_streaks": lambda spark, sf: _picked(L.error_streaks(_web_log(spark, sf)), "streak"),
        "pause_windows": lambda spark, sf: _picked(L.pause_windows(_web_log(spark, sf)), "pause_until"),
        "paused_attempts": lambda spark, sf: _picked(L.paused_attempts(_web_log(spark, sf)), "is_paused"),
        "best_sustained_delay": lambda spark, sf: L.best_sustained_delay(_web_log(spark, sf)),
        "worker_status": lambda spark, sf: L.worker_status(_web_log(spark, sf)),
        "fetch_resolution": _resolution,
        "outcome_of_result": lambda spark, sf: _picked(
            _log(spark, sf).withColumn("outcome", L.outcome_of_result(F.col("title").isNotNull())), "outcome"
        ),
        "rate_gap_audit": lambda spark, sf: L.rate_gap_audit(_dense_log(spark, sf), 2000, 1),
        "rate_gap_audit_live": lambda spark, sf: L.rate_gap_audit(_dense_log(spark, sf), 110, 3),
        "rate_gap_audit_keyed": lambda spark, sf: L.rate_gap_audit(_dense_log(spark, sf), 110, 10),
        "stream_extract": _stream_extract,
        "stream_extract_fields": _stream_extract_fields,
        "stream_extract_web": _stream_extract_web,
        "stream_best_version": _stream_best,
        "stream_registry_stats": _stream_stats,
        "stream_registry_latest": _stream_latest,
        **{name: _scalar(name) for name in SCALARS},
        "iso_seconds": _iso_seconds,
    }
    return {name: _with_settings(job) for name, job in found.items()}


def _with_settings(job):
    return lambda spark, sf_dir: job(tuned(spark), sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed sections per article, with the article's title and ids."""
    articles = X.xml_articles(_jats(tuned(spark), sf_dir))
    return articles.select("doc_id", "pmc_id", "title", F.size("sections").alias("n_sections"))
