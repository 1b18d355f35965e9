"""HTML articles from the token table: the same stages as for JATS.

HTML needs repair rather than rejection: the tokens of a page are a tree, whatever ends its tags
leave out (see ``markup_tokens``). Units do not nest here: within one group an element of
interest ends before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.functions.keys import growing_keys, last_wins
from scholion.functions.scalars import (
    KEYWORD_LEADS,
    NEW_TAB,
    html_date,
    html_unescape,
    normalize_ws,
    sentence_gap,
    split_keywords,
    strip_texts,
    trim_ws,
    try_int,
)
from scholion.operators.elements import (
    collected,
    delta,
    first_element,
    first_text,
    inside,
    is_opener,
    ordered,
    unit_texts,
)
from scholion.operators.tokens import attr as attr_of
from scholion.operators.tokens import (
    before_in_doc,
    markup_tokens,
    running_last,
    running_sum,
)

BODY_CLASS = "body main-article-body"
SKIPPED_CLASSES = ("abstract", "ref-list")
HEADINGS = ("title", "b", "strong", "bold")

# Result column to the name of its meta tag.
META_NAMES = {
    "journal": "citation_journal_title",
    "citation_title": "citation_title",
    "publication_date": "citation_publication_date",
    "volume": "citation_volume",
    "issue": "citation_issue",
    "first_page": "citation_firstpage",
    "doi": "citation_doi",
    "pmid": "citation_pmid",
    "ncbi_domain": "ncbi_domain",
    "ncbi_type": "ncbi_type",
    "ncbi_pcid": "ncbi_pcid",
    "fulltext_url": "citation_fulltext_html_url",
    "pdf_url": "citation_pdf_url",
    "og_title": "og:title",
    "og_type": "og:type",
}
AUTHOR_META = "citation_author"


def attr(name: str) -> Column:
    return attr_of(name, html=True)


def _is(*kinds) -> Column:
    return F.col("kind").isin(*kinds)


def _section_class(text: str) -> Column:
    return (F.col("tag") == "section") & F.coalesce(attr("class").contains(text), F.lit(False))


def _is_section() -> Column:
    return F.col("tag") == "section"


def html_scoped(tokens: DataFrame) -> DataFrame:
    """Add scopes: abs (the abstract element), body (the article body), counters for
    keyword and footnote sections, and where a token lies in the body: near (its
    ancestor or self one level down) and deep (two levels down)."""
    paired = F.col("start_pos").isNotNull()
    t = tokens.select(
        "*",
        first_element(F.col("tag") == "h1").alias("h1"),
        first_element(attr("id") == "abstract1").alias("abs_by_id"),
        first_element(_section_class("abstract")).alias("abs_by_class"),
        first_element(_is_section() & (attr("class") == BODY_CLASS)).alias("body"),
        F.max(_is_section() & (attr("class") == BODY_CLASS)).over(W.partitionBy("doc_id")).alias(
            "has_body"
        ),
        running_sum(delta(_section_class("kwd") & paired)).alias("kwd_level"),
        running_sum(delta(_section_class("fn") & paired)).alias("fn_level"),
    )
    t = t.withColumn("abs", F.coalesce("abs_by_id", "abs_by_class"))
    classes = F.split(F.coalesce(attr("class"), F.lit("")), " ")
    skipped = _is_section() & F.arrays_overlap(
        classes, F.array(*[F.lit(c) for c in SKIPPED_CLASSES])
    )
    here = F.struct(
        "pos", "end_pos", _is_section().alias("is_section"), skipped.alias("skipped")
    )
    below = F.col("depth") - F.col("body.depth")
    opens = is_opener() & F.col("end_pos").isNotNull() & inside("body")
    return t.select(
        "*",
        below.alias("below"),
        running_last(F.when(opens & (below == 1), here)).alias("near"),
        running_last(F.when(opens & (below == 2), here)).alias("deep"),
    ).drop("abs_by_id", "abs_by_class")


def _scoped(tokens: DataFrame) -> DataFrame:
    return tokens if "near" in tokens.columns else html_scoped(tokens)


def _body_kind() -> Column:
    """Kind of an element inside the body: ``sec`` opens a child section or one inside a
    child section, ``heading`` and ``line`` are the elements directly in those."""
    b, tag = F.col("below"), F.col("tag")
    heading = tag.isin(*HEADINGS) | tag.rlike("^h[0-9]")
    in_child = F.col("near.is_section") & ~F.col("near.skipped")
    in_nested = in_child & F.col("deep.is_section") & (F.col("deep.pos") > F.col("near.pos"))
    return F.when(
        inside("body") & F.col("end_pos").isNotNull() & is_opener(),
        F.when((b == 1) & _is_section(), F.when(~F.col("near.skipped"), "sec"))
        .when((b == 1) & heading, "heading")
        .when(b == 1, "line")
        .when((b == 2) & in_child & _is_section(), "sec")
        .when((b == 2) & in_child & heading, "heading")
        .when((b == 2) & in_child, "line")
        .when((b == 3) & in_nested, "inner"),
    )


GROUPS = ("title", "meta", "abstract", "keywords", "sections")


def html_elements(scoped: DataFrame, groups=GROUPS) -> DataFrame:
    """Elements of interest with their raw text: doc_id, kind, pos, end_pos (of keyword sections),
    name, content, ctx (child section, nested section), text. A ``doc`` row stands for the page
    itself."""
    opens = is_opener() & F.col("end_pos").isNotNull()
    units = []
    if "title" in groups:
        # only the first one, so that one nested in it is part of its text
        units.append(F.when(opens & (F.col("pos") == F.col("h1.pos")), "title"))
    if {"abstract", "keywords"} & set(groups):
        p = opens & (F.col("tag") == "p")
        in_abs = inside("abs") & (F.col("kwd_level") == 0) & (F.col("fn_level") == 0)
        units.append(F.when(p & in_abs, "abs_p").when(p & (F.col("kwd_level") > 0), "kwd_p"))
    if "sections" in groups:
        units.append(_body_kind())
    # One unit kind per entry; an element may be of interest to several jobs at once.
    t = scoped.select("*", *[k.alias(f"kind_{i}") for i, k in enumerate(units)])
    unit = [
        F.when(
            F.col(f"kind_{i}").isNotNull(),
            F.struct(F.col(f"kind_{i}").alias("kind"), "pos", "end_pos", _context().alias("ctx")),
        )
        for i in range(len(units))
    ]
    t = t.select("*", *[running_last(u).alias(f"unit_{i}") for i, u in enumerate(unit)])
    held = [
        F.when(F.col("pos") < F.greatest(F.col(f"unit_{i}.end_pos"), F.col(f"unit_{i}.pos") + 1), F.col(f"unit_{i}"))
        for i in range(len(units))
    ]
    # Text after an element without content is not its own.
    owns = lambda u: F.when(
        (F.col("pos") < u["end_pos"]), F.col("text")
    ).otherwise("")
    no_text, no_end = F.lit(None).cast("string"), F.lit(None).cast("int")
    entries = [
        F.when(h.isNotNull(), F.struct(
            h["kind"].alias("kind"), h["pos"].alias("at"), no_end.alias("end_pos"), h["ctx"].alias("ctx"),
            no_text.alias("name"), no_text.alias("content"), owns(h).alias("piece"),
        ))
        for h in held
    ]
    no_ctx = F.lit(None).cast("struct<child:int,nested:int>")

    def marker(match: Column, kind: str, name=no_text, content=no_text, end=no_end) -> Column:
        return F.when(match, F.struct(
            F.lit(kind).alias("kind"), F.col("pos").alias("at"), end.alias("end_pos"), no_ctx.alias("ctx"),
            name.alias("name"), content.alias("content"), F.lit("").alias("piece"),
        ))

    entries.append(marker(F.col("pos") == 0, "doc"))
    if "meta" in groups:
        named = is_opener() & (F.col("tag") == "meta") & attr("name").isNotNull()
        content = F.coalesce(attr("content"), F.lit(""))
        entries.append(marker(named, "meta", attr("name"), content))
    if "keywords" in groups:
        entries.append(marker(opens & _section_class("kwd"), "kwd_section", end=F.col("end_pos")))
    if "sections" in groups:
        whole = opens & (F.col("pos") == F.col("body.pos"))
        entries.append(marker(whole, "body"))
        # Nothing at all between the tags, not even white space.
        bare = whole & (F.col("text") == "") & (F.col("end_pos") == F.col("pos") + 1)
        entries.append(marker(bare, "bare_body"))
    spread = t.select("doc_id", "pos", F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return (
        spread.select("doc_id", "pos", "e.*")
        .groupBy("doc_id", "kind", "at", "end_pos", "ctx", "name", "content")
        .agg(F.expr("listagg(piece, '') within group (order by pos)").alias("text"))
        .withColumnRenamed("at", "pos")
    )


def _context() -> Column:
    """(child section, nested section) of a body element, 0 for none."""
    child = F.when(F.col("near.is_section"), F.col("near.pos")).otherwise(0)
    nested = F.when(
        (F.col("below") > 1) & F.col("deep.is_section") & (F.col("deep.pos") > F.col("near.pos")),
        F.col("deep.pos"),
    ).otherwise(0)
    return F.struct(
        F.when(inside("body"), child).otherwise(0).cast("int").alias("child"),
        F.when(inside("body"), nested).otherwise(0).cast("int").alias("nested"),
    )


def _group_columns(elements: DataFrame) -> DataFrame:
    """Add the group number: a heading opens one, and so does a change of section."""
    part = _is("sec", "heading", "line", "inner")
    t = elements.select(
        "*",
        F.last(F.when(part, F.col("ctx")), ignorenulls=True).over(before_in_doc()).alias("above"),
    )
    moved = F.col("above").isNull() | ~F.col("above").eqNullSafe(F.col("ctx"))
    starts = F.when(part & (_is("sec", "heading") | moved), 1)
    return t.select("*", running_sum(starts).alias("section_no")).drop("above")


# --- aggregates --------------------------------------------------------------------


def _title_aggs() -> dict[str, Column]:
    return {"title": trim_ws(first_text(_is("title")))}


def _meta_aggs() -> dict[str, Column]:
    def first(tag: str) -> Column:
        return F.min_by("content", F.when(_is("meta") & (F.col("name") == tag), F.col("pos")))

    return {column: first(tag) for column, tag in META_NAMES.items()}


def _author_aggs() -> dict[str, Column]:
    named = _is("meta") & (F.col("name") == AUTHOR_META)
    value = trim_ws(F.col("content"))
    return {
        "authors": F.when(F.count(F.when(named, 1)) > 0, collected(named & (value != ""), value))
    }


def _abstract_aggs() -> dict[str, Column]:
    line = normalize_ws(html_unescape(F.col("text")))
    lines = F.filter(collected(_is("abs_p"), line), lambda x: x != "")
    return {"abstract_text": F.when(F.count(F.when(_is("abs_p"), 1)) > 0, F.array_join(lines, " "))}


def _keyword_aggs() -> dict[str, Column]:
    """Section by section, with all paragraphs below it: one that lies in several keyword sections
    counts for each of them."""
    words = split_keywords(strip_texts(trim_ws(html_unescape(F.col("text"))), KEYWORD_LEADS))
    within = lambda s, p: (p["pos"] > s["pos"]) & (p["pos"] < s["end_pos"])
    sections = ordered(_is("kwd_section"), "end_pos")
    paragraphs = ordered(_is("kwd_p"), words.alias("words"))
    found = F.transform(sections, lambda s: F.filter(paragraphs, lambda p: within(s, p)))
    listed = F.flatten(F.transform(F.flatten(found), lambda p: p["words"]))
    return {"keywords": F.when(F.count(F.when(_is("kwd_section"), 1)) > 0, listed)}


def _section_aggs() -> dict[str, Column]:
    text = html_unescape(trim_ws(F.col("text")))
    is_line = _is("line") | (_is("inner") & (trim_ws(F.col("text")) != ""))
    lines = F.transform(ordered(is_line, text.alias("line")), lambda x: x["line"])
    return {
        "section_title": trim_ws(F.max(F.when(_is("heading"), text))),
        "section_text": trim_ws(F.array_join(lines, "\n")),
        "scope": F.max("ctx.child"),
    }


def _shown(text: Column) -> Column:
    return trim_ws(strip_texts(sentence_gap(text), (NEW_TAB,)))


def _entries() -> Column:
    """Keyed sections of ``found``: array<struct<section_no, section_title, section_text,
    scope>> in order."""
    keys = growing_keys(
        F.transform(
            "found", lambda s: F.struct(s["section_title"].alias("title"), s["scope"].alias("scope"))
        )
    )
    shown = F.transform("found", lambda s: _shown(s["section_text"]))
    pairs = F.zip_with(
        keys, shown, lambda k, t: F.struct(k.alias("key"), t.alias("text"))
    )
    return F.transform(F.array(pairs), last_wins)[0]


def _aggregate(rows: DataFrame, aggs: dict[str, Column], *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])


# --- operators ---------------------------------------------------------------------


def _page(tokens: DataFrame, aggs: dict[str, Column], *groups) -> DataFrame:
    return _aggregate(html_elements(_scoped(tokens), groups), aggs, "doc_id")


def html_title(tokens: DataFrame) -> DataFrame:
    """(doc_id, value)"""
    return _page(tokens, _title_aggs(), "title").withColumnRenamed("title", "value")


def html_meta(tokens: DataFrame) -> DataFrame:
    """(doc_id, one column per meta name)"""
    return _page(tokens, _meta_aggs(), "meta")


def html_authors(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, value)"""
    return _listed(_page(tokens, _author_aggs(), "meta"), "authors")


def html_publish_date(meta: DataFrame) -> DataFrame:
    """(doc_id, publish_date) from ``html_meta``."""
    return meta.select("doc_id", html_date(F.col("publication_date")).alias("publish_date"))


def html_abstract(tokens: DataFrame) -> DataFrame:
    """(doc_id, value)"""
    return _page(tokens, _abstract_aggs(), "abstract").withColumnRenamed("abstract_text", "value")


def html_keywords(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, value)"""
    return _listed(_page(tokens, _keyword_aggs(), "keywords"), "keywords")


def _listed(df: DataFrame, column: str) -> DataFrame:
    return df.select("doc_id", F.posexplode(column).alias("ord", "value")).withColumn(
        "ord", F.col("ord") + 1
    )


def _full_text() -> Column:
    kind = F.coalesce("ncbi_type", F.lit(""))
    return (kind != "") & ~F.lower(kind).startswith("scan")


def html_full_text_flag(meta: DataFrame) -> DataFrame:
    """(doc_id, is_full_text) from ``html_meta``."""
    return meta.select("doc_id", _full_text().alias("is_full_text"))


def _section_lists(tokens: DataFrame) -> DataFrame:
    rows = _group_columns(html_elements(_scoped(tokens), ("sections",)))
    found = _aggregate(rows, _section_aggs(), "doc_id", "section_no")
    found = found.where(F.col("section_text") != "")
    entry = F.struct("section_no", "section_title", "section_text", "scope")
    listed = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    return listed.select("doc_id", _entries().alias("entries"))


def html_sections(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, key, text)"""
    return _section_lists(tokens).select(
        "doc_id", F.posexplode("entries").alias("i", "e")
    ).select(
        "doc_id", (F.col("i") + 1).alias("ord"), F.col("e.key").alias("key"), F.col("e.text").alias("text")
    )


def html_full_text_fallback(tokens: DataFrame) -> DataFrame:
    """(doc_id, key, text): pages whose body section has no content."""
    rows = html_elements(_scoped(tokens), ("sections",)).where(_is("bare_body"))
    return rows.select("doc_id", F.lit("full_text").alias("key"), F.lit("").alias("text"))


def html_element_texts(tokens: DataFrame, *tags: str) -> DataFrame:
    """(doc_id, pos, tag, text): every element of these names with all text below it, in page order.
    An element that lies in another one counts for both."""
    named = tokens.select(
        "*",
        F.when(F.col("tag").isin(*tags), F.col("tag")).alias("kind"),
        F.lit(0).alias("hidden"),
        F.lit(False).alias("skip_hidden"),
    )
    found = unit_texts(named, list(tags), [], [])
    return found.select("doc_id", "pos", F.col("kind").alias("tag"), "text")


def html_require_title(articles: DataFrame) -> DataFrame:
    """Keep records with a title; the others count as failures."""
    return articles.where(F.coalesce("title", F.lit("")) != "")


def id_of_name(doc_id: Column) -> Column:
    name = F.substring_index(doc_id.cast("string"), "/", -1)
    number = F.replace(F.replace(name, F.lit("pmc"), F.lit("")), F.lit(".html"), F.lit(""))
    return F.coalesce(number.try_cast("int"), F.lit(0))


NO_TITLE = "no title"


def html_article_results(
    payloads: DataFrame, pmc_id: Column | None = None, tasks: int | None = None
) -> DataFrame:
    """One row per payload: the article record of pages with a title, for all others no more than
    fault and fault_pos."""
    rows = _records(markup_tokens(payloads, "html", keep_blank=True, tasks=tasks), pmc_id)
    good = F.coalesce("title", F.lit("")) != ""
    kept = [F.when(good, F.col(c)).alias(c) for c in rows.columns if c != "doc_id"]
    return rows.select(
        "doc_id", *kept, F.when(~good, NO_TITLE).alias("fault"), F.when(~good, 0).cast("int").alias("fault_pos")
    )


def html_articles(payloads: DataFrame, pmc_id: Column | None = None, tasks: int | None = None) -> DataFrame:
    """(doc_id, payload) to one article record per page.

    ``pmc_id`` gives the article id from doc_id, as pages do not name their own. By default
    it is the number in doc_id, which may be the path of a ``pmc<id>.html`` file; else 0."""
    return _records(markup_tokens(payloads, "html", tasks=tasks), pmc_id)


def _records(tokens: DataFrame, pmc_id: Column | None) -> DataFrame:
    pmc_id = id_of_name(F.col("doc_id")) if pmc_id is None else pmc_id
    rows = _group_columns(html_elements(html_scoped(tokens)))
    in_body = _is("sec", "heading", "line", "inner")
    rows = rows.withColumn("slot", F.when(in_body, F.col("section_no")).otherwise(0))
    page = (
        _title_aggs() | _meta_aggs() | _author_aggs() | _abstract_aggs() | _keyword_aggs()
        | {
            "has_body": F.count(F.when(_is("body"), 1)) > 0,
            "bare": F.count(F.when(_is("bare_body"), 1)) > 0,
        }
    )
    groups = _aggregate(rows, page | _section_aggs(), "doc_id", "slot")
    section = F.when(
        (F.col("slot") > 0) & (F.col("section_text") != ""),
        F.struct(F.col("slot").alias("section_no"), "section_title", "section_text", "scope"),
    )
    groups = groups.select(
        "doc_id",
        F.when(F.col("slot") == 0, F.struct(*page)).alias("page"),
        section.alias("section"),
    )
    docs = groups.groupBy("doc_id").agg(
        F.first("page", ignorenulls=True).alias("page"),
        F.sort_array(F.collect_list("section")).alias("found"),
    ).select("doc_id", "page.*", "found")
    bare = F.create_map(F.lit("full_text"), F.lit(""))
    docs = docs.select("*", _entries().alias("entries"))
    filled = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["key"], e["text"])))
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        pmc_id.alias("pmc_id"),
        try_int(F.col("pmid")).alias("pm_id"),
        "doi",
        "title",
        none.alias("category"),
        "journal",
        none.alias("publisher"),
        "volume",
        "issue",
        none.alias("issn"),
        F.col("first_page").alias("f_page"),
        none.alias("l_page"),
        "authors",
        html_date(F.col("publication_date")).alias("publish_date"),
        "abstract_text",
        "keywords",
        F.when(_full_text() & F.col("has_body"), F.when(F.col("bare"), bare).otherwise(filled)).alias(
            "sections"
        ),
    )
