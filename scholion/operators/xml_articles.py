"""JATS articles from the token table.

Stages, all inside one partitioning by document:

1. ``xml_first_article``: keep the first article, add scopes.
2. ``xml_elements``: name the elements that matter (``kind``) and gather their text.
3. one operator per result, each reading only the kinds it needs, and
   ``xml_articles``, which builds whole records in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.functions.keys import restart_keys
from scholion.functions.scalars import (
    clamped_date,
    digits_to_id,
    full_name,
    is_blank,
    normalize_ws,
    sentence_gap,
    trim_ws,
    try_int,
    xml_unescape,
)
from scholion.operators.elements import (
    blank_to_null,
    collected,
    delta,
    first_element,
    first_text,
    inside,
    is_opener,
    listed_texts,
    ordered,
    unit_texts,
)
from scholion.operators.tokens import (
    NO_END,
    attr,
    attr_sql,
    before_in_doc,
    markup_tokens,
    running_last,
    running_sum,
)

# Elements whose text never belongs to the prose around them.
IGNORED = (
    "fig", "fig-group", "table-wrap", "table-wrap-group", "table", "graphic",
    "inline-graphic", "media", "supplementary-material", "disp-formula",
    "inline-formula", "xref", "label",
)
# Section types that are left out of the body.
SKIPPED_SEC_TYPES = ("abstract", "ref-list", "supplementary-material")
# Elements that act as headings.
HEADINGS = ("title", "bold", "b", "strong")

META_UNITS = {
    "title": "article-title",
    "volume": "volume",
    "issue": "issue",
    "f_page": "fpage",
    "l_page": "lpage",
}
JOURNAL_UNITS = {"journal": "journal-title", "publisher": "publisher-name", "issn": "issn"}
ID_TYPES = ("doi", "pmid", "pmcaid", "pmcid")
DATE_PARTS = ("year", "month", "day")

FRONT_GROUPS = {
    "title": (["title"], []),
    "ids": (["article_id"], []),
    "journal": (["journal", "publisher", "issn", "volume", "issue", "f_page", "l_page"], []),
    "category": (["subject"], ["subj_group"]),
    "dates": (["year", "month", "day"], ["date"]),
    "authors": (["given", "surname"], ["contrib"]),
    "keywords": (["kwd"], ["kwd_group"]),
    "abstract": (["abs_p", "abs_title"], ["abs_sec"]),
}
BODY_GROUPS = {"sections": (["line", "heading", "sec_title", "body_text"], ["sec"])}
TABLE_GROUPS = {
    "tables": (
        ["label", "cap_title", "caption", "note_p", "th", "td"],
        ["wrap", "table", "table_part", "tr", "foot"],
    )
}
GROUPS = FRONT_GROUPS | BODY_GROUPS | TABLE_GROUPS
TABLE_KINDS = (*TABLE_GROUPS["tables"][0], *TABLE_GROUPS["tables"][1])
PARENTS = ("subj_group", "kwd_group", "date", "abs_sec", "sec")
INFO = ["info", "flag", "rel", "wrap_level"]


def _counters() -> dict[str, Column]:
    """How many elements of some names are open, as steps of running sums. These follow from a tag's
    name alone, so the pass that finds its depth adds them; other tokens get them in a pass of
    their own."""
    names = {
        "front_level": F.col("qname") == "front",
        "body_level": F.col("qname") == "body",
        "hidden": F.col("tag").isin(*IGNORED),
        "wrap_level": F.col("qname") == "table-wrap",
        "note_level": F.col("qname").isin("caption", "table-wrap-foot"),
        "thead_level": F.col("qname") == "thead",
        "sec_level": F.col("tag") == "sec",
    }
    return {name: delta(match) for name, match in names.items()}


def xml_tokens(payloads: DataFrame, keep_blank: bool = False, tasks: int | None = None) -> DataFrame:
    """The tokens of ``markup_tokens`` with the counters that the operators here work with."""
    return markup_tokens(payloads, "xml", keep_blank, tasks, _counters())


def xml_first_article(tokens: DataFrame) -> DataFrame:
    """Tokens of the first article of each well-formed payload, with scope columns.

    Scopes are structs (pos, end_pos, depth): front (else the article), meta and
    journal (else front), abstract, body. Counters: hidden (open ignored elements),
    front_level, secs, wrap_level and so on.
    """
    return _scopes(tokens, F.col("qname") == "article")


def xml_fragment(tokens: DataFrame) -> DataFrame:
    """Tokens of each well-formed payload as a whole, which need not hold an article, with the same
    scope columns: the root stands for the article. For ``xml_tables`` and its like."""
    return _scopes(tokens, F.col("depth") == 1)


# What is wrong with payloads whose tokens are all right, or that have none.
NO_ROOT, TWO_ROOTS, NO_ARTICLE = "no root", "second root", "no article"


def _scopes(tokens: DataFrame, root_match: Column, keep_faults: bool = False, body_only: bool = False) -> DataFrame:
    """``keep_faults``: a payload without an article has one row in place of its tokens, an empty
    article whose column ``fault`` (pos, kind) tells the first thing that is wrong, as a parser
    would meet it: that an element has no end is known only when all else was read. ``body_only``
    keeps the tokens of the body and, without its text, the one that opens the article."""
    doc, counters = W.partitionBy("doc_id"), _counters()
    if "sec_level" not in tokens.columns:
        counted = [running_sum(c).alias(name) for name, c in counters.items()]
        tokens = tokens.select("*", F.col("pos").alias("n"), F.col("end_pos").alias("end_n"), *counted)
    balance = F.when(F.col("is_open"), 1).when(F.col("is_close"), -1).otherwise(0)
    root = F.when(is_opener() & (F.col("depth") == 1), 1)
    # What is open around the article does not count in it.
    used = ("body_level", "hidden", "sec_level") if body_only else tuple(counters)
    around = [(F.col(c) - F.coalesce(counters[c], F.lit(0))).alias(c) for c in used]
    facts = [
        first_element(root_match, *around).alias("article"),
        F.max("bad").over(doc).alias("broken"),
        F.sum(balance).over(doc).alias("left_open"),
        F.count(root).over(doc).alias("roots"),
    ]
    if keep_faults:
        ordered_doc = doc.orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        what = F.struct("pos", F.col("fault").alias("kind"))
        facts += [
            F.min(F.when(F.col("fault") != NO_END, what)).over(doc).alias("first_bad"),
            F.min(F.when(F.col("fault") == NO_END, what)).over(doc).alias("first_open"),
            F.nth_value(F.when(root == 1, F.col("pos")), 2, True).over(ordered_doc).alias("second_root"),
        ]
    t = tokens.select("*", *facts)
    well_formed = ~F.col("broken") & (F.col("left_open") == 0) & (F.col("roots") == 1)
    in_article = well_formed & F.col("pos").between(F.col("article.pos"), F.col("article.end_pos"))
    inner = {c: F.col(c) - F.col(f"article.{c}") for c in used}
    place = F.struct("article.pos", "article.end_pos", "article.depth")
    if keep_faults:
        named = lambda pos, kind: F.struct(pos.cast("int").alias("pos"), F.lit(kind).alias("kind"))
        fault = F.when(
            ~F.coalesce(well_formed & F.col("article").isNotNull(), F.lit(False)),
            F.coalesce(
                "first_bad",
                "first_open",
                F.when(F.col("second_root").isNotNull(), named(F.col("second_root"), TWO_ROOTS)),
                F.when(F.col("roots") == 0, named(F.lit(0), NO_ROOT)),
                named(F.lit(0), NO_ARTICLE),
            ),
        )
        t = t.withColumn("fault", fault)
        stands_in = F.col("fault").isNotNull()
        t = t.where(F.when(stands_in, F.col("pos") == 0).otherwise(in_article))
        empty = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("end_pos"), F.lit(1).cast("long").alias("depth"))
        instead = {
            "is_open": F.lit(False), "is_close": F.lit(False), "is_selfclosing": F.lit(True),
            "qname": F.lit("article"), "tag": F.lit("article"), "attrs": F.lit(""), "text": F.lit(""),
            "depth": F.lit(1).cast("long"), "end_pos": F.lit(0), "start_pos": F.lit(0), "end_n": F.col("n"),
        }
        given = {k: F.when(stands_in, v).otherwise(F.col(k)) for k, v in instead.items()}
        given |= {c: F.when(stands_in, F.lit(0)).otherwise(v) for c, v in inner.items()}
        t = t.withColumns(given | {"article": F.when(stands_in, empty).otherwise(place)})
        t = t.drop("first_bad", "first_open", "second_root")
    else:
        t = t.where(in_article).drop("fault").withColumns(inner | {"article": place})
    t = t.drop("bad", "broken", "left_open", "roots", *[c for c in counters if c not in used])

    if body_only:
        t = t.where((F.col("body_level") > 0) | (F.col("pos") == F.col("article.pos")))
        t = t.withColumn("text", F.when(F.col("body_level") > 0, F.col("text")))
    own_front = (F.col("qname") == "front") & (F.col("depth") == F.col("article.depth") + 1)
    scopes = [first_element(F.col("qname") == "body", "sec_level").alias("body")]
    if not body_only:
        is_abstract = (F.col("qname") == "abstract") & (F.col("front_level") > 0)
        scopes += [
            F.coalesce(first_element(own_front), "article").alias("front"),
            F.coalesce(
                first_element(is_abstract & attr("abstract-type").isNull()),
                first_element(is_abstract),
            ).alias("abstract"),
        ]
    t = t.select("*", *scopes)
    in_body = F.coalesce(F.col("pos").between(F.col("body.pos"), F.col("body.end_pos")), F.lit(False))
    if body_only:
        t = t.where(in_body | (F.col("pos") == F.col("article.pos")))
    child_of_body = inside("body") & (F.col("depth") == F.col("body.depth") + 1)
    secs = F.when(in_body, F.col("sec_level") - F.col("body.sec_level")).otherwise(0)
    scopes = [F.max(child_of_body & is_opener()).over(doc).alias("body_has_elements")]
    for scope in () if body_only else ("meta", "journal"):
        found = first_element((F.col("qname") == f"{'article' if scope == 'meta' else scope}-meta") & inside("front"))
        scopes.append(F.coalesce(found, "front").alias(scope))
    t = t.select("*", secs.alias("secs"), *scopes)
    t = t.select("*", F.expr(STRUCTURAL).alias("structural"))
    counted = {"skipped": F.expr(SKIPS)}
    if not body_only:
        counted["history"] = (F.col("qname") == "pub-history") & inside("meta")
        counted["categories"] = (F.col("qname") == "article-categories") & inside("meta")
    return t.select("*", F.expr(SKIPS).alias("skips"), *[running_sum(delta(c)).alias(k) for k, c in counted.items()])


# Rules below are SQL conditions on a tag, alike on both tags of an element.
SECS_HERE = "(secs + if(tag = 'sec' and (is_close or is_selfclosing), 1, 0))"


def _below(scope: str) -> str:
    return f"(start_pos > {scope}.pos and start_pos < {scope}.end_pos)"


# Body element with nothing but sections between it and the body.
STRUCTURAL = (
    f"coalesce({_below('body')} and "
    f"{SECS_HERE} = depth - body.depth - if(tag = 'sec', 0, 1), false)"
)


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Body element that prose leaves out with all below it.
SKIPS = (
    f"structural and (tag in ({_names(IGNORED)}, 'ref-list') or "
    f"(tag = 'sec' and lower(coalesce({attr_sql('sec-type')}, '')) in ({_names(SKIPPED_SEC_TYPES)})))"
)


def _front_rules(groups) -> list[tuple[str, str, str, str]]:
    """(kind, condition, info, flag) for front matter."""
    in_meta, in_front = _below("meta"), _below("front")
    rules = []

    def add(kind: str, condition: str, info: str = "null", flag: str = "false") -> None:
        rules.append((kind, condition, info, flag))

    if "title" in groups:
        add("title", f"qname = 'article-title' and {in_meta}")
    if "ids" in groups:
        known = f"{attr_sql('pub-id-type')} in ({_names(ID_TYPES)})"
        add("article_id", f"qname = 'article-id' and {in_meta} and {known}", attr_sql("pub-id-type"))
    if "journal" in groups:
        for kind, name in JOURNAL_UNITS.items():
            add(kind, f"qname = '{name}' and {_below('journal')}", attr_sql("pub-type"))
        for kind, name in META_UNITS.items():
            add(kind, f"qname = '{name}' and {in_meta} and depth = meta.depth + 1")
    if "category" in groups:
        add("subject", f"qname = 'subject' and {in_meta} and categories > 0")
        add("subj_group", f"qname = 'subj-group' and {in_meta}", attr_sql("subj-group-type"))
    if "dates" in groups:
        dated = "(qname = 'pub-date' or (qname = 'date' and history > 0))"
        # The pub-type of a pub-date, blank when it has none; null for other dates.
        pub_type = f"if(qname = 'pub-date', coalesce({attr_sql('pub-type')}, ''), null)"
        add("date", f"{dated} and {in_meta}", pub_type, "history > 0")
        for part in DATE_PARTS:
            add(part, f"qname = '{part}' and {in_meta}")
    if "authors" in groups:
        author = f"{attr_sql('contrib-type')} = 'author'"
        add("contrib", f"qname = 'contrib' and {in_front} and {author}")
        add("given", f"qname = 'given-names' and {in_front}")
        add("surname", f"qname = 'surname' and {in_front}")
    if "keywords" in groups:
        add("kwd_group", f"qname = 'kwd-group' and {in_front}")
        add("kwd", f"qname = 'kwd' and {in_front}")
    if "abstract" in groups:
        in_abs, down = _below("abstract"), "depth - abstract.depth"
        add("abs_p", f"qname = 'p' and {in_abs}")
        add("abs_sec", f"qname = 'sec' and {in_abs} and {down} = 1")
        add("abs_title", f"qname = 'title' and {in_abs} and {down} = 2")
    return rules


def _body_rules() -> list[tuple[str, str, str, str]]:
    """As above; the flag says that the text keeps what prose leaves out."""
    usable = "structural and skipped = 0 and not skips"
    plain = f"{usable} and tag <> 'sec'"
    at_top = f"{SECS_HERE} = 0"
    heading = f"tag in ({_names(HEADINGS)})"
    whole = "qname = 'body' and start_pos = body.pos and not coalesce(body_has_elements, false)"
    return [
        ("sec", f"{usable} and tag = 'sec'", "null", "false"),
        ("heading", f"{plain} and {at_top} and {heading}", "null", "true"),
        ("sec_title", f"{plain} and not {at_top} and qname = 'title'", "null", "true"),
        ("other", f"{plain} and not {at_top} and tag = 'title'", "null", "false"),
        ("line", f"{plain} and {heading}", "null", "true"),
        ("line", plain, "null", "false"),
        ("body_text", whole, "null", "true"),
    ]


def _table_rules() -> list[tuple[str, str, str, str]]:
    def named(kind: str, names: str, more: str = "", info: str = "null", flag: str = "false"):
        return (kind, f"wrap_level > 0 and qname in ({names}){more}", info, flag)

    noted = " and note_level > 0"
    return [
        ("wrap", "qname = 'table-wrap'", attr_sql("id"), "false"),
        named("table", "'table'"),
        named("table_part", "'tbody', 'tfoot'", info="qname"),
        named("tr", "'tr'"),
        named("foot", "'table-wrap-foot'"),
        named("label", "'label'"),
        named("caption", "'caption'"),
        named("cap_title", "'title'", noted),
        named("note_p", "'p'", noted),
        named("th", "'th'", flag="thead_level > 0"),
        named("td", "'td'"),
    ]


def xml_elements(scoped: DataFrame, groups=tuple(GROUPS), tasks: int | None = None) -> DataFrame:
    """Elements of the asked groups with their normalized text, dealt to ``tasks`` by document if given.

    Columns: doc_id, pos, end_pos, depth, kind, info (an attribute), flag, rel (open
    sections in the body), wrap_level, text. An element that is part of a table or of the
    body and of the front matter as well has a row for each.
    """
    t = scoped
    rules = []
    if "sections" in groups:
        rules += _body_rules()
    if "tables" in groups:
        rules += _table_rules()
    front_rules = _front_rules(groups)
    both = bool(rules and front_rules)
    if not both:
        rules, front_rules = rules + front_rules, []
    # The article itself is always there, so that no article is lost for want of fields.
    rules.append(("article", "start_pos = article.pos", "null", "false"))

    def first_rule(rules) -> str:
        cases = " ".join(f"when {r[1]} then {i}" for i, r in enumerate(rules))
        return f"case when start_pos is not null then case {cases} end end"

    def of_rule(rule: str, values: list[str], default: str) -> str:
        cases = [f"when {i} then {v}" for i, v in enumerate(values) if v != default]
        return f"case {rule} {' '.join(cases)} else {default} end" if cases else default

    def described(rule: str, rules, prefix: str = "") -> list[str]:
        return [
            of_rule(rule, [f"'{r[0]}'" for r in rules], "null") + f" as {prefix}kind",
            f"cast({of_rule(rule, [r[2] for r in rules], 'null')} as string) as {prefix}info",
            of_rule(rule, [r[3] for r in rules], "false") + f" as {prefix}flag",
        ]

    columns = described("rule", rules)
    t = t.selectExpr("*", f"{first_rule(rules)} as rule")
    if both:
        columns += described("front_rule", front_rules, "front_")
        t = t.selectExpr("*", f"{first_rule(front_rules)} as front_rule")
    carried = [c for c in ("fault",) if c in t.columns]
    t = t.selectExpr(
        "doc_id", "pos", "end_pos", "depth", "is_open", "is_close", "is_selfclosing", "n", "end_n",
        "text", "hidden", "wrap_level" if "wrap_level" in t.columns else "0L as wrap_level", *carried, *columns,
        (SECS_HERE if "sections" in groups else "0L") + " as rel",
    )
    info = [*INFO, *carried]
    if both:
        # Alone, the front kind is the kind; next to another one it is carried along.
        alone = "kind is null"
        t = t.selectExpr(
            "* except (kind, info, flag, front_kind)",
            "coalesce(kind, front_kind) as kind",
            f"if({alone}, front_info, info) as info",
            f"if({alone}, front_flag, flag) as flag",
            f"if({alone}, null, front_kind) as front_kind",
        )
        info += ["front_kind", "front_info", "front_flag"]
    t = t.selectExpr("*", "kind in ('th', 'td') or (kind = 'line' and not flag) as skip_hidden")
    units = [k for g in groups for k in GROUPS[g][0]]
    markers = ["article"] + [k for g in groups for k in GROUPS[g][1]]
    found = listed_texts(t, units, markers, info, "front_kind" if both else None, tasks)
    if both:
        one = "struct(kind, info, flag, text)"
        two = "struct(front_kind as kind, front_info as info, front_flag as flag, whole_text as text)"
        found = found.selectExpr(
            "doc_id", "pos", "end_pos", "depth", "rel", "wrap_level", *carried,
            f"inline(if(front_kind is null, array({one}), array({one}, {two})))",
        )
    return found.withColumn("text", normalize_ws(F.col("text"))).withColumn("info", xml_unescape(F.col("info")))


def _with_parent(elements: DataFrame) -> DataFrame:
    """Add the parent where it is a marker that can be one, and ``repeated``: an
    earlier element of the same kind has the same parent."""
    is_parent = F.col("kind").isin(*PARENTS)
    key = F.when(is_parent, F.col("depth")).otherwise(F.col("depth") - 1)
    w = W.partitionBy("doc_id", key).orderBy("pos")
    up_to_here = w.rowsBetween(W.unboundedPreceding, 0)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    near = F.last(
        F.when(is_parent, F.struct("pos", "end_pos", "kind", "info", "rel")), ignorenulls=True
    ).over(up_to_here)
    is_title = F.col("kind").isin("sec_title", "abs_title")
    last_title = F.last(F.when(is_title, F.col("pos")), ignorenulls=True).over(before)
    t = elements.select("*", near.alias("near"), last_title.alias("last_title"))
    holds = (F.col("near.pos") < F.col("pos")) & (F.col("pos") < F.col("near.end_pos"))
    t = t.withColumn("parent", F.when(holds, F.col("near")))
    again = F.coalesce(F.col("last_title") > F.col("parent.pos"), F.lit(False))
    return t.withColumn("repeated", again).drop("near", "last_title")


# --- columns added to the element table --------------------------------------------


def _is(*kinds) -> Column:
    return F.col("kind").isin(*kinds)


def _front_columns(elements: DataFrame, groups, *more: Column) -> DataFrame:
    """The names that follow a contributor, the parts that follow a date, and the
    abstract section around a paragraph; ``more`` are added along with them."""
    added = [*more]
    parts = [k for g, ks in (("authors", ("given", "surname")), ("dates", DATE_PARTS))
             if g in groups for k in ks]
    for kind in parts:
        added.append(
            F.expr(
                f"lead(case when kind = '{kind}' then struct(pos, depth, text) end, 1) "
                "ignore nulls over (partition by doc_id order by pos)"
            ).alias(f"next_{kind}")
        )
    if "abstract" in groups:
        sec = F.when(_is("abs_sec"), F.struct("pos", "end_pos"))
        added.append(running_last(sec).alias("abs_sec"))
    return elements.select("*", *added) if added else elements


def _next_text(kind: str) -> Column:
    """Text of the first element of that kind below the element at hand."""
    return F.when(F.col(f"next_{kind}.pos") < F.col("end_pos"), F.col(f"next_{kind}.text"))


def _date_part(kind: str) -> Column:
    child = F.col(f"next_{kind}.depth") == F.col("depth") + 1
    return F.when(child, _next_text(kind))


def _date_value() -> Column:
    return clamped_date(*[_date_part(k) for k in DATE_PARTS])


def _at_top() -> Column:
    return (_is("sec") & (F.col("rel") == 1)) | (_is("line", "heading") & (F.col("rel") == 0))


def _above() -> Column:
    """Kind of the last element before this one that lies at body level."""
    return F.last(F.when(_at_top(), F.col("kind")), ignorenulls=True).over(before_in_doc()).alias("above")


def _body_columns(elements: DataFrame) -> DataFrame:
    """Add the group number: a group is one section-to-be. A heading or a section opens
    one at body level, and so does the first element after a section."""
    t = elements if "above" in elements.columns else elements.select("*", _above())
    starts = _at_top() & (
        _is("sec", "heading") | F.col("above").isNull() | (F.col("above") == "sec")
    )
    opens = F.when(starts | _is("body_text"), 1)
    return t.select("*", running_sum(opens).alias("section_no")).drop("above")


def _table_columns(elements: DataFrame) -> DataFrame:
    """Add wrap (the table-wrap around an element), tbl (its first table), part (table
    body or foot), row and the first-row flag. What lies in several nested wraps has a row for
    each, as it belongs to all of them."""
    nested = F.col("kind").isin(*TABLE_KINDS) & (F.col("wrap_level") > 1)
    levels = F.when(nested, F.sequence(F.lit(1).cast("long"), F.col("wrap_level"))).otherwise(F.array("wrap_level"))
    elements = elements.select("*", F.explode(levels).alias("level"))
    w = W.partitionBy("doc_id", "level").orderBy("pos")
    here = w.rowsBetween(W.unboundedPreceding, 0)
    before = w.rowsBetween(W.unboundedPreceding, -1)

    def latest(match: Column, *fields, frame=here) -> Column:
        return F.last(
            F.when(match, F.struct("pos", "end_pos", "depth", *fields)), ignorenulls=True
        ).over(frame)

    def around(scope: str) -> Column:
        return (F.col(f"{scope}.pos") < F.col("pos")) & (F.col("pos") < F.col(f"{scope}.end_pos"))

    filled = F.col("end_pos") > F.col("pos")
    own = F.col("level") == F.col("wrap_level")
    t = elements.select(
        "*",
        latest(_is("wrap") & filled & own, "info").alias("wrap"),
        latest(_is("table"), frame=before).alias("earlier_table"),
    )
    child = F.col("depth") == F.col("wrap.depth") + 1
    first = _is("table") & (F.coalesce("earlier_table.pos", F.lit(-1)) < F.col("wrap.pos"))
    t = t.select(
        "*",
        first.alias("first_table"),
        latest(first).alias("tbl"),
        latest(_is("caption") & child).alias("cap"),
        latest(_is("foot") & child).alias("foot"),
    )
    below = F.col("depth") - F.col("tbl.depth")
    in_table = around("tbl") & (F.col("tbl.pos") > F.col("wrap.pos"))
    t = t.select(
        "*",
        F.coalesce(in_table, F.lit(False)).alias("in_table"),
        below.alias("below"),
        latest(_is("table_part") & in_table & (below == 1), "info").alias("part"),
        latest(_is("tr") & in_table & (below == 2)).alias("row"),
        latest(_is("tr") & in_table & (below == 2), frame=before).alias("earlier_row"),
    )
    in_part = F.col("in_table") & around("part")
    first_row = (
        _is("tr") & (F.col("below") == 2) & in_part & (F.col("part.info") == "tbody")
        & (F.coalesce("earlier_row.pos", F.lit(-1)) < F.col("part.pos"))
    )
    in_row = in_part & around("row") & (F.col("row.pos") > F.col("part.pos"))
    t = t.select(
        "*",
        latest(first_row).alias("head_row"),
        F.coalesce(in_row, F.lit(False)).alias("in_row"),
    )
    return t.select(
        "*",
        F.coalesce(around("head_row"), F.lit(False)).alias("in_head_row"),
        F.coalesce(around("cap"), F.lit(False)).alias("in_caption"),
        F.coalesce(around("foot"), F.lit(False)).alias("in_foot"),
    ).drop("head_row", "earlier_row", "earlier_table")


# --- aggregates --------------------------------------------------------------------


def _title_aggs() -> dict[str, Column]:
    return {"title": blank_to_null(first_text(_is("title")))}


def _id_aggs() -> dict[str, Column]:
    def of_type(t: str) -> Column:
        return blank_to_null(first_text(_is("article_id") & (F.col("info") == t)))

    return {
        "pmc_id": digits_to_id(F.coalesce(of_type("pmcaid"), of_type("pmcid"))),
        "pm_id": try_int(of_type("pmid")),
        "doi": of_type("doi"),
    }


def _journal_aggs() -> dict[str, Column]:
    electronic = blank_to_null(first_text(_is("issn") & (F.col("info") == "epub")))
    plain = {
        k: blank_to_null(first_text(_is(k)))
        for k in ("journal", "publisher", "volume", "issue", "f_page", "l_page")
    }
    return plain | {"issn": F.coalesce(electronic, blank_to_null(first_text(_is("issn"))))}


def _category_aggs() -> dict[str, Column]:
    heading = (F.col("parent.kind") == "subj_group") & (F.col("parent.info") == "heading")
    return {
        "category": F.coalesce(
            blank_to_null(first_text(_is("subject") & heading)),
            blank_to_null(first_text(_is("subject"))),
        )
    }


def _date_aggs() -> dict[str, Column]:
    def of_first(match: Column) -> Column:
        return F.min_by("date_value", F.when(_is("date") & match, F.col("pos")))

    kind = F.col("info")
    return {
        "publish_date": F.least(
            F.min(F.when(_is("date") & F.col("flag"), F.col("date_value"))),
            of_first(kind == "epub"),
            of_first(kind == "ppub"),
            of_first(kind == "collection"),
            of_first(kind.isNotNull()),
        )
    }


def _author_aggs() -> dict[str, Column]:
    author = full_name(_next_text("given"), _next_text("surname"))
    return {"authors": collected(_is("contrib") & author.isNotNull(), author)}


def _keyword_aggs() -> dict[str, Column]:
    direct = F.col("parent.kind") == "kwd_group"
    return {"keywords": collected(_is("kwd") & direct & (F.col("text") != ""), F.col("text"))}


def _abstract_aggs() -> dict[str, Column]:
    in_sec = F.col("pos") < F.col("abs_sec.end_pos")
    paragraphs = ordered(
        _is("abs_p") & (F.col("text") != ""),
        F.col("text").alias("value"),
        F.when(in_sec, F.col("abs_sec.pos")).alias("sec"),
    )
    own_title = (F.col("parent.kind") == "abs_sec") & ~F.col("repeated") & (F.col("text") != "")
    titles = F.map_from_entries(
        F.collect_list(F.when(_is("abs_title") & own_title, F.struct("parent.pos", "text")))
    )
    return {
        "abs_paragraphs": paragraphs,
        "abs_titles": titles,
        "abs_secs": F.count(F.when(_is("abs_sec"), 1)),
    }


def _abstract_text() -> Column:
    """Paragraphs joined by a space; in a structured abstract the first paragraph of a
    titled section is led by the title."""

    def text(p: Column, i: Column, all_ps: Column) -> Column:
        new = (i == 0) | (F.get(all_ps, i - 1)["sec"] != p["sec"])
        head = F.try_element_at("abs_titles", p["sec"])
        led = F.concat(head, F.lit(": "), p["value"])
        return F.when(new & head.isNotNull(), led).otherwise(p["value"])

    in_secs = F.filter("abs_paragraphs", lambda p: p["sec"].isNotNull())
    structured = F.transform(
        F.array(in_secs),
        lambda ps: F.array_join(F.transform(ps, lambda p, i: text(p, i, ps)), " "),
    )[0]
    flat = F.array_join(F.transform("abs_paragraphs", lambda p: p["value"]), " ")
    return blank_to_null(F.when(F.col("abs_secs") > 0, structured).otherwise(flat))


def _section_aggs() -> dict[str, Column]:
    """Per group: title and the lines joined by newlines. The title of a section counts
    as a line at the place where the section opens."""
    own_title = _is("sec_title") & ~F.col("repeated")
    is_line = (_is("line", "body_text") | own_title) & (F.col("text") != "")
    leads = _is("heading") | (own_title & (F.col("parent.rel") == 1))
    line = F.struct(
        F.when(own_title, F.col("parent.pos")).otherwise(F.col("pos")).alias("at"),
        F.col("text").alias("line"),
    )
    lines = F.sort_array(F.collect_list(F.when(is_line, line)))
    return {
        "section_title": F.max(
            F.when(leads, F.col("text")).when(_is("body_text"), F.lit("full_text"))
        ),
        "section_text": F.array_join(F.transform(lines, lambda x: x["line"]), "\n"),
        "is_fallback": F.coalesce(F.max(_is("body_text")), F.lit(False)),
    }


def _table_aggs() -> dict[str, Column]:
    """Parts of one table per wrap."""
    child = F.col("depth") == F.col("wrap.depth") + 1
    title = F.col("in_caption") & (F.col("depth") == F.col("wrap.depth") + 2)
    head = F.col("in_table") & _is("th")
    shown = F.col("text") != ""
    cell = _is("td") & F.col("in_row") & (F.col("below") == 3)
    placed = F.struct(
        (F.col("part.info") == "tfoot").alias("in_foot"),
        F.col("row.pos").alias("row_at"),
        "pos",
        F.col("text").alias("value"),
    )
    return {
        "has_table": F.coalesce(F.max("first_table"), F.lit(False)),
        "label": blank_to_null(first_text(_is("label") & child)),
        "cap_title": blank_to_null(first_text(_is("cap_title") & title)),
        "wrap_id": F.max(F.when(_is("wrap") & (F.col("pos") == F.col("wrap.pos")), trim_ws(F.col("info")))),
        "cap_notes": collected(_is("note_p") & F.col("in_caption") & shown, F.col("text")),
        "caption": blank_to_null(first_text(_is("caption") & child)),
        "foot_notes": collected(_is("note_p") & F.col("in_foot") & shown, F.col("text")),
        "heads": collected(head & F.col("flag") & shown, F.col("text")),
        "n_heads": F.count(F.when(head & F.col("flag"), 1)),
        "row_heads": collected(head & F.col("in_head_row") & shown, F.col("text")),
        "cells": F.sort_array(F.collect_list(F.when(cell, placed))),
    }


def _with_table(parts: DataFrame) -> DataFrame:
    """Add name, description, columns and data of the table to its parts.

    The cells come sorted, body before foot, so a row is a slice between two starts."""
    t = parts.selectExpr(
        "*",
        "coalesce(label, cap_title, wrap_id, 'Table') as name",
        "concat(if(size(cap_notes) > 0, cap_notes, array_compact(array(caption))), foot_notes) "
        "as notes",
        "if(n_heads > 0, heads, row_heads) as columns",
        "if(size(cells) > 0, filter(sequence(0, size(cells) - 1), "
        "i -> i = 0 or cells[i].row_at <> get(cells, i - 1).row_at), array()) as starts",
    )
    return t.selectExpr(
        "*",
        "if(size(notes) > 0, array_join(notes, ' '), null) as description",
        "transform(starts, (s, j) -> transform(slice(cells, s + 1, "
        "coalesce(get(starts, j + 1), size(cells)) - s), c -> c.value)) as data",
    )


def _aggregate(rows: DataFrame, aggs: dict[str, Column], *keys) -> DataFrame:
    """Rows are sorted by document already; sorted by all keys, one group is held at a time."""
    rows = rows.sortWithinPartitions(*keys) if len(keys) > 1 else rows
    return rows.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])


# --- operators: front matter -------------------------------------------------------


def _scoped(tokens: DataFrame, body_only: bool = False) -> DataFrame:
    """Accept tokens of whole payloads or of first articles."""
    if "article" in tokens.columns:
        return tokens
    return _scopes(tokens, F.col("qname") == "article", body_only=body_only)


def _front_rows(tokens: DataFrame, *groups) -> DataFrame:
    rows = xml_elements(_scoped(tokens), groups)
    if {"category", "keywords", "abstract"} & set(groups):
        rows = _with_parent(rows)
    rows = _front_columns(rows, groups)
    return rows.withColumn("date_value", _date_value()) if "dates" in groups else rows


def xml_title(tokens: DataFrame) -> DataFrame:
    """(doc_id, value)"""
    t = _aggregate(_front_rows(tokens, "title"), _title_aggs(), "doc_id")
    return t.withColumnRenamed("title", "value")


def xml_ids(tokens: DataFrame) -> DataFrame:
    """(doc_id, pmc_id, pm_id, doi)"""
    return _aggregate(_front_rows(tokens, "ids"), _id_aggs(), "doc_id")


def xml_journal(tokens: DataFrame) -> DataFrame:
    """(doc_id, journal, publisher, issn, volume, issue, f_page, l_page)"""
    t = _aggregate(_front_rows(tokens, "journal"), _journal_aggs(), "doc_id")
    return t.select(
        "doc_id", "journal", "publisher", "issn", "volume", "issue", "f_page", "l_page"
    )


def xml_category(tokens: DataFrame) -> DataFrame:
    """(doc_id, value)"""
    t = _aggregate(_front_rows(tokens, "category"), _category_aggs(), "doc_id")
    return t.withColumnRenamed("category", "value")


def xml_date_candidates(tokens: DataFrame) -> DataFrame:
    """(doc_id, node, source, ts): each candidate node once, under the first rule that
    considers it. Nodes without a usable year are dropped."""
    doc = W.partitionBy("doc_id")
    rows = _front_rows(tokens, "dates").where(_is("date"))

    def first_of(match: Column) -> Column:
        return F.min(F.when(match, F.col("pos"))).over(doc) == F.col("pos")

    kind = F.col("info")
    rows = rows.select(
        "doc_id",
        F.col("pos").alias("node"),
        F.when(F.col("flag"), "history")
        .when(first_of(kind == "epub"), "epub")
        .when(first_of(kind == "ppub"), "ppub")
        .when(first_of(kind == "collection"), "collection")
        .when(first_of(kind.isNotNull()), "any")
        .alias("source"),
        F.col("date_value").alias("ts"),
    )
    return rows.where(F.col("source").isNotNull() & F.col("ts").isNotNull())


def xml_publish_date(candidates: DataFrame) -> DataFrame:
    """(doc_id, publish_date): the earliest candidate."""
    return candidates.groupBy("doc_id").agg(F.min("ts").alias("publish_date"))


def _listed(df: DataFrame, column: str) -> DataFrame:
    return df.select("doc_id", F.posexplode(column).alias("ord", "value")).withColumn(
        "ord", F.col("ord") + 1
    )


def xml_authors(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, value)"""
    return _listed(
        _aggregate(_front_rows(tokens, "authors"), _author_aggs(), "doc_id"), "authors"
    )


def xml_keywords(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, value)"""
    return _listed(
        _aggregate(_front_rows(tokens, "keywords"), _keyword_aggs(), "doc_id"), "keywords"
    )


def xml_abstract(tokens: DataFrame) -> DataFrame:
    """(doc_id, value)"""
    t = _aggregate(_front_rows(tokens, "abstract"), _abstract_aggs(), "doc_id")
    return t.select("doc_id", _abstract_text().alias("value"))


# --- operators: body ---------------------------------------------------------------


def xml_prose_text(tokens: DataFrame, qname: str = "p") -> DataFrame:
    """(doc_id, element, text) of every element of that name in the first article, with
    ignored elements below it left out; element is its token position."""
    t = _scoped(tokens).select(
        "doc_id", "pos", "end_pos", "depth", "is_open", "is_close", "is_selfclosing",
        "text", "hidden",
        F.when(F.col("qname") == qname, "prose").alias("kind"),
        F.lit(True).alias("skip_hidden"),
    )
    found = unit_texts(t, ["prose"], [], [])
    return found.select(
        "doc_id", F.col("pos").alias("element"), normalize_ws(F.col("text")).alias("text")
    )


def _section_rows(tokens: DataFrame) -> DataFrame:
    rows = _body_columns(_with_parent(xml_elements(_scoped(tokens, body_only=True), ("sections",))))
    found = _aggregate(rows, _section_aggs(), "doc_id", "section_no")
    return found.where(F.col("section_text") != "")


def xml_sections(tokens: DataFrame) -> DataFrame:
    """(doc_id, ord, title, text): body sections in order, before keys are given. ``ord``
    rises within a document but may have gaps where blank sections were."""
    return (
        _section_rows(tokens)
        .where(~F.col("is_fallback"))
        .select(
            "doc_id",
            F.col("section_no").alias("ord"),
            F.coalesce("section_title", F.lit("")).alias("title"),
            F.col("section_text").alias("text"),
        )
    )


def xml_full_text_fallback(tokens: DataFrame) -> DataFrame:
    """(doc_id, key, text): the text of a body that has no elements."""
    return (
        _section_rows(tokens)
        .where("is_fallback")
        .select("doc_id", F.lit("full_text").alias("key"), F.col("section_text").alias("text"))
    )


def xml_section_keys(sections: DataFrame) -> DataFrame:
    """(doc_id, ord, title, text) to (doc_id, ord, key, text) with unique keys."""
    listed = sections.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("ord", "title", "text"))).alias("items")
    )
    return listed.select("doc_id", "items", _keys_of("items", "title").alias("keys")).select(
        "doc_id",
        F.posexplode(
            F.arrays_zip("keys", F.transform("items", lambda i: i["text"]).alias("text"))
        ).alias("i", "entry"),
    ).select(
        "doc_id",
        (F.col("i") + 1).alias("ord"),
        F.col("entry.keys").alias("key"),
        sentence_gap(F.col("entry.text")).alias("text"),
    )


def _keys_of(items: str, title: str) -> Column:
    return restart_keys(F.transform(items, lambda i: i[title]))


# --- operators: tables -------------------------------------------------------------


def _tables(tokens: DataFrame) -> DataFrame:
    """One row per table-wrap that has a table: doc_id, table_no, name, description,
    columns, data."""
    rows = _table_columns(xml_elements(_scoped(tokens), ("tables",)))
    rows = rows.where(F.col("wrap").isNotNull()).withColumn("at", F.col("wrap.pos"))
    tables = _with_table(_aggregate(rows, _table_aggs(), "doc_id", "at").where("has_table"))
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("at"))
    return tables.select(
        "doc_id", number.alias("table_no"), "name", "description", "columns", "data"
    )


def xml_tables(tokens: DataFrame) -> DataFrame:
    """(doc_id, table_no, name, description)"""
    return _tables(tokens).select("doc_id", "table_no", "name", "description")


def xml_table_columns(tokens: DataFrame) -> DataFrame:
    """(doc_id, table_no, ord, header): blank headers are dropped."""
    return _tables(tokens).select(
        "doc_id", "table_no", F.posexplode("columns").alias("i", "header")
    ).select("doc_id", "table_no", (F.col("i") + 1).alias("ord"), "header")


def xml_table_rows(tokens: DataFrame) -> DataFrame:
    """(doc_id, table_no, row_no, col_no, cell): body rows, then foot rows; td cells."""
    rows = _tables(tokens).select("doc_id", "table_no", F.posexplode("data").alias("r", "cells"))
    cells = rows.select("doc_id", "table_no", "r", F.posexplode("cells").alias("c", "cell"))
    return cells.select(
        "doc_id",
        "table_no",
        (F.col("r") + 1).alias("row_no"),
        (F.col("c") + 1).alias("col_no"),
        "cell",
    )


def _table_json() -> Column:
    return F.to_json(
        F.struct(
            F.col("name").alias("TableName"),
            F.col("description").alias("Description"),
            F.col("columns").alias("Colmuns"),
            F.col("data").alias("Data"),
        ),
        {"ignoreNullFields": "false"},
    )


def xml_table_json(tokens: DataFrame) -> DataFrame:
    """(doc_id, table_no, name, json)"""
    return _tables(tokens).select("doc_id", "table_no", "name", _table_json().alias("json"))


def _table_key(name: Column) -> Column:
    return F.when(is_blank(name), F.lit("Table")).otherwise(trim_ws(name))


def xml_merge_tables(keyed: DataFrame, table_json: DataFrame) -> DataFrame:
    """Sections (doc_id, ord, key, text) and tables (doc_id, table_no, name, json) to one
    list (doc_id, ord, key, text): tables come last, under their names."""
    no_text = F.lit(None).cast("string")
    both = keyed.select(
        "doc_id", F.lit(0).alias("part"), "ord", F.col("key").alias("name"), "text"
    ).unionByName(
        table_json.select(
            "doc_id",
            F.lit(1).alias("part"),
            F.col("table_no").alias("ord"),
            _table_key(F.col("name")).alias("name"),
            F.coalesce("json", no_text).alias("text"),
        )
    )
    entry = F.struct("part", "ord", "name", "text")
    listed = both.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("items"))

    def names(part: int) -> Column:
        return F.transform(F.filter("items", lambda i: i["part"] == part), lambda i: i["name"])

    keys = restart_keys(names(1), taken=names(0))
    return listed.select("doc_id", keys.alias("keys"), "items").select(
        "doc_id",
        F.posexplode(
            F.arrays_zip("keys", F.transform("items", lambda i: i["text"]).alias("text"))
        ).alias("i", "entry"),
    ).select(
        "doc_id",
        (F.col("i") + 1).alias("ord"),
        F.col("entry.keys").alias("key"),
        F.col("entry.text").alias("text"),
    )


# --- whole records -----------------------------------------------------------------

BODY_KINDS = (*BODY_GROUPS["sections"][0], *BODY_GROUPS["sections"][1])
ARTICLE_COLUMNS = (
    "doc_id", "pmc_id", "pm_id", "doi", "title", "category", "journal", "publisher",
    "volume", "issue", "issn", "f_page", "l_page", "authors", "publish_date",
    "abstract_text", "keywords", "sections",
)


def xml_articles(payloads: DataFrame, tasks: int | None = None) -> DataFrame:
    """(doc_id, payload) to one article record per payload that has an article.

    One pass: tokens are made once, and front matter, body and tables are grouped side
    by side, each under its own key, inside the document partitioning. With ``tasks``, payloads and
    then their elements are dealt to as many tasks."""
    return _records(xml_first_article(xml_tokens(payloads, tasks=tasks)), tasks=tasks)


def xml_article_results(payloads: DataFrame, tasks: int | None = None) -> DataFrame:
    """(doc_id, payload) to one row per payload: the article record of those with an article, for all
    others no more than fault and fault_pos, what is wrong first and the token where it is. The
    same single pass; ``xml_articles`` are the rows without a fault."""
    tokens = xml_tokens(payloads, keep_blank=True, tasks=tasks)
    rows = _records(_scopes(tokens, F.col("qname") == "article", keep_faults=True), {"fault": F.max("fault")}, tasks)
    kept = [F.when(F.col("fault").isNull(), F.col(c)).alias(c) for c in ARTICLE_COLUMNS[1:]]
    return rows.select("doc_id", *kept, F.col("fault.kind").alias("fault"), F.col("fault.pos").alias("fault_pos"))


def _records(scoped: DataFrame, more: dict[str, Column] | None = None, tasks: int | None = None) -> DataFrame:
    """Article records of scoped tokens, with ``more`` aggregates over front matter."""
    more = more or {}
    rows = xml_elements(scoped, tuple(GROUPS), tasks)
    rows = _front_columns(_with_parent(rows), tuple(GROUPS), _above())
    rows = _table_columns(_body_columns(rows)).withColumn("date_value", _date_value())
    slot = F.when(_is(*BODY_KINDS), 1).when(_is(*TABLE_KINDS), 2).otherwise(0)
    at = F.when(slot == 1, F.col("section_no")).when(slot == 2, F.col("wrap.pos"))
    rows = rows.select("*", slot.alias("slot"), at.alias("at"))
    front = (
        _title_aggs() | _id_aggs() | _journal_aggs() | _category_aggs() | _date_aggs()
        | _author_aggs() | _keyword_aggs() | _abstract_aggs() | more
    )
    groups = _with_table(
        _aggregate(rows, front | _section_aggs() | _table_aggs(), "doc_id", "slot", "at")
    )
    section = F.when(
        (F.col("slot") == 1) & (F.col("section_text") != ""),
        F.struct("at", "section_title", "section_text", "is_fallback"),
    )
    table = F.when(
        (F.col("slot") == 2) & F.col("at").isNotNull() & F.col("has_table"),
        F.struct("at", _table_key(F.col("name")).alias("key"), _table_json().alias("json")),
    )
    groups = groups.select(
        "doc_id",
        "slot",
        F.when(F.col("slot") == 0, F.struct(*front)).alias("front"),
        section.alias("section"),
        table.alias("tbl"),
    )
    docs = groups.groupBy("doc_id").agg(
        F.first("front", ignorenulls=True).alias("front"),
        F.sort_array(F.collect_list("section")).alias("found_sections"),
        F.sort_array(F.collect_list("tbl")).alias("found_tables"),
        F.coalesce(F.max(F.col("slot") == 2), F.lit(False)).alias("has_wraps"),
    )
    docs = docs.select("doc_id", "front.*", "found_sections", "found_tables", "has_wraps")
    docs = docs.select("*", _keys_of("found_sections", "section_title").alias("section_keys"))
    docs = docs.select(
        "*",
        restart_keys(
            F.transform("found_tables", lambda t: t["key"]), taken=F.col("section_keys")
        ).alias("all_keys"),
    )
    texts = F.concat(
        F.transform(
            "found_sections",
            lambda s: F.when(s["is_fallback"], s["section_text"]).otherwise(
                sentence_gap(s["section_text"])
            ),
        ),
        F.transform("found_tables", lambda t: t["json"]),
    )
    has_map = (F.size("found_sections") > 0) | F.col("has_wraps")

    def or_null(name: str) -> Column:
        return F.when(F.size(name) > 0, F.col(name)).alias(name)

    return docs.select(
        *ARTICLE_COLUMNS[:13],
        or_null("authors"),
        "publish_date",
        _abstract_text().alias("abstract_text"),
        or_null("keywords"),
        F.when(has_map, F.map_from_arrays("all_keys", texts)).alias("sections"),
        *more,
    )
