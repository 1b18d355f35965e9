"""Token table: one row per markup item, together with the text that follows it.

Cost model. The payloads are exchanged once by document id, as compact strings and
before they are exploded; all windows and groupings below then run inside that
partitioning. A document's tokens share one window group, so ``doc_id`` must be a
unique key of the payload row (a path or row id, not an article id that may repeat).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.functions.scalars import xml_unescape

# In XML a quote always opens a value, and no value holds "<".
XML_ATTRIBUTES = r"""[^<>"']*+(?:"[^"<]*+"[^<>"']*+|'[^'<]*+'[^<>"']*+)*+"""
# In HTML a quote counts right after "=" only; an unquoted value ends at white space or ">".
HTML_ATTRIBUTES = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)[^>=]*+)*+"""
COMMENT = r"<!--.*?-->"
CDATA = r"<!\[CDATA\[.*?\]\]>"
INSTRUCTION = r"<\?.*?\?>"
DOCTYPE = r"<![A-Za-z][^\[>]*+(?:\[[^\]]*+\][^>]*+)?>"
# The only capture inside the markup: the name.
NAME = r"</?([A-Za-z_:][^\s/<>]*+)"
XML_TAG = f"{NAME}{XML_ATTRIBUTES}>"
HTML_TAG = f"{NAME}{HTML_ATTRIBUTES}>"
# Text before the first markup item is an item of its own, after a byte order mark.
LEADING = r"\A\x{FEFF}?+(?=\s*+[^<\s])"
# Script and style hold raw text that must not be read as markup.
RAW_ELEMENT = r"<(?i:script)\b[^>]*+>.*?</(?i:script)\s*+>|<(?i:style)\b[^>]*+>.*?</(?i:style)\s*+>"
# Tags come first, as nearly every item is one; script and style must come before them.
XML_MARKUP = f"{XML_TAG}|{COMMENT}|{CDATA}|{INSTRUCTION}|{DOCTYPE}|<|{LEADING}"
HTML_MARKUP = f"{RAW_ELEMENT}|{HTML_TAG}|{COMMENT}|{DOCTYPE}|<"

# How a token breaks well-formedness.
STRAY, ENTITY, NO_END, NO_START, OUTSIDE = (
    "stray <", "unknown entity", "element without end", "end without element", "text outside the root",
)

UNKNOWN_ENTITY = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"

# HTML elements that never have a closing tag.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
)

# HTML elements that an opening tag closes when its own end was left out, each with
# the elements that keep it open from outside: a list inside an item starts items of its own.
IMPLIED_ENDS = (
    (("li",), ("li",), ("ul", "ol", "menu")),
    (("td", "th"), ("td", "th"), ("tr", "table")),
    (("tr",), ("tr", "td", "th"), ("table",)),
    (("thead", "tbody", "tfoot"), ("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    (("dd", "dt"), ("dd", "dt"), ("dl",)),
    (("option",), ("option",), ("select",)),
    ((
        "p", "section", "article", "aside", "header", "footer", "main", "nav", "div",
        "body", "html", "ul", "ol", "dl", "table", "figure", "blockquote", "pre", "form",
        "hr", "h1", "h2", "h3", "h4", "h5", "h6",
    ), ("p",), ("table", "td", "th", "caption", "button", "object")),
)

# Tags that are folded at once. Results are appended to a list of this length, so that time
# grows with the number of tags and not with its square.
FOLD_BLOCK = 256

# Characters of payloads that a task turns into tokens. Whole records hold 65 to 70 bytes for each of
# them in their sorts and windows, and a core of four has some 850 MB where the heap has 6 GB.
TASK_CHARS = 8_000_000
# A smaller task takes less time than it takes to set it up.
LEAST_TASK_CHARS = 1_000_000


def in_doc_order() -> W:
    """Running frame from the start of the document to the current token."""
    return W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)


def before_in_doc() -> W:
    return W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)


def whole_doc() -> W:
    return W.partitionBy("doc_id")


def running_sum(c: Column) -> Column:
    return F.sum(F.coalesce(c, F.lit(0))).over(in_doc_order())


def running_last(c: Column) -> Column:
    return F.last(c, ignorenulls=True).over(in_doc_order())


VALUE = r"""(?:"[^"]*+"|\x27[^\x27]*+\x27|[^\s"\x27][^\s]*+)"""
# One attribute with its value, if it has one.
ATTRIBUTE = rf"[^\s=/]++(?:\s*+=\s*+{VALUE}?+)?+[\s/]*+"


def attr_sql(name: str, html: bool = False) -> str:
    """Raw value of an attribute of the tag at hand, as SQL; null when absent. Whole
    attributes are passed over up to the first of that name, so a value is never read as
    one. HTML names may be in any case."""
    case, there = ("(?i)", "lower(attrs)") if html else ("", "attrs")
    pattern = rf"{case}^[\s/]*+(?:{ATTRIBUTE})*?{name}\s*+=\s*+({VALUE})".replace("\\", "\\\\")
    found = f"nullif(regexp_extract(attrs, '{pattern}', 1), '')"
    bare = r"""if(left(v, 1) in ('"', '\''), substring(v, 2, length(v) - 2), v)"""
    return f"if({there} like '%{name}%', transform(array({found}), v -> {bare})[0], null)"


def attr(name: str, html: bool = False) -> Column:
    return F.expr(attr_sql(name, html))


def tasks_for(payloads: DataFrame, column: str = "payload") -> int:
    """How many tasks to deal payloads to, by one pass over their lengths: none gets much more than
    ``TASK_CHARS``, however many payloads there are, and all cores have work if there is enough."""
    chars = payloads.agg(F.sum(F.length(column))).first()[0] or 0
    cores = payloads.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-chars // TASK_CHARS), min(cores, chars // LEAST_TASK_CHARS))


def markup_tokens(
    payloads: DataFrame,
    mode: str = "xml",
    keep_blank: bool = False,
    tasks: int | None = None,
    counters: dict[str, Column] | None = None,
) -> DataFrame:
    """``(doc_id, payload)`` to tokens.

    Columns: doc_id, pos, is_open, is_close, is_selfclosing, qname, tag (lower-case
    local name), attrs, text (character data up to the next markup item, decoded),
    depth (of the element a tag opens or closes), end_pos (position of the matching
    close tag, on opening and self-closing tags), start_pos (position of the element's
    opening tag, on all tags), bad (the token breaks well-formedness) and, in XML, fault (how it
    does). A closing tag carries the attributes of its opening tag. HTML text is left undecoded.
    ``keep_blank`` gives payloads without any markup or text one token without a tag. ``tasks`` is the
    number of tasks that payloads are dealt to (see ``tasks_for``); the session's if it is not given.
    ``counters`` are running sums over an XML document to add, by name: they follow from a tag's kind
    and name and cost no pass of their own next to the depth. With them come n, the number of the
    token in its document, and end_n, the number of the matching close tag.

    HTML is repaired, not rejected. Every element has an end: where a tag ends it, where a tag
    implies its end (see ``IMPLIED_ENDS``), where an element around it ends, or at the end of
    the page. Ends that no tag marks become closing tokens of their own without text, so the
    tokens of a page are a tree. A closing tag that closes nothing is bad, and no tag.
    """
    parts = _parts(payloads, mode, keep_blank=keep_blank, tasks=tasks)
    return _xml_structure(parts, counters or {}) if mode == "xml" else _html_structure(parts)


def _parts(
    payloads: DataFrame, mode: str, *keys: str, keep_blank: bool = False, tasks: int | None = None
) -> DataFrame:
    """(keys, markup, qname, rest): arrays of markup items, their names and the text after each,
    dealt by the keys (doc_id if none are given). The payload is scanned once per part; that is far cheaper than matching every exploded item
    again. Blank payloads have no items; they are not filtered out first, because a filter would be
    pushed below whatever builds the payload and make Spark build it twice."""
    markup = XML_MARKUP if mode == "xml" else HTML_MARKUP
    pattern = F.lit(f"(?s)({markup})([^<]*+)")
    parts = [
        F.regexp_extract_all("payload", pattern, F.lit(group)).alias(name)
        for group, name in ((1, "markup"), (2, "qname"), (3, "rest"))
    ]
    keys = keys or ("doc_id",)
    dealt = keys if tasks is None else (tasks, *keys)
    found = payloads.select(*keys, "payload").repartition(*dealt).select(*keys, *parts)
    if not keep_blank:
        return found
    names = ("markup", "qname", "rest")
    listed = lambda c: F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.col(c)).otherwise(F.array(F.lit("")))
    return found.select(*keys, *[listed(c).alias(c) for c in names])


def _attrs() -> Column:
    """What a tag holds between its name and its end."""
    tail = F.when(F.col("markup").endswith("/>"), 2).otherwise(1)
    return F.substring(
        F.col("markup"),
        F.length("qname") + 2,
        F.length("markup") - F.length("qname") - 1 - tail,
    )


def _xml_items(items: DataFrame, *keys: str) -> DataFrame:
    """(keys, markup, qname, rest) to XML items with decoded text, kind of tag and the step of the
    depth. ``stray`` names what breaks well-formedness by itself."""
    closes = (F.col("qname") != "") & F.col("markup").startswith("</")
    opens = (F.col("qname") != "") & ~closes
    ends = F.col("markup").endswith("/>")
    # White space in the sense of XML: a no-break space is text.
    shown = F.btrim("rest", F.lit(" \t\r\n")) != ""
    rest = F.when(shown, xml_unescape(F.col("rest"))).otherwise("")
    is_cdata = F.col("markup").startswith("<![CDATA[")
    inner = F.expr("substring(markup, 10, length(markup) - 12)")
    # Text nodes of white space only do not exist in the document model.
    text = F.concat(F.when(is_cdata, inner).otherwise(""), rest)
    unknown = F.col("rest").contains("&") & F.col("rest").rlike(UNKNOWN_ENTITY)
    return items.select(
        *keys,
        (opens & ~ends).alias("is_open"),
        closes.alias("is_close"),
        (opens & ends).alias("is_selfclosing"),
        "qname",
        F.lower(F.substring_index("qname", ":", -1)).alias("tag"),
        F.when(opens, _attrs()).alias("attrs"),
        text.alias("text"),
        F.when(F.col("markup") == "<", STRAY).when(unknown, ENTITY).alias("stray"),
        F.when(opens & ~ends, 1).when(closes, -1).otherwise(0).alias("step"),
    )


def _own_level() -> Column:
    """Depth of the element that a tag opens or closes, from the level after it."""
    return F.col("level") + F.when(F.col("is_close") | F.col("is_selfclosing"), 1).otherwise(0)


def _with_neighbours(items: DataFrame, *keys: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Add nxt, with the columns ``more``, and prv: opening and closing tags of one depth alternate,
    so neighbours are partners."""
    pairable = F.col("is_open") | F.col("is_close")
    w = W.partitionBy(*keys, F.when(pairable, F.col("depth"))).orderBy("pos")
    other = F.when(F.col("is_open"), F.lead(F.struct("pos", "qname", "is_close", *more)).over(w))
    back = F.when(F.col("is_close"), F.lag(F.struct("pos", "qname", "is_open", "attrs")).over(w))
    return items.select("*", other.alias("nxt"), back.alias("prv"))


def _xml_tokens(paired: DataFrame, *more: Column | str) -> DataFrame:
    """Items with level, depth, nxt and prv to the columns of the token table and ``more``."""
    has_end = F.coalesce(F.expr("nxt.is_close and nxt.qname = qname"), F.lit(False))
    has_start = F.coalesce(F.expr("prv.is_open and prv.qname = qname"), F.lit(False))
    unpaired = (
        F.when(F.col("is_open") & ~has_end, NO_END)
        .when(F.col("is_close") & ~has_start, NO_START)
        .when(F.col("level") < 0, NO_START)
        .when((F.col("level") == 0) & (F.col("text") != ""), OUTSIDE)
    )
    fault = F.coalesce("stray", unpaired)
    return paired.select(
        "doc_id",
        "pos",
        "is_open",
        "is_close",
        "is_selfclosing",
        "qname",
        "tag",
        F.coalesce("attrs", "prv.attrs").alias("attrs"),
        "text",
        "depth",
        F.when(F.col("is_selfclosing"), F.col("pos")).otherwise(F.col("nxt.pos")).alias("end_pos"),
        F.when(F.col("is_close"), F.col("prv.pos"))
        .when(F.col("is_open") | F.col("is_selfclosing"), F.col("pos"))
        .alias("start_pos"),
        fault.isNotNull().alias("bad"),
        fault.alias("fault"),
        *more,
    )


def _exploded(parts: DataFrame, *keys: str) -> DataFrame:
    found = F.posexplode(F.arrays_zip("markup", "qname", "rest")).alias("pos", "item")
    return parts.select(*keys, found).select(*keys, "pos", "item.*")


def _xml_structure(parts: DataFrame, counters: dict[str, Column]) -> DataFrame:
    items = _xml_items(_exploded(parts, "doc_id"), "doc_id", "pos")
    if not counters:
        leveled = items.select("*", F.sum("step").over(in_doc_order()).alias("level"))
        return _xml_tokens(_with_neighbours(leveled.withColumn("depth", _own_level()), "doc_id"))
    sums = {"level": F.col("step"), "n": F.lit(1)} | counters
    leveled = items.select("*", *[running_sum(c).alias(name) for name, c in sums.items()])
    paired = _with_neighbours(leveled.withColumn("depth", _own_level()), "doc_id", more=("n",))
    end_n = F.when(F.col("is_selfclosing"), F.col("n")).otherwise(F.col("nxt.n")).alias("end_n")
    return _xml_tokens(paired, "n", end_n, *counters)


# --- very large documents ----------------------------------------------------------

# What may hold "<" without beginning a tag; outside of these a document can be cut at any "<".
SPECIAL = f"{COMMENT}|{CDATA}|{INSTRUCTION}|{DOCTYPE}"
SPECIAL_START = r"<!--|<!\[CDATA\[|<\?|<![A-Za-z]"
# Where comments, character data and instructions end.
SPECIAL_ENDS = {"<!--": "-->", "<![CDATA[": "]]>", "<?": "?>"}


def _ranges(payload: str, size: int) -> str:
    """The payload as an array of ranges of about ``size`` characters, each from one "<" that begins
    an item to the next such. Pieces are cut before any "<"; a fold over them knows whether a
    piece ends inside a comment or the like, and joins it with the next one if so."""
    quoted = lambda pattern: pattern.replace("\\", "\\\\")
    pieces = f"regexp_extract_all({payload}, '(?s).{{1,{size}}}[^<]*+', 0)"
    ended = " ".join(
        f"when '{start}' then if(contains(p, '{end}'), substr(p, locate('{end}', p) + {len(end)}), null)"
        for start, end in SPECIAL_ENDS.items()
    )
    # A document type has no simple end; it is read again together with what follows.
    scanned = f"case s.open when '' then p {ended} else concat(s.held, p) end"
    plain = f"regexp_replace(left_over, '(?s){quoted(SPECIAL)}', ' ')"
    may_start = "contains(left_over, '<!') or contains(left_over, '<?')"
    open_now = f"""case when left_over is null then s.open
        when {may_start} then regexp_extract({plain}, '{quoted(SPECIAL_START)}', 0) else '' end"""
    state = """named_struct('open', open_now, 'held', if(open_now = '', '', concat(s.held, p)),
        'done', if(open_now = '', concat(s.done, array(concat(s.held, p))), s.done))"""
    step = f"transform(array({scanned}), left_over -> transform(array({open_now}), open_now -> {state})[0])[0]"
    start = "named_struct('open', '', 'held', '', 'done', cast(array() as array<string>))"
    return f"aggregate({pieces}, {start}, (s, p) -> {step}, s -> if(s.held = '', s.done, concat(s.done, array(s.held))))"


def large_markup_tokens(payloads: DataFrame, range_size: int = 1 << 20) -> DataFrame:
    """``markup_tokens`` of XML payloads of which a single one is too much for a task.

    A payload is cut into ranges in the task that reads it, by one scan; ranges are then dealt by
    document *and* range, and no window, group or join holds more than a range's tokens of a
    document. A range's positions and levels are running sums inside it plus the sum over all
    ranges before, from a table of one row per range. Of the tags of one depth that a range holds
    only the first can have its partner before and only the last after the range; those few are
    paired among themselves. The rows equal those of ``markup_tokens``; a null or blank payload
    has none. A comment or character data longer than a range makes its range as long.
    """
    here = ("doc_id", "range")
    cut = payloads.select("doc_id", F.posexplode(F.expr(_ranges("payload", range_size))).alias("range", "payload"))
    parts = _parts(cut, "xml", *here)
    local = _xml_items(_exploded(parts, *here), *here, "pos")
    in_range = W.partitionBy(*here).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    local = local.select("*", F.sum("step").over(in_range).alias("level"))
    local = _with_neighbours(local.withColumn("depth", _own_level()), *here)

    earlier = W.partitionBy("doc_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    bases = (
        local.groupBy(*here)
        .agg(F.count("*").alias("n"), F.sum("step").alias("rise"))
        .select(*here, before("n").cast("int").alias("base_pos"), before("rise").alias("base_level"))
    )
    alone = (F.col("is_open") & F.col("nxt").isNull()) | (F.col("is_close") & F.col("prv").isNull())
    few = local.where(alone).select(*here, "pos", "depth", "qname", "is_open", "is_close", "attrs").join(bases, [*here])
    few = few.select(
        *here,
        F.col("pos").alias("at"),
        (F.col("pos") + F.col("base_pos")).alias("pos"),
        (F.col("depth") + F.col("base_level")).alias("depth"),
        "qname", "is_open", "is_close", "attrs",
    )
    met = _with_neighbours(few, "doc_id").groupBy(*here).agg(F.collect_list(F.struct("at", "nxt", "prv")).alias("met"))
    carried = bases.join(met, [*here], "left")
    # One row per range meets the range's tokens, where they already are.
    far = "filter(met, m -> m.at = pos)[0]"
    moved = local.join(carried, [*here]).selectExpr(
        "*",
        f"if(is_open and nxt is null, {far}.nxt, named_struct('pos', nxt.pos + base_pos, 'qname', nxt.qname, 'is_close', nxt.is_close)) as far_nxt",
        f"""if(is_close and prv is null, {far}.prv,
            named_struct('pos', prv.pos + base_pos, 'qname', prv.qname, 'is_open', prv.is_open, 'attrs', prv.attrs)) as far_prv""",
    )
    return _xml_tokens(
        moved.selectExpr(
            "* except (pos, level, depth, nxt, prv, far_nxt, far_prv, met, base_pos, base_level)",
            "pos + base_pos as pos", "level + base_level as level", "depth + base_level as depth",
            "far_nxt as nxt", "far_prv as prv",
        )
    )


# --- HTML --------------------------------------------------------------------------

# What an entry of the repaired page is.
NO_TAG, OPEN, SELFCLOSING, CLOSE, IMPLIED_CLOSE = range(5)

ENTRY = "array<struct<pos:int, kind:int, src:int, own:int, other:int, depth:int>>"


def _listed(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _nearest(names) -> str:
    """Place of the innermost open element of these names, from 1; 0 if none is open."""
    if len(names) == 1:
        return f"array_position(s.names, '{names[0]}')"
    places = f"transform(array({_listed(names)}), n -> array_position(s.names, n))"
    return f"coalesce(array_min(filter({places}, x -> x > 0)), 0)"


def _outermost_before(closed, keepers) -> str:
    """How many open elements end: up to the outermost of the closed names that lies inside all
    keepers."""
    inner = f"if({_nearest(keepers)} = 0, s.names, slice(s.names, 1, cast({_nearest(keepers)} as int) - 1))"
    if len(closed) == 1:
        # one of a kind is open at most, as each new one ends the one before
        return f"array_position({inner}, '{closed[0]}')"
    within = f"transform({inner}, (n, i) -> if(n in ({_listed(closed)}), i + 1, 0))"
    return f"coalesce(array_max({within}), 0)"


def _entry(pos: str, kind: int, src: str, own: str, other: str, depth: str) -> str:
    return (
        f"named_struct('pos', cast({pos} as int), 'kind', {kind}, 'src', cast({src} as int), "
        f"'own', cast({own} as int), 'other', cast({other} as int), 'depth', cast({depth} as int))"
    )


def _ended(count: str, size: str) -> str:
    """Entries of the innermost ``count`` open elements that end here without a tag: a closing
    token for each, from the inside out, and their opening tags, which were kept until now."""
    ended = f"slice(s.opened, 1, cast({count} as int))"
    closes = f"transform({ended}, (o, j) -> {_entry('s.n + j', IMPLIED_CLOSE, '-1', 'o.src', 'o.pos', f'{size} - j')})"
    opens = f"transform({ended}, (o, j) -> {_entry('o.pos', OPEN, 'o.src', 'o.src', 's.n + j', f'{size} - j')})"
    return f"concat({closes}, {opens})"


def _fold_step() -> str:
    """The state after tag ``t`` (i, kind, name). ``s`` holds n (the next position), names and
    opened (open elements, innermost first) and done (entries)."""
    implied = " ".join(
        f"when t.kind < {CLOSE} and t.name in ({_listed(tags)}) then {_outermost_before(closed, keepers)}"
        for tags, closed, keepers in IMPLIED_ENDS
    )
    ends = f"case when t.kind = {CLOSE} then array_position(s.names, t.name) when t.kind = {NO_TAG} then 0 {implied} else 0 end"
    size = "size(s.opened)"
    # at closing tags the last element ends by a tag of its own
    silent = f"if(t.kind = {CLOSE} and p > 0, p - 1, p)"
    match = "element_at(s.opened, cast(p as int))"
    here = f"s.n + {silent}"
    own = f"""case
        when t.kind = {OPEN} then array()
        when t.kind = {SELFCLOSING} then array({_entry(here, SELFCLOSING, 't.i', 't.i', here, f'{size} - p + 1')})
        when t.kind = {CLOSE} and p > 0 then array(
            {_entry(here, CLOSE, 't.i', f'{match}.src', f'{match}.pos', f'{size} - p + 1')},
            {_entry(f'{match}.pos', OPEN, f'{match}.src', f'{match}.src', here, f'{size} - p + 1')})
        else array({_entry(here, NO_TAG, 't.i', '-1', 'null', size)}) end"""
    left = "slice(s.{0}, cast(p as int) + 1, size(s.opened))"
    pushed = f"array(named_struct('pos', cast({here} as int), 'src', t.i))"
    state = f"""named_struct(
        'n', cast({here} + 1 as int),
        'names', case when t.kind = {OPEN} then concat(array(t.name), {left.format('names')})
                      when p > 0 then {left.format('names')} else s.names end,
        'opened', case when t.kind = {OPEN} then concat({pushed}, {left.format('opened')})
                       when p > 0 then {left.format('opened')} else s.opened end,
        'done', concat(s.done, if({silent} > 0, {_ended(silent, size)}, cast(array() as {ENTRY})), cast({own} as {ENTRY})))"""
    return f"transform(array({ends}), p -> {state})[0]"


def _tree() -> str:
    """Entries of the page ``d`` (m, q: markup and names) in the order of the repaired page."""
    kind = (
        f"case when q = '' then {NO_TAG} when startswith(d.m[i], '</') then {CLOSE} "
        f"when endswith(d.m[i], '/>') or lower(substring_index(q, ':', -1)) in ({_listed(VOID_TAGS)}) then {SELFCLOSING} else {OPEN} end"
    )
    tags = f"transform(d.q, (q, i) -> named_struct('i', i, 'kind', {kind}, 'name', lower(substring_index(q, ':', -1))))"
    blocks = f"transform(sequence(0, size(d.q) div {FOLD_BLOCK}), b -> slice(tags, cast(b as int) * {FOLD_BLOCK} + 1, {FOLD_BLOCK}))"
    names, opened = "cast(array() as array<string>)", "cast(array() as array<struct<pos:int, src:int>>)"
    inner = f"""aggregate(block, named_struct('n', g.n, 'names', g.names, 'opened', g.opened, 'done', cast(array() as {ENTRY})),
        (s, t) -> {_fold_step()})"""
    folded = f"""aggregate({blocks},
        named_struct('n', 0, 'names', {names}, 'opened', {opened}, 'done', cast(array() as array<{ENTRY}>)),
        (g, block) -> transform(array({inner}), r -> named_struct(
            'n', r.n, 'names', r.names, 'opened', r.opened, 'done', concat(g.done, array(r.done))))[0],
        s -> concat(flatten(s.done), {_ended('size(s.opened)', 'size(s.opened)')}))"""
    return f"sort_array(transform(array({tags}), tags -> {folded})[0])"


def _html_structure(parts: DataFrame) -> DataFrame:
    """The page as a tree, by a fold over its tags that keeps the open elements. The arrays are
    bound once, so that no lambda holds the scan of the payload."""
    shown = """transform(entries, e -> named_struct('pos', e.pos, 'kind', e.kind, 'other', e.other, 'depth', e.depth,
        'qname', get(d.q, if(e.own >= 0, e.own, e.src)), 'markup', get(d.m, if(e.own >= 0, e.own, e.src)),
        'rest', if(e.src >= 0, get(d.r, e.src), '')))"""
    rows = f"""transform(array(named_struct('m', markup, 'q', qname, 'r', rest)), d ->
        transform(array({_tree()}), entries -> {shown})[0])[0]"""
    t = parts.select("doc_id", F.explode(F.expr(rows)).alias("e")).select("doc_id", "e.*")
    is_tag = F.col("kind") != NO_TAG
    opens = F.col("kind").isin(OPEN, SELFCLOSING)
    stray = (F.col("markup") == "<") | ((F.col("kind") == NO_TAG) & (F.col("qname") != ""))
    return t.select(
        "doc_id",
        "pos",
        (F.col("kind") == OPEN).alias("is_open"),
        F.col("kind").isin(CLOSE, IMPLIED_CLOSE).alias("is_close"),
        (F.col("kind") == SELFCLOSING).alias("is_selfclosing"),
        "qname",
        F.when(is_tag, F.lower(F.substring_index("qname", ":", -1))).otherwise("").alias("tag"),
        F.when(is_tag, _attrs()).alias("attrs"),
        F.when(F.col("markup") == "<", F.concat("markup", "rest")).otherwise(F.col("rest")).alias("text"),
        F.col("depth").cast("long").alias("depth"),
        F.when(opens, F.col("other")).alias("end_pos"),
        F.when(opens, F.col("pos")).when(is_tag, F.col("other")).alias("start_pos"),
        stray.alias("bad"),
    )
