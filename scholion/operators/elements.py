"""Element table: the elements a job asks for, each with its own text.

``unit_texts`` and ``listed_texts`` are the only places where tokens become text. They run inside
the document partitioning of the token table; the second is for tokens that are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.operators.tokens import running_sum


def is_opener() -> Column:
    return F.col("is_open") | F.col("is_selfclosing")


def delta(match: Column) -> Column:
    """+1 where a matching element opens, -1 where it closes.

    ``match`` must answer alike on both tags of an element, so it may use names,
    attributes, depth and start_pos, but not pos."""
    return F.when(match & F.col("is_open"), 1).when(match & F.col("is_close"), -1)


def inside(scope: str) -> Column:
    """The element at hand lies below the scope element (a struct column)."""
    return (F.col("start_pos") > F.col(f"{scope}.pos")) & (
        F.col("start_pos") < F.col(f"{scope}.end_pos")
    )


def first_element(match: Column, *more: Column | str) -> Column:
    """First matching element of the document as struct (pos, end_pos, depth, more)."""
    found = F.when(match & is_opener(), F.struct("pos", "end_pos", "depth", *more))
    return F.min(found).over(W.partitionBy("doc_id"))


def unit_texts(
    tokens: DataFrame, units: list[str], markers: list[str], info: list[str], whole: str | None = None
) -> DataFrame:
    """One row per element whose ``kind`` is in ``units`` or ``markers``.

    ``tokens`` must carry ``kind`` (null for other elements), ``hidden`` (how many
    hidden elements are open) and ``skip_hidden`` (whether the unit's text leaves the
    hidden elements below it out). Units may nest: a text then counts for each of
    them. Markers get no text. ``info`` columns are copied from the opening tag. Where the
    info column ``whole`` is set, whole_text is the text with the hidden elements.
    """
    def among(kinds: list[str]) -> str:
        listed = ", ".join(f"'{k}'" for k in kinds)
        return f"coalesce(kind in ({listed}), false)" if kinds else "false"

    is_marker = f"({among(markers)} and (is_open or is_selfclosing))"
    t = tokens.selectExpr("*", f"{among(units)} as is_unit", f"{is_marker} as is_marker")
    t = t.select("*", running_sum(delta(F.col("is_unit"))).alias("open_units"))
    me = ", ".join(["pos", "end_pos", "depth", "kind", "skip_hidden", "hidden", *info])
    t = t.selectExpr(
        "doc_id", "pos", "text", "hidden", "is_marker",
        "is_unit and (is_open or is_selfclosing) as starts",
        "is_unit and is_selfclosing as empty",
        "open_units + if(is_unit and is_selfclosing, 1, 0) as own_level",
        f"struct({me}) as me",
    )
    # No level at all for tokens outside of every unit; level 0 is for markers.
    lowest = "case when text <> '' then 1L when starts then own_level end"
    levels = f"if({lowest} <= own_level, sequence({lowest}, own_level), array())"
    t = t.selectExpr(
        "doc_id", "pos", "text", "hidden", "starts", "empty", "own_level", "me",
        f"explode(concat(if(is_marker, array(0L), array()), {levels})) as level",
    )
    t = t.selectExpr(
        "*",
        "last(case when level = 0 or (starts and level = own_level) then me end, true) over "
        "(partition by doc_id, level order by pos "
        "rows between unbounded preceding and current row) as unit",
    )
    no_text = "level = 0 or (empty and level = own_level)"
    left_out = f"{no_text} or (unit.skip_hidden and hidden > unit.hidden)"
    pieces = {"text": f"if({left_out}, '', text)"}
    if whole:
        pieces["whole_text"] = f"if({no_text} or unit.{whole} is null, '', text)"
    return (
        t.selectExpr("doc_id", "unit", "pos", *(f"{piece} as {name}" for name, piece in pieces.items()))
        .groupBy("doc_id", "unit")
        .agg(*(F.expr(f"listagg({name}, '') within group (order by pos)").alias(name) for name in pieces))
        .select("doc_id", "unit.*", *pieces)
        .drop("skip_hidden", "hidden")
    )


def listed_texts(
    tokens: DataFrame,
    units: list[str],
    markers: list[str],
    info: list[str],
    whole: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The rows of ``unit_texts`` for tokens that know their number ``n`` in the document and, where
    an element opens, that of its end (``end_n``).

    A document's texts are listed once and those of a unit are a stretch of that list, so no token is
    spread over the units around it. Tokens whose text is null are in no unit; all others of a
    document should follow one another, as a stretch is looked for by its numbers if there are gaps.

    With ``tasks``, the elements are dealt to one task more than that, a row for each document. What comes
    after then runs in a stage of its own: a stage should have fewer generated classes than the
    session keeps (100 by default), as all tasks compile the others again.
    """
    def among(kinds: list[str]) -> str:
        listed = ", ".join(f"'{k}'" for k in kinds)
        return f"coalesce(kind in ({listed}), false)" if kinds else "false"

    me = ", ".join(["pos", "end_pos", "depth", "kind", "skip_hidden", "hidden", *info])
    own = f"struct({me}, n, end_n, is_open and {among(units)} as filled)"
    rows = tokens.selectExpr(
        "doc_id",
        "if(text is not null, struct(n, text, hidden), null) as piece",
        f"if((is_open or is_selfclosing) and {among(units + markers)}, {own}, null) as unit",
    )
    docs = rows.groupBy("doc_id").agg(
        F.sort_array(F.collect_list("piece")).alias("pieces"), F.collect_list("unit").alias("units")
    )
    stretch = """case when not u.filled then array()
        when d.whole then slice(d.pieces, cast(u.n - d.pieces[0].n + 1 as int), cast(u.end_n - u.n as int))
        else filter(d.pieces, p -> p.n >= u.n and p.n < u.end_n) end"""
    shown = "if(coalesce(u.skip_hidden, false), filter(ps, p -> p.hidden <= u.hidden), ps)"
    joined = lambda ps: f"array_join(transform({ps}, p -> p.text), '')"
    texts = [f"{joined(shown)} as text"]
    if whole:
        texts.append(f"if(u.{whole} is null, '', {joined('ps')}) as whole_text")
    # The lists are bound once, so that nothing is made again for each unit.
    followed = "coalesce(element_at(pieces, -1).n - pieces[0].n + 1 = size(pieces), false)"
    of_units = f"""transform(array(struct(pieces, if(size(pieces) > 0, {followed}, false) as whole)), d ->
        transform(units, u -> transform(array({stretch}), ps -> struct({", ".join(texts)}))[0]))[0]"""
    found = docs.selectExpr("doc_id", "units", f"{of_units} as texts")
    if tasks is not None:
        # An exchange into the partitions that there are already would be left out.
        found = found.repartition(tasks + 1, "doc_id")
    found = found.selectExpr("doc_id", "inline(arrays_zip(units, texts)) as (unit, found)")
    return found.select("doc_id", "unit.*", "found.*").drop("skip_hidden", "hidden", "n", "end_n", "filled")


def first_text(match: Column, text: Column | None = None) -> Column:
    """Text of the first matching row, as aggregate."""
    text = F.col("text") if text is None else text
    return F.min_by(text, F.when(match, F.col("pos")))


def ordered(match: Column, *fields) -> Column:
    """All matching rows in document order, as aggregate: array<struct<pos, fields...>>."""
    return F.sort_array(F.collect_list(F.when(match, F.struct("pos", *fields))))


def collected(match: Column, value: Column) -> Column:
    """Values of all matching rows in document order, as aggregate."""
    return F.transform(ordered(match, value.alias("value")), lambda v: v["value"])


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
