"""Scalar column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character class that counts as white space, in Java regex form.
WS = r"(?U)\s+"
WS_ENDS = r"(?U)^\s+|\s+$"

# Texts that are dropped from HTML articles.
NEW_TAB = "Open in a new tab"
KEYWORD_LEADS = ("Keywords:", "Abbreviations:")

# The five entities every XML document knows.
XML_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

HTML_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}

ENTITY_PIECES = r"&#?[0-9A-Za-z]+;|&|[^&]+"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def normalize_ws(c: Column) -> Column:
    """Collapse white space runs to one space and trim."""
    return F.trim(F.regexp_replace(c, WS, " "))


def trim_ws(c: Column) -> Column:
    """Trim all Unicode white space, leaving inner runs alone."""
    return F.regexp_replace(c, WS_ENDS, "")


def null_if_blank(c: Column) -> Column:
    return F.nullif(normalize_ws(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (trim_ws(c) == "")


def try_int(c: Column) -> Column:
    """Whole number with optional sign and outer blanks, else null."""
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("int"))


def digits_to_id(c: Column) -> Column:
    """Keep the digits; 0 when nothing usable is left."""
    return F.coalesce(F.regexp_replace(c, r"[^\p{Nd}]", "").try_cast("int"), F.lit(0))


def clamped_date(year: Column, month: Column, day: Column) -> Column:
    """Texts to a timestamp: month into 1..12, day into 1..28, both 1 when unusable."""
    y = try_int(year)
    m = F.least(F.greatest(F.coalesce(try_int(month), F.lit(1)), F.lit(1)), F.lit(12))
    d = F.least(F.greatest(F.coalesce(try_int(day), F.lit(1)), F.lit(1)), F.lit(28))
    zero = F.lit(0)
    return F.when(
        y.between(1, 9999), F.call_function("try_make_timestamp_ntz", y, m, d, zero, zero, zero)
    )


def sentence_gap(c: Column) -> Column:
    """Put the missing space between a full stop and a capital letter."""
    return F.regexp_replace(c, r"\.([A-Z])", ". $1")


def _unescape(c: Column, entities: dict[str, str]) -> Column:
    named = F.create_map(*[F.lit(v) for k, t in entities.items() for v in (f"&{k};", t)])

    def decode_piece(piece: Column) -> Column:
        numeric = piece.rlike(r"^&#([0-9]+|[xX][0-9A-Fa-f]+);$")
        return (
            F.when(numeric, F.coalesce(_reference_text(piece), piece))
            .when(piece.startswith("&"), F.coalesce(F.try_element_at(named, piece), piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(c, F.lit(ENTITY_PIECES), 0)
    decoded = F.array_join(F.transform(pieces, decode_piece), "")
    return F.when(c.contains("&"), decoded).otherwise(c)


def _reference_text(piece: Column) -> Column:
    is_hex = F.lower(F.substring(piece, 3, 1)) == "x"
    hex_digits = F.regexp_extract(piece, "^&#[xX]0*([0-9A-Fa-f]{1,6});$", 1)
    dec_digits = F.regexp_extract(piece, "^&#0*([0-9]{1,7});$", 1)
    code = F.when(is_hex, F.conv(F.nullif(hex_digits, F.lit("")), 16, 10)).otherwise(dec_digits)
    return let(
        code.try_cast("bigint"),
        lambda n: F.when(
            n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF),
            F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
        ),
    )


def xml_unescape(c: Column) -> Column:
    return _unescape(c, XML_ENTITIES)


def html_unescape(c: Column) -> Column:
    """Named and numeric references to characters; unknown ones stay as they are."""
    return _unescape(c, HTML_ENTITIES)


def xml_escape(c: Column) -> Column:
    return F.replace(
        F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )


def strip_texts(c: Column, texts) -> Column:
    for text in texts:
        c = F.replace(c, F.lit(text), F.lit(""))
    return c


def strip_boilerplate(c: Column) -> Column:
    return strip_texts(c, (NEW_TAB, *KEYWORD_LEADS))


def split_keywords(c: Column) -> Column:
    """Split on semicolon and comma, trim, drop blanks."""
    parts = F.transform(F.split(c, "[;,]"), trim_ws)
    return F.filter(parts, lambda x: x != "")


def full_name(given: Column, surname: Column) -> Column:
    """Given name and surname with blanks skipped; null when both are missing."""
    return F.nullif(
        F.concat_ws(" ", null_if_blank(given), null_if_blank(surname)), F.lit("")
    )


def article_url(pmc_id: Column) -> Column:
    return F.concat(
        F.lit("https://pmc.ncbi.nlm.nih.gov/articles/PMC"), pmc_id.cast("string"), F.lit("/")
    )


def efetch_url(pmc_id: Column) -> Column:
    return F.concat(
        F.lit("https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi?db=pmc&id=PMC"),
        pmc_id.cast("string"),
        F.lit("&rettype=xml"),
    )


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


# The date patterns of HTML articles, in the order they are tried.
HTML_DATE_PATTERNS = (
    "yyyy MMM d",
    "yyyy MMMM d",
    "yyyy MMM",
    "yyyy MMMM",
    "yyyy M d",
    "yyyy",
)


def html_date(raw: Column) -> Column:
    """First pattern that fits the whole trimmed text; month names in any case."""
    text = F.initcap(trim_ws(raw))
    tries = [F.try_to_date(text, p) for p in HTML_DATE_PATTERNS]
    fits = text.rlike(r"^[0-9]{4}( [A-Za-z]+( [0-9]{1,2})?| [0-9]{1,2} [0-9]{1,2})?$")
    return F.when(fits, F.coalesce(*tries)).cast("timestamp_ntz")
