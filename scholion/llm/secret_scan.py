"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From its parse tree a Boolean query over trigrams is derived
that every match must satisfy. The index holds a posting (trigram, text) for the trigrams that
some query asks for; a text is a candidate of a rule if its postings satisfy the rule's query,
and only candidates are matched against the rule. A rule without mandatory trigrams has no query
and is matched against every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and without overlap, whose group `group` has at least
    `least` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The three kinds of the contract, then public token formats. A run of one class
# of characters is whole or not a match, so its least length stands in the pattern.
ASSIGN = Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2)
ACCESS = Rule("access", r"AKIA[A-Z0-9]{14,}")
HEX = Rule("hex", r"[0-9a-f]{16,}")
BASE = (ASSIGN, ACCESS, HEX)
MORE = (
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}"),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]{50,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
)
RULES = BASE + MORE

# ------------------------------------------------- trigram queries from patterns

#: True: anything satisfies it. Otherwise a trigram, or ("and" | "or", parts).
Query = bool | str | tuple

#: A piece of a pattern is spelled out while it has at most so many spellings.
SPELLINGS = 40


def _all(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list[Query]) -> Query:
    if any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _grams(spellings: list[str]) -> Query:
    """Any spelling's trigrams; a spelling whose trigrams hold another's adds nothing."""
    grams = sorted({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in spellings}, key=lambda g: (len(g), sorted(g)))
    least = [g for i, g in enumerate(grams) if not any(h <= g for h in grams[:i])]
    return _any([_all(sorted(g)) for g in least])


def _pieces(node) -> list[list[str] | Query | None]:
    """A parsed sequence as pieces: lists of spellings that may be joined with their neighbours,
    queries that hold on their own, and None where anything may stand. All in lower case."""
    import re._constants as c

    out: list = []
    for op, arg in node:
        if op is c.LITERAL:
            out.append([chr(arg).lower()])
        elif op is c.IN and all(o is c.LITERAL for o, _ in arg):
            out.append(sorted({chr(a).lower() for _, a in arg}))
        elif op is c.SUBPATTERN:
            out += _pieces(arg[-1])
        elif op is c.BRANCH:
            options = [_pieces(x) for x in arg[1]]
            words = [_spelled(x) for x in options]
            if all(w is not None for w in words):
                out.append(sorted({s for w in words for s in w}))
            else:
                out += [None, _any([_query(x) for x in options]), None]
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, body = arg
            inner = _pieces(body)
            word = _spelled(inner)
            if word is not None and (low, high) == (0, 1):
                out.append(sorted({"", *word}))
            elif word is not None and low == high and len(word) ** low <= SPELLINGS:
                out += [word] * low
            else:
                out += [None, _query(inner) if low else True, None]
        elif op is not c.AT:
            out.append(None)
    return out


def _spelled(pieces) -> list[str] | None:
    """All spellings of a sequence, if they are known and few."""
    words = [""]
    for piece in pieces:
        if not isinstance(piece, list) or len(words) * len(piece) > SPELLINGS:
            return None
        words = [w + p for w in words for p in piece]
    return words


def _query(pieces) -> Query:
    parts, words = [], [""]
    for piece in [*pieces, None]:
        if isinstance(piece, list) and len(words) * len(piece) <= SPELLINGS:
            words = [w + p for w in words for p in piece]
            continue
        parts.append(_grams(words))
        words = piece if isinstance(piece, list) else [""]
        if not isinstance(piece, list) and piece is not None:
            parts.append(piece)
    return _all(parts)


def trigram_query(pattern: str) -> Query:
    """What the trigrams of the lower-cased text must satisfy if the (ASCII) pattern matches."""
    import re._parser

    return _query(_pieces(re._parser.parse(pattern)))


def trigrams_of(query: Query) -> list[str]:
    if query is True:
        return []
    if isinstance(query, str):
        return [query]
    return sorted({t for part in query[1] for t in trigrams_of(part)})


def _holds(query: Query, postings: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(postings, query)
    parts = [_holds(p, postings) for p in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


# ------------------------------------------------- index and matching


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (key, trigram) of the distinct texts, for the given trigrams."""
    text = text_or_empty()
    # the text is lowered once, whatever the number of trigrams
    found = F.transform(
        F.array(F.lower(text)), lambda low: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(low, t))
    )[0]
    return docs.select(text_key(text).alias("key"), F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key -> the kinds of rules whose queries its postings satisfy; only texts with any."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}
    postings = (
        trigram_index(docs, sorted({t for q in indexed.values() for t in trigrams_of(q)}))
        .groupBy("key")
        .agg(F.collect_set("trigram").alias("postings"))  # as many as the queries name, at most
    )
    kinds = F.array_compact(F.array(*(F.when(_holds(q, F.col("postings")), F.lit(k)) for k, q in indexed.items())))
    return postings.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


#: Elements of an array that one fold goes over, and characters of a piece of text.
FOLD = 256
PIECE = 512


def _once(value: Column, body) -> Column:
    """body(value), with the value computed once whatever the uses."""
    return F.transform(F.array(value), body)[0]


def _running(numbers: Column, join) -> Column:
    """Each number joined with all before it, for join = sum or greatest. Folds that append copy
    what they have, so they go over blocks, and the blocks' last values over each other."""

    def fold(part, last):
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        step = lambda s, v: _once(
            join(s["at"], last(v)), lambda at: F.struct(at.alias("at"), F.array_append(s["all"], at).alias("all"))
        )
        return F.aggregate(part, zero, step, lambda s: s["all"])

    def of_blocks(blocks):
        # a block's offset is the running value at the end of the block before
        ends = F.concat(F.array(F.lit(0)), fold(blocks, lambda b: F.element_at(b, -1)))
        return F.flatten(F.zip_with(blocks, F.slice(ends, 1, F.size(blocks)), lambda b, at: F.transform(b, lambda v: join(v, at))))

    def of_numbers(all_numbers):
        n = F.size(all_numbers)
        cut = lambda i: fold(F.slice(all_numbers, i * FOLD + 1, FOLD), lambda v: v)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / FOLD).cast("int")), cut)
        return F.when(n > 0, _once(blocks, of_blocks)).otherwise(F.array().cast("array<int>"))

    return _once(numbers, of_numbers)


def rule_spans(text: str, rule: Rule, rank: int) -> Column:
    """array of struct(start, rank, end, kind) in code points, from the lengths of the pieces
    between the matches; in time near to the number of matches."""
    quoted = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    matches = f"transform(regexp_extract_all({text}, '{quoted}', 0), m -> struct(length(m) as m, length(m) as g))"
    if rule.group:
        groups = f"regexp_extract_all({text}, '{quoted}', {rule.group})"
        matches = f"zip_with(regexp_extract_all({text}, '{quoted}', 0), {groups}, (m, g) -> struct(length(m) as m, length(g) as g))"
    # the last piece has no match after it
    found = F.expr(
        f"""filter(
            zip_with(split({text}, '{quoted}', -1), {matches}, (p, x) -> struct(length(p) + x.m as step, x.m as m, x.g as g)),
            x -> x.m is not null)"""
    )

    def placed(x):
        spans = F.zip_with(
            x,
            _running(F.transform(x, lambda v: v["step"]), lambda a, b: a + b),
            lambda v, end: F.struct(
                (end - v["m"]).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"), v["g"].alias("g")
            ),
        )
        kept = F.filter(spans, lambda s: s["g"] >= rule.least) if rule.least else spans
        return F.transform(kept, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))

    return _once(found, placed)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs with `spans`: array of (start, rank, end, kind), sorted by start and then
    in the order of the rules; code points, end exclusive.

    Null texts count as empty. Equal texts share their postings. Texts are read twice: once for
    the index, once to match. Candidates are found by the texts' 128-bit keys, broadcast while
    their table is small and joined by a shuffle beyond. A column named spans, if there is one,
    is replaced. Texts may be of any length; nothing is cut.
    """
    found = written(candidates(docs, rules))
    text = F.coalesce("text", F.lit("")).alias("__text")
    keyed = docs.drop("spans").select("*", text).withColumn("__key", text_key(F.col("__text")))
    joined = keyed.join(
        broadcast_if_small(found.select(F.col("key").alias("__key"), F.col("kinds").alias("__kinds"))), "__key", "left"
    )
    parts = []
    for rank, rule in enumerate(rules):
        holds = F.col("__text").rlike(rule.pattern)
        if trigram_query(rule.pattern) is not True:
            holds = F.array_contains("__kinds", rule.kind) & holds
        spans = F.when(holds, rule_spans("__text", rule, rank))
        parts.append(F.coalesce(spans, F.expr(f"cast(array() as {SPANS})")))
    return joined.withColumn("spans", F.sort_array(F.concat(*parts))).drop("__key", "__text", "__kinds")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Rows of scan_secrets with every span, and what overlaps it, replaced by the mark. The text
    is cut into pieces once, so that what stands between two spans is found in a few of them."""

    def between(pieces, start, end):
        """The text from start to end, empty if they are the wrong way round."""
        first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.when(end > start, F.substring(some, start % PIECE + 1, end - start)).otherwise(F.lit(""))

    def marked(covered):
        """covered: the pieces, and each span with the end of all spans up to it and before it."""
        pieces, spans = covered["pieces"], covered["spans"]
        out = F.transform(
            spans, lambda s: F.when(s["start"] >= s["before"], F.concat(between(pieces, s["before"], s["start"]), F.lit(mark))).otherwise("")
        )
        return F.concat(F.array_join(out, ""), between(pieces, F.element_at(spans, -1)["upto"], F.length("text")))

    ends = _running(F.transform("spans", lambda s: s["end"]), F.greatest)
    spans = _once(
        ends,
        lambda e: F.zip_with(
            F.zip_with("spans", e, lambda s, upto: F.struct(s["start"].alias("start"), upto.alias("upto"))),
            F.concat(F.array(F.lit(0)), F.slice(e, 1, F.size(e) - 1)),
            lambda s, before: F.struct(s["start"].alias("start"), s["upto"].alias("upto"), before.alias("before")),
        ),
    )
    pieces = F.expr(f"regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0)")
    clean = _once(F.struct(pieces.alias("pieces"), spans.alias("spans")), marked)
    return scanned.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
