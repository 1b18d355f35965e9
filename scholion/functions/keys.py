"""Section keys: a fold over the ordered sections of one document.

Items are ``array<struct<title, text, ...>>`` in document order. The folds hold the
list of keys given so far and one counter, so they work inside the row and need no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholion.functions.scalars import is_blank, let


def no_keys() -> Column:
    return F.array().cast("array<string>")


def _suffixed(base: Column, n: Column) -> Column:
    return F.concat(base, F.lit("_"), n.cast("string"))


def _first_free(keys: Column, base: Column, start: Column) -> Column:
    """Smallest n >= start whose suffixed key is free. The start is nearly always free;
    only then are further numbers looked at."""
    later = F.filter(
        F.sequence(start + 1, start + F.size(keys) + 1),
        lambda n: ~F.array_contains(keys, _suffixed(base, n)),
    )
    return F.when(~F.array_contains(keys, _suffixed(base, start)), start).otherwise(later[0])


def _append(items: Column, value: Column) -> Column:
    return F.concat(items, F.array(value))


def _state(keys: Column, n: Column) -> Column:
    return F.struct(keys.alias("keys"), n.cast("int").alias("n"))


def _base(title: Column, n: Column) -> Column:
    """Key before clash handling, and the counter after it."""
    blank = is_blank(title)
    return F.struct(
        F.when(blank, F.concat(F.lit("section_"), n.cast("string")))
        .otherwise(title)
        .alias("key"),
        (n + F.when(blank, 1).otherwise(0)).alias("n"),
    )


def restart_keys(titles: Column, taken: Column | None = None) -> Column:
    """Keys for ``titles``; a clash restarts from the plain title (``T``, ``T_1``, ``T_2``).

    ``taken`` are keys in use before the first title; they stay at the head of the
    result. The counter starts at 1 in either case.
    """
    start = _state(no_keys() if taken is None else taken, F.lit(1))

    def step(acc: Column, title: Column) -> Column:
        def place(base: Column) -> Column:
            clash = let(
                _first_free(acc["keys"], base["key"], base["n"]),
                lambda n: _state(_append(acc["keys"], _suffixed(base["key"], n)), n + 1),
            )
            fresh = _state(_append(acc["keys"], base["key"]), base["n"])
            return F.when(F.array_contains(acc["keys"], base["key"]), clash).otherwise(fresh)

        return let(_base(title, acc["n"]), place)

    return F.aggregate(titles, start, step, lambda acc: acc["keys"])


def _grown(keys: Column, base: Column) -> Column:
    """Free key where each clash adds its number to the key already tried."""

    def grow(b: Column) -> Column:
        return F.struct(_suffixed(b["key"], b["n"]).alias("key"), (b["n"] + 1).alias("n"))

    def until_free(b: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(keys)),
            b,
            lambda a, _: F.when(F.array_contains(keys, a["key"]), grow(a)).otherwise(a),
        )

    once = let(
        grow(base),
        lambda b: F.when(F.array_contains(keys, b["key"]), until_free(b)).otherwise(b),
    )
    return F.when(F.array_contains(keys, base["key"]), once).otherwise(base)


def growing_keys(items: Column) -> Column:
    """Keys for ``array<struct<title, scope>>`` where a clash keeps growing (``T_1_2``).

    Scope 0 is the article body and sees every key given so far. Any other scope is
    one child section and sees only its own keys.
    """
    start = F.struct(
        no_keys().alias("all"),
        no_keys().alias("child"),
        F.lit(0).cast("int").alias("scope"),
        F.lit(1).cast("int").alias("n"),
        no_keys().alias("out"),
    )

    def step(acc: Column, item: Column) -> Column:
        top = item["scope"] == 0
        mine = F.when(item["scope"] == acc["scope"], acc["child"]).otherwise(no_keys())

        def place(seen: Column) -> Column:
            return let(
                let(_base(item["title"], acc["n"]), lambda b: _grown(seen["keys"], b)),
                lambda k: F.struct(
                    F.when(F.array_contains(acc["all"], k["key"]), acc["all"])
                    .otherwise(_append(acc["all"], k["key"]))
                    .alias("all"),
                    F.when(top, no_keys())
                    .otherwise(_append(seen["keys"], k["key"]))
                    .alias("child"),
                    item["scope"].cast("int").alias("scope"),
                    k["n"].cast("int").alias("n"),
                    _append(acc["out"], k["key"]).alias("out"),
                ),
            )

        return let(F.struct(F.when(top, acc["all"]).otherwise(mine).alias("keys")), place)

    return F.aggregate(items, start, step, lambda acc: acc["out"])


def last_wins(entries: Column) -> Column:
    """One entry per key of ``array<struct<key, text>>``: the place of the first, the text
    of the last."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    merged = F.transform(
        keys,
        lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1),
    )
    return F.when(F.size(keys) == F.size(entries), entries).otherwise(merged)
