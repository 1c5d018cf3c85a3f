"""Small helpers for building column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A plain reuse of the Python variable would repeat the expression, and the optimizer may inline a
    projected column into a lambda that refers to it, which evaluates it once per array element.
    """
    return F.transform(F.array(value), body)[0]


def any_of(words: Iterable[str]) -> str:
    """Regex alternation that matches any of the literal words."""
    return "(?:" + "|".join(re.escape(w).replace(r"\-", "-") for w in words) + ")"


def empty_array(of: str) -> Column:
    return F.array().cast(f"array<{of}>")


# Characters that count as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def capitalized(text: Column) -> Column:
    return F.concat(F.upper(cut(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def cut(text: Column, start: Column | int, length: Column | int) -> Column:
    """``substring`` that accepts columns and integers alike."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.substring(text, as_col(start), as_col(length))


RUN = 64  # elements that a fold gathers before they are joined to the rest, as it copies what it has gathered


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``step``, for which 0 changes nothing, over an array of whole numbers.

    Runs of fixed length are folded one by one, then their last results, which then go into all results of the next
    run. That takes about linear time, as no fold copies more than one run or one result for each run.
    """

    def folded(items: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("last"), empty_array("bigint").alias("out"))

        def add(acc: Column, v: Column) -> Column:
            return bind(step(acc["last"], v), lambda x: F.struct(x.alias("last"), F.array_append(acc["out"], x).alias("out")))

        return F.aggregate(items, start, add, lambda acc: acc["out"])

    def of(items: Column) -> Column:
        last_run = F.greatest(F.ceil(F.size(items) / RUN).cast("int") - 1, F.lit(0))
        runs = F.transform(F.sequence(F.lit(0), last_run), lambda r: folded(F.slice(items, r * RUN + 1, F.lit(RUN))))

        def after(run: Column, i: Column, ends: Column) -> Column:
            return F.when(i == 0, run).otherwise(F.transform(run, lambda x: step(F.get(ends, i - 1), x)))

        def joined(own: Column) -> Column:
            ends = folded(F.transform(own, lambda r: F.get(r, F.size(r) - 1)))
            return bind(ends, lambda e: F.flatten(F.transform(own, lambda r, i: after(r, i, e))))

        return F.when(F.size(items) <= RUN, folded(items)).otherwise(bind(runs, joined))

    return bind(values, of)


_BUILT: dict = {}


def on_columns(build: Callable[..., Column], *names: str, **options) -> Column:
    """``build`` applied to named columns, built once per session.

    The larger expressions consist of thousands of nodes, and making each is a call into the JVM. As they
    refer to columns by name only, one copy serves every DataFrame.
    """
    from pyspark import SparkContext

    key = (build, names, tuple(sorted(options.items())), id(SparkContext._jvm))
    if key not in _BUILT:
        _BUILT[key] = build(*[F.col(n) for n in names], **options)
    return _BUILT[key]
