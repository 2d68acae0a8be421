"""Small Column helpers for the truthiness rules the inputs were written against."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column] | str) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, a function or the text of a SQL lambda.

    Catalyst shares repeated sub-expressions only within one projection and not inside
    ``when`` branches; binding through a one-element array does it everywhere. Long bodies are
    given as SQL text, which the JVM parses in one call; built from Python one operator at a
    time they cost a good part of a second per use.
    """
    function = F.expr(body) if isinstance(body, str) else None
    bound = F.array(value)
    if function is not None:
        return F.get(F.call_function("transform", bound, function), F.lit(0))
    return F.get(F.transform(bound, lambda v: body(v)), F.lit(0))


def sql_let(name: str, value: str, body: str) -> str:
    """The same inside SQL text: ``body`` may use ``name`` for ``value``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def first_text(*options: Column) -> Column:
    """First option that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def leading_int(c: Column) -> Column:
    """Leading integer of a text (``'12px'`` is 12); NULL when there is none."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def json_truthy(v: Column) -> Column:
    """Truthiness of a VARIANT value: null, false, 0 and ``''`` are false, the rest true."""
    text = F.to_json(v)
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.coalesce(~text.isin("null", "false", '""') & ~zero, F.lit(False))


def lossy_utf8(c: Column) -> Column:
    """Text of a binary column; invalid bytes become U+FFFD."""
    return F.make_valid_utf8(c.cast("string"))


def any_of(tests: Iterable[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out
