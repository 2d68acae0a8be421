"""JSON texts as they arrive from outside: strict validity and key presence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What Spark's reader would let pass and the format does not.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value; never NULL.

    The text is read as the first of two elements of an array, the second being its own hash. Readers stop
    at the end of the first value they find, but no text can close the array and go on with its hash, and
    one with a comma makes more elements. Repeated keys are valid, the last one counts; the bare
    ``null`` does not count as valid.
    """
    mark = F.xxhash64(text).cast("string")
    read = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>", _STRICT)
    whole = (F.size(read) == 2) & (F.get(read, F.lit(1)) == mark)
    return F.coalesce(whole & (F.trim(text) != "null"), F.lit(False))


def has_keys(text: Column, *names: str) -> Column:
    """Whether an object has all the keys ``names``, null values included.

    Only texts that hold the names, or an escaped letter, are read.
    """
    wanted = F.array(*[F.lit(n) for n in names])
    likely = F.lit(True)
    for name in names:
        likely = likely & text.contains(name)
    likely = likely | text.contains("\\u")
    return F.coalesce(likely & (F.size(F.array_intersect(F.json_object_keys(text), wanted)) == len(names)), F.lit(False))
