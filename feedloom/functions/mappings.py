"""Value mappings by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mappings that exist.
MAPPINGS: dict[str, Mapping[str, object]] = {"GENDER": {"MALE": True, "FEMALE": False}}


def mapped(c: Column, mapping: str | Mapping[str, object]) -> Column:
    """The value ``c`` stands for, NULL for values the mapping lacks."""
    table = MAPPINGS[mapping] if isinstance(mapping, str) else mapping
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
