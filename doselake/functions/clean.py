"""Null, blank and sentinel rules on single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: sentinels and default members of the data model ---------------
UNKNOWN_MUNICIPALITY = "999999"
UNKNOWN_UF = "XX"
BRAZIL = "10"
NO_INFORMATION = "SEM INFORMACAO"
FOREIGN = "ESTRANGEIRO"
UNKNOWN_RACE = "99"
KNOWN_SEXES = ("F", "M")
# -----------------------------------------------------------------------------------


def is_blank(c: Column) -> Column:
    """True for null and for the empty string; never null itself."""
    return F.coalesce(c == "", F.lit(True))


def known(c: Column, sentinel: str) -> Column:
    """The value, or null where it is the "ignored" sentinel of the source."""
    return F.nullif(c, F.lit(sentinel))


def _has_full_date(c: Column) -> Column:
    """Year, month and day are all there; Spark would also take ``2026`` or ``2026-02``."""
    return F.substring_index(c, "-", 2) != c


def to_date(c: Column) -> Column:
    return F.when(_has_full_date(c), c.try_cast("date"))


def to_timestamp(c: Column) -> Column:
    return F.when(_has_full_date(c), c.try_cast("timestamp"))


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def default(c: Column, member: str = NO_INFORMATION) -> Column:
    return F.coalesce(c, F.lit(member))


def sex(c: Column) -> Column:
    return F.when(c.isin(*KNOWN_SEXES), c).otherwise(NO_INFORMATION)


def composite_key(*parts: Column) -> Column:
    """Parts joined by a dash; null as soon as one part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), part] if pieces else [part]
    return F.concat(*pieces)
