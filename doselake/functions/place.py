"""Where a dose counts: residence first, place of application as the fallback.

The rules first settle *which* of the two places is used (``origin``), and only
then read code and state from it. The origin stays available as a column, so the
share of records on each path can be reported (P4-P6, Q10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import clean

NO_COUNTRY = "SEM_PAIS"
ABROAD = "EXTERIOR"
APPLICATION = "APLICACAO"
RESIDENCE = "RESIDENCIA"


def origin(country: Column, home_municipality: Column) -> Column:
    """One of the four paths; the country is judged before the municipality."""
    unknown_home = clean.is_blank(clean.known(home_municipality, clean.UNKNOWN_MUNICIPALITY))
    return (
        F.when(clean.is_blank(country), NO_COUNTRY)
        .when(country != clean.BRAZIL, ABROAD)
        .when(unknown_home, APPLICATION)
        .otherwise(RESIDENCE)
    )


def _of_place(path: Column, home: Column, applied: Column, sentinel: str) -> Column:
    chosen = F.when(path == RESIDENCE, home).when(path == APPLICATION, applied)
    return clean.known(chosen, sentinel)


def municipality(path: Column, home: Column, applied: Column) -> Column:
    return _of_place(path, home, applied, clean.UNKNOWN_MUNICIPALITY)


def direct_uf(path: Column, home: Column, applied: Column) -> Column:
    """The state as the source spells it. An empty text stays an empty text."""
    return _of_place(path, home, applied, clean.UNKNOWN_UF)


def coverage_uf(path: Column, direct: Column, from_code: Column) -> Column:
    return (
        F.when(path == NO_COUNTRY, clean.NO_INFORMATION)
        .when(path == ABROAD, clean.FOREIGN)
        .otherwise(F.coalesce(direct, from_code, F.lit(clean.NO_INFORMATION)))
    )


def uf_prefix(municipality_code: Column) -> Column:
    return F.substring(municipality_code, 1, 2)


def natural_key(municipality_code: Column, uf: Column) -> Column:
    """Municipality code, or the state / special member where there is none."""
    return F.coalesce(municipality_code, uf)
