"""Names: month from a file name (S5), clean column names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import MONTH_ABBREVIATIONS

# --- fixed values: how a month may be written in a file name, first match wins ------
_YEAR = r"(20\d{2})"
_NUMBER = r"(0[1-9]|1[0-2])"
_ABBREVIATION = "(" + "|".join(MONTH_ABBREVIATIONS) + ")"
_MONTH_PATTERNS = [
    # pattern, group of the year, group of the month
    (_YEAR + r"[-_.]?" + _NUMBER, 1, 2),
    (_NUMBER + r"[-_.]" + _YEAR, 2, 1),
    (_YEAR + r"[-_.]?" + _ABBREVIATION, 1, 2),
    (_ABBREVIATION + r"[-_.]?" + _YEAR, 2, 1),
]
_EMPTY_COLUMN = "coluna"
_DIGIT_PREFIX = "c_"
# ---------------------------------------------------------------------------------------


def file_stem(name: Column) -> Column:
    """File name without its last extension, in lower case."""
    return F.lower(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def month_of(name: Column) -> Column:
    """``YYYY-MM`` found in a file name, or null."""
    stem = file_stem(name)
    numbers = F.create_map(
        *[
            F.lit(v)
            for i, abbreviation in enumerate(MONTH_ABBREVIATIONS, start=1)
            for v in (abbreviation, f"{i:02d}")
        ]
    )
    candidates = []
    for pattern, year_group, month_group in _MONTH_PATTERNS:
        year = F.regexp_extract(stem, pattern, year_group)
        month = F.regexp_extract(stem, pattern, month_group)
        number = F.coalesce(F.element_at(numbers, month), month)
        candidates.append(F.when(year != "", F.concat(year, F.lit("-"), number)))
    return F.coalesce(*candidates)


def clean_names(header: Sequence[str]) -> list[str]:
    """Column names of plain letters, digits and underscores, unique in their order."""
    taken: set[str] = set()
    names = []
    for raw in header:
        plain = unicodedata.normalize("NFKD", raw).encode("ascii", "ignore").decode("ascii")
        words = [w for w in re.split(r"[^0-9A-Za-z]+", plain) if w]
        stem = "_".join(words).lower() or _EMPTY_COLUMN
        if "0" <= stem[0] <= "9":
            stem = _DIGIT_PREFIX + stem
        name, repeat = stem, 1
        while name in taken:
            repeat += 1
            name = f"{stem}_{repeat}"
        taken.add(name)
        names.append(name)
    return names
