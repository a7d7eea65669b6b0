"""Calendar columns (P16 and the date parts of the month dimension)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: month names shown in reports, and the file-name abbreviations --
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
MONTH_ABBREVIATIONS = [
    "jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez",
]
# -----------------------------------------------------------------------------------


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_name(month_number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), month_number.cast("int"))
