"""Column-level cleaning rules. All are built-in expressions that stay in codegen.

Text that cannot be read becomes null whatever the session's ANSI setting, so
one dirty value never fails a job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Control characters that no list of loans holds.
ENTRY_START, ENTRY_END = "\x01", "\x02"


def quoted(name: str) -> Column:
    """A column whose name may hold dots, spaces or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_underscores(text: Column) -> Column:
    """Remove blanks, then underscores, from both ends; inner ones stay."""
    return F.btrim(F.trim(text), F.lit("_"))


def strip_trailing_underscores(text: Column) -> Column:
    return F.rtrim(F.trim(text), F.lit("_"))


def without_point_zero(text: Column) -> Column:
    """``4.0`` -> ``4``; any other text is unchanged."""
    return F.when(text.endswith(".0"), F.left(text, F.length(text) - 2)).otherwise(text)


def truncating_int(text: Column) -> Column:
    """Whole number before the decimal point: ``6`` and ``6.0`` both give 6."""
    whole = F.regexp_extract(F.trim(text), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return whole.try_cast("int")


def rounding_int(text: Column) -> Column:
    """Nearest whole number of a decimal text, as ad-hoc SQL casts do it."""
    return F.round(text.try_cast("double")).try_cast("int")


def within(value: Column, low: float, high: float) -> Column:
    """True only for a known value inside the closed range, else false."""
    return F.coalesce(value.between(low, high), F.lit(False))


def allowed(text: Column, categories: Iterable[str]) -> Column:
    """The trimmed category when it is on the list, else null."""
    value = F.trim(text)
    return F.when(value.isin(list(categories)), value)


def matching(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), text)


def meaningful_text(text: Column) -> Column:
    """Trimmed text; blank or all-underscore placeholders become null."""
    value = F.trim(text)
    return F.when(F.length(F.btrim(value, F.lit("_"))) > 0, value)


def loan_list(text: Column) -> Column:
    """One separator between loan types: ``A, and B`` -> ``A, B``; empty -> null."""
    value = F.regexp_replace(F.trim(text), r",\s*and\s+", ", ")
    return F.when(F.length(value) > 0, value)


def listed_entries(loans: Column) -> Column:
    """Number of non-blank entries of a cleaned list, repeats included."""
    return F.regexp_count(loans, F.lit(r"^[^, ]|,\s*[^,\s]"))


def padded_list(loans: Column) -> Column:
    """``A, B`` with a start mark before and an end mark behind each entry, blank ones too."""
    inner = F.regexp_replace(F.trim(loans), r" *,\s*", ENTRY_END + ENTRY_START)
    return F.concat(F.lit(ENTRY_START), inner, F.lit(ENTRY_END))


def entry_count(padded: Column, entry: str) -> Column:
    """How often ``entry`` occurs in a padded list, by the length it takes up."""
    token = f"{ENTRY_START}{entry}{ENTRY_END}"
    left_over = F.length(F.replace(padded, F.lit(token), F.lit("")))
    return ((F.length(padded) - left_over) / F.lit(len(token))).cast("int")


def history_months(text: Column, pattern: str) -> Column:
    """``2 Years and 3 Months`` -> 27; any other text -> null."""
    years = F.substring_index(text, " ", 1).try_cast("int")
    months = F.substring_index(F.substring_index(text, " ", -2), " ", 1).try_cast("int")
    return F.when(text.rlike(pattern), F.try_add(F.try_multiply(years, F.lit(12)), months))


def usable(value: Column, dtype: str) -> Column:
    """Null for NaN, so missing means null for every column type."""
    return F.when(~F.isnan(value), value) if dtype in ("double", "float") else value
