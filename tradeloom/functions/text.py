"""Text cleaning used when report cells become columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters they fold to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY"


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def squeeze_spaces(column: Column) -> Column:
    """Collapse runs of white space, trim, and turn blank text into NULL."""
    return blank_to_null(F.regexp_replace(column, r"\s+", " "))


def fold_letters(column: Column) -> Column:
    """Lower-case plain letters only: ``ESPAÑA `` -> ``espana``."""
    return F.regexp_replace(F.lower(F.translate(column, ACCENTED, UNACCENTED)), "[^a-z]", "")


def display_name(column: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """Title-case a name unless its folded form has an override."""
    titled = F.initcap(F.trim(column))
    if not overrides:
        return titled
    table = F.create_map(*[F.lit(part) for pair in overrides.items() for part in pair])
    return F.coalesce(F.try_element_at(table, fold_letters(column)), titled)


def clean_identifier(column: Column) -> Column:
    """Identifier text with the ``.0`` of whole numbers removed and blanks as NULL."""
    return blank_to_null(F.regexp_replace(F.trim(column), r"^(-?\d+)\.0+$", "$1"))


def trailing_code(column: Column, missing: str = "_") -> Column:
    """Code in the last parentheses, ``NAME (270 432)`` -> ``270432``."""
    has_code = column.rlike(r"\([^()]*\)\s*$")
    code = F.regexp_extract(column, r"\(([^()]*)\)\s*$", 1)
    return F.when(has_code, F.regexp_replace(code, r"\s+", "")).otherwise(F.lit(missing))


def without_trailing_code(column: Column) -> Column:
    """Description left once the trailing code is removed."""
    stripped = F.trim(F.regexp_replace(column, r"\s*\([^()]*\)\s*$", ""))
    return F.regexp_replace(stripped, " {2,}", " ")


def strip_letter_suffix(column: Column) -> Column:
    """Drop trailing letters but keep those inside: ``AB12CD`` -> ``AB12``."""
    return F.regexp_replace(F.trim(column), "[A-Za-z]+$", "")


def first_token(column: Column) -> Column:
    return F.regexp_extract(F.trim(column), r"^(\S*)", 1)


def after_first_token(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, r"^\S+\s+", ""))


def leading_digits(column: Column) -> Column:
    return F.nullif(F.regexp_extract(column, r"^(\d+)", 1), F.lit(""))


def after_leading_digits(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, r"^\d+\s+", ""))


def decimal_text(column: Column) -> Column:
    """Number written with a decimal comma; anything unreadable becomes NULL.

    Dashes and blanks fill most cells of a wide sheet; they are sorted out before the cast,
    which is slow on text it cannot read.
    """
    number = F.replace(F.trim(column), F.lit(","), F.lit("."))
    return F.when(~number.isin("-", ""), number.try_cast("double"))


def mentions_word(columns: list[Column], word: str) -> Column:
    """True when any of the columns contains ``word``, ignoring case."""
    return F.contains(F.lower(F.concat_ws("\u0001", *columns)), F.lit(word.lower()))
