from pyspark.sql import Column, functions as F

from plateward.values import VIOLATION_SEPARATOR


def clean(text: Column) -> Column:
    """Without leading and trailing spaces (tabs stay)."""
    return F.trim(text)


def clean_upper(text: Column) -> Column:
    return F.upper(clean(text))


def part_count(text: Column, separator: str = VIOLATION_SEPARATOR) -> Column:
    """Number of separated parts; 0 for NULL. Counts separators, so no array is built."""
    separators = F.length(text) - F.length(F.replace(text, F.lit(separator), F.lit("")))
    return F.coalesce(separators + 1, F.lit(0))


def normal_form(text: Column) -> Column:
    """Upper-case letters and digits only, so spelling variants compare equal.

    NULL where nothing is left, as for names in other scripts: they are not variants of each other.
    """
    return F.nullif(F.regexp_replace(F.upper(text), "[^A-Z0-9]", ""), F.lit(""))


def letters_only(text: Column) -> Column:
    """Letters, marks on them, and digits of any script; all else is left out."""
    return F.regexp_replace(text, "[^\\p{L}\\p{M}\\p{N}]", "")


def missing_to_null(text: Column, tokens) -> Column:
    return F.when(~text.isin(*tokens), text)
