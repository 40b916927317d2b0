"""Rules about one inspection: risk, outcome, dates and quality flags."""

from pyspark.sql import Column, functions as F

from plateward.functions.text import clean, clean_upper
from plateward.values import (
    DATE_FORMAT,
    FAIL_RESULT,
    JURISDICTION_CITY,
    PASS_RESULTS,
    RISK_LEVELS,
    UNKNOWN,
)


def risk_rank(risk: Column) -> Column:
    """1, 2 or 3 by the first of these digits the text contains, else NULL."""
    return F.coalesce(*(F.when(risk.contains(digit), rank) for digit, _, rank in RISK_LEVELS))


def risk_level(risk: Column) -> Column:
    """Level name by the same rule, UNKNOWN where no digit is found."""
    levels = (F.when(risk.contains(digit), level) for digit, level, _ in RISK_LEVELS)
    return F.coalesce(*levels, F.lit(UNKNOWN))


def invalid_risk(risk: Column) -> Column:
    """A risk text is given but holds no known digit. No text is not invalid."""
    return risk.isNotNull() & risk_rank(risk).isNull()


def out_of_jurisdiction(city: Column, home: str = JURISDICTION_CITY) -> Column:
    """Another city is named. An unknown city counts as inside."""
    return F.coalesce(clean_upper(city) != home, F.lit(False))


def passed(result: Column) -> Column:
    return F.coalesce(result.isin(*PASS_RESULTS), F.lit(False))


def failed(result: Column) -> Column:
    return F.coalesce(result == FAIL_RESULT, F.lit(False))


def fail_without_violations(result: Column, violations: Column) -> Column:
    return failed(clean(result)) & violations.isNull()


def us_date(text: Column) -> Column:
    """Month/day/year text as a date; text that is no date gives NULL."""
    return F.try_to_date(text, DATE_FORMAT)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def for_display(value: Column) -> Column:
    """Two decimals, halves to even."""
    return F.bround(value, 2)
