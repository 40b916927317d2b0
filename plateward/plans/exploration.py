"""The exploratory tables of the mart, each small enough to print or plot."""

from pyspark.sql import DataFrame

from plateward.operators import counts, explore

FLAGS = ("flag_fail_without_violations", "flag_missing_license", "repeat_fail_flag")


def explore_tables(mart: DataFrame) -> dict[str, DataFrame]:
    rows = explore.load_mart(mart)
    return {
        "row_counts": counts.row_counts(explored=rows),
        "year_span": explore.year_span(rows),
        "results_distribution": explore.rounded(counts.value_shares(rows, "results"), "pct"),
        "fail_rate_by_type": explore.rounded(
            explore.fail_rate_by(rows, "facility_type_grouped"), "fail_rate"
        ),
        "yearly_trend": explore.rounded(explore.yearly_trend(rows), "pass_rate", "fail_rate"),
        "violations_by_risk": explore.rounded(
            explore.violations_by_risk(rows), "avg_violations", "median_violations"
        ),
        "flag_summary": explore.rounded(explore.flag_summary(rows, FLAGS), "pct"),
    }
