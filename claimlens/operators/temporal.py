"""Calendar columns and trends per year, quarter or month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.config import TIME_LEVELS
from claimlens.functions.columns import percent
from claimlens.operators.aggregate import CLAIMS, COST, PROVIDERS, UNIT_COST, Grouping

TIME_KEYS = dict(zip(TIME_LEVELS, (
    ("report_year",),
    ("report_year", "report_quarter"),
    ("report_year", "report_month"),
)))
TIME_PREFIXES = dict(zip(TIME_LEVELS, ("yearly", "quarterly", "monthly")))


def add_calendar(
    df: DataFrame, date_column: str | None = None, year: int | None = None, quarter: str | None = None
) -> DataFrame:
    """Add report_date, report_year, report_quarter ('Q1'..'Q4') and report_month.

    They come from ``date_column``; without one, from the ``year`` (and
    ``quarter``) the files were published for, the rest being NULL. A text
    that is no date gives a NULL calendar; :func:`bad_dates` counts these.
    """
    if date_column:
        return df.withColumn("report_date", F.expr(f"try_cast(`{date_column}` AS date)")).withColumns({
            "report_year": F.expr("year(report_date)"),
            "report_quarter": F.expr("concat('Q', quarter(report_date))"),
            "report_month": F.expr("month(report_date)"),
        })
    if year is None:
        raise ValueError("add_calendar needs a date column or a year")
    return df.withColumns({
        "report_date": F.lit(None).cast("date"),
        "report_year": F.lit(int(year)),
        "report_quarter": F.lit(quarter).cast("string"),
        "report_month": F.lit(None).cast("int"),
    })


def bad_dates(df: DataFrame, date_column: str) -> DataFrame:
    """The texts of a date column that are no dates, each with its rows."""
    broken = f"`{date_column}` IS NOT NULL AND try_cast(`{date_column}` AS date) IS NULL"
    return df.filter(broken).groupBy(F.col(date_column).alias("date_text")).agg(F.count(F.lit(1)).alias("row_count"))


def trend_grouping(level: str = "year") -> Grouping:
    prefix = TIME_PREFIXES[level]
    return Grouping(
        keys=(*TIME_KEYS[level], "provider_state", "risk_category"),
        measures={
            f"{prefix}_claims": CLAIMS,
            f"{prefix}_cost": COST,
            f"{prefix}_providers": PROVIDERS,
            "avg_cost_per_claim": UNIT_COST,
        },
    )


def trends(df: DataFrame, level: str = "year", ordered: bool = True) -> DataFrame:
    """Claims, cost, providers and mean unit cost per period, state and category."""
    grouping = trend_grouping(level)
    result = grouping.of(df)
    return result.orderBy(*grouping.keys) if ordered else result


def year_over_year(yearly: DataFrame) -> DataFrame:
    """Change of yearly claims against the previous year present for the group.

    ``prev_year`` tells which one that was. A group holds one row per year.
    """
    w = Window.partitionBy("provider_state", "risk_category").orderBy("report_year")
    return yearly.select(
        "provider_state",
        "risk_category",
        "report_year",
        F.lag("report_year").over(w).alias("prev_year"),
        "yearly_claims",
        F.lag("yearly_claims").over(w).alias("prev_claims"),
    ).withColumns({
        "claims_change": F.expr("yearly_claims - prev_claims"),
        "claims_change_pct": percent("yearly_claims - prev_claims", "prev_claims"),
    })


def reference_average(yearly: DataFrame) -> DataFrame:
    """Claims per year and category, beside the category's mean over the years.

    The window runs over one row per year and category.
    """
    per_year = yearly.groupBy("report_year", "risk_category").agg(F.sum("yearly_claims").alias("yearly_claims"))
    over_years = F.avg("yearly_claims").over(Window.partitionBy("risk_category"))
    return per_year.withColumn("avg_yearly_claims", over_years)
