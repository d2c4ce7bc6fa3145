"""The facts behind the written reports, as one long table (section, name, label, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent
from .cohorts import first_cohort


def _fact(section: str, name: str, label: Column, value: Column) -> list[Column]:
    return [
        F.lit(section).alias("section"),
        F.lit(name).alias("name"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    ]


def _extremes(df: DataFrame, section: str, label: str, picks: dict[str, tuple[str, bool]]) -> DataFrame:
    """One fact per pick (name -> measure, largest?): the row at that extreme, in a single pass.

    Ties go to the smallest label.
    """
    aggregates = []
    for name, (measure, largest) in picks.items():
        row = F.struct((F.col(measure) if not largest else -F.col(measure)).alias("k"), F.col(label).alias("l"))
        aggregates.append(F.min(F.when(F.col(measure).isNotNull(), row)).alias(name))
    best = df.agg(*aggregates)
    facts = [
        F.struct(*_fact(section, name, F.col(name)["l"], -F.col(name)["k"] if largest else F.col(name)["k"]))
        for name, (_, largest) in picks.items()
    ]
    return best.select(F.inline(F.array(*facts)))


def retention_facts(retention: DataFrame, months: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """Retention of the first cohort in percent after the given months; 0 where nobody is left."""
    curve = first_cohort(retention)
    rates = curve.agg(
        *[
            F.coalesce(F.max(F.when(F.col("cohort_index") == m, F.col("retention_rate"))), F.lit(0.0)).alias(f"m{m}")
            for m in months
        ]
    )
    facts = [
        F.struct(*_fact("retention", f"month_{m}", F.lit(str(m)), F.col(f"m{m}") * 100.0)) for m in months
    ]
    return rates.select(F.inline(F.array(*facts)))


def _top_margin(by_region: DataFrame) -> DataFrame:
    """Margin in percent of the region with the largest revenue; ties go to the smallest name."""
    row = F.struct((-F.col("revenue")).alias("k"), F.col("region").alias("l"), percent("profit", "revenue").alias("margin"))
    top = by_region.agg(F.min(F.when(F.col("revenue").isNotNull(), row)).alias("top"))
    return top.select(*_fact("region", "top_region_margin", F.col("top.l"), F.col("top.margin")))


def insights(monthly: DataFrame, by_category: DataFrame, by_region: DataFrame, retention: DataFrame) -> DataFrame:
    """Peak and weak month, best and worst categories and regions, margin of the best region, first cohort."""
    months = monthly.withColumn("label", F.date_format("month_start", "yyyy-MM"))
    parts = [
        _extremes(months, "demand", "label", {"peak_month": ("revenue", True), "weak_month": ("revenue", False)}),
        _extremes(
            by_category,
            "category",
            "category",
            {
                "most_profitable": ("profit", True),
                "least_profitable": ("profit", False),
                "highest_margin": ("profit_margin_pct", True),
                "lowest_margin": ("profit_margin_pct", False),
            },
        ),
        _extremes(by_region, "region", "region", {"top_region": ("revenue", True), "low_region": ("revenue", False)}),
        _top_margin(by_region),
        retention_facts(retention),
    ]
    return reduce(DataFrame.unionByName, parts)


def forecast_insights(forecast: DataFrame) -> DataFrame:
    """Mean forecast and the month of the highest one."""
    months = forecast.withColumn("label", F.date_format("month", "yyyy-MM"))
    mean = months.agg(F.avg("forecast_revenue").alias("m")).select(
        *_fact("forecast", "mean_forecast", F.lit(None), F.col("m"))
    )
    return mean.unionByName(_extremes(months, "forecast", "label", {"peak_month": ("forecast_revenue", True)}))
