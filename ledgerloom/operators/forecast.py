"""Revenue forecasts with an additive trend and an additive yearly season.

Closed form per series: a centred 12-month mean gives trend points, the mean residual of each
calendar month gives the season, a straight line through the trend points is extended. Series of
less than two years get the line alone, those of less than one year their mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import min_max_index, ratio

PERIOD = 12
FACTOR = 2 * PERIOD
MONEY = "decimal(20,2)"


def forecast_revenue(
    monthly: DataFrame,
    periods: int = 6,
    by: Sequence[str] = (),
    value: str = "revenue",
    month: str = "month_start",
    drop_partial_last: bool = False,
) -> DataFrame:
    """``periods`` months after the last one, per ``by`` group, from a series without gaps.

    ``drop_partial_last`` leaves the last month out of the fit. One row per month and group goes
    in, so all windows here are over a single series.
    """
    keys = list(by) or ["_series"]
    series = monthly if by else monthly.withColumn("_series", F.lit(0))
    ordered = Window.partitionBy(*keys).orderBy(month)
    whole = Window.partitionBy(*keys)
    y = series.select(
        *keys,
        F.col(month).alias("month"),
        F.col(value).cast(MONEY).alias("y"),
        F.row_number().over(ordered).alias("t"),
        F.count("*").over(whole).alias("n"),
    )
    if drop_partial_last:
        y = y.filter("t < n").withColumn("n", F.col("n") - 1)

    # trend points are kept as 24 times their value: sums of cents, exact in any order
    by_time = Window.partitionBy(*keys).orderBy("t")
    centred = F.sum("y").over(by_time.rowsBetween(-6, 5)) + F.sum("y").over(by_time.rowsBetween(-5, 6))
    two_years = F.col("n") >= 2 * PERIOD
    inside = (F.col("t") > 6) & (F.col("t") <= F.col("n") - 6)
    # under two years the line goes through the values themselves
    point = F.when(~two_years, F.col("y") * FACTOR).when(inside, centred)
    points = y.withColumn("point", point.cast("decimal(24,2)")).withColumn("phase", F.pmod("t", F.lit(PERIOD)))

    t = F.when(F.col("point").isNotNull(), F.col("t"))
    sums = points.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("month").alias("last_month"),
        ratio(F.sum("y"), F.count("y")).alias("mean"),
        F.count("point").alias("k"),
        F.sum(t).alias("st"),
        F.sum(t * t).alias("stt"),
        F.sum("point").alias("sp"),
        F.sum(t * F.col("point")).alias("stp"),
    )
    slope = ratio(F.col("k") * F.col("stp") - F.col("st") * F.col("sp"), F.col("k") * F.col("stt") - F.col("st") * F.col("st"))
    lines = sums.withColumn("slope", slope / FACTOR).withColumn(
        "intercept", ratio("sp", F.col("k") * FACTOR) - F.col("slope") * ratio("st", "k")
    )
    off_line = points.filter(two_years & F.col("point").isNotNull()).withColumn("r", F.col("y") * FACTOR - F.col("point"))
    residuals = off_line.groupBy(*keys, "phase").agg(ratio(F.sum("r"), F.count("r") * FACTOR).alias("r"))
    season = residuals.withColumn("season", F.col("r") - F.avg("r").over(whole)).drop("r")

    steps = lines.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    steps = steps.withColumn("phase", F.pmod(F.col("n") + F.col("h"), F.lit(PERIOD)))
    placed = steps.join(season, [*keys, "phase"], "left")
    line = F.col("intercept") + F.col("slope") * (F.col("n") + F.col("h"))
    predicted = F.when(F.col("n") < PERIOD, F.col("mean")).when(~two_years, line).otherwise(line + F.col("season"))
    method = F.when(F.col("n") < PERIOD, "mean").when(~two_years, "trend").otherwise("trend+season")
    return placed.select(
        *by,
        F.add_months("last_month", F.col("h")).alias("month"),
        predicted.alias("forecast_revenue"),
        method.alias("method"),
    )


def with_forecast_index(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds the place of each month between the lowest (0) and highest (1) forecast month."""
    w = Window.partitionBy(*by)
    low, high = F.min("forecast_revenue").over(w), F.max("forecast_revenue").over(w)
    return forecast.withColumn("forecast_index", min_max_index("forecast_revenue", low, high))
