"""The answers: small reports, each computed from the gold layer alone.

All means are taken over trips, as sum over count, unless a name says
`mean_of_cells`: the plain average of the cells' own averages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.contract import AMOUNT, FLEET, HOUR, MONTH, PASSENGERS, PICKUP, YEAR
from fareloom.functions.bands import day_type, demand_band
from fareloom.functions.measures import (
    count_text,
    decimal_text,
    mean_fare,
    mean_passengers,
    money_text,
    ratio_where,
    revenue,
    share_of_total,
    trips,
)
from fareloom.labels import ENGLISH, LabelSet


def mean_of_cells() -> Column:
    return F.round(F.avg("avg_total_amount"), 2)


def of_fleet(gold: DataFrame, fleet: str) -> DataFrame:
    return gold.filter(F.col(FLEET) == fleet)


def of_month(gold: DataFrame, year: int, month: int) -> DataFrame:
    return gold.filter((F.col(YEAR) == year) & (F.col(MONTH) == month))


def titled(report: DataFrame, title: str) -> DataFrame:
    """Put the report's heading in front, as a constant column."""
    return report.select(F.lit(title).alias("analysis"), "*")


def top_rows(report: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n rows with the highest measure; equal ones in the order of the key."""
    return report.orderBy(F.desc(measure), key).limit(n)


# First question: what a trip of the fleet costs.


def fleet_mean(gold: DataFrame, fleet: str = "yellow") -> DataFrame:
    return of_fleet(gold, fleet).agg(
        mean_fare().alias("avg_total_amount"),
        trips().alias("total_trips"),
        revenue().alias("total_revenue"),
    )


def _fleet_months(gold: DataFrame, fleet: str) -> DataFrame:
    return (
        of_fleet(gold, fleet)
        .groupBy("year_month")
        .agg(
            mean_of_cells().alias("mean_of_cells"),
            mean_fare().alias("weighted_mean"),
            trips().alias("total_trips"),
            revenue().alias("total_revenue"),
        )
    )


def fleet_mean_by_month(gold: DataFrame, fleet: str = "yellow") -> DataFrame:
    return _fleet_months(gold, fleet).orderBy("year_month")


def fleet_share_by_month(gold: DataFrame, fleet: str = "yellow") -> DataFrame:
    share = share_of_total("total_trips").alias("percentage_trips_month")
    return _fleet_months(gold, fleet).select("*", share).orderBy("year_month")


# Second question: how many passengers a trip has, hour by hour.


def passengers_by_hour(gold: DataFrame, year: int, month: int = 5) -> DataFrame:
    return (
        of_month(gold, year, month)
        .groupBy(HOUR)
        .agg(
            mean_passengers().alias("avg_passengers"),
            trips().alias("total_trips"),
            F.sum("sum_passenger_count").alias("total_passengers"),
        )
        .orderBy(HOUR)
    )


def passenger_peaks(
    gold: DataFrame, year: int, month: int = 5, labels: LabelSet = ENGLISH
) -> DataFrame:
    hours = passengers_by_hour(gold, year, month).drop("total_passengers")
    band = demand_band(F.col(HOUR), labels).alias("demand_period")
    return hours.select("*", band).orderBy(F.desc("avg_passengers"), HOUR)


def passengers_by_period(gold: DataFrame, year: int, month: int = 5) -> DataFrame:
    periods = (
        of_month(gold, year, month)
        .groupBy("pickup_period")
        .agg(mean_passengers().alias("avg_passengers"), trips().alias("total_trips"))
    )
    share = share_of_total("total_trips").alias("percentage_trips")
    return periods.select("*", share).orderBy(F.desc("avg_passengers"), "pickup_period")


def busiest_passenger_hours(gold: DataFrame, year: int, month: int = 5, n: int = 3) -> DataFrame:
    hours = passengers_by_hour(gold, year, month).drop("total_passengers")
    return top_rows(hours, "avg_passengers", HOUR, n)


# Comparisons.


def compare_fleets(gold: DataFrame) -> DataFrame:
    fleets = gold.groupBy(FLEET).agg(
        mean_fare().alias("avg_fare"),
        mean_passengers().alias("avg_passengers"),
        trips().alias("total_trips"),
        revenue().alias("total_revenue"),
    )
    share = share_of_total("total_trips").alias("percentage_market")
    return fleets.select("*", share).orderBy(F.desc("total_trips"), FLEET)


def monthly_evolution(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("year_month")
        .agg(
            trips().alias("monthly_trips"),
            mean_fare().alias("avg_fare_month"),
            mean_passengers().alias("avg_passengers_month"),
            revenue().alias("monthly_revenue"),
        )
        .orderBy("year_month")
    )


def busiest_hours(gold: DataFrame, n: int = 5) -> DataFrame:
    """The n hours with most trips; shares refer to the trips of all hours."""
    hours = gold.groupBy(HOUR).agg(
        trips().alias("total_trips"),
        mean_fare().alias("avg_fare"),
        mean_passengers().alias("avg_passengers"),
    )
    share = share_of_total("total_trips").alias("percentage_trips")
    return top_rows(hours.select("*", share), "total_trips", HOUR, n)


def weekend_split(gold: DataFrame, labels: LabelSet = ENGLISH) -> DataFrame:
    split = gold.groupBy("is_weekend").agg(
        trips().alias("trips"),
        mean_fare().alias("avg_fare"),
        mean_passengers().alias("avg_passengers"),
    )
    return split.select(
        day_type(F.col("is_weekend"), labels).alias("day_type"),
        "trips",
        "avg_fare",
        "avg_passengers",
        share_of_total("trips").alias("percentage_trips"),
    ).orderBy(F.desc("trips"), "day_type")


def weekend_fare_gap(gold: DataFrame, labels: LabelSet = ENGLISH) -> DataFrame:
    """Which side of the week is dearer and by how much, from rounded means.

    No row unless there are trips on both sides.
    """
    on = {True: F.col("is_weekend"), False: ~F.col("is_weekend")}
    weekday, weekend = labels.day_types
    fares = gold.agg(
        *(
            F.round(ratio_where(on[flag], "sum_total_amount", "total_trips"), 2).alias(name)
            for flag, name in ((False, "weekday_fare"), (True, "weekend_fare"))
        )
    )
    higher = F.greatest("weekday_fare", "weekend_fare")
    lower = F.least("weekday_fare", "weekend_fare")
    return fares.filter(
        F.col("weekday_fare").isNotNull() & F.col("weekend_fare").isNotNull()
    ).select(
        F.when(F.col("weekend_fare") > F.col("weekday_fare"), weekend)
        .otherwise(weekday)
        .alias("dearer_side"),
        F.round((F.try_divide(higher, lower) - 1) * 100, 1).alias("gap_pct"),
    )


def trips_by_dayname(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("pickup_dayname")
        .agg(trips().alias("total_trips"), mean_of_cells().alias("mean_of_cells"))
        .orderBy(F.desc("total_trips"), "pickup_dayname")
    )


def fare_by_fleet_month(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy(FLEET, "year_month")
        .agg(trips().alias("total_trips"), mean_fare().alias("avg_fare"))
        .orderBy(FLEET, "year_month")
    )


def trips_by_fleet_month(gold: DataFrame) -> DataFrame:
    return fare_by_fleet_month(gold).drop("avg_fare")


def peak(gold: DataFrame, key: str) -> DataFrame:
    """The fleet, hour or month with most trips."""
    return top_rows(gold.groupBy(key).agg(trips().alias("trips")), "trips", key, 1)


# Checks of the layer itself.


def validate(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count(F.lit(1)).alias("total_gold_records"),
        F.countDistinct(FLEET).alias("taxi_types"),
        F.countDistinct("year_month").alias("available_months"),
        F.min(YEAR).alias("min_year"),
        F.max(YEAR).alias("max_year"),
        trips().alias("total_aggregated_trips"),
    )


def coverage(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy(FLEET, "year_month")
        .agg(trips().alias("trips"), F.countDistinct(HOUR).alias("hours_covered"))
        .orderBy(FLEET, "year_month")
    )


# Summaries. Without a year, the month of the second answer is that month of
# every year in the table.


def headline(gold: DataFrame, fleet: str, month: int, year: int | None) -> DataFrame:
    in_month = F.col(MONTH) == month
    if year is not None:
        in_month = in_month & (F.col(YEAR) == year)
    return gold.agg(
        trips().alias("total_trips"),
        F.sum("sum_total_amount").alias("total_revenue"),
        F.countDistinct(FLEET).alias("taxi_types"),
        F.countDistinct("year_month").alias("months_analysed"),
        ratio_where(F.col(FLEET) == fleet, "sum_total_amount", "total_trips").alias("answer_1"),
        ratio_where(in_month, "sum_passenger_count", "total_trips").alias("answer_2"),
    )


def executive_summary(
    gold: DataFrame,
    fleet: str = "yellow",
    month: int = 5,
    year: int | None = None,
    labels: LabelSet = ENGLISH,
) -> DataFrame:
    """Four indicators as text, from one aggregation."""
    texts = (
        count_text(F.col("total_trips")),
        money_text(F.col("total_revenue")),
        money_text(F.col("answer_1")),
        decimal_text(F.col("answer_2")),
    )
    rows = [
        F.struct(F.lit(indicator).alias("indicator"), text.alias("result"))
        for indicator, text in zip(labels.indicators, texts, strict=True)
    ]
    return headline(gold, fleet, month, year).select(F.inline(F.array(*rows)))


def final_metrics(
    gold: DataFrame, fleet: str = "yellow", month: int = 5, year: int | None = None
) -> DataFrame:
    money = {name: F.round(name, 2) for name in ("total_revenue", "answer_1", "answer_2")}
    return headline(gold, fleet, month, year).withColumns(money)


# Looking at the layer.


def explore(gold: DataFrame, fleet: str = "yellow", month: str = "2023-05", n: int = 10) -> DataFrame:
    """A slice of gold, in the order of its key."""
    slice_ = of_fleet(gold, fleet).filter(F.col("year_month") == month)
    return slice_.orderBy(HOUR, "pickup_dayname").limit(n)


def sample(gold: DataFrame, n: int = 3) -> DataFrame:
    return gold.orderBy(FLEET, YEAR, MONTH, HOUR, "pickup_dayname").limit(n)


# The two questions asked of trip rows instead of gold, leaving out rows
# without a positive amount or passenger count.


def fleet_mean_from_trips(bronze: DataFrame, fleet: str = "yellow") -> DataFrame:
    return (
        bronze.filter((F.col(FLEET) == fleet) & (F.col(AMOUNT) > 0))
        .groupBy("year_month")
        .agg(F.round(F.avg(AMOUNT), 2).alias("avg_fare"), F.count(F.lit(1)).alias("trips"))
        .orderBy("year_month")
    )


def passengers_from_trips(bronze: DataFrame, month: str) -> DataFrame:
    return (
        bronze.filter((F.col("year_month") == month) & (F.col(PASSENGERS) > 0))
        .groupBy(F.hour(PICKUP).alias("hour"))
        .agg(F.round(F.avg(PASSENGERS), 2).alias("avg_passengers"), F.count(F.lit(1)).alias("trips"))
        .orderBy("hour")
    )


@dataclass(frozen=True)
class Period:
    """The month the second question asks about."""

    year: int
    month: int = 5

    @property
    def text(self) -> str:
        return f"{self.year}-{self.month:02d}"


def catalogue(period: Period) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """All answers over gold by name."""
    when = (period.year, period.month)
    return {
        "q1_main": fleet_mean,
        "q1_monthly": fleet_mean_by_month,
        "q1_share": fleet_share_by_month,
        "q2_main": lambda gold: passengers_by_hour(gold, *when),
        "q2_peaks": lambda gold: passenger_peaks(gold, *when),
        "q2_period": lambda gold: passengers_by_period(gold, *when),
        "q2_top3": lambda gold: busiest_passenger_hours(gold, *when),
        "fleet_compare": compare_fleets,
        "monthly_evolution": monthly_evolution,
        "top5_hours": busiest_hours,
        "weekend_split": weekend_split,
        "weekend_fare_gap": weekend_fare_gap,
        "trips_by_dayname": trips_by_dayname,
        "fare_by_type_month": fare_by_fleet_month,
        "trips_by_type_month": trips_by_fleet_month,
        "peak_type": lambda gold: peak(gold, FLEET),
        "peak_hour": lambda gold: peak(gold, HOUR),
        "peak_month": lambda gold: peak(gold, "year_month"),
        "validate_gold": validate,
        "validate_coverage": coverage,
        "exec_summary": lambda gold: executive_summary(gold, month=period.month),
        "exec_summary_year": lambda gold: executive_summary(
            gold, month=period.month, year=period.year
        ),
        "final_metrics": lambda gold: final_metrics(gold, month=period.month),
        "explore_gold": lambda gold: explore(gold, month=period.text),
        "gold_sample": sample,
    }


def answer(
    gold: DataFrame, name: str, period: Period, labels: LabelSet = ENGLISH
) -> DataFrame:
    """One answer by name, under its heading where it has one."""
    report = catalogue(period)[name](gold)
    title = labels.titles.get(name)
    return titled(report, title) if title else report


def register_views(spark: SparkSession, gold: DataFrame, period: Period) -> list[str]:
    """Make every answer a temporary view, for use from SQL."""
    names = []
    for name, build in catalogue(period).items():
        build(gold).createOrReplaceTempView(f"answer_{name}")
        names.append(f"answer_{name}")
    return names
