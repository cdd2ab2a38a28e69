"""Inputs that several queries derive from the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources import table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Columns an hourly rental model is trained on: year and the two count columns
# that add up to the label are left out. Fixed values.
RENTAL_FEATURES = [
    "season", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit",
    "temp", "atemp", "hum", "windspeed",
]

RENTALS_SQL = """
    rentals AS (
        SELECT strftime(ts, '%Y-%m-%d') AS dteday, CAST(hour(ts) AS INTEGER) AS hr,
               CAST(month(any_value(ts)) AS INTEGER) AS mnth,
               CAST((day(any_value(ts)) - 1) // 8 + 1 AS INTEGER) AS season,
               CAST(isodow(any_value(ts)) - 1 AS INTEGER) AS weekday,
               CAST(day(any_value(ts)) = 1 AS INTEGER) AS holiday,
               CAST(isodow(any_value(ts)) < 6 AS INTEGER) AS workingday,
               CAST(hour(ts) // 6 + 1 AS INTEGER) AS weathersit,
               CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) / count(*) AS temp,
               CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) / count(*) AS atemp,
               CAST(count(*) FILTER (event_type = 'signup') AS DOUBLE) / count(*) AS hum,
               CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) / count(*) AS windspeed,
               count(*) FILTER (event_type = 'purchase') AS casual,
               count(*) FILTER (event_type <> 'purchase') AS registered,
               count(*) AS cnt
        FROM events GROUP BY strftime(ts, '%Y-%m-%d'), hour(ts))
"""


def rentals(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts with calendar codes and 0..1 measurements, from the event log."""
    day, hour = F.to_date("ts"), F.hour("ts")
    events = table(spark, sf, "events").select(day.alias("day"), hour.alias("hr"), "event_type")
    counts = events.groupBy("day", "hr").agg(
        *[
            F.count_if(F.col("event_type") == kind).alias(kind)
            for kind in ("click", "view", "signup", "error", "purchase")
        ],
        F.count("*").alias("cnt"),
    )
    weekday = F.weekday("day")
    return counts.select(
        F.date_format("day", "yyyy-MM-dd").alias("dteday"),
        "hr",
        F.month("day").alias("mnth"),
        F.expr("int((day(day) - 1) div 8 + 1)").alias("season"),
        weekday.alias("weekday"),
        (F.dayofmonth("day") == 1).cast("int").alias("holiday"),
        (weekday < 5).cast("int").alias("workingday"),
        F.expr("int(hr div 6 + 1)").alias("weathersit"),
        (F.col("click") / F.col("cnt")).alias("temp"),
        (F.col("view") / F.col("cnt")).alias("atemp"),
        (F.col("signup") / F.col("cnt")).alias("hum"),
        (F.col("error") / F.col("cnt")).alias("windspeed"),
        F.col("purchase").alias("casual"),
        (F.col("cnt") - F.col("purchase")).alias("registered"),
        "cnt",
    )
