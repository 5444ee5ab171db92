"""Per-visitor history: new-visitor flag and logins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidehouse.operators.keyed import first_per_day, first_per_key
from tidehouse.operators.lookup import spread_join


def new_visitor_days(logs: DataFrame, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """The one day (``new_day``) on which each visitor counts as new.

    It is the day of the first record when that says new, otherwise the day before it.
    """
    day = F.to_date(F.col(ts))
    first = first_per_key(logs.select("mid", "is_new", ts, *tie), ["mid"], [ts, *tie])
    new_day = F.when(F.col("is_new") == "1", day).otherwise(F.date_sub(day, 1))
    return first.select("mid", new_day.alias("new_day"))


def with_true_flag(
    logs: DataFrame,
    new_days: DataFrame,
    ts: str = "ts",
    tie: Sequence[str] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """``is_new`` set to 0 on every day but the visitor's new day; a busy visitor-day is cut."""
    days = new_days.select("mid", F.col("new_day").alias("_day"), F.lit(True).alias("_known"))
    joined = spread_join(
        logs.withColumn("_day", F.to_date(F.col(ts))),
        days,
        on=["mid", "_day"],
        spread_by=[ts, *tie],
        rows_per_task=rows_per_task,
    )
    wrong = (F.col("is_new") == "1") & F.col("_known").isNull()
    fixed = F.when(wrong, F.lit("0")).otherwise(F.col("is_new"))
    return joined.withColumn("is_new", fixed).select(*logs.columns)


def fix_is_new(
    logs: DataFrame,
    ts: str = "ts",
    tie: Sequence[str] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """Corrects ``is_new`` from the visitor's first record.

    The first record alone decides, so it is found with one row per visitor and joined back on
    (mid, day); no visitor's history is ordered in one task.
    """
    return with_true_flag(logs, new_visitor_days(logs, ts, tie), ts, tie, rows_per_task)


def logins(
    entries: DataFrame, ts: str = "ts", tie: Sequence[str] = (), back_days: int = 8
) -> DataFrame:
    """First entry of every (uid, day): ``uu_ct`` 1, ``back_ct`` 1 after ``back_days`` days away.

    The history window sees one row per day of a user, never all of the user's pages.
    """
    daily = first_per_day(entries, ["uid"], ts, tie)
    day = F.to_date(F.col(ts))
    previous = F.lag(day).over(Window.partitionBy("uid").orderBy(ts))
    away = F.coalesce(F.datediff(day, previous) >= back_days, F.lit(False))
    return daily.withColumns(
        {"back_ct": away.cast("long"), "uu_ct": F.lit(1).cast("long")}
    )
