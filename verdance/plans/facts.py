"""What answers are made of (Q4): one row per greenhouse with its numbers, whatever their number,
for tables with real keys and for tables whose greenhouses are told from the time alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.model import LABELS, STATS
from verdance.operators.tables import keyed_only, labelled
from verdance.plans.reports import HOT

MEANS = {"avg_temp": "temp", "avg_humidity": "humidity", "max_light": "light"}


def known_names(spark: SparkSession, names: tuple[str, ...] = LABELS) -> DataFrame:
    """(ord, greenhouse): greenhouses that have facts even without a window."""
    return spark.createDataFrame(list(enumerate(names)), "ord int, greenhouse string")


def facts(
    windows: DataFrame,
    real: bool | Column = True,
    names: DataFrame | None = None,
    hot_above: float = HOT,
    window_seconds: int = 5,
    digits: int = 4,
) -> DataFrame:
    """One row per greenhouse, and one of all (null greenhouse).

    ``real`` says whether keys are real, as ``priority.keyed_source`` tells it; otherwise
    greenhouses come from the time, and then

    * ``hot_n``, ``hot_mean``, ``hot_max`` are those of all windows in every row, since a window of
      no real greenhouse cannot be told to be another's; ``ranked_hot`` is counted by label;
    * ``rank_*`` are means of the means of each start, not of rows; ``mean_*`` are means of rows.

    ``names`` (ord, greenhouse) adds greenhouses without windows. One grouping by greenhouse and
    start, and one of its rows; the newest windows are read by their start.
    """
    is_real = F.lit(real) if isinstance(real, bool) else real
    temp = F.col("avg_temp")
    hot = temp > hot_above
    rows = labelled(keyed_only(windows, real), real, window_seconds).where(F.col("greenhouse").isNotNull())
    starts = rows.groupBy("greenhouse", "win_start").agg(
        F.count("*").alias("windows"),
        F.count_if(hot).alias("hot_n"),
        F.sum(F.when(hot, temp)).alias("hot_sum"),
        F.max(F.when(hot, temp)).alias("hot_max"),
        *[f(c).alias(f"{n}_{k}") for c, n in MEANS.items() for f, k in ((F.sum, "sum"), (F.count, "n"))],
    )
    both = [F.sum("windows").alias("windows"), F.sum("hot_n").alias("hot_n"), F.sum("hot_sum").alias("hot_sum"), F.max("hot_max").alias("hot_max")]
    per = starts.groupBy("greenhouse").agg(
        *both,
        F.max("win_start").alias("last_start"),
        *[F.try_divide(F.sum(f"{n}_sum"), F.sum(f"{n}_n")).alias(f"mean_{n}") for n in MEANS.values()],
        *[F.avg(F.try_divide(f"{n}_sum", f"{n}_n")).alias(f"start_{n}") for n in MEANS.values()],
    )
    totals = per.agg(*both, F.max("last_start").alias("last_start"))
    every = totals.select(F.struct("*").alias("t")).scalar()

    newest = per.select(F.col("greenhouse").alias("g"), F.col("last_start").alias("s"))
    last = (
        rows.join(newest, (F.col("greenhouse") == F.col("g")) & (F.col("win_start") == F.col("s")))
        .groupBy("greenhouse").agg(F.max(F.struct(*STATS)).alias("latest"))
    )
    own = lambda c: F.when(is_real, F.col(c)).otherwise(every[c])
    named = per.join(last, "greenhouse", "left")
    named = named.withColumn("ord", F.lit(None).cast("int")) if names is None else named.join(names, "greenhouse", "full_outer")
    rounded = lambda c: F.round(c, digits)
    hot_n = F.coalesce(own("hot_n"), F.lit(0).cast("long"))
    mode = F.when(is_real, "real").otherwise("synthetic").alias("mode")
    named = named.select(
        mode,
        "greenhouse",
        "ord",
        F.coalesce("windows", F.lit(0).cast("long")).alias("windows"),
        hot_n.alias("hot_n"),
        rounded(F.try_divide(own("hot_sum"), hot_n)).alias("hot_mean"),
        rounded(own("hot_max")).alias("hot_max"),
        F.coalesce("hot_n", F.lit(0).cast("long")).alias("ranked_hot"),
        *[rounded(F.col(f"mean_{n}")).alias(f"mean_{n}") for n in MEANS.values()],
        *[rounded(F.when(is_real, F.col(f"mean_{n}")).otherwise(F.col(f"start_{n}"))).alias(f"rank_{n}") for n in MEANS.values()],
        "last_start",
        *[rounded(F.col("latest")[s]).alias(f"last_{s}") for s in STATS],
    )
    count = F.coalesce("hot_n", F.lit(0).cast("long"))
    whole = totals.select(
        mode,
        F.lit(None).cast("string").alias("greenhouse"),
        F.lit(None).cast("int").alias("ord"),
        F.coalesce("windows", F.lit(0).cast("long")).alias("windows"),
        count.alias("hot_n"),
        rounded(F.try_divide("hot_sum", count)).alias("hot_mean"),
        rounded(F.col("hot_max")).alias("hot_max"),
        count.alias("ranked_hot"),
        *[F.lit(None).cast("double").alias(f"{k}_{n}") for k in ("mean", "rank") for n in MEANS.values()],
        "last_start",
        *[F.lit(None).cast("double").alias(f"last_{s}") for s in STATS],
    )
    return named.unionByName(whole)


def rankings(table: DataFrame) -> DataFrame:
    """(answer_key, greenhouse, sort_value, n, temp, humidity, light, last_start), in rank order by
    ``sort_value``: greenhouses by hot windows, and by temperature (A7-A10). Without real keys the
    latter lists every known greenhouse in its order, also those without a window."""
    named, no = table.where(F.col("greenhouse").isNotNull()), F.lit(None).cast("double")
    hot = named.where("ranked_hot > 0").select(
        F.lit("alarm_top").alias("answer_key"), "greenhouse", (-F.col("ranked_hot")).cast("double").alias("sort_value"),
        F.col("ranked_hot").alias("n"), no.alias("temp"), no.alias("humidity"), no.alias("light"), F.lit(None).cast("timestamp").alias("last_start"),
    )
    warm = named.where("mode = 'synthetic' or windows > 0").select(
        F.lit("gh_rank").alias("answer_key"), "greenhouse",
        F.when(F.col("mode") == "real", -F.col("rank_temp")).otherwise(F.col("ord").cast("double")).alias("sort_value"),
        F.col("windows").alias("n"), F.col("rank_temp").alias("temp"), F.col("rank_humidity").alias("humidity"), F.col("rank_light").alias("light"), "last_start",
    )
    return hot.unionByName(warm)
