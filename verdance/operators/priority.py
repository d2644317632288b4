"""Primary table with a backup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.operators.tables import multi_key, with_key_column


def priority_source(primary: DataFrame, backup: DataFrame, qualifies: Column, by: str | None = None) -> DataFrame:
    """Qualifying rows of the primary, or of the backup where the primary has none.

    Without ``by`` that is one decision for the whole result: whether the primary has a
    qualifying row is an aggregate inside the query, so building it starts no job.
    With ``by`` it is taken per value of that column: backup rows whose value has a
    qualifying primary row are dropped by an anti-join against the distinct values,
    which are few where ``by`` names greenhouses; the adaptive planner broadcasts
    them only when their measured size allows.
    """
    first = primary.where(qualifies).withColumn("source", F.lit(1))
    second = backup.where(qualifies).withColumn("source", F.lit(2))
    if by is None:
        none = first.agg((F.count("*") == 0).alias("none")).scalar()
        return first.unionByName(second.where(none))
    served = first.select(F.col(by).alias("_served")).distinct()
    rest = second.join(served, F.col(by).eqNullSafe(F.col("_served")), "left_anti")
    return first.unionByName(rest)


def keyed_source(primary: DataFrame, backup: DataFrame) -> tuple[DataFrame, Column]:
    """The rows reports read, and whether their keys are real: those of the first of the
    two tables that holds several keys (A13), else of the primary with labels derived
    from time. Both answers are scalars inside the query; building it starts no job."""
    first, second = multi_key(primary), multi_key(backup)
    chosen = with_key_column(primary).where(first | ~second)
    return chosen.unionByName(with_key_column(backup).where(~first & second)), first | second
