"""Partition layout and broadcast decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Widest row a bounded lookup table is assumed to have when its size is checked.
_ROW_BYTES = 200


def by_document(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Hash-partition whole documents on their key.

    Texts are shuffled once, before they are exploded.  Every later grouping,
    window or broadcast join that keeps the key reuses this layout, so the
    much larger token tables never move.  Catalyst drops the step when the
    input already arrives in this layout (after a shuffled join on the key).
    """
    return df.repartition(key)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy projections work for every core.

    A table that already arrives in at least as many splits as there are cores
    is returned as it is: at scale this never shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when `max_rows`, a bound that holds by
    construction (a vocabulary limit, a top-k), keeps the table under the
    session's broadcast threshold.  Otherwise Spark shuffles both sides and
    adaptive execution splits skewed partitions."""
    spark = df.sparkSession
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    digits = "".join(c for c in str(raw) if c.isdigit() or c == "-")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(
        str(raw).lower().lstrip("-0123456789")[:1], 1)
    threshold = int(digits or 0) * unit
    return F.broadcast(df) if 0 < max_rows * _ROW_BYTES <= threshold else df


def settled(value: Column) -> Column:
    """A score as ranking sees it: 12 digits, so that the last bits, which depend
    on the order in which a sum was taken, do not break ties between equals."""
    return F.round(value, 12)


def scalar(df: DataFrame, value: Column) -> Column:
    """One value of a one-row table as a scalar subquery."""
    return df.select(value.alias("v")).scalar()
