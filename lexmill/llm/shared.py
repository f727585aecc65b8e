"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexmill.session import materialize

__all__ = ["binary_texts", "materialize", "popcount", "resolve_pairs", "table"]


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def binary_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, one at a time; null counts as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def resolve_pairs(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of the index pairs (a[i], b[i]) in `labels`, in
    place; a label is the smallest index of its component."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped
