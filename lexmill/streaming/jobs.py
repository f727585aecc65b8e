"""Scoring, quota counting and duplicate removal on unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from lexmill.operators.scoring import SINGLE_QUOTA, ScoringModel, score_texts


def score_stream(texts: DataFrame, model: ScoringModel, out: str, checkpoint: str,
                 key: str = "doc_id") -> DataStreamWriter:
    """Score every micro-batch of (key, text) with the written model tables.

    Each batch goes to its own folder in overwrite mode, so a batch repeated
    after a failure replaces its first attempt.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        score_texts(batch, model, key).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return texts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def quota_stream(events: DataFrame, limit: int = SINGLE_QUOTA, client: str = "user_id",
                 ts: str = "ts", width: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    """Requests per client and minute, emitted when the minute is closed.

    State is one count per open client and minute; the watermark evicts it and
    drops rows that arrive later.
    """
    counts = (events.withWatermark(ts, delay).groupBy(client, F.window(ts, width).alias("w"))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(client, F.col("w.start").alias("minute"), "n",
                         F.greatest(F.col("n") - limit, F.lit(0)).alias("over_limit"))


def dedup_stream(texts: DataFrame, ts: str = "ts", delay: str = "10 minutes",
                 text: str = "text") -> DataFrame:
    """First arrival of each exact text within the watermark delay.  State
    keeps digests, not texts."""
    return (texts.withColumn("text_digest", F.sha2(F.col(text), 256)).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(["text_digest"]).drop("text_digest"))
