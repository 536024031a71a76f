"""Rolling aggregates beside the batch path."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmart.sources.files import Files


def hourly(rows: DataFrame, time: str, group: str, value: str, late: str = "1 hour") -> DataFrame:
    """Count and sum per hour and group; works on a stream and on a plain frame alike."""
    marked = rows.withWatermark(time, late) if rows.isStreaming else rows
    return (
        marked.groupBy(F.window(time, "1 hour").alias("hour"), group)
        .agg(F.count("*").alias("sales"), F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_sum"))
        .select(F.col("hour.start").cast("timestamp_ntz").alias("hour_start"), group, "sales", "value_sum")
    )


def start_hourly(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write changed totals of every micro-batch as its own slice; a repeated batch replaces its slice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """Current totals: per key the values of the newest batch that changed it."""
    return spark.read.parquet(path).groupBy(*keys).agg(*[F.max_by(name, "batch_id").alias(name) for name in values])


def start_totals(
    rows: DataFrame, path: str, checkpoint: str, time: str, group: str, value: str, late: dt.timedelta = dt.timedelta(hours=1)
) -> StreamingQuery:
    """Hourly totals of a stream together with what came too late for them, so that both add up to all rows.

    Every micro-batch writes what it adds to each hour, as its own slice, marked late where the hour had ended ``late`` before
    the latest moment seen in earlier batches. A batch's slice and the moment it leaves behind are replaced when the batch is
    repeated. No state is kept but these; read the slices with ``totals``. Rows without a moment count as late.
    """
    spark = rows.sparkSession
    files = Files(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = files.names(f"{path}/latest")
        before = [files.text(f"{path}/latest/{name}") for name in seen if int(name) < batch_id]
        limit = max((dt.datetime.fromisoformat(text) for text in before if text), default=None)
        hour = F.date_trunc("hour", F.col(time)).cast("timestamp_ntz")
        closed = F.lit(False) if limit is None else hour + F.make_interval(hours=F.lit(1)) <= F.lit(limit - late)
        sums = F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_sum")
        added = batch.groupBy(hour.alias("hour_start"), F.col(group), F.coalesce(closed, F.lit(True)).alias("is_late")).agg(F.count("*").alias("sales"), sums)
        added.write.mode("overwrite").parquet(f"{path}/slices/batch_id={batch_id}")
        latest = batch.agg(F.max(F.col(time).cast("timestamp_ntz"))).first()[0]
        files.delete(f"{path}/latest/{batch_id:012d}")
        files.create(f"{path}/latest/{batch_id:012d}", "" if latest is None else latest.isoformat())

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Totals by hour and group, in time and late apart."""
    slices = spark.read.parquet(f"{path}/slices")
    sums = F.sum("sales").alias("sales"), F.sum("value_sum").cast("decimal(38,2)").alias("value_sum")
    return slices.groupBy("hour_start", group, "is_late").agg(*sums)
