"""Data-quality and service-level reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.rounding import ratio_half_up
from salesmart.plans.runlog import duration_seconds
from salesmart.schema import DUPLICATE, FAIL, PASS, RUNNING
from salesmart.sources.landing import parse_file_name

# Service-level targets and alert thresholds.
REJECT_PCT, DUPLICATE_PCT = 5, 3
DEADLINE_HOUR = 7
MISSING_ALERT, DURATION_ALERT_SECONDS = 2, 30 * 60


def _percent(part: str, whole: str) -> Column:
    return ratio_half_up(F.col(part) * 100, F.col(whole), top_digits=0)


def by_file(validated: DataFrame) -> DataFrame:
    status = F.col("validation_status")
    return validated.groupBy("source_file").agg(
        F.count("*").alias("total_rows"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == FAIL).alias("failed"),
        F.count_if(F.col("rejection_reason") == DUPLICATE).alias("duplicates"),
    )


def rejection_rate(validated: DataFrame) -> DataFrame:
    return (
        by_file(validated)
        .select("source_file", "total_rows", "passed", "failed", _percent("failed", "total_rows").alias("rejection_rate_pct"))
        .orderBy(F.desc("rejection_rate_pct"), "source_file")
    )


def _failed(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("validation_status") == FAIL)


def reasons(validated: DataFrame, by_code: bool = False) -> DataFrame:
    """Failed rows per reason text, or per rule code (texts carry the offending value)."""
    reason = F.split("rejection_reason", ":")[0] if by_code else F.col("rejection_reason")
    return (
        _failed(validated)
        .groupBy(reason.alias("rejection_reason"))
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "rejection_reason")
    )


def reasons_by_file(validated: DataFrame) -> DataFrame:
    return (
        _failed(validated)
        .groupBy("source_file", "rejection_reason")
        .agg(F.count("*").alias("rejected_rows"))
        .orderBy(F.desc("rejected_rows"), "source_file", "rejection_reason")
    )


def dup_by_file(validated: DataFrame) -> DataFrame:
    return (
        validated.where(F.col("rejection_reason") == DUPLICATE)
        .groupBy("source_file")
        .agg(F.count("*").alias("duplicate_rows"))
        .orderBy(F.desc("duplicate_rows"), "source_file")
    )


def missing_history(missing_log: DataFrame) -> DataFrame:
    return missing_log.select("run_date", "store_id", "expected_file", "logged_at").orderBy(F.desc("run_date"), "store_id")


def stuck_runs(runs: DataFrame, now: Column) -> DataFrame:
    """Runs still marked RUNNING more than an hour after they began."""
    return runs.where((F.col("status") == RUNNING) & (F.col("pipeline_start") < now - F.make_interval(hours=F.lit(1))))


def sla_report(runs: DataFrame, files: DataFrame) -> DataFrame:
    """One row per run: targets met and alerts raised. Rates are judged per store file (``by_file`` rows), worst one counts."""
    _, day = parse_file_name(F.col("source_file"))
    per_day = (
        files.withColumn("run_date", day)
        .groupBy("run_date")
        .agg(
            F.max(_percent("failed", "total_rows")).alias("worst_rejection_pct"),
            F.max(_percent("duplicates", "total_rows")).alias("worst_duplicate_pct"),
            F.count_if(F.col("failed") * 100 >= F.col("total_rows") * REJECT_PCT).alias("stores_over_rejection"),
            F.count_if(F.col("duplicates") * 100 >= F.col("total_rows") * DUPLICATE_PCT).alias("stores_over_duplicates"),
        )
    )
    deadline = F.col("run_date").cast("timestamp_ntz") + F.make_interval(days=F.lit(1), hours=F.lit(DEADLINE_HOUR))
    absent = F.coalesce("files_missing", F.lit(0))
    seconds = duration_seconds(F.col("pipeline_start"), F.col("pipeline_end"))
    on_time = F.coalesce((F.col("status") == "SUCCESS") & (F.col("pipeline_end") <= deadline), F.lit(False))
    return runs.join(per_day, "run_date", "left").select(
        "run_id",
        "run_date",
        "status",
        on_time.alias("completed_on_time"),
        "worst_rejection_pct",
        "worst_duplicate_pct",
        F.coalesce("stores_over_rejection", F.lit(0)).alias("stores_over_rejection"),
        F.coalesce("stores_over_duplicates", F.lit(0)).alias("stores_over_duplicates"),
        (absent == 0).alias("no_file_missing"),
        (absent > MISSING_ALERT).alias("missing_alert"),
        F.coalesce(seconds > DURATION_ALERT_SECONDS, F.lit(False)).alias("duration_alert"),
    )


def freshness(fact: DataFrame) -> DataFrame:
    """Latest business day in the fact and when it was loaded."""
    return fact.agg(F.max("date_key").alias("latest_date_key"), F.max("loaded_at").alias("latest_load"))
