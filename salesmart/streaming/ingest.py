"""Near-real-time ingest: micro-batches through the same validation and load as the daily run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmart import schema
from salesmart.operators import staging
from salesmart.operators.ids import number_lines
from salesmart.plans.daily import Settings, validate_and_load
from salesmart.sources import landing
from salesmart.sources.warehouse import Warehouse
from salesmart.storage import Scratch


def stream_pos_csv(
    spark: SparkSession, root: str, glob: str = "*.csv", encoding: str = "UTF-8", archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Store files of one encoding as a stream (``glob`` picks its files); ``stream_stores`` joins several.

    A stream binds columns by position, so headers are checked against the standard order and a file
    with another order stops the stream. With ``archive``, a batch's files move there once a later
    batch has been committed.
    """
    reader = (
        spark.readStream.schema(schema.POS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("recursiveFileLookup", True)  # the date folders below the root
        .option("pathGlobFilter", glob)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(root).select(
        "*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("file_block")
    )


def stream_stores(
    spark: SparkSession, root: str, stores: list[str], encodings: dict[str, str] | None = None, **options
) -> DataFrame:
    """The files of all ``stores`` as one stream, whatever their encodings, so that one query loads them."""
    groups: dict[str, list[str]] = {}
    for store in stores:
        groups.setdefault((encodings or {}).get(store, "UTF-8"), []).append(store)
    parts = [
        stream_pos_csv(spark, root, f"{{{','.join(sorted(group))}}}_sales_*.csv", encoding, **options)
        for encoding, group in sorted(groups.items())
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def stream_files(spark: SparkSession, root: str, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Store files below ``root`` as a stream of their places; each is read within its micro-batch, as the daily run reads it.

    So a file's columns are taken by its own header, whatever their order, its store's encoding counts, and one
    stream takes all stores. With ``archive``, a batch's files move there once a later batch has been committed.
    """
    kinds = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(kinds).option("recursiveFileLookup", True).option("pathGlobFilter", "*_sales_*.csv")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    store, _ = landing.parse_file_name(F.element_at(F.split("path", "/"), -1))
    return reader.load(root).select("path", store.alias("store_id")).where("store_id is not null")


def read_batch(files: DataFrame, settings: Settings) -> DataFrame | None:
    """Rows of a micro-batch of ``stream_files``: one row a file comes to the driver, as in the daily run."""
    places = [(row.path, row.store_id) for row in files.collect()]
    return landing.read_files(files.sparkSession, places, settings.encodings, settings.line_breaks) if places else None


def stage_batch(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Number the rows of one micro-batch by file and line and stage them."""
    placed = rows if "file_row" in rows.columns else rows.withColumn("file_row", F.monotonically_increasing_id())
    return number_lines(scratch.table(staging.stage(placed), "landed"), "stg_id")


def start_load(
    rows: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    settings: Settings | None = None,
    staged: bool = False,
    name: str = "stream",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Validate and load every micro-batch of ``rows`` (of ``stream_files``, ``stream_stores`` or ``stream_pos_csv``).

    A batch is a load named after the stream and its batch id; repeated after a failure, it replaces its earlier commit
    and ignores that one's ids, so the tables are the same. ``name`` belongs to the
    ``checkpoint`` that first used it; another stream needs a name of its own. ``trigger`` is for
    ``DataStreamWriter.trigger``; by default what is there is loaded and the query ends.
    """
    settings = settings or Settings(raw="")
    warehouse.claim(name, checkpoint)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        scratch = Scratch(warehouse.spark, f"batch-{batch_id}")
        try:
            if "path" in batch.columns:
                batch = read_batch(batch, settings)
                if batch is None:
                    return
            table = scratch.table(batch, "staged") if staged else stage_batch(batch, scratch)
            validate_and_load(warehouse, table, f"{name}-{batch_id}", scratch, settings)
        finally:
            scratch.drop()

    return (
        rows.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
