"""Store files: which are expected, which arrived, and reading them."""

from __future__ import annotations

import codecs
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.schema import POS_COLUMNS
from salesmart.sources.files import Files

# Fixed pattern: <store_id>_sales_<yyyy-mm-dd>.csv
FILE_NAME = r"^(.+?)_sales_(\d{4}-\d{2}-\d{2})\.csv$"
# Headers are read by so many threads at a time, and where they need the parser by as many small jobs.
HEADER_JOBS = 16


class NoInputFiles(FileNotFoundError):
    """Not one store file arrived for the date."""


def file_name(store_id: Column, business_date: Column) -> Column:
    return F.concat(store_id, F.lit("_sales_"), F.date_format(business_date, "yyyy-MM-dd"), F.lit(".csv"))


def parse_file_name(name: Column) -> tuple[Column, Column]:
    """Store id and business date of a file name; NULL where the name has another form."""
    store = F.nullif(F.regexp_extract(name, FILE_NAME, 1), F.lit(""))
    date = F.nullif(F.regexp_extract(name, FILE_NAME, 2), F.lit("")).try_cast("date")
    return store, date


def expected_files(dim_store: DataFrame, start: str | dt.date, end: str | dt.date | None = None) -> DataFrame:
    """One row per active store and day."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end or start)).cast("date"))
    grid = dim_store.where("is_active").select("store_id", F.explode(days).alias("business_date"))
    return grid.withColumn("expected_file", file_name(F.col("store_id"), F.col("business_date")))


def missing_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected files that did not arrive; ``found`` has store_id and business_date."""
    arrived = found.select("store_id", "business_date").distinct()
    return expected.join(arrived, ["store_id", "business_date"], "left_anti")


def list_arrivals(spark: SparkSession, root: str, date: str | dt.date) -> DataFrame:
    """Files in the day's folder, from the file listing alone (contents are not read)."""
    return _listed(spark, [f"{root.rstrip('/')}/{date}"], f"*_sales_{date}.csv")


def list_range(spark: SparkSession, root: str, dates: list[dt.date]) -> DataFrame:
    """Files in the folders of several days, each with its own day in its name."""
    files = _listed(spark, [f"{root.rstrip('/')}/{date}" for date in dates], "*_sales_*.csv")
    return files.where(F.element_at(F.split("path", "/"), -2) == F.col("business_date").cast("string"))


def _listed(spark: SparkSession, folders: list[str], pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folders).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    store, day = parse_file_name(name)
    return files.select("path", name.alias("source_file"), store.alias("store_id"), day.alias("business_date"), "length", "modificationTime")


def _reader(spark: SparkSession, encoding: str, line_breaks: bool):
    return spark.read.option("multiLine", line_breaks).option("encoding", encoding).option("escape", '"').option("mode", "PERMISSIVE")


def read_header(spark: SparkSession, path: str, encoding: str, line_breaks: bool = True) -> list[str]:
    """The first record of a file, read by the same parser as the rest; reading stops after it."""
    first = _reader(spark, encoding, line_breaks).option("header", False).csv(path).head()
    names = [] if first is None else [value or "" for value in first]
    return [name.strip("\r\n").removeprefix("\ufeff") for name in names]


def plain_header(files: Files, path: str, encoding: str) -> list[str] | None:
    """The names in a file's first line, from its first bytes; None where that takes a parser: quotes, a blank first
    line, line ends of another kind, or an encoding that is not known here."""
    size = 4096
    while True:
        head = files.head(path, size)
        try:
            text = codecs.getincrementaldecoder(encoding)().decode(head)
        except (LookupError, UnicodeError):
            return None
        line, end, _ = text.partition("\n")
        if end or len(head) < size:
            line = line.removesuffix("\r").removeprefix("\ufeff")
            return None if not line.strip() or '"' in line or "\r" in line else line.split(",")
        size *= 16


def header_of(spark: SparkSession, files: Files, path: str, encoding: str, line_breaks: bool) -> tuple[str, ...]:
    return tuple(plain_header(files, path, encoding) or read_header(spark, path, encoding, line_breaks))


def read_pos_csv(spark: SparkSession, paths: list[str], encoding: str = "UTF-8", line_breaks: bool = True) -> DataFrame:
    """Rows of the files with the eleven columns taken by header name, whatever their order.

    Columns a file lacks are NULL, extra ones are ignored, and of a repeated name the last column counts.
    ``file_block`` and ``file_row`` order the lines of a file. ``line_breaks=False`` lets Spark split big files
    between tasks; use it where no field holds a line break.
    """
    files = Files(spark)
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        headers = list(pool.map(lambda path: header_of(spark, files, path, encoding, line_breaks), paths))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        by_header.setdefault(header, []).append(path)
    parts = []
    for header, group in by_header.items():
        place = {name: i for i, name in enumerate(header)}
        columns = [(F.col(f"_c{place[name]}") if name in place else F.lit(None).cast("string")).alias(name) for name in POS_COLUMNS]
        kinds = ", ".join(f"_c{i} string" for i in range(max(len(header), 1)))
        rows = _reader(spark, encoding, line_breaks).schema(kinds).option("header", True).option("enforceSchema", True).csv(group)
        parts.append(
            rows.select(
                *columns,
                F.col("_metadata.file_name").alias("source_file"),
                F.col("_metadata.file_block_start").alias("file_block"),
                F.monotonically_increasing_id().alias("file_row"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_landing(
    spark: SparkSession, root: str, date: str | dt.date, encodings: dict[str, str] | None = None, line_breaks: bool = True
) -> DataFrame:
    """All store files of one date; ``encodings`` names the stores that do not send UTF-8.

    A file is read by one task, since quoted fields may hold line breaks, unless ``line_breaks=False`` says that this
    feed has none. The size of a file plays no part.
    """
    encodings = encodings or {}
    try:
        arrivals = list_arrivals(spark, root, date).where("store_id is not null").select("path", "store_id").collect()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        arrivals = []
    if not arrivals:
        raise NoInputFiles(f"no store files under {root}/{date}")
    return read_files(spark, [(row.path, row.store_id) for row in arrivals], encodings, line_breaks)


def read_files(spark: SparkSession, files: list[tuple[str, str]], encodings: dict[str, str] | None = None, line_breaks: bool = True) -> DataFrame:
    """Rows of (path, store) files, each in its store's encoding and with columns taken by its own header."""
    groups: dict[str, list[str]] = {}
    for path, store in files:
        groups.setdefault((encodings or {}).get(store, "UTF-8"), []).append(path)
    out = None
    for encoding, paths in sorted(groups.items()):
        part = read_pos_csv(spark, sorted(paths), encoding, line_breaks)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
