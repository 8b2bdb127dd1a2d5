"""Trip files in, trip datasets and result sets out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.functions import columns as C
from curbline.operators import clean
from curbline.sources import cells

ROWS_PER_FILE = 5_000_000
LOAD_PARTITIONS = ["year", "month", "load_id"]


def read_csv(spark: SparkSession, path, repair: bool = False) -> DataFrame:
    """Vendor CSV: header line, fixed schema, empty cell = NULL.

    A cell that does not parse becomes NULL and its row is kept. With ``repair`` it is
    first read in the other ways of ``cells.links`` (``1.0`` as a whole number, say).
    ``path`` may be a file, a folder, a glob or a list of them; all are one scan.
    """
    if repair:
        return cells.typed(read_csv_text(spark, path))
    return _csv_options(spark.read.schema(S.TRIP_SCHEMA)).csv(path)


def read_csv_text(spark: SparkSession, path) -> DataFrame:
    """The same scan with every cell as text, for ``cells.typed`` and ``cells.cell_report``."""
    return _csv_options(spark.read.schema(cells.as_text())).csv(path)


FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def files_of(listing: DataFrame, drop_root: str | None = None) -> DataFrame:
    """(load_id, path, length, modified) of a scan of whole files; no content is read."""
    named = load_id_of(F.col("_metadata.file_path"), drop_root).alias("load_id")
    modified = F.unix_micros("_metadata.file_modification_time").alias("modified")
    return listing.select(named, "path", F.col("_metadata.file_size").alias("length"), modified)


def csv_files(spark: SparkSession, path, drop_root: str | None = None) -> DataFrame:
    """Files that ``read_csv`` of the same path would scan, also those without a row."""
    return files_of(spark.read.format("binaryFile").load(path), drop_root)


def stream_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """CSV files as they arrive in a folder, a row a file."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return files_of(reader.load(folder))


def _csv_options(reader):
    return reader.option("header", True).option("nullValue", "").option("emptyValue", "").option("mode", "PERMISSIVE")


def stream_csv(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same scan over files as they arrive in a folder."""
    reader = _csv_options(spark.readStream.schema(S.TRIP_SCHEMA)).option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_load_id(reader.csv(folder))


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/+", "/")


def load_id_of(path: Column, drop_root: str | None = None) -> Column:
    """Load a file stands for: its name and a digest of its path, so that files of one
    name in different folders are different loads. The path counts from ``drop_root``
    on, if that is given: a drop that moves as a whole keeps its loads."""
    plain = _plain(path)
    if drop_root is not None:
        root = F.concat(F.regexp_replace(_plain(F.lit(drop_root)), "/+$", ""), F.lit("/"))
        plain = F.when(F.startswith(plain, root), F.substring(plain, F.length(root) + 1, F.length(plain))).otherwise(plain)
    return F.concat_ws("~", F.substring_index(plain, "/", -1), F.substring(F.md5(plain), 1, 16))


def with_load_id(scanned: DataFrame, drop_root: str | None = None) -> DataFrame:
    """Name the file each row came from; only valid directly on a file scan."""
    return scanned.select(*scanned.columns, load_id_of(F.col("_metadata.file_path"), drop_root).alias("load_id"))


def with_listed_load_id(scanned: DataFrame, path, drop_root: str | None = None) -> DataFrame:
    """``with_load_id`` of a scan of ``path``, by looking up its listing: a load is worked
    out once a file, not once a row, and a row a file goes to every task. Only a file that
    came after the listing has it worked out by row."""
    files = scanned.sparkSession.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    loads = files.distinct().select("_file", load_id_of(F.col("_file"), drop_root).alias("_load"))
    rows = scanned.select(*scanned.columns, F.col("_metadata.file_path").alias("_file"))
    named = F.coalesce("_load", load_id_of(F.col("_file"), drop_root)).alias("load_id")
    return rows.join(F.broadcast(loads), "_file", "left").select(*scanned.columns, named)


def scan_csv(spark: SparkSession, path, drop_root: str | None = None, repair: bool = False) -> DataFrame:
    """``read_csv`` with the load each row belongs to."""
    if repair:
        return cells.typed(with_listed_load_id(read_csv_text(spark, path), path, drop_root))
    return with_listed_load_id(read_csv(spark, path), path, drop_root)


def _with_month(trips: DataFrame) -> DataFrame:
    return trips.withColumns({"year": F.year(C.PICKUP), "month": F.month(C.PICKUP)})


def write_partitioned(
    df: DataFrame, path: str, partition_by, dynamic: bool = False, gather: bool = True, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Parquet, one folder per partition value, at most ``rows_per_file`` rows a file.

    Gathering brings a partition's rows together so files are not tiny; the
    ``rebalance`` hint lets adaptive execution split a partition that is too big
    for one task, such as a month holding a third of all trips. Without it every
    task writes what it read, and nothing is shuffled.
    """
    writer = (
        (df.hint("rebalance", *partition_by) if gather else df)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
    )
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def ingest_csv(
    spark: SparkSession,
    csv_path,
    output_path: str,
    partition_by=("year", "month"),
    gather: bool = True,
    repair: bool = False,
) -> DataFrame:
    """CSV to partitioned Parquet; returns the written dataset.

    Rows of a partition are gathered, as files may hold any months. Where each file
    holds one month, ``gather=False`` saves the shuffle.
    """
    rows = _with_month(scan_csv(spark, csv_path, repair=repair))
    write_partitioned(rows, output_path, list(partition_by), gather=gather)
    return spark.read.parquet(output_path)


def ingest_folder(spark: SparkSession, input_dir: str, output_dir: str, repair: bool = False) -> DataFrame:
    """Every ``*.csv`` of a folder into one dataset, in one scan.

    A folder without CSV files is an error (path not found).
    """
    return ingest_csv(spark, f"{input_dir.rstrip('/')}/*.csv", output_dir, repair=repair)


def load_report(trips: DataFrame) -> DataFrame:
    """Rows per (year, month), in order, with the total beside them.

    Run it on the written dataset: the counts then come from file footers and
    the CSV is not parsed again.
    """
    months = trips.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())
    return months.withColumn("total_rows", total).orderBy("year", "month")


def write_cleaned(raw: DataFrame, path: str, limits: dict = S.CLEANING_LIMITS) -> None:
    """Clean raw trips that carry a ``load_id`` and write them by year, month and load."""
    write_partitioned(cleaned_rows(raw, limits), path, LOAD_PARTITIONS)


def cleaned_rows(raw: DataFrame, limits: dict = S.CLEANING_LIMITS) -> DataFrame:
    return clean.clean_trips(raw, limits).select(*S.CLEANED_SCHEMA.fieldNames())


def read_cleaned(spark: SparkSession, path: str, folders=None) -> DataFrame:
    """Cleaned trips. The schema is given, so load ids stay text and no footer is
    opened to infer it; filters on year, month and load_id prune folders. With
    ``folders`` (below ``path``) only these are listed and read."""
    reader = spark.read.schema(S.CLEANED_SCHEMA)
    return reader.parquet(path) if folders is None else reader.option("basePath", path).parquet(*folders)


def write_results(results: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each named result set as JSON lines in its own folder. They are small and do not
    depend on each other, so a few are written at the same time."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in results}
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(df.write.mode("overwrite").json, paths[name]) for name, df in results.items()]:
            done.result()
    return paths


def export_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV with a header line per part file."""
    df.write.mode("overwrite").option("header", True).csv(path)
