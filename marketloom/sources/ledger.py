"""A ledger of raw files read, so that a rerun reads new or changed files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "path string, size long, modified timestamp"


def listed(spark: SparkSession, folders: list[str], pattern: str = "*.json") -> DataFrame:
    """(path, size, modified) of the files below ``folders``, without reading them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", True).load(folders).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def unread(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger does not hold in this size and of this time."""
    return files.join(ledger, ["path", "size", "modified"], "left_anti")


def record(files: DataFrame, ledger_path: str) -> None:
    """Add files to the ledger; do so once what was read of them is written."""
    files.select("path", "size", "modified").write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger, empty before the first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], FILE)
    return spark.read.schema(FILE).parquet(ledger_path)


def lines_of(
    spark: SparkSession, folders: list[str], files: DataFrame, pattern: str = "*.json"
) -> DataFrame:
    """(path, value): the lines of ``files``, which lie below ``folders``.

    Files older than the oldest wanted are left out when Spark lists them, the others by a join.
    ``files`` is read twice, so hand in a table.
    """
    # As text of the session's time zone, which the reader takes it in.
    before = F.min("modified") - F.expr("INTERVAL 1 SECOND")
    since = files.agg(F.date_format(before, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if since is not None:
        zone = spark.conf.get("spark.sql.session.timeZone")
        reader = reader.option("modifiedAfter", since).option("timeZone", zone)
    place = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    lines = reader.text(folders).select(place.alias("path"), "value")
    wanted = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    return lines.join(wanted, "path", "left_semi")
