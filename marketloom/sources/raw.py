"""Raw documents: one JSON object per symbol and run date, with a records array."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.schemas import RAW_ARRAY, RAW_STRUCT

# Folder of each raw data set below the raw root.
RAW_FOLDERS = {
    "equity": ("equities", "yahoo"),
    "crypto": ("crypto", "binance"),
    "fx": ("fx", "yahoo"),
}


def safe_symbol(symbol: Column) -> Column:
    """File name form of a symbol."""
    return F.replace(symbol, F.lit("/"), F.lit("_"))


def partition_folder(root: str, folder: str, source: str, run_date: str) -> str:
    return f"{root}/{folder}/source={source}/date={run_date}"


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, multi_line: bool = True
) -> DataFrame:
    """Documents with their source file path.

    ``multi_line`` reads one indented document per file; without it every line
    is a document, so that large files can be split over tasks.
    """
    reader = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "*.json")
        # The folder's source=/date= names must not override the document's own fields.
        .option("recursiveFileLookup", True)
    )
    documents = reader.json(paths)
    return documents.select("*", F.col("_metadata.file_path").alias("bronze_file_path"))


def _read_partition(
    spark: SparkSession, kind: str, root: str, run_date: str, schema: StructType, multi_line: bool
) -> DataFrame:
    folder, source = RAW_FOLDERS[kind]
    path = partition_folder(root, folder, source, run_date)
    message = f"No {kind} JSON files found for {run_date} in {path}"
    try:
        documents = read_documents(spark, path, schema, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(message) from error
    if documents.select("bronze_file_path").isEmpty():
        raise ValueError(message)
    return documents


def read_equity_documents(
    spark: SparkSession, root: str, run_date: str, multi_line: bool = True
) -> DataFrame:
    return _read_partition(spark, "equity", root, run_date, RAW_STRUCT, multi_line)


def read_crypto_documents(
    spark: SparkSession, root: str, run_date: str, multi_line: bool = True
) -> DataFrame:
    return _read_partition(spark, "crypto", root, run_date, RAW_ARRAY, multi_line)


def read_fx_documents(
    spark: SparkSession, root: str, run_date: str, multi_line: bool = True
) -> DataFrame:
    return _read_partition(spark, "fx", root, run_date, RAW_STRUCT, multi_line)


def complete(
    documents: DataFrame, start_date: str | None, end_date: str | None, interval: str
) -> DataFrame:
    """Documents with all top-level fields that validation expects, in their usual order."""
    given = {"start_date": start_date, "end_date": end_date, "interval": interval}
    missing = {k: F.lit(v).cast("string") for k, v in given.items() if k not in documents.columns}
    fields = ["source", "symbol", *given, "records"]
    others = [c for c in documents.columns if c not in fields]
    return documents.withColumns(missing).select(*fields, *others) if missing else documents


def write_documents(
    documents: DataFrame,
    root: str,
    kind: str,
    run_date: str,
    start_date: str | None = None,
    end_date: str | None = None,
    interval: str = "1d",
    per_symbol: bool = False,
    mode: str = "overwrite",
) -> str:
    """Land complete documents as JSON Lines in the run's ``source=/date=`` folder.

    Lines are found by the symbol they hold (``validate.validate_lines``). Landing again replaces
    the folder's documents. With ``per_symbol`` there is a folder per symbol, and only those of
    the symbols landed are replaced; that means a file per symbol, so it is for small universes.
    """
    folder, source = RAW_FOLDERS[kind]
    path = partition_folder(root, folder, source, run_date)
    documents = complete(documents, start_date, end_date, interval)
    if per_symbol:
        keyed = documents.withColumn("file", safe_symbol(F.col("symbol")))
        writer = keyed.write.partitionBy("file").option("partitionOverwriteMode", "dynamic")
    else:
        writer = documents.write
    # A null end date must stay a field.
    writer.option("ignoreNullFields", False).mode(mode).json(path)
    return path


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, as a URI or absolute, and the path in it."""
    place = path.removeprefix("file:")
    return fs.FileSystem.from_uri("/" + place.lstrip("/") if place.startswith("/") else place)


def _put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: set[str] = set()
    for batch in batches:
        contents = batch["content"].to_pylist()
        for path, content in zip(batch["path"].to_pylist(), contents, strict=True):
            files, place = file_system(path)
            if content is None:
                files.create_dir(place)
                continue
            folder, name = place.rsplit("/", 1)
            if folder not in made:
                files.create_dir(folder)
                made.add(folder)
            # Under another name until it is whole, so that a repeated task finds no half of it.
            unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(unfinished) as out:
                out.write(content)
            files.move(unfinished, place)
        yield batch.select(["path"])


def write_files(files: DataFrame) -> int:
    """Land files (path, content binary) under the very names given; returns how many.

    Null content makes a folder; a repeated path keeps one of its contents. Tasks write their own
    rows, to a file system known to pyarrow.
    """
    named = files.select("path", F.col("content").cast("binary").alias("content"))
    return named.dropDuplicates(["path"]).mapInArrow(_put, "path string").count()
