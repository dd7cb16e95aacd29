"""Listing of landed files, and what their first bytes say about their columns."""

import gzip
import io
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import file_system

FILES_PER_TASK = 200


def list_files(spark: SparkSession, roots: list[str], pattern: str) -> DataFrame:
    """``path``, ``folder``, ``modified`` and ``bytes`` of the files below ``roots``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = reader.option("pathGlobFilter", pattern).load(roots)
    return found.select(
        "path",
        F.regexp_replace("path", r"/[^/]*$", "").alias("folder"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def scoped_folders(spark: SparkSession, root: str, column: str, values) -> list[str]:
    """The folders of the wanted values of a table's first partition column, those that exist."""
    system, place = file_system(spark, root)
    folders = [f"{root}/{column}={value}" for value in values]
    return [folder for folder in folders if system.exists(place(folder))]


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a table's first partition column, from the names of its folders."""
    system, place = file_system(spark, root)
    names = [entry.getPath().getName() for entry in system.listStatus(place(root))]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def open_part(path: str):
    """A landed file, opened in a task."""
    uri = path if "://" in path else path.replace("file:/", "file:///", 1)
    system, inner = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(inner)


def first_line(path: str) -> str:
    """First line of a text file, plain or gzip."""
    with open_part(path) as raw:
        stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        return io.TextIOWrapper(io.BufferedReader(stream), "utf-8-sig", newline="").readline().rstrip("\r\n")


def signed_files(files: DataFrame, signature: Callable[[str], str]) -> DataFrame:
    """The files with their ``signature``, taken in tasks."""

    def signed(batches):
        for batch in batches:
            yield batch.assign(signature=[signature(p) for p in batch["path"]])

    tasks = max(1, files.count() // FILES_PER_TASK)
    columns = files.select("path", "folder", "modified", "bytes")
    return columns.repartition(tasks).mapInPandas(signed, "path string, folder string, modified timestamp, bytes bigint, signature string")


def by_signature(files: DataFrame, signature: Callable[[str], str]) -> dict[str, list[str]]:
    """Signature -> the folders whose files all have it, and single files of the other folders.

    Files that come with a ``signature`` are not opened.  What comes to the driver is one row per folder;
    paths of files only where a folder is mixed, which is the exception.
    """
    known = files.where("signature IS NOT NULL") if "signature" in files.columns else files.limit(0).withColumn("signature", F.lit(""))
    unknown = files.where("signature IS NULL").drop("signature") if "signature" in files.columns else files
    marked = known.select("path", "folder", "signature")
    if not unknown.isEmpty():
        marked = marked.unionByName(signed_files(unknown, signature).select("path", "folder", "signature"))
    kinds = marked.groupBy("folder").agg(
        F.min("signature").alias("signature"),
        F.when(F.min("signature") != F.max("signature"), F.collect_list(F.struct("path", "signature"))).alias("files"),
    )
    groups: dict[str, list[str]] = {}
    for row in kinds.sort("folder").toLocalIterator():
        members = [(row["folder"], row["signature"])] if row["files"] is None else sorted(map(tuple, row["files"]))
        for path, kind in members:
            groups.setdefault(kind, []).append(path)
    return groups
