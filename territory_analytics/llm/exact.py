"""Exact duplicates by an extendible-hash index on shared files.

Texts are addressed by the leading bits of a 64-bit hash.  The directory starts with one bucket; a
bucket that holds more than its capacity is split by the next bit, and where it already used all bits of
the directory, the directory doubles.  Every bucket becomes a folder of the index, written in the order
of the hash.  An owner task per bucket streams its files: entries of one hash are chained and compared
byte by byte, so two texts count as equal only if they are.

Copies are combined before they leave the task that reads them (one entry per text and ``COMBINE_BYTES``
of different texts), so the owner of a very frequent text gets few entries, and it holds one chain at a
time.
"""

import heapq
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..storage import durable, scratch_path
from .common import small_batches, table, text_bytes
from .files import open_file

#: Bytes of texts in a bucket; fewer where that gives less than one bucket per shuffle partition.
BUCKET_BYTES = 32 << 20
#: Bytes of different texts that a reading task holds to combine their copies.
COMBINE_BYTES = 16 << 20
#: The directory can double so often beyond what evenly filled buckets need.
SPARE_BITS = 3
SEED = 42


class Directory:
    """Leading bits of the hash -> bucket, grown by doubling.

    ``loads`` has the bytes of each cell, the finest split that the directory may come to.  A bucket
    that is overfull as a single cell stays so.
    """

    def __init__(self, loads: np.ndarray, capacity: int):
        cell_bits = int(len(loads)).bit_length() - 1
        upto = np.concatenate([[0], np.cumsum(loads, dtype=np.int64)])
        self.bits, self.entries = 0, np.zeros(1, np.int32)
        self.buckets = [(0, 0)]  # (leading bits, how many)
        waiting = [0]
        while waiting:
            number = waiting.pop()
            prefix, depth = self.buckets[number]
            width = cell_bits - depth
            load = upto[(prefix + 1) << width] - upto[prefix << width]
            if load <= capacity or depth == cell_bits:
                continue
            if depth == self.bits:
                self.bits, self.entries = self.bits + 1, np.repeat(self.entries, 2)
            self.buckets[number] = (prefix * 2, depth + 1)
            self.buckets.append((prefix * 2 + 1, depth + 1))
            upper = len(self.buckets) - 1
            span = self.bits - depth - 1
            self.entries[(prefix * 2 + 1) << span : (prefix * 2 + 2) << span] = upper
            waiting += [number, upper]

    def bucket(self, hashed: int) -> int:
        """Bucket of an unsigned 64-bit hash."""
        return int(self.entries[hashed >> (64 - self.bits)]) if self.bits else 0


def _directory(members: DataFrame) -> Directory:
    """Directory for the different hashes of ``members`` (``hash``, ``n_bytes``).

    What comes to the driver is one sum per cell, some 2**SPARE_BITS cells for a bucket.
    """
    different = members.groupBy("hash").agg(F.max("n_bytes").alias("n_bytes"))
    total = members.agg(F.sum("n_bytes")).first()[0] or 0
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    capacity = max(1, min(BUCKET_BYTES, total // partitions))
    bits = (total // capacity).bit_length() + SPARE_BITS
    cell = F.shiftrightunsigned(F.col("hash"), 64 - bits)
    sums = different.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("load")).toPandas()
    loads = np.zeros(1 << bits, np.int64)
    loads[sums["cell"].to_numpy(np.int64)] = sums["load"].to_numpy(np.int64)
    return Directory(loads, capacity)


_ENTRY = pa.schema(
    [
        ("bucket", pa.int32()), ("hash", pa.int64()), ("text", pa.binary()),
        ("last_id", pa.int64()), ("copies", pa.int64()),
    ]
)


def _combined(directory: Directory):
    """Function that turns (id, text) rows into entries, one for all copies it has at hand."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                entry = seen.get(text)
                if entry is None:
                    seen[text] = [doc_id, 1]
                    held += len(text) + 200
                    if held > COMBINE_BYTES:
                        yield from entries(seen)
                        seen, held = {}, 0
                else:
                    entry[0] = _larger(entry[0], doc_id)
                    entry[1] += 1
        yield from entries(seen)

    def entries(seen: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        texts = list(seen)
        for k in range(0, len(texts), 500):
            part = texts[k : k + 500]
            hashes = [xxhash.xxh64_intdigest(t, SEED) for t in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([directory.bucket(h) for h in hashes], pa.int32()),
                    pa.array(np.array(hashes, np.uint64).view(np.int64)),
                    pa.array(part, pa.binary()),
                    pa.array([seen[t][0] for t in part], pa.int64()),
                    pa.array([seen[t][1] for t in part], pa.int64()),
                ],
                schema=_ENTRY,
            )

    return combine


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def write_index(rows: DataFrame, directory: Directory, folder: str) -> None:
    """Entries of (id, text) rows as Parquet, a folder per bucket, ordered by hash."""
    entries = rows.mapInArrow(_combined(directory), "bucket int, hash long, text binary, last_id long, copies long")
    ordered = entries.repartition("bucket").sortWithinPartitions("bucket", "hash")
    ordered.write.partitionBy("bucket").parquet(folder)


def _entries_of(path: str) -> Iterator[tuple]:
    with open_file(path) as file:
        for batch in pq.ParquetFile(file).iter_batches(200, columns=["hash", "text", "last_id", "copies"]):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


_CLASS = pa.schema(
    [("hash", pa.int64()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())]
)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of equal texts of whole buckets."""
    from hashlib import sha256

    for batch in batches:
        for paths in batch.column(0).to_pylist():
            ordered = heapq.merge(*(_entries_of(p) for p in paths), key=itemgetter(0))
            rows = []
            for hashed, entries in groupby(ordered, itemgetter(0)):
                chain: list[list] = []
                for _, text, last_id, copies in entries:
                    for link in chain:
                        if link[0] == text:
                            link[1], link[2] = _larger(link[1], last_id), link[2] + copies
                            break
                    else:
                        chain.append([text, last_id, copies])
                digests = [sha256(text).digest() for text, _, _ in chain]
                if len(set(digests)) < len(chain):
                    raise ValueError("two different texts have one SHA-256")
                rows += [(hashed, d, link[1], link[2]) for d, link in zip(digests, chain, strict=True)]
                if len(rows) >= 5_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _CLASS]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CLASS, strict=True)], schema=_CLASS)


def classes(spark, folder: str) -> DataFrame:
    """``hash``, ``sha``, ``keep_id``, ``group_size`` of every different text of an index."""
    files = spark.read.parquet(folder).select("bucket", F.col("_metadata.file_path").alias("path")).distinct()
    buckets = durable(files.groupBy("bucket").agg(F.collect_list("path").alias("paths")))
    paths = F.transform("paths", lambda p: F.replace(p, F.lit("%20"), F.lit(" ")))
    owners = buckets.select(paths.alias("paths")).repartition(max(1, buckets.count()))
    return owners.mapInArrow(_own, "hash long, sha binary, keep_id long, group_size long")


def exact_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays (keep_id); a NULL id stays only where no row of the
    group has another.  NULL texts are empty.  Rows that agree in id and text share one fate, and each
    counts in group_size.
    """
    spark = documents.sparkSession
    small_batches(spark)
    content = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), content.alias("text"))
    members = durable(
        rows.select(
            "id",
            F.xxhash64("text").alias("hash"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        )
    )
    if members.isEmpty():
        found = spark.createDataFrame([], "hash long, sha binary, keep_id long, group_size long")
    else:
        folder = scratch_path(spark, "index")
        write_index(rows, _directory(members), folder)
        found = durable(classes(spark, folder))
    return members.join(found, ["hash", "sha"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(spark, sf_dir) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
