"""Replacement of stored tables and partitions that a failure cannot damage.

New rows are written aside first, into hidden folders beside their places; the old rows stay readable all
the while.  Only when every write has ended, a journal that lists the places is stored, and then each old
folder is renamed away and the new one into its place.  A write that raises leaves everything as it was.
A driver lost while renaming leaves the journal, and ``settle`` (which every later replacement below the
same root calls first) carries the rest of the renames out, so either all places are new or all are old.

Folders must be renamed by the file system itself, as on HDFS, local disks and stores with real folders.
Between the two renames of a place it is absent for an instant; one run at a time replaces a place.
"""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..storage import file_system, shuffles_end

NEW, OLD, JOURNAL = ".new-", ".old-", ".swap-"


def write_counted(
    df: DataFrame,
    path: str,
    buckets: tuple[int, str] | None = None,
    partition: str | None = None,
    mode: str = "overwrite",
    **options,
) -> int:
    """Write ``df`` to ``path`` and return the rows written, counted by the write itself.

    ``partition`` names a column that has a folder per value.
    ``buckets`` (number, column) writes bucketed files; only writers of catalog tables can, so there is one
    for as long as the write takes.
    """
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("rows")).write.mode(mode)
    writer = writer.options(**{"compression": "zstd", **options})
    if partition is not None:
        writer = writer.partitionBy(partition)
    with shuffles_end(df.sparkSession):
        if buckets is None:
            writer.parquet(path)
        else:
            name = f"written_{uuid.uuid4().hex}"
            number, column = buckets
            writer.format("parquet").bucketBy(number, column).sortBy(column).option("path", path).saveAsTable(name)
            df.sparkSession.sql(f"DROP TABLE {name}")  # external, so the files stay
    return seen.get["rows"]


def _beside(place: str, prefix: str, run: str) -> str:
    """A hidden folder in the folder of ``place``; a leading dot keeps it out of every scan."""
    above, name = place.rstrip("/").rsplit("/", 1)
    return f"{above}/{prefix}{run}-{name}"


class Swap:
    """Places below ``root`` that are replaced together, or not at all.

    ``with Swap(spark, root) as swap:`` writes aside, and publishes when the block ends without an error.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.places: list[str] = []

    def __enter__(self) -> "Swap":
        settle(self.spark, self.root)
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            self.abandon()

    def write(self, df: DataFrame, place: str, below: str = "", **options) -> int:
        """Write the future rows of ``place``, or of its folder ``below``, aside; rows written.

        With ``mode="append"`` they come to those that this block has written there.
        """
        place = place.rstrip("/")
        if not f"{place}/".startswith(f"{self.root}/"):
            raise ValueError(f"{place} is not below {self.root}")
        if place not in self.places:
            self.places.append(place)
        new = _beside(place, NEW, self.run)
        return write_counted(df, f"{new}/{below}" if below else new, **options)

    def write_partitions(self, df: DataFrame, root: str, column: str, values) -> int:
        """Write the future rows of the partitions ``values`` below ``root`` aside, in one job; rows written.

        Listed partitions without rows become empty ones.
        """
        system, path = file_system(self.spark, self.root)
        together = _beside(f"{root}/parts", NEW, self.run)
        written = write_counted(df, together, partition=column)
        for value in values:
            place = f"{root}/{column}={value}"
            new = path(f"{together}/{column}={value}")
            if system.exists(new):
                self.places.append(place)
                _rename(system, new, path(_beside(place, NEW, self.run)))
            else:
                self.write(self.spark.createDataFrame([], df.drop(column).schema), place)
        system.delete(path(together), True)
        return written

    def at(self, place: str) -> str:
        """Where the rows of ``place`` are to be read from inside the block: the new ones if it has any."""
        place = place.rstrip("/")
        return _beside(place, NEW, self.run) if place in self.places else place

    def commit(self) -> list[str]:
        """Store the journal: from here on the replacement happens, if need be by ``settle``; the places."""
        system, path = file_system(self.spark, self.root)
        journal = f"{self.root}/{JOURNAL}{self.run}"
        names = [place[len(self.root) :].lstrip("/") for place in self.places]
        # The journal appears whole, by a rename of its own.
        stream = system.create(path(f"{journal}.tmp"), True)
        stream.write(bytearray("\n".join(names).encode()))
        stream.close()
        _rename(system, path(f"{journal}.tmp"), path(journal))
        return names

    def publish(self) -> None:
        if self.places:
            _carry_out(self.spark, self.root, self.run, self.commit())

    def abandon(self) -> None:
        system, path = file_system(self.spark, self.root)
        for place in self.places:
            system.delete(path(_beside(place, NEW, self.run)), True)


def settle(spark: SparkSession, root: str) -> list[str]:
    """Carry out what the journals below ``root`` list, left by drivers that were lost; their places."""
    system, path = file_system(spark, root)
    if not system.exists(path(root)):
        return []
    settled = []
    for entry in system.listStatus(path(root)):
        name = entry.getPath().getName()
        if name.startswith(JOURNAL) and not name.endswith(".tmp"):
            stream = system.open(entry.getPath())
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            places = text.split("\n")
            _carry_out(spark, root, name.removeprefix(JOURNAL), places)
            settled += places
    return settled


def _carry_out(spark: SparkSession, root: str, run: str, places: list[str]) -> None:
    """The renames of a journal; those that are done already are left out, so it can be repeated."""
    system, path = file_system(spark, root)
    for name in places:
        place = f"{root}/{name}" if name else root
        new, old = path(_beside(place, NEW, run)), path(_beside(place, OLD, run))
        if system.exists(new):
            if system.exists(path(place)):
                _rename(system, path(place), old)
            _rename(system, new, path(place))
        system.delete(old, True)
    system.delete(path(f"{root}/{JOURNAL}{run}"), False)


def _rename(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"could not rename {source.toString()} to {target.toString()}")
