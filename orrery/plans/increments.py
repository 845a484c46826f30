"""Incremental runs: only the days whose rows have changed are built and written again.

A manifest next to the output says which rows came from which input file and day: their
number and two order-free digests.  A run then takes three steps:

1. Files that the manifest knows by path, length and time are not opened.  The others
   are read once for their digests.
2. The digests of each day, added up over its files, are compared with the manifest's.
   A file that was touched, moved, split or merged changes no day.
3. Days that differ are read from the files that hold them, built, and written with
   dynamic partition overwrite.  The manifest follows last.

A run that dies before its manifest is in place is repeated by the next one: the old
manifest still names the days that differ.  The output is a folder with a partition for
each day; what is built for a day must depend on the rows of that day only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "load_day"
#: The partition of rows without a day.
NO_DAY = "none"
_FILE = ("file", "length", "modified")
_DIGESTS = ("rows", "digest", "check")
MANIFEST_SCHEMA = (
    "file string, length bigint, modified timestamp, load_day string, "
    "rows bigint, digest decimal(38,0), check decimal(38,0)"
)

Reader = Callable[[Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Increment:
    """What a run did: how many files it read, and which days it wrote and removed."""

    files_read: int
    days_written: tuple[str, ...]
    days_removed: tuple[str, ...]


def parquet_files(spark: SparkSession, schema: StructType | str | None = None) -> Reader:
    """Reads a list of parquet files; `schema` saves a look into them."""
    reader = spark.read.schema(schema) if schema else spark.read
    return lambda paths: reader.parquet(*paths)


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified) of every data file below `path`; contents are never read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )


def file_digests(rows: DataFrame, day: Column) -> DataFrame:
    """(file, load_day, rows, digest, check) of rows that come straight from files.

    Sums of row hashes: equal for the same rows in any order and any files, and folded
    inside the tasks, so a row per file and day is exchanged.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2)]
    hashed = rows.select(
        F.col("_metadata.file_path").alias("file"), _day_name(day).alias(DAY),
        hashes[0].alias("a"), hashes[1].alias("b"),
    )
    return hashed.groupBy("file", DAY).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("a").alias("digest"), F.sum("b").alias("check")
    )


def _day_name(day: Column) -> Column:
    return F.coalesce(day.cast("date").cast("string"), F.lit(NO_DAY))


def run_increment(
    spark: SparkSession,
    source: str,
    target: str,
    read: Reader,
    day: Column,
    build: Callable[[DataFrame], DataFrame],
    fmt: str = "parquet",
) -> Increment:
    """Bring the folder `target` up to date with the files below `source`.

    `day` is the day of an input row, `build` makes the output rows of whole days; the
    output has one more column, `load_day`, by which it is partitioned.  Rows whose day is
    unknown share one partition.  Lists of files and days come to the driver, as they do
    in any listing; rows do not.
    """
    folder = Manifests(spark, target)
    old = folder.newest()
    files = input_files(spark, source)
    touched = [r["file"] for r in files.join(old.select(*_FILE), list(_FILE), "left_anti").toLocalIterator()]
    known = old.join(files, list(_FILE), "left_semi")
    if not touched and files.count() == old.select("file").distinct().count():
        return Increment(0, (), ())
    if touched:
        digests = file_digests(read(touched), day)
        # A file without rows is noted too, or every run would open it again.
        fresh = files.join(old.select(*_FILE), list(_FILE), "left_anti").join(digests, "file", "left")
        known = known.unionByName(fresh.fillna(0, ["rows"]))
    new = folder.written(known)

    written, removed = _different_days(old, new)
    held = new.where(F.col(DAY).isin(written)).select("file").distinct().toLocalIterator() if written else ()
    holders = [r["file"] for r in held]
    if holders:
        rows = read(holders)
        built = build(rows.withColumn(DAY, _day_name(day)).where(F.col(DAY).isin(written)))
        before = {d: folder.part_files(d) for d in written}
        by_day = built.write.format(fmt).mode("overwrite").partitionBy(DAY)
        by_day.option("partitionOverwriteMode", "dynamic").save(target)
        # Of a day for which nothing was built, the overwrite leaves what was there.
        for name in written:
            if before[name] & folder.part_files(name):
                folder.remove(name)
    for name in removed:
        folder.remove(name)
    folder.publish(new)
    return Increment(len(touched), tuple(written), tuple(removed))


def _different_days(old: DataFrame, new: DataFrame) -> tuple[list[str], list[str]]:
    """(days whose rows differ, days that have no rows any more), in order."""
    total = lambda df: df.where(F.col("rows") > 0).groupBy(DAY).agg(*(F.sum(c).alias(c) for c in _DIGESTS))
    before = total(old).withColumnsRenamed({c: f"{c}_before" for c in _DIGESTS})
    same = F.lit(True)
    for c in _DIGESTS:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_before"))
    found = total(new).join(before, DAY, "full").where(~same).select(DAY, F.col("rows").isNull().alias("gone"))
    days = sorted((r[DAY], r["gone"]) for r in found.collect())
    return [d for d, gone in days if not gone], [d for d, gone in days if gone]


class Manifests:
    """The manifests of an output folder: one folder each, numbered, the newest whole one counts."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.target).getFileSystem(conf)

    # Readers of the output skip names that begin with an underscore.
    def _folder(self, number: int) -> str:
        return f"{self.target}/_manifest/{number:09d}"

    def _numbers(self, whole: bool = True) -> list[int]:
        root = self._path(f"{self.target}/_manifest")
        if not self._files.exists(root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(root)]
        return sorted(
            int(n) for n in names
            if n.isdigit() and not (whole and not self._files.exists(self._path(f"{root}/{n}/_SUCCESS")))
        )

    def newest(self) -> DataFrame:
        numbers = self._numbers()
        if not numbers:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._folder(numbers[-1]))

    def written(self, manifest: DataFrame) -> DataFrame:
        """`manifest` as a table that does not count yet."""
        path = f"{self.target}/_manifest/next"
        manifest.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(path)

    def publish(self, manifest: DataFrame) -> None:
        """Make `manifest` the newest one and remove those before it."""
        older = self._numbers(whole=False)
        number = older[-1] + 1 if older else 1
        manifest.write.parquet(self._folder(number))
        for n in [*older, "next"]:
            name = self._folder(n) if isinstance(n, int) else f"{self.target}/_manifest/{n}"
            self._files.delete(self._path(name), True)

    def _part(self, day: str):
        return self._path(f"{self.target}/{DAY}={day}")

    def part_files(self, day: str) -> set[str]:
        part = self._part(day)
        if not self._files.exists(part):
            return set()
        return {status.getPath().getName() for status in self._files.listStatus(part)}

    def remove(self, day: str) -> None:
        self._files.delete(self._part(day), True)
