"""Keyed upsert into Parquet tables that are laid out by a hash of their key.

A table is a folder per bucket of key hashes.  A merge looks up only the buckets
its keys fall into and reads their key and order columns.  Buckets in which it
replaces a row are written anew, the others get a file more; a bucket with many
such files is written anew as well, so nothing grows with the number of merges.

Newest wins: with order columns (when and where a row was read), a row replaces
the held one only if it is newer, in whatever order batches arrive.  The same
batch again is not newer, so it writes nothing.

A merge first writes all its files beside the table and then moves them, bucket
by bucket.  A run lost while writing leaves the table as it was; one lost while
moving is finished by whoever opens the table next.  A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"
KIND = "kind"


class Merged(NamedTuple):
    """Rows a merge added and replaced, and those it left out as they were not newer."""

    inserted: int = 0
    replaced: int = 0
    older: int = 0

    @property
    def rows(self) -> int:
        return self.inserted + self.replaced


def names_of(schema: str) -> list[str]:
    """Column names of a flat schema text."""
    return [part.split()[0] for part in schema.replace("(18,2)", "").replace("(10,2)", "").split(",") if part.strip()]


class KeyedTable:
    """One table at ``path`` with the business key ``keys``.

    ``order`` is the schema of the order columns, empty if the batch always wins.
    ``buckets`` is fixed with the first merge: choose it so that a bucket, the unit
    that a merge rewrites, stays near ``rows_per_file`` rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        schema: str,
        order: str = "",
        buckets: int = 16,
        files_per_bucket: int = 8,
        rows_per_file: int = 2_000_000,
    ):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), keys, schema
        self.order, self.buckets = names_of(order), buckets
        self.files_per_bucket, self.rows_per_file = files_per_bucket, rows_per_file
        self.columns = [*names_of(schema), *self.order]
        self.stored = ", ".join(s for s in (schema, order, f"{BUCKET} int") if s)

    # ---- files -----------------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _inside(self, path) -> list:
        fs = self._fs()
        return [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []

    def files(self, bucket: int) -> list[str]:
        return [p.getName() for p in self._inside(self._path(f"{BUCKET}={bucket}")) if p.getName().startswith("part-")]

    def finish(self) -> None:
        """Move what a complete write left beside the table, and clear away an incomplete one."""
        fs, beside = self._fs(), self._path("_next")
        if not fs.exists(beside):
            return
        if fs.exists(self._path("_next", "_SUCCESS")):
            for folder in self._inside(self._path("_next", f"{KIND}=replace")):
                target = self._path(folder.getName())
                fs.delete(target, True)
                fs.rename(folder, target)
            for folder in self._inside(self._path("_next", f"{KIND}=add")):
                target = self._path(folder.getName())
                fs.mkdirs(target)
                for file in self._inside(folder):
                    fs.rename(file, self._path(folder.getName(), file.getName()))
        fs.delete(beside, True)

    # ---- reading ---------------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def holds_rows(self) -> bool:
        return any(p.getName().startswith(f"{BUCKET}=") for p in self._inside(self._path()))

    def held(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The stored rows with their order columns and bucket; only the folders of ``buckets`` are opened."""
        if not self.holds_rows():
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(self.path)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(sorted(buckets)))

    def read(self) -> DataFrame:
        self.finish()
        return self.held().drop(*self.order, BUCKET)

    # ---- writing ---------------------------------------------------------------------
    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]  # at most ``buckets``

    def _piece(self, counts: list, anew: list[int]) -> Column:
        """Which of a bucket's files a row goes to: a task writes a file, not a bucket."""
        rows = {r[BUCKET]: r["n"] for r in counts}
        for r in self.held(anew).groupBy(BUCKET).count().collect() if anew else ():
            rows[r[BUCKET]] += r["count"]
        files = -(-max(rows.values()) // self.rows_per_file)
        return F.pmod(F.xxhash64(F.lit("piece"), *self.keys), F.lit(files))

    def _put(self, fresh: DataFrame, total: int) -> Merged:
        """Write ``fresh`` (columns, bucket, ``_replaces``), one row per key."""
        counts = fresh.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.count_if("_replaces").alias("replaced")).collect()
        if not counts:
            return Merged(older=total)
        anew = [r[BUCKET] for r in counts if r["replaced"] or len(self.files(r[BUCKET])) >= self.files_per_bucket]
        columns = [*self.columns, BUCKET]
        out = fresh.select(*columns, F.when(F.col(BUCKET).isin(anew), "replace").otherwise("add").alias(KIND))
        if anew:
            kept = self.held(anew).join(fresh.select(*self.keys), self.keys, "left_anti")
            out = out.unionByName(kept.select(*columns, F.lit("replace").alias(KIND)))
        (
            out.repartition(KIND, BUCKET, self._piece(counts, anew))
            .sortWithinPartitions(KIND, BUCKET, *self.keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy(KIND, BUCKET)
            .parquet(f"{self.path}/_next")
        )
        self.finish()
        written, replaced = sum(r["n"] for r in counts), sum(r["replaced"] for r in counts)
        return Merged(written - replaced, replaced, total - written)

    def candidates(self, rows: DataFrame, buckets: list[int]) -> DataFrame:
        """The rows (with their bucket) that are new or newer than the held ones, and whether they replace one."""
        held = self.held(buckets).select(*self.keys, F.lit(True).alias("_replaces"), *[F.col(c).alias(f"_held_{c}") for c in self.order])
        newer = F.col("_replaces").isNull()
        if self.order:
            newer = newer | (F.struct(*self.order) > F.struct(*[F.col(f"_held_{c}").alias(c) for c in self.order]))
        else:
            newer = F.lit(True)
        joined = rows.join(held, self.keys, "left").where(newer)
        return joined.select(*self.columns, BUCKET, F.coalesce("_replaces", F.lit(False)).alias("_replaces"))

    def merge(self, batch: DataFrame, collapsed: bool = False) -> Merged:
        """Upsert ``batch``; copies of a key collapse to the newest first, unless the caller has done so."""
        self.finish()
        if not collapsed:
            batch = newest(batch, self.keys, self.order) if self.order else batch.dropDuplicates(self.keys)
        rows = batch.select(*self.columns, self._bucket().alias(BUCKET)).persist()  # counted, looked up and written
        fresh = None
        try:
            counted = {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}
            if not counted:
                return Merged()
            fresh = self.candidates(rows, list(counted))
            if self.holds_rows():  # else they are the rows as they are kept already
                fresh = fresh.persist()
            return self._put(fresh, sum(counted.values()))
        finally:
            rows.unpersist()
            if fresh is not None:
                fresh.unpersist()

    def merge_dimension(self, batch: DataFrame, now: Column) -> Merged:
        """Type 1 update: known values are replaced by known values only.

        Rows that bring nothing new are left out, so a batch of already known
        ids writes nothing.  ``created_at`` survives, ``updated_at`` moves.
        """
        self.finish()
        names = [c for c in self.columns if c not in (*self.keys, "created_at", "updated_at")]
        absent = [F.lit(None).alias(n) for n in names if n not in batch.columns]
        rows = batch.dropDuplicates(self.keys).select("*", *absent, self._bucket().alias(BUCKET)).persist()
        fresh = None
        try:
            held = self.held(self._touched(rows)).select(
                *self.keys, F.lit(True).alias("_held"), "created_at", "updated_at", *[F.col(n).alias(f"_old_{n}") for n in names]
            )
            differs = F.col("_held").isNull()
            for n in names:
                differs = differs | (F.col(n).isNotNull() & ~F.col(n).eqNullSafe(F.col(f"_old_{n}")))
            fresh = rows.join(held, self.keys, "left").where(differs).select(
                *self.keys,
                *[F.coalesce(F.col(n), F.col(f"_old_{n}")).alias(n) for n in names],
                F.coalesce("created_at", now.cast("timestamp_ntz")).alias("created_at"),
                F.when(F.col("_held"), now.cast("timestamp_ntz")).alias("updated_at"),
                BUCKET,
                F.coalesce("_held", F.lit(False)).alias("_replaces"),
            )
            fresh = fresh.persist()
            return self._put(fresh, 0)._replace(older=0)
        finally:
            rows.unpersist()
            if fresh is not None:
                fresh.unpersist()


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key with its order columns; copies combine before the shuffle."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("r"))
    return last.select(*keys, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)])
