"""Stored vector collections in versions: a small pointer file names the folders that make up the current one.

    <root>/<name>/versions/00000003.json     length of the vectors, columns, and a folder for each bucket
    <root>/<name>/data/<random>/bucket=5/..   points whose id hashes to bucket 5

An upsert reads and writes only the buckets that its ids hash to, in a folder of its own, and then puts the next pointer
file in place. That last step is one rename that fails if the file is there already: what a job wrote before it stopped,
for whatever reason, is never seen, two writers cannot both make the same version, and readers of an older version keep
their files until ``vacuum``. Buckets are hashes of unique ids and therefore even.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.session import even

BUCKETS = 16


class Conflict(RuntimeError):
    """Another writer made this version first."""


@dataclass(frozen=True)
class Version:
    number: int
    dim: int
    buckets: int
    schema: T.StructType
    folders: dict[int, str]

    def text(self) -> str:
        folders = {str(b): f for b, f in sorted(self.folders.items())}
        return json.dumps({"dim": self.dim, "buckets": self.buckets, "schema": self.schema.jsonValue(), "folders": folders})


class Collection:
    """One named collection under ``root``. Nothing is held but the place; every call looks at the current version."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark, self.place = spark, f"{root}/{name}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions ---

    def versions(self) -> list[int]:
        folder = self._path(f"{self.place}/versions")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The current version, or the one of that number."""
        known = self.versions()
        if not known or (number is not None and number not in known):
            raise FileNotFoundError(f"{self.place} has {f'no version {number}' if known else 'no version'}")
        number = known[-1] if number is None else number
        read = json.loads("\n".join(r.value for r in self.spark.read.text(self._pointer(number), wholetext=True).collect()))
        folders = {int(b): f for b, f in read["folders"].items()}
        return Version(number, read["dim"], read["buckets"], T.StructType.fromJson(read["schema"]), folders)

    def _pointer(self, number: int) -> str:
        return f"{self.place}/versions/{number:08d}.json"

    def _commit(self, made: Version) -> None:
        """Put a pointer file in place, unless there is one of that number."""
        fresh = self._path(f"{self.place}/versions/{uuid.uuid4().hex}.new")
        out = self._files.create(fresh, False)
        try:
            out.write(bytearray(made.text().encode()))
        finally:
            out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        only_new = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fresh, self._path(self._pointer(made.number)), only_new)
        except Exception as e:
            self._files.delete(fresh, False)
            if "AlreadyExists" in str(e):
                raise Conflict(f"{self.place}: version {made.number} is there already") from e
            raise

    # --- writing ---

    def create(self, dim: int, schema: T.StructType, buckets: int = BUCKETS) -> Version:
        """The current version; an empty first one if there is none. Raises if its vectors have another length."""
        if self.versions():
            now = self.version()
            if now.dim != dim:
                raise ValueError(f"{self.place} holds vectors of {now.dim} entries, expected {dim}")
            return now
        made = Version(1, dim, buckets, schema, {})
        try:
            self._commit(made)
        except Conflict:  # another writer was faster
            return self.create(dim, schema, buckets)
        return made

    def upsert(self, points: DataFrame) -> Version:
        """New points replace stored ones of the same id, the rest stay (actions); the version that results.

        Of rows that share an id, one stays: the same for the same rows.
        """
        now = self.version()
        new = _one_each(points.select(*now.schema.fieldNames()))
        touched = {r.bucket for r in new.select(_bucket(now.buckets)).distinct().collect()}  # as many as buckets at most
        if not touched:
            return now
        stored = self.read(now.number, sorted(touched))
        merged = new.unionByName(stored.join(new.select("point_id"), "point_id", "left_anti"))
        return self._written(now, merged, {b: f for b, f in now.folders.items() if b not in touched})

    def delete(self, ids: DataFrame) -> Version:
        """The version without the points of these ids (actions)."""
        now = self.version()
        gone = ids.select(F.col("point_id").cast("bigint")).distinct()
        touched = {r.bucket for r in gone.select(_bucket(now.buckets)).distinct().collect()} & set(now.folders)
        if not touched:
            return now
        left = self.read(now.number, sorted(touched)).join(gone, "point_id", "left_anti")
        return self._written(now, left, {b: f for b, f in now.folders.items() if b not in touched})

    def replace(self, points: DataFrame) -> Version:
        """All points new (actions); the version that results."""
        now = self.version()
        return self._written(now, _one_each(points.select(*now.schema.fieldNames())), {})

    def _written(self, now: Version, points: DataFrame, others: dict[int, str]) -> Version:
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self.place}/{folder}"
        try:
            dealt = points.withColumn("bucket", _bucket(now.buckets))
            even(dealt, "bucket").write.partitionBy("bucket").parquet(path)
            here = self._path(path)
            names = [s.getPath().getName() for s in self._files.listStatus(here)]
            folders = {int(n[7:]): f"{folder}/{n}" for n in names if n.startswith("bucket=")}
            if folders:
                self._check(self.spark.read.schema(now.schema).parquet(*[f"{self.place}/{f}" for f in folders.values()]), now.dim)
            made = Version(now.number + 1, now.dim, now.buckets, now.schema, {**others, **folders})
            self._commit(made)
        except BaseException:
            self._files.delete(self._path(path), True)
            raise
        return made

    def _check(self, written: DataFrame, dim: int) -> None:
        size = F.coalesce(F.size("vector"), F.lit(-1))
        least, most, nameless = written.agg(F.min(size), F.max(size), F.count_if(F.col("point_id").isNull())).first()
        if least is not None and (least != dim or most != dim):
            raise ValueError(f"vectors of {least} to {most} entries, expected {dim}")
        if nameless:
            raise ValueError(f"{nameless} points have no id")

    # --- reading ---

    def read(self, number: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All points of a version, or those of some buckets."""
        of = self.version(number)
        folders = [f for b, f in of.folders.items() if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], of.schema)
        return self.spark.read.schema(of.schema).parquet(*[f"{self.place}/{f}" for f in folders])

    def retrieve(self, ids: list[int]) -> DataFrame:
        """Points by id, from the buckets of these ids alone."""
        of = self.version()
        rows = self.spark.createDataFrame([(i,) for i in ids], "point_id bigint")
        touched = [r.bucket for r in rows.select(_bucket(of.buckets)).distinct().collect()]
        return self.read(of.number, touched).filter(F.col("point_id").isin(ids))

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions and remove folders that none of these names; how many went.

        Not while another job writes: its folder is in no version yet.
        """
        numbers = self.versions()
        kept = [self.version(n) for n in numbers[-keep:]]
        used = {f.split("/")[1] for v in kept for f in v.folders.values()}
        for n in numbers[:-keep]:
            self._files.delete(self._path(self._pointer(n)), False)
        folder = self._path(f"{self.place}/data")
        there = [s.getPath().getName() for s in self._files.listStatus(folder)] if self._files.exists(folder) else []
        gone = [n for n in there if n not in used]
        for n in gone:
            self._files.delete(self._path(f"{self.place}/data/{n}"), True)
        return len(gone)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("point_id").cast("bigint")), F.lit(buckets)).cast("int").alias("bucket")


def _one_each(points: DataFrame) -> DataFrame:
    """One row for each id: of several, the one whose values hash lowest."""
    values = [c for c in points.columns if c != "point_id"]
    one = F.min_by(F.struct(*values), F.xxhash64(*values)).alias("_one")
    return points.groupBy(F.col("point_id").cast("bigint").alias("point_id")).agg(one).select(*[F.col("point_id") if c == "point_id" else F.col(f"_one.{c}") for c in points.columns])
