"""Keyed rows in buckets by key hash, copy on write, with versioned manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources import shared_fs


class BucketStore:
    """manifests/<version>.json lists the files of every bucket.

    A batch is reduced per key and routed to its buckets; the files of the touched buckets, and only
    these, are merged with it and written anew. A version is committed by creating the next
    manifest, which fails if another writer was first; files of a failed writer are in no manifest
    and so are never read. Readers of older versions keep their files until ``expire``. A batch
    without rows commits nothing. The layout (keys, schema) is fixed when the store is
    made; opening it with another one is refused. The number of buckets follows the size of the store: ``compact`` writes as many as its
    bytes ask for, and a batch that finds buckets of twice GROW bytes has them divided first."""

    #: Bytes of files that a bucket should have.
    GROW = 128 << 20

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, buckets: int = 16):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        m = self.manifest()
        if m and (m["keys"], m["schema"]) != (self.keys, self.schema):
            raise ValueError(f"{path} has keys {m['keys']} and rows {m['schema']}")
        self.buckets = m["buckets"] if m else buckets

    # what kinds of stores differ in

    def reduced(self, changes: DataFrame) -> DataFrame:
        """One row per key, of the store's schema."""
        raise NotImplementedError

    def newer(self, column: str, base: Column, delta: Column, base_row: Column, delta_row: Column) -> Column:
        """A column's value where both sides have the key."""
        raise NotImplementedError

    # versions

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in shared_fs.names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        v = [version] if version else self.versions()
        return json.loads(shared_fs.read_text(self.spark, f"{self.path}/manifests/{v[-1]:012d}.json")) if v else None

    def _commit(self, old: dict, files: dict, **more) -> int:
        known = old.get("sizes", {})
        sizes = {f: known.get(f) or shared_fs.size(self.spark, f"{self.path}/{f}") for fs in files.values() for f in fs}
        m = {"version": old["version"] + 1, "buckets": self.buckets, "keys": self.keys, "schema": self.schema, "files": files, "sizes": sizes} | more
        if not shared_fs.write_new(self.spark, f"{self.path}/manifests/{m['version']:012d}.json", json.dumps(m)):
            raise RuntimeError(f"version {m['version']} of {self.path} was committed by another writer; apply the batch again")
        return m["version"]

    # reading

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in files])

    def rows(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        return self._read([f for fs in m["files"].values() for f in fs] if m else [])

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # writing

    def _old(self) -> dict:
        m = self.manifest() or {"version": 0, "files": {}}
        self.buckets = m.get("buckets", self.buckets)  # another writer may have divided them
        return m

    def _new_part(self, old: dict) -> str:
        return f"data/{old['version'] + 1:012d}-{self.spark.sparkContext._jvm.java.util.UUID.randomUUID()}"

    def _write(self, rows: DataFrame, part: str) -> dict[str, list[str]]:
        """One file per bucket, the bucket's number being its task's."""
        out = rows.withColumn("bucket", self.bucket_of()).repartitionById(self.buckets, F.col("bucket"))
        out.sortWithinPartitions(*self.keys).write.partitionBy("bucket").parquet(f"{self.path}/{part}")
        files = {}
        for d in shared_fs.names(self.spark, f"{self.path}/{part}"):
            if d.startswith("bucket="):
                files[d[7:]] = [f"{part}/{d}/{n}" for n in shared_fs.names(self.spark, f"{self.path}/{part}/{d}") if n.endswith(".parquet")]
        return files

    def apply(self, changes: DataFrame, batch: int | None = None) -> int:
        """Merge a batch; returns the version that holds it. A numbered batch that the store
        already holds (a stream's batch done again) changes nothing."""
        old = self._old()
        if batch is not None and old.get("batch", -1) >= batch:
            return old["version"]
        if sum(old.get("sizes", {}).values()) > 2 * self.GROW * self.buckets:
            self.compact()
            old = self._old()
        part, delta = self._new_part(old), self.reduced(changes)
        if old["files"]:
            # the batch is reduced first; the result is kept for the two uses that follow
            stage = f"{self.path}/{part}.delta"
            delta.write.parquet(stage)
            delta = self.spark.read.schema(self.schema).parquet(stage)
            touched = [str(r[0]) for r in delta.select(self.bucket_of()).distinct().collect()]  # at most ``buckets`` numbers
            files = self._write(self._merged(self._read([f for b in touched for f in old["files"].get(b, [])]), delta), part)
            shared_fs.delete(self.spark, stage)
        else:
            files = self._write(delta, part)
        more = {"batch": batch if batch is not None else old.get("batch", -1)}
        return self._commit(old, old["files"] | files, **more) if files else old["version"]

    def _merged(self, base: DataFrame, delta: DataFrame) -> DataFrame:
        """Sort-merge join of the touched buckets with the batch."""
        b, d = base.alias("b"), delta.alias("d").hint("merge")
        on = [F.col(f"b.{k}").eqNullSafe(F.col(f"d.{k}")) for k in self.keys]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        b = b.withColumn("_in_b", F.lit(True)).alias("b")
        d = d.withColumn("_in_d", F.lit(True)).alias("d")
        row = lambda s: F.struct(*[F.col(f"{s}.{c}").alias(c) for c in base.columns])

        def value(c: str) -> Column:
            x, y = F.col(f"b.{c}"), F.col(f"d.{c}")
            return F.when(F.col("b._in_b").isNull(), y).when(F.col("d._in_d").isNull(), x).otherwise(x if c in self.keys else self.newer(c, x, y, row("b"), row("d")))

        return b.join(d, cond, "full_outer").select(*[value(c).alias(c) for c in base.columns])

    # maintenance

    def compact(self, target: int | None = None) -> int:
        """All rows in as many buckets, of one file each, as ``target`` bytes a bucket (GROW if none is given) ask for; nothing
        is written if that is within a factor of two of what there is."""
        old = self._old()
        wanted = max(1, -(-sum(old.get("sizes", {}).values()) // (target or self.GROW)))
        if not old["files"] or (all(len(fs) == 1 for fs in old["files"].values()) and wanted <= 2 * self.buckets and self.buckets <= 2 * wanted):
            return old["version"]
        self.buckets = wanted
        files = self._write(self._read([f for fs in old["files"].values() for f in fs]), self._new_part(old))
        return self._commit(old, files, **{k: v for k, v in old.items() if k in ("batch", "ledger", "dim")})

    def expire(self, keep: int = 5, older_than_ms: int | None = None) -> int:
        """Drop versions beyond the last ``keep`` (of these only ones written before a time, if given)
        and the data that no remaining version uses; returns how many were dropped."""
        v = self.versions()
        old = [x for x in v[:-keep] if older_than_ms is None or shared_fs.modified(self.spark, f"{self.path}/manifests/{x:012d}.json") < older_than_ms]
        if not old:
            return 0
        new = [x for x in v if x not in old]
        used = {f.split("/")[1] for x in new for fs in self.manifest(x)["files"].values() for f in fs}
        for x in old:
            shared_fs.delete(self.spark, f"{self.path}/manifests/{x:012d}.json")
        for n in shared_fs.names(self.spark, f"{self.path}/data"):
            if n not in used and int(n[:12]) <= new[-1]:
                shared_fs.delete(self.spark, f"{self.path}/data/{n}")
        return len(old)
