"""The vector table: chunks and embeddings of documents, replaced row by row in one commit with the feed's positions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import vectors
from tidemill.operators import documents
from tidemill.session import ship
from tidemill.sources import shared_fs
from tidemill.sources.bucket_store import BucketStore

COLUMNS = [*documents.ROW_KEY, "chunk_index", "vector_id", "text_hash", "content", "metadata", "embedding"]
SCHEMA = "tenant_id string, source_table string, source_pk string, chunk_index int, vector_id string, text_hash string, content string, metadata string, embedding array<float>"
REFUSED = "unusable embedding of"


class VectorStore(BucketStore):
    """Chunk rows in buckets by the key of their source row (tenant, table, key), so that all chunks of a row are replaced together.

    ``sync`` holds documents against what is stored: changed ones are cut and embedded anew, unchanged ones get their metadata refreshed,
    and those without text lose their chunks. Only buckets with such rows are read and written; the new
    manifest also has the ledger, the greatest position per topic and partition, so that rows and positions are never apart. An embedding
    of another length or with an entry that is no finite number fails the sync before anything is committed. A store is opened with the
    dimension it was made with."""

    def __init__(self, spark: SparkSession, path: str, dim: int = 512, buckets: int = 16):
        super().__init__(spark, path, documents.ROW_KEY, SCHEMA, buckets)
        self.dim = dim
        m = self.manifest()
        if m and m["dim"] != dim:
            raise ValueError(f"{path} has vectors of {m['dim']} numbers, not {dim}")

    def checked(self, rows: DataFrame) -> DataFrame:
        """rows, of which an unusable embedding fails the job."""
        good = F.coalesce(vectors.is_finite(F.col("embedding")) & (F.size("embedding") == self.dim), F.lit(False))
        bad = F.raise_error(F.concat(F.lit(REFUSED + " "), F.col("vector_id"))).cast("array<float>")
        return rows.withColumn("embedding", F.when(good, F.col("embedding")).otherwise(bad)).select(*COLUMNS)

    def load(self, rows: DataFrame, ledger: dict[str, int] | None = None) -> int:
        """The first version, from rows of an existing table; unusable ones must have been left out."""
        old = self._old()
        if old["files"]:
            raise ValueError(f"{self.path} is not empty")
        return self._commit(old, self._write(self.checked(rows), self._new_part(old)), dim=self.dim, ledger=ledger or {})

    def ledger(self) -> dict[str, int]:
        """Greatest position by "topic/partition"."""
        return (self.manifest() or {}).get("ledger", {})

    def sync(self, docs: DataFrame, model: Callable[[list[str]], np.ndarray], size: int = 400, overlap: int = 50, ledger: dict[str, int] | None = None, gone: DataFrame | None = None) -> dict[str, int]:
        """Rows by action. docs: hashed documents; gone: keys to be deleted besides those of blank documents."""
        old, ledger = self._old(), ledger or {}
        known = old.get("ledger", {})
        merged = known | {k: max(v, known.get(k, v)) for k, v in ledger.items()}
        part = self._new_part(old)
        keys = docs.select(*documents.ROW_KEY).unionByName(gone.select(*documents.ROW_KEY)) if gone is not None else docs.select(*documents.ROW_KEY)
        if gone is not None:
            docs = docs.join(gone.select(*documents.ROW_KEY), documents.ROW_KEY, "left_anti")
        stored = self.rows().join(keys.distinct(), documents.ROW_KEY, "left_semi")
        stage = f"{self.path}/{part}.plan"
        documents.plan_sync(docs, documents.stored_hashes(stored)).write.parquet(stage)
        plan = self.spark.read.schema("tenant_id string, source_table string, source_pk string, action string").parquet(stage).where("action <> 'ignored'")
        counts = {r.action: r.n for r in plan.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per action
        if counts:
            ship(self.spark)
            touched = [str(r[0]) for r in plan.select(self.bucket_of()).distinct().collect()]  # at most ``buckets`` numbers
            base = self._read([f for b in touched for f in old["files"].get(b, [])])
            named = lambda a: plan.where(F.col("action") == a).select(*documents.ROW_KEY)
            fresh = documents.chunk_rows(docs.join(named("upserted"), documents.ROW_KEY, "left_semi"), size, overlap)
            new = self.checked(fresh.withColumn("embedding", vectors.embed(F.col("content"), model)))
            meta = docs.join(named("metadata_refreshed"), documents.ROW_KEY, "left_semi").select(*documents.ROW_KEY, documents.metadata_of().alias("metadata"))
            rows = documents.replace_rows(documents.refresh_metadata(base, meta), plan.where("action <> 'metadata_refreshed'"), new.select(*base.columns))
            files = {b: fs for b, fs in old["files"].items() if b not in touched} | self._write(rows, part)
        else:
            files = old["files"]
        shared_fs.delete(self.spark, stage)
        if counts or merged != known:
            self._commit(old, files, dim=self.dim, ledger=merged)
        return counts
