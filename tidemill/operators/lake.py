"""Lake tables: the current rows of a source table, kept by merging batches of change messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import envelope
from tidemill.sources.bucket_store import BucketStore

KEY = ["tenant_id", "id"]
SPLIT = "changes of a key lie in several partitions:"


class LakeTable(BucketStore):
    """Rows of one table by (tenant_id, id), with the position of their last change.

    A deleted row stays as a tombstone with its position, so that a change older than what is stored
    is of no effect whenever it comes. (A table that forgets positions would take it for news.)"""

    def __init__(self, spark: SparkSession, path: str, table: str, buckets: int = 16, guard: bool = True):
        self.table, self.row, self.guard = table, envelope.ROWS[table], guard
        cols = [f"{f.name} {f.dataType.simpleString()}" for f in self.row]
        super().__init__(spark, path, KEY, ", ".join([*cols, "event_pos string", "is_deleted boolean"]), buckets)

    def reduced(self, messages: DataFrame) -> DataFrame:
        flat = envelope.flatten(envelope.parse(envelope.of_table(messages, self.table), self.row), self.row)
        best = F.max_by(F.struct(*[c for c in self.row.names if c not in KEY], "is_deleted"), "event_pos").alias("_r")
        one = flat.groupBy(*KEY).agg(best, F.max("event_pos").alias("event_pos"), F.min("partition").alias("_from"), F.max("partition").alias("_to"))
        pos = F.col("event_pos")
        if self.guard:  # in the same pass; the batch fails before anything is committed
            where = F.format_string(SPLIT + " %s/%d: %d and %d", *KEY, "_from", "_to")
            pos = F.when(F.col("_from") == F.col("_to"), pos).otherwise(F.raise_error(where).cast("string"))
        return one.select(*[F.col(c) if c in KEY else F.col(f"_r.{c}") for c in self.row.names], pos.alias("event_pos"), "_r.is_deleted")

    def apply(self, changes: DataFrame, batch: int | None = None) -> int:
        """As of every store; a key whose changes lie in several partitions, where their order is not defined, is refused."""
        try:
            return super().apply(changes, batch)
        except Exception as e:
            if SPLIT in str(e):
                raise ValueError(str(e)[str(e).index(SPLIT) :].splitlines()[0]) from e
            raise

    def newer(self, column: str, base: Column, delta: Column, base_row: Column, delta_row: Column) -> Column:
        return F.when(delta_row["event_pos"] >= base_row["event_pos"], delta).otherwise(base)

    def current(self, version: int | None = None) -> DataFrame:
        return self.rows(version).where("NOT is_deleted").select(*self.row.names)

    def probe(self, tenant: str, ident: int | None = None) -> str:
        """A row's status (PRESENT if the table has none), ABSENT, or without an id the tenant's number of rows."""
        rows = self.current().where(F.col("tenant_id") == tenant)
        if ident is None:
            return str(rows.count())
        hit = rows.where(F.col("id") == int(ident)).limit(1).collect()
        return "ABSENT" if not hit else (hit[0].status if "status" in self.row.names else "PRESENT")


def probe_arguments(args: list[str]) -> tuple[str, str | None]:
    """[] is (default, all), [id] is (default, id), [tenant, id] both."""
    return ("default", None) if not args else ("default", args[0]) if len(args) == 1 else (args[0], args[1])
