"""A stored keyed table that micro-batches are merged into.

A batch is written as a delta under its own id and then noted in the ledger; a
batch that runs again overwrites its delta, or is left out if it was noted. So
neither a crash between the two nor a restart adds or loses a row. Once
``every`` deltas stand, they are merged: only the days that they touch are
read and rewritten in the table, and the ledger begins a new generation. A
crash in between leaves the old generation, whose deltas then only say again
what the table says already.

A read takes the table and at most ``every`` deltas and keeps the last row of
each key, so what it costs follows the table and not the number of batches.
There is no state and no watermark: a correction is kept however late it comes.
A row's partition must follow from its key. One writer at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources import tables as tb

_LEDGER = T.StructType([T.StructField("upto", T.LongType()), T.StructField("noted", T.LongType()), T.StructField("generation", T.LongType())])


class KeyedSink:
    """``keys`` name a row; ``order`` says which of several rows of a key is the last, later batches winning among equals."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], order: list[Column], partition: str = "base_date", every: int = 20):
        self.spark, self.root, self.schema, self.keys, self.order, self.partition, self.every = spark, root.rstrip("/"), schema, keys, order, partition, every
        self.refresh()

    def refresh(self) -> None:
        """What another process has written since; a reader calls it, the one writer need not."""
        self.generation, self.upto, self.noted = self._state()

    def _state(self) -> tuple[int, int, list[int]]:
        """The newest generation, the last batch that the table holds, and the batches noted since: ``every`` rows at most."""
        if not tb._exists(self.spark, f"{self.root}/ledger"):
            return 0, -1, []
        rows = self.spark.read.schema(_LEDGER).parquet(f"{self.root}/ledger")
        newest = rows.agg(F.max("generation").alias("g"))
        held = rows.where(F.col("generation") == newest.scalar()).collect()
        if not held:
            return 0, -1, []
        return held[0]["generation"], max([r["upto"] for r in held if r["upto"] is not None], default=-1), sorted({r["noted"] for r in held if r["noted"] is not None})

    def _note(self, generation: int, mode: str, upto: int | None, noted: int | None) -> None:
        row = self.spark.range(1, numPartitions=1).select(F.lit(upto).cast("long").alias("upto"), F.lit(noted).cast("long").alias("noted"))
        row.write.mode(mode).parquet(f"{self.root}/ledger/generation={generation}")

    def _delta(self, batch_id: int) -> str:
        return f"{self.root}/deltas/{batch_id:012d}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """To be given to ``foreachBatch``."""
        if batch_id <= self.upto or batch_id in self.noted:
            return
        rows = tb.dedupe_last(tb.align_schema(batch, self.schema), self.keys, self.order)
        rows.write.mode("overwrite").parquet(self._delta(batch_id))
        self._note(self.generation, "append", None, batch_id)
        self.noted.append(batch_id)
        if len(self.noted) >= self.every:
            self.compact()

    def _changes(self) -> DataFrame | None:
        """The last row of each key that the deltas hold."""
        if not self.noted:
            return None
        parts = [self.spark.read.schema(self.schema).parquet(self._delta(b)).withColumn("batch", F.lit(b)) for b in self.noted]
        return tb.dedupe_last(reduce(DataFrame.unionByName, parts), self.keys, [*self.order, F.desc("batch")]).select(*self.schema.names, "batch")

    def _merged(self, table: DataFrame, changes: DataFrame) -> DataFrame:
        both = table.withColumn("batch", F.lit(-1)).unionByName(changes)
        return tb.dedupe_last(both, self.keys, [*self.order, F.desc("batch")]).select(*self.schema.names)

    def compact(self) -> None:
        """Deltas into the table, of which only the touched days are read and rewritten."""
        changes = self._changes()
        if changes is None:
            return
        changes = changes.persist()
        try:
            days = [r[0] for r in changes.select(self.partition).distinct().collect()]  # no more than the calendar has
            touched = self.table().where(F.col(self.partition).isin(days))
            tb.store(self._merged(touched, changes), f"{self.root}/table", self.partition)
        finally:
            changes.unpersist()
        done, last = list(self.noted), max(self.noted)
        self._note(self.generation + 1, "overwrite", last, None)
        before = self.generation
        self.generation, self.upto, self.noted = before + 1, last, []
        for path in [self._delta(b) for b in done] + [f"{self.root}/ledger/generation={before}"]:
            self._forget(path)

    def _forget(self, path: str) -> None:
        """Removes what a merge has made superfluous, in whatever store the table is."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def table(self) -> DataFrame:
        """What has been merged so far."""
        return tb.read(self.spark, f"{self.root}/table", self.schema)

    def read(self, days: Column | None = None) -> DataFrame:
        """The last row of every key; ``days``, a condition on the partition column, prunes what is read."""
        table, changes = self.table(), self._changes()
        if days is not None:
            table, changes = table.where(days), changes if changes is None else changes.where(days)
        return table if changes is None else self._merged(table, changes)
