"""Incremental upsert: a stream of offers kept as mergeable deltas.

Each micro-batch is folded to one row per key (its first and last end) and
written to its own folder, named by the batch id; a replayed batch writes the
same folder again.  A batch therefore costs as much as the batch, not as the
table.  Reading folds all deltas once more, and ``compact`` folds them for good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


class UpsertTable:
    """Offers by key, stored below ``path``."""

    def __init__(self, path: str, key: str, order: Sequence[str], latest: Sequence[str]):
        self.path, self.key, self.order, self.latest = path.rstrip("/"), key, list(order), list(latest)

    def _fold(self, ends: DataFrame) -> DataFrame:
        """Merge ``(key, first, last)`` rows; every end is a struct that starts with its position."""
        return ends.groupBy(self.key).agg(
            F.min_by("first", "first.position").alias("first"), F.max_by("last", "last.position").alias("last"))

    def _ends(self, df: DataFrame) -> DataFrame:
        first = [c for c in df.columns if c not in (self.key, *self.latest)]
        position = F.struct(*self.order).alias("position")
        return self._fold(df.select(
            self.key,
            F.struct(position, F.struct(*first).alias("row")).alias("first"),
            F.struct(position, F.struct(*[c for c in df.columns if c in self.latest]).alias("row")).alias("last")))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        self._ends(batch).write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def start_once(self, stream: DataFrame, checkpoint: str, time: str, same: Sequence[str], late: str, **trigger) -> StreamingQuery:
        """``start`` for a source that delivers records again and late.

        Records that agree in ``same`` count once, and one that is more than ``late`` behind the newest time of the batches
        before is left out.  Spark's state holds the keys of the last ``late`` alone, however long the stream runs.
        """
        once = stream.withWatermark(time, late).where(F.col(time).isNotNull()).dropDuplicatesWithinWatermark(list(same))
        return self.start(once, checkpoint, **trigger)

    def _folders(self, spark: SparkSession, kind: str) -> dict[int, str]:
        """Committed folders of a kind by their number."""
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return {}
        out = {}
        for status in fs.listStatus(root):
            folder = status.getPath()
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                out[int(folder.getName().split("=")[1])] = folder.toString()
        return out

    def _current(self, spark: SparkSession) -> tuple[DataFrame, int]:
        bases, deltas = self._folders(spark, "base"), self._folders(spark, "delta")
        upto = max(bases, default=-1)
        paths = [p for n, p in sorted(deltas.items()) if n > upto]
        if upto >= 0:
            paths.append(bases[upto])
        if not paths:
            raise ValueError(f"no batch has been written to {self.path}")
        return self._fold(spark.read.parquet(*paths)), max([upto, *deltas])

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key as of the last committed batch."""
        ends, _ = self._current(spark)
        return ends.select(self.key, "first.row.*", "last.row.*")

    def compact(self, spark: SparkSession) -> None:
        """Fold everything committed so far into a new base; older folders stay for running readers."""
        ends, upto = self._current(spark)
        if upto in self._folders(spark, "base"):
            return  # nothing came since, and the base must not be written while it is read
        ends.write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
