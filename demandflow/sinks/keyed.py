"""A parquet table with one row per key, fed by change batches.

Open Spark cannot MERGE into parquet, and rewriting the whole table for every batch would cost the
table, not the batch. So a batch only appends its newest rows, in a folder of its flow and batch, with
the time it arrived as a column; reading takes the newest row per key. Flows number their own batches
and nothing is handed out, so any number of flows may write at the same moment: no two share a folder.
A replayed batch that is whole (Spark's ``_SUCCESS`` marker) is skipped, an unfinished one is written anew.

``compact`` writes a base of all rows so far, and beside it the last batch of every flow that is in it.
Whatever is not in the base stays a change, also a batch that began before the base was written and
ended after it. Batches of one flow come one after the other, as those of a stream do.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from demandflow.operators.latest import latest_per_key, repeated_keys
from demandflow.sinks.tables import CODEC, ROWS_PER_FILE

# When a batch reached the table, in microseconds. As a sequence column it makes the last batch win;
# flow and batch settle equal times.
ARRIVAL = "_arrived"
ORIGIN = ["_flow", "_batch"]
EXTRA = StructType([StructField(ARRIVAL, LongType()), StructField("_flow", StringType()), StructField("_batch", LongType())])

COMPACT_SHARE = 0.5
COMPACT_MIN_BYTES = 256 * 1024 * 1024
COMPACT_FOLDERS = 20
# Changes up to this size are matched with the base by their keys. With more, marks of their keys tell which base rows
# may have a change, where the base is large; changes above MARK_SHARE of the base are reduced together with it.
FEW_BYTES = 32 * 1024 * 1024
MARK_FROM_BYTES = 128 * 1024 * 1024
MARK_SHARE = 0.5
# 2**28 marks, 32 MB whatever the number of keys, in rows of 2**15 marks.
MARK_BITS, MARK_ROW_BITS = 28, 15


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], sequence_by: list[str], distinct: bool = False):
        """``distinct``: most batches hold a key once, so a batch is written before its keys are checked."""
        self.distinct = distinct
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.within = [c for c in sequence_by if c != ARRIVAL]
        self.sequence_by = [*sequence_by, *ORIGIN] if ARRIVAL in sequence_by else sequence_by

    def apply(self, changes: DataFrame, batch_id: int, flow: str = "direct") -> bool:
        """Add a batch of a flow; whether it was new. Work grows with the batch, not with the table. The batch is
        read more than once, as files can be."""
        _, folded = self._base()
        if batch_id <= folded.get(flow, -1) or (flow, batch_id) in self._changes(folded):
            return False
        rows, folder = changes.select(*self.schema.names), f"{self.path}/changes/_flow={flow}/_batch={batch_id}"
        if self.distinct and self._kept(rows, folder):
            return True
        self._write(latest_per_key(rows, self.keys, self.within), folder)
        return True

    def _kept(self, rows: DataFrame, folder: str) -> bool:
        """Write a batch as it is and keep it if its keys are distinct. Until the marker of a whole batch is there no
        reader sees it, and a batch with a key twice is overwritten by its newest rows."""
        self._write(rows, folder, marked=False)
        if repeated_keys(self.spark.read.schema(self.schema).parquet(folder), self.keys):
            return False
        marker = self._hadoop_path(f"{folder}/_SUCCESS")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker, True).close()
        return True

    def _write(self, rows: DataFrame, folder: str, marked: bool = True) -> None:
        arrived = rows.withColumn(ARRIVAL, F.lit(time.time_ns() // 1000)).write.mode("overwrite")
        arrived = arrived.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(marked).lower())
        arrived.options(maxRecordsPerFile=ROWS_PER_FILE, compression=CODEC).parquet(folder)

    def read(self) -> DataFrame:
        """The table as of the last whole batch.

        While the changes are few, base rows whose key has no newer change pass straight through, by a
        broadcast of the changed keys and no shuffle of the base. With more on a large base, a broadcast of marks says
        which base rows may have a newer change, and only those are shuffled; otherwise one shuffle reduces all rows.
        A batch holds a key once, so the largest batch serves as the base where there is none.
        """
        return self._rows(*self._base()).select(*self.schema.names)

    def _rows(self, base: str | None, folded: dict[str, int]) -> DataFrame:
        schema, newer = StructType([*self.schema.fields, *EXTRA.fields]), self._changes(folded)
        reader = self.spark.read.schema(schema)
        if not newer:
            return reader.parquet(f"{base}/rows") if base else self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/changes/_flow={flow}/_batch={batch}" for flow, batch in newer]
        weights = [self._bytes(folder) for folder in folders]

        def batches(*chosen: str) -> DataFrame:
            return reader.option("basePath", f"{self.path}/changes").parquet(*chosen).select(*schema.names)

        if base:
            old, old_weight = reader.parquet(f"{base}/rows"), self._bytes(f"{base}/rows")
        else:
            largest = weights.index(max(weights))
            old, old_weight = batches(folders.pop(largest)), weights.pop(largest)
            if not folders:
                return old
        changes = batches(*folders)
        if sum(weights) > FEW_BYTES:
            if old_weight < MARK_FROM_BYTES or sum(weights) > MARK_SHARE * old_weight:
                return latest_per_key(old.unionByName(changes), self.keys, self.sequence_by)
            marked = self._marked(old, changes)
            contested = marked.where("__marked").select(*schema.names).unionByName(changes)
            return marked.where("NOT __marked").select(*schema.names).unionByName(
                latest_per_key(contested, self.keys, self.sequence_by)
            )
        changed = changes.select(*self.keys).distinct()
        same_key = reduce(lambda a, b: a & b, [old[k].eqNullSafe(changed[k]) for k in self.keys])
        contested = old.join(changed, same_key, "left_semi").unionByName(changes)
        return old.join(changed, same_key, "left_anti").unionByName(latest_per_key(contested, self.keys, self.sequence_by))

    def _marked(self, old: DataFrame, changes: DataFrame) -> DataFrame:
        """``old`` with ``__marked``, true for every row whose key is among the changes and for few others: a
        key marks one of 2**28 bits, whose rows are broadcast."""
        number = F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - MARK_BITS)
        row = F.shiftright(number, MARK_ROW_BITS)
        bit = number.bitwiseAND((1 << MARK_ROW_BITS) - 1)
        marks = changes.select(row.alias("__row"), bit.alias("__bit")).groupBy("__row").agg(
            F.bitmap_construct_agg("__bit").alias("__marks")
        )
        byte = F.conv(F.hex(F.substring("__marks", (F.shiftright("__bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        placed = old.withColumns({"__row": row, "__bit": bit}).join(F.broadcast(marks), "__row", "left")
        return placed.withColumn("__marked", F.coalesce(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1, F.lit(False)))

    def is_one_batch(self) -> bool:
        """Whether the table is a single batch, which holds a key once: compacting it would only copy it."""
        base, folded = self._base()
        return base is None and len(self._changes(folded)) == 1

    def compact(self) -> None:
        """Fold everything so far into one base folder. Readers keep the old folders meanwhile."""
        stamp = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        base, folded = self._base()
        newer = self._changes(folded)
        if newer:
            rows = self._rows(base, folded)
            for flow, batch in newer:
                folded[flow] = max(batch, folded.get(flow, -1))
            self.spark.createDataFrame(list(folded.items()), "flow string, batch long").coalesce(1).write.parquet(f"{self.path}/base/{stamp}/folded")
            rows.write.options(maxRecordsPerFile=ROWS_PER_FILE, compression=CODEC).parquet(f"{self.path}/base/{stamp}/rows")

    def compact_if_due(self, share: float = COMPACT_SHARE, min_bytes: int = COMPACT_MIN_BYTES) -> bool:
        """Compact once the changes weigh ``share`` of the base, so that over time the table is
        rewritten at the cost of a few times its changes, not once per batch."""
        base, folded = self._base()
        newer = self._changes(folded)
        if not newer:
            return False
        weights = sorted(self._bytes(f"{self.path}/changes/_flow={flow}/_batch={batch}") for flow, batch in newer)
        # without a base the largest of several batches serves as one, see ``read``
        held = self._bytes(f"{base}/rows") if base else weights.pop() if len(weights) > 1 else 0
        due = len(newer) >= COMPACT_FOLDERS or sum(weights) >= max(share * held, min_bytes)
        if due:
            self.compact()
        return due

    def vacuum(self) -> None:
        """Delete what the current base replaces. Run it when no reader and no compaction is on it."""
        base, folded = self._base()
        old = [b for b in self._found(f"{self.path}/base/*") if base and b.split("/")[-1] < base.split("/")[-1]]
        changes = self._found(f"{self.path}/changes/_flow=*/_batch=*")
        for folder in [*old, *[c for c in changes if self._origin(c)[1] <= folded.get(self._origin(c)[0], -1)]]:
            path = self._hadoop_path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _base(self) -> tuple[str | None, dict[str, int]]:
        """The newest whole base, and the last batch of each flow that is in it."""
        whole = self._found(f"{self.path}/base/*/rows/_SUCCESS")
        if not whole:
            return None, {}
        base = max(whole).removesuffix("/rows/_SUCCESS")
        return base, {r.flow: r.batch for r in self.spark.read.parquet(f"{base}/folded").collect()}

    def _changes(self, folded: dict[str, int]) -> list[tuple[str, int]]:
        """Flow and batch of the finished change folders that are in no base (a listing of names only)."""
        done = [self._origin(f.removesuffix("/_SUCCESS")) for f in self._found(f"{self.path}/changes/_flow=*/_batch=*/_SUCCESS")]
        return sorted((flow, batch) for flow, batch in done if batch > folded.get(flow, -1))

    @staticmethod
    def _origin(folder: str) -> tuple[str, int]:
        flow, batch = (part.split("=", 1)[1] for part in folder.split("/")[-2:])
        return flow, int(batch)

    def _bytes(self, folder: str) -> int:
        path = self._hadoop_path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def _found(self, pattern: str) -> list[str]:
        path = self._hadoop_path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [status.getPath().toString() for status in found]

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)
