"""A ledger of late rows (St5).

``split_late`` keeps a micro-batch's rows that are older than the newest time
seen less the allowed lateness, in a side table with key, time and lateness;
``LateRows`` is a listener that writes what the watermarks of any query have
dropped, one row per batch and query, to a table. Both tables are keyed by
batch, so a batch that runs again is counted once, and totals hold over any
number of batches and restarts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

DROPPED = "query string, run string, batch bigint, operator int, dropped bigint"


class LateRows(StreamingQueryListener):
    """Rows dropped by watermarks: one file of lines per (query, batch)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.jsc, self.path = spark.sparkContext._jvm, spark.sparkContext._jsc, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        dropped = [(i, int(op.get("numRowsDroppedByWatermark", 0))) for i, op in enumerate(p.get("stateOperators", []))]
        lines = [json.dumps({"query": p["id"], "run": p["runId"], "batch": p["batchId"], "operator": i, "dropped": n}) for i, n in dropped if n]
        if not lines:
            return
        file = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p['id']}-{p['batchId']}-{p['runId']}.json")
        out = file.getFileSystem(self.jsc.hadoopConfiguration()).create(file, True)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()


def dropped_rows(spark: SparkSession, path: str) -> DataFrame:
    """(query, batches, dropped) over everything the listener has written. Of a
    batch that ran in several runs, or reported again without data, the most."""
    per = spark.read.schema(DROPPED).json(path).groupBy("query", "batch", "operator").agg(F.max("dropped").alias("dropped"))
    return per.groupBy("query").agg(F.count_distinct("batch").alias("batches"), F.sum("dropped").alias("dropped"))


def split_late(path: str, keys: list[str], ts_col: str, lateness_s: float, on_time):
    """A ``foreachBatch`` function: rows later than ``lateness_s`` behind the
    newest row of earlier batches go to ``path``/late with their lateness; the
    others to ``on_time(batch, epoch)``."""
    late, marks = f"{path.rstrip('/')}/late", f"{path.rstrip('/')}/marks"

    def run(batch: DataFrame, epoch_id: int) -> None:
        from .pipelines import _progress
        spark = batch.sparkSession
        t = F.unix_micros(F.col(ts_col).cast("timestamp"))
        newest = _progress(spark, marks, epoch_id, "bigint")
        behind = (F.lit(newest) - t) / F.lit(1e6)
        is_late = F.lit(False) if newest is None else F.coalesce(behind > lateness_s, F.lit(False))
        if newest is not None:
            (batch.filter(is_late).select(*keys, ts_col, behind.alias("behind_s"))
             .write.mode("overwrite").parquet(f"{late}/epoch={epoch_id}"))
        on_time(batch.filter(~is_late), epoch_id)
        top = batch.agg(F.max(t)).first()[0]
        top = max((x for x in (top, newest) if x is not None), default=None)
        if top is not None:
            spark.createDataFrame([(int(top),)], "upto bigint").write.mode("overwrite").parquet(f"{marks}/epoch={epoch_id}")
    return run


def late_totals(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Late rows and the worst lateness per key."""
    df = spark.read.schema(f"{schema}, behind_s double, epoch bigint").parquet(f"{path.rstrip('/')}/late")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("late_rows"), F.max("behind_s").alias("worst_s"))
