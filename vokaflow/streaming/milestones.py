"""Milestones of a running job as a stream: each is handled once when its step is reached."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def last_step(steps: DataFrame, run: str) -> DataFrame:
    """(run, step): the last step of each run, 0 where none is known."""
    return steps.groupBy(run).agg(F.coalesce(F.max("step"), F.lit(0)).alias("step"))


def due(steps: DataFrame, milestones: Sequence[int], done: DataFrame) -> DataFrame:
    """Milestones at or below the highest step that are not done yet; none without steps."""
    spark = steps.sparkSession
    wanted = spark.createDataFrame([(m,) for m in milestones], "milestone long")
    reached = steps.agg(F.coalesce(F.max("step"), F.lit(0)).alias("step"))
    return wanted.crossJoin(F.broadcast(reached)).filter("milestone <= step").join(done, "milestone", "left_anti").select("milestone")


def watch(steps: DataFrame, milestones: Sequence[int], done_path: str, handle: Callable[[int], None], checkpoint: str, interval: str = "300 seconds") -> StreamingQuery:
    """Starts a query over a stream of (step) that calls handle(milestone) and then records it in done_path.

    The record is written after the call, so a crash repeats a milestone at most once.
    """
    spark = steps.sparkSession

    def batch(rows: DataFrame, epoch: int) -> None:
        done = spark.read.schema("milestone long").option("mergeSchema", False).parquet(done_path)
        for r in due(rows, milestones, done).orderBy("milestone").collect():  # a handful of fixed milestones
            handle(r["milestone"])
            spark.createDataFrame([(r["milestone"],)], "milestone long").write.mode("append").parquet(done_path)

    spark.createDataFrame([], "milestone long").write.mode("append").parquet(done_path)
    return steps.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
