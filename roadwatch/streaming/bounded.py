"""The end of a bounded input (SURVEY K, end of input).

A watermark trails the latest event by its delay, so when a finite landing
folder has been read, the last windows, timers and pending records are still
open. A stream built with :func:`with_end` also reads a control folder. Once
the data is through, :func:`run_to_end` puts one marker there: it lifts the
watermark past every window and is dropped right behind the watermark
(:func:`roadwatch.operators.windows.past_end_marker`), so it is no row of any
operator. (All its columns but the time are NULL. A filter on other columns
right behind the watermark is moved before it by Spark and would stop the
marker: filter the stream before :func:`with_end`, or after the operator.) Spark then closes windows and fires timers as it always does, in
micro-batches of the query's own checkpoint: nothing comes out twice after a
restart, and every stateful operator is covered without reading its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.operators.windows import END_MS
from roadwatch.streaming.jobs import start

_SCHEMA = "end_ms long"


def with_end(stream: DataFrame, control: str, time_col: str) -> DataFrame:
    """``stream`` and the end marker of the shared folder ``control`` (made if absent).

    Use a folder per input; a query of two inputs ends when both have ended.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], _SCHEMA).write.mode("ignore").parquet(control)
    kind = stream.schema[time_col].dataType
    marker = spark.readStream.schema(_SCHEMA).parquet(control).select(F.col("end_ms").cast(kind).alias(time_col))
    return stream.unionByName(marker, allowMissingColumns=True)


def end_input(spark: SparkSession, control: str) -> None:
    """Declare that the inputs of ``control`` are complete (again: no effect). Rows that
    come later are late."""
    if spark.read.schema(_SCHEMA).parquet(control).isEmpty():
        spark.createDataFrame([(END_MS,)], _SCHEMA).coalesce(1).write.mode("append").parquet(control)


def run_to_end(df: DataFrame, name: str, controls: list[str], **writer) -> None:
    """Run a bounded stream (``df`` built over :func:`with_end` inputs) to its very end:
    all data that is there, then the marker, then whatever that closes.

    ``writer`` as for :func:`roadwatch.streaming.jobs.start`. A run that was
    interrupted is simply run again: both steps go on from the checkpoint.
    """
    for last in (False, True):
        if last:
            for control in controls:
                end_input(df.sparkSession, control)
        start(df, name, trigger={"availableNow": True}, **writer).awaitTermination()
