"""Incremental runs as Structured Streaming; the progress of each is in its checkpoint folder.

Null keys are keys like others; a stream without files gives empty tables.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, format: str = "parquet") -> DataFrame:
    """New files of a folder, ``files_per_trigger`` a batch (the work budget of one step)."""
    reader = spark.readStream.schema(schema).format(format)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.load(path)


def deduplicated(stream: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """The first row of each key within the watermark's delay, with state that does not grow.

    Rows later than the delay are left out, keys seen for the first time included: use it where files arrive in about the
    order of event time. Where any file may come at any time, ``first_rows_table`` loses nothing.
    """
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def first_rows_table(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A step that appends a batch's first row of each key, unless the table has one as early; read it by ``read_firsts``.

    Whatever the order of the files, the rows read are the same, and late ones are not lost. The part is named by the
    batch, and a batch that is done again looks at the parts before it only.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = _firsts(batch, keys, order)
        if number:
            known = spark.read.schema(rows.schema).parquet(*[f"{path}/batch={n}" for n in range(number)])
            place = known.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_known"))
            same = [rows[k].eqNullSafe(place[k]) for k in keys]
            later = F.coalesce(F.struct(*[rows[o] for o in order]) >= F.col("_known"), F.lit(False))
            rows = rows.join(place, [*same, later], "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def _firsts(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; rows equal in ``order`` are told apart by their other columns."""
    rest = [*order, *sorted(c for c in rows.columns if c not in keys and c not in order)]
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def read_firsts(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key over all parts of a ``first_rows_table``."""
    return _firsts(spark.read.parquet(path).drop("batch"), keys, order)


def windowed_counts(stream: DataFrame, time_col: str, window: str, delay: str, *by: str) -> DataFrame:
    """Rows per event-time window and group; rows later than the delay are left out."""
    rows = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("w.start").alias("window_start"), *by, "n")


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there now into a Parquet table, and stop; a later run goes on from the checkpoint."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None, may_go_on: Callable[[], bool] | None = None) -> bool:
    """``step`` on each batch of what is there now; it must be idempotent by the batch number. True if all was done.

    After ``seconds``, or once ``may_go_on`` (a look at the space left, say) denies it, no further batch is begun; a later
    run goes on with the rest.
    """
    if seconds is None and may_go_on is None:
        query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return True
    end = time.monotonic() + seconds if seconds is not None else float("inf")

    def guarded(batch: DataFrame, number: int) -> None:
        if time.monotonic() > end or (may_go_on is not None and not may_go_on()):
            raise _Enough
        step(batch, number)

    query = stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if _Enough.__name__ not in str(e):
            raise
        return False
    return True


class _Enough(Exception):
    """Ends a run of batches between two of them."""


def unfinished(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is left of a list of work: its keys without those that are recorded as done. Null keys stay."""
    return work.join(done.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def latest_state_table(path: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A step that appends a batch's latest state of each key as one part of a table; read it by ``read_states``.

    The part is named by the batch, so a batch that is done again replaces its own part only.
    """

    def step(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c != key]
        rows = batch.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def read_states(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """The latest state of each key over all parts."""
    rows = spark.read.parquet(path).drop("batch")
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
