"""Run the refresh and the ledger for each batch of newly arrived files.

There are no event-time windows here: deliveries are whole files, and each batch is merged
into a table in month partitions (``sources.month_table``), of which it writes only the months it
touches. A batch that is run again after a failure writes its own version again, so nothing is
applied twice; the next batch starts from the newest version below its own number.
``merge_stream`` is the general form for tables without a month: whole numbered versions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cotejo.operators.snapshots import LEDGER_KEY, extend_ledger
from cotejo.sources import storage
from cotejo.sources.month_table import MonthTable

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def _versions(spark: SparkSession, root: str) -> list[int]:
    found = [int(v) for v in storage.partitions(spark, root, "version")]
    return sorted(v for v in found if storage.finished(spark, f"{root}/version={v}"))


def read_newest(spark: SparkSession, root: str, schema, below: int | None = None) -> DataFrame:
    """Newest finished version of a table, or an empty table."""
    if storage.exists(spark, f"{root}/manifest"):
        table = MonthTable(spark, root, spark.createDataFrame([], schema).schema, "")
        return table.read(table.manifest(below))
    versions = [v for v in _versions(spark, root) if below is None or v < below]
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/version={versions[-1]}")


def merge_stream(
    stream: DataFrame, root: str, checkpoint: str, merge: Merge
) -> StreamingQuery:
    """Merge all files that have arrived into the table at ``root``, then stop."""
    schema = stream.schema

    def on_batch(batch: DataFrame, number: int) -> None:
        # Version numbers start at 1, so that a table written beforehand can be version 0.
        version = number + 1
        old = read_newest(batch.sparkSession, root, schema, below=version)
        merge(old, batch).write.mode("overwrite").parquet(f"{root}/version={version}")

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _month_stream(
    stream: DataFrame, root: str, checkpoint: str, date: str, change: Callable[[MonthTable, DataFrame, int], object], keep: int
) -> StreamingQuery:
    schema = stream.schema

    def on_batch(batch: DataFrame, number: int) -> None:
        table = MonthTable(batch.sparkSession, root, schema, date)
        change(table, batch, number + 1)
        table.remove_unused(keep)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_stream(
    stream: DataFrame, root: str, checkpoint: str, date: str = "Fecha", keep: int = 2
) -> StreamingQuery:
    """Replace the trailing window of a master table by each delivery; what is written follows the
    delivery. The ``keep`` newest versions stay, and a table may be begun as version 0 by
    ``MonthTable.replace_window``."""
    return _month_stream(stream, root, checkpoint, date, MonthTable.replace_window, keep)


def ledger_stream(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = LEDGER_KEY, date: str | None = None, keep: int = 2
) -> StreamingQuery:
    """Add each batch of differences to a ledger; only the months that it has differences for are
    read and written. ``date`` is the key's date column, by default its first column."""
    date = keys[0] if date is None else date
    if date not in keys:
        raise ValueError(f"the month of a difference has to follow from its key: {date} is not in it")

    def change(table: MonthTable, batch: DataFrame, version: int) -> None:
        table.merge_months(batch, version, lambda old, new: extend_ledger(new, old, keys))

    return _month_stream(stream, root, checkpoint, date, change, keep)
