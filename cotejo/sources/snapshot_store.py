"""A table that keeps one full copy per month, in partitions ``snapshot_month=yyyy-MM``.

A snapshot is known by its month, not by the time a file was written. Which months there are is
listed from the partition folders, without reading a file; a read of some months is a literal
filter on the partition column and lists only their folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.operators.filters import in_months, last_n_months, month_bound, months_of
from cotejo.sources import storage

SNAPSHOT = "snapshot_month"


def write_snapshot(df: DataFrame, root: str, date: str, keep: int | None = None) -> list[str]:
    """Write ``df`` as the snapshot of its newest month; only that partition is replaced.

    With ``keep`` snapshots older than the ``keep`` newest ones are then removed, after the write
    has been committed; their months are returned. ``df`` is read twice, for its newest month
    and for its rows: pass an expensive one through ``session.cut_lineage`` first.
    """
    newest = df.agg(F.date_format(F.max(date), "yyyy-MM")).scalar()
    (
        df.withColumn(SNAPSHOT, newest)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT)
        .parquet(root)
    )
    return remove_old(df.sparkSession, root, keep) if keep is not None else []


def snapshot_months(spark: SparkSession, root: str) -> list[str]:
    """Months ``yyyy-MM`` of the snapshots, oldest first, from the names of the folders."""
    return storage.partitions(spark, root, SNAPSHOT)


def remove_old(spark: SparkSession, root: str, keep: int = 12) -> list[str]:
    """Remove the folders of all but the ``keep`` newest snapshots; their months are returned."""
    months = snapshot_months(spark, root)
    old = months[: max(len(months) - keep, 0)]
    storage.remove(spark, [f"{root.rstrip('/')}/{SNAPSHOT}={m}" for m in old])
    return old


def read_snapshots(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """All snapshots, or those of some months; the month stays text.

    Only the folders of these months are listed and read.
    """
    if months is None:
        months = snapshot_months(spark, root)
    if not months:
        df = spark.read.option("recursiveFileLookup", True).parquet(root)
        return df.withColumn(SNAPSHOT, F.lit(None).cast("string")).limit(0)
    folders = [f"{root.rstrip('/')}/{SNAPSHOT}={m}" for m in months]
    df = spark.read.option("basePath", root).parquet(*folders)
    return df.withColumn(SNAPSHOT, F.date_format(F.col(SNAPSHOT).cast("string").cast("date"), "yyyy-MM"))


def read_nth_newest(spark: SparkSession, root: str, n: int = 1) -> DataFrame:
    """The n-th newest snapshot (1 is the newest); no rows when there are fewer."""
    months = snapshot_months(spark, root)
    return read_snapshots(spark, root, months[-n:][:1] if n <= len(months) else [])


def nth_newest(df: DataFrame, n: int = 1, snapshot: str = SNAPSHOT, raw: str | None = None) -> DataFrame:
    """Rows of the n-th newest snapshot (1 is the newest); none when there are fewer.

    ``raw`` names a date column that ``snapshot`` is the month of: two bounds on it reach the scan.
    """
    if raw is None:
        months = df.select(snapshot).dropna().distinct().orderBy(F.desc(snapshot)).limit(n)
        bounds = months.agg(F.when(F.count("*") == n, F.min(snapshot)).alias("month"))
        return df.filter(F.col(snapshot) == bounds.scalar())
    months = months_of(df, raw).orderBy(F.desc("month")).limit(n)
    first = month_bound(df, raw, months, F.when(F.count("*") == n, F.min("month")))
    return in_months(df, raw, first, F.add_months(first, 1).cast(df.schema[raw].dataType))


def keep_newest(df: DataFrame, keep: int = 12, snapshot: str = SNAPSHOT, raw: str | None = None) -> DataFrame:
    """Rows of the ``keep`` newest snapshots; ``raw`` as in ``nth_newest``. To free the storage of
    the others see ``remove_old``."""
    if raw is not None:
        return last_n_months(df, raw, keep)
    months = df.select(snapshot).dropna().distinct().orderBy(F.desc(snapshot)).limit(keep)
    return df.filter(F.col(snapshot) >= months.agg(F.min(snapshot)).scalar())
