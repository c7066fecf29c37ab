"""A table in month partitions, of which a change replaces only the months that it touches.

    root/version=<n>/month=<yyyy-MM>/     rows that version n wrote
    root/manifest/version=<n>/            for every month of the table, the version that holds it

A version is committed by its manifest, which is written last. A version that is written again
replaces its own folders and its own manifest, so a batch that is repeated changes nothing.
Rows without a date are a month of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.sources import storage

MONTH = "month"
UNDATED = "none"
Manifest = dict[str, int]


class MonthTable:
    """The table at ``root`` with the columns of ``schema``, by the month of ``date``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, date: str) -> None:
        self.spark, self.root, self.schema, self.date = spark, root.rstrip("/"), schema, date

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = storage.partitions(self.spark, f"{self.root}/manifest", "version")
        return sorted(int(v) for v in found if storage.finished(self.spark, self._manifest(int(v))))

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def _folder(self, version: int, month: str) -> str:
        return f"{self.root}/version={version}/{MONTH}={month}"

    def manifest(self, below: int | None = None) -> Manifest:
        """Month -> version that holds it, in the newest version (below one): a row per month."""
        versions = [v for v in self.versions() if below is None or v < below]
        if not versions:
            return {}
        rows = self.spark.read.schema("month string, version int").json(self._manifest(versions[-1]))
        return {r.month: r.version for r in rows.collect()}

    def month_of(self, date: str | Column | None = None) -> Column:
        return F.coalesce(F.date_format(self.date if date is None else date, "yyyy-MM"), F.lit(UNDATED))

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """Rows of the newest version, or of the months in ``manifest``; only these folders are read."""
        held = self.manifest() if manifest is None else manifest
        if not held:
            return self.spark.createDataFrame([], self.schema)
        folders = [self._folder(version, month) for month, version in sorted(held.items())]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, rows: DataFrame, version: int, kept: Manifest) -> Manifest:
        path = f"{self.root}/version={version}"
        named = rows.select(*[F.col(f"`{c}`") for c in self.schema.fieldNames()])
        named.withColumn(MONTH, self.month_of()).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(MONTH).parquet(path)
        written = storage.partitions(self.spark, path, MONTH)
        held = {**kept, **{month: version for month in written}}
        listed = self.spark.createDataFrame(sorted(held.items()), "month string, version int")
        listed.coalesce(1).write.mode("overwrite").json(self._manifest(version))
        return held

    def replace_window(self, latest: DataFrame, version: int) -> Manifest:
        """Replace all rows from the first date of ``latest`` on, and those without a date, by
        ``latest``: the moving window of a master table.

        Months before the first date keep their folders; of its own month the older days are
        written again. An empty delivery changes nothing.
        """
        held = self.manifest(below=version)
        first = latest.agg(F.min(self.date)).first()[0]
        if first is None and latest.isEmpty():
            return self._write(latest, version, held)
        held.pop(UNDATED, None)
        if first is None:
            return self._write(latest, version, {})
        border = f"{first.year:04d}-{first.month:02d}"
        older = {month: v for month, v in held.items() if month < border}
        rows = latest
        if border in held:
            rest = self.read({border: held[border]})
            rows = rest.filter(F.col(self.date) < F.lit(first)).unionByName(latest)
        return self._write(rows, version, older)

    def merge_months(
        self, changes: DataFrame, version: int, merge: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> Manifest:
        """Write ``merge(old, changes)`` in place of the months that ``changes`` has; ``old`` is
        only these months, all others keep their folders and are not read."""
        held = self.manifest(below=version)
        months = [r[0] for r in changes.select(self.month_of()).distinct().collect()]
        touched = {month: held[month] for month in months if month in held}
        kept = {month: v for month, v in held.items() if month not in touched}
        return self._write(merge(self.read(touched), changes), version, kept)

    def remove_unused(self, keep: int = 2) -> list[str]:
        """Remove the manifests of all but the ``keep`` newest versions, and the month folders that
        none of the kept ones names; the folders removed are returned."""
        versions = self.versions()
        old, kept = versions[: max(len(versions) - keep, 0)], versions[max(len(versions) - keep, 0) :]
        used = {self._folder(v, m) for n in kept for m, v in self.manifest(below=n + 1).items()}
        gone = []
        for version in old:
            folder = f"{self.root}/version={version}"
            mine = [f"{folder}/{MONTH}={m}" for m in storage.partitions(self.spark, folder, MONTH)]
            gone += [path for path in mine if path not in used]
        storage.remove(self.spark, [self._manifest(v) for v in old])
        storage.remove(self.spark, gone)
        return gone
