"""Master table with a moving window, and what changed in it retroactively."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.operators.aggregates import conditional_sum, with_keys
from cotejo.operators.filters import before_first


def window_refresh(
    master: DataFrame, latest: DataFrame, date: str = "Fecha", raw: str | None = None
) -> DataFrame:
    """Master rows before the first date of the latest delivery, and the whole delivery.

    Applying the same delivery twice gives the same table. ``raw`` names a date column that the
    master has besides, of which ``date`` is the month: the scan then reads only what stays.
    """
    kept = before_first(master, latest, date, raw)
    return (kept if raw is None or raw in latest.columns else kept.drop(raw)).unionByName(latest)


def retro_diff(
    current: DataFrame,
    previous: DataFrame,
    dims: Sequence[str],
    measure: str,
    current_name: str = "Registros ultimo mes",
    previous_name: str = "Registros mes anterior",
    difference: str = "Diferencia",
) -> DataFrame:
    """Keys that both versions have with a different total.

    Both versions are stacked and summed side by side: one shuffle, no join.
    """
    dims = list(dims)
    stacked = current.select(*dims, F.col(measure).alias("__v"), F.lit(True).alias("__now")).unionByName(
        previous.select(*dims, F.col(measure).alias("__v"), F.lit(False).alias("__now"))
    )
    sums = (
        with_keys(stacked, dims)
        .groupBy(*dims)
        .agg(
            conditional_sum(F.col("__now"), "__v").alias(current_name),
            conditional_sum(~F.col("__now"), "__v").alias(previous_name),
        )
    )
    change = F.col(current_name) - F.col(previous_name)
    return sums.withColumn(difference, change).filter(
        (F.col(difference) != 0) & F.col(difference).isNotNull()
    )
