"""The camera registry: two parallel lists, one of ids and one of addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.functions.text import address_kind, list_entries


def camera_registry(settings: DataFrame, ids: str, urls: str) -> DataFrame:
    """One row per camera of each settings row: `camera_id`, `url`, `kind`.

    `ids` and `urls` name the list columns; other columns are kept. Lists of
    different lengths fail the job.
    """
    kept = [name for name in settings.columns if name not in (ids, urls)]
    lists = settings.select(
        *kept,
        list_entries(F.col(ids)).alias("camera_id"),
        list_entries(F.col(urls)).alias("url"),
    )
    message = F.lit("the lists of camera ids and addresses differ in length")
    paired = F.when(
        F.size("camera_id") == F.size("url"), F.arrays_zip("camera_id", "url")
    ).otherwise(F.raise_error(message))
    return lists.select(*kept, F.inline(paired)).select(
        *kept, "camera_id", "url", address_kind(F.col("url")).alias("kind")
    )
