"""Apply a change feed: upserts and deletes by key, newest wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platework.operators.latest import dedup_latest

_DELETED = "__deleted"
_FROM_FEED = "__from_feed"


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence_by: list[str],
    delete_when: Column | None = None,
) -> DataFrame:
    """The target after the changes, with the target's columns.

    Per key the row with the highest ``sequence_by`` survives; a change beats a target row with the
    same sequence, and a change older than the target row is ignored. Applying the same changes twice
    gives the same table. Target and changes are read once and shuffled once, by key, after each task
    has cut its rows to one per key.
    """
    doomed = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    feed = changes.withColumns({_DELETED: doomed, _FROM_FEED: F.lit(1)})
    columns = changes.columns if target is None else target.columns
    if target is not None:
        feed = target.withColumns({_DELETED: F.lit(False), _FROM_FEED: F.lit(0)}).unionByName(
            feed.select(*columns, _DELETED, _FROM_FEED)
        )
    order = [F.col(c).desc_nulls_last() for c in [*sequence_by, _FROM_FEED]]
    return dedup_latest(feed, keys, order).where(~F.col(_DELETED)).select(*columns)
