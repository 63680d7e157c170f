"""Rank tiers over a whole table without ranking the whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.scoring import first_match


def leading_values(values: DataFrame, metric: str, depth: int) -> DataFrame:
    """One row holding the ``depth`` largest metric values in rank order (NULL ranks first).

    ``orderBy().limit()`` runs as a per-task top-k, so at most ``depth`` values per task are merged.
    """
    top = values.select(metric).orderBy(F.col(metric).desc_nulls_first()).limit(depth)
    entry = F.struct(F.col(metric).isNull().alias("missing"), F.col(metric).alias("amount"))
    return top.agg(F.sort_array(F.collect_list(entry), asc=False).alias("leaders"))


def rank_tier(values: DataFrame, metric: str, tiers: list[tuple[int, str]], default: str) -> Column:
    """Tier label by ``rank() over (order by metric desc)``, ties sharing a rank.

    ``rank <= k`` holds exactly when the metric is at least the k-th largest one, so the ranking is
    reduced to a scalar subquery over ``values`` and a comparison per row. With fewer than k rows
    every row qualifies. ``values`` must hold the metric of every row that is being labelled.
    """
    depth = max(k for k, _ in tiers)
    leaders = leading_values(values, metric, depth).scalar()
    amount = F.col(metric)

    def within(k: int) -> Column:
        kth = F.get(leaders, F.lit(k - 1))
        reaches = ~kth.getField("missing") & (amount >= kth.getField("amount"))
        return kth.isNull() | amount.isNull() | F.coalesce(reaches, F.lit(False))

    return first_match([(within(k), name) for k, name in sorted(tiers)], default)
