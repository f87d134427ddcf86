"""Statistics over landed visit events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def visit_stats(visits: DataFrame, visitor: str = "visitor_id", page: str = "page") -> DataFrame:
    """Events, visitors, pages and the most visited page, in one row.

    All but the visitors come from the visits per page.
    """
    pages = visits.groupBy(page).agg(F.count(F.lit(1)).alias("_visits"))
    visitors = visits.select(visitor).distinct().agg(F.count(visitor).alias("v")).scalar()
    top = F.min_by(F.struct(page, "_visits"), F.struct(-F.col("_visits"), page))
    return (pages.agg(F.coalesce(F.sum("_visits"), F.lit(0)).alias("total_events"),
                      F.count(page).alias("total_pages"), top.alias("_top"))
            .select("total_events", visitors.alias("unique_visitors"), "total_pages",
                    F.col(f"_top.{page}").alias("top_page"), F.col("_top._visits").alias("top_page_visits")))


def recent_visits(visits: DataFrame, order: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    return visits.orderBy(F.desc(order)).select(order, *columns).limit(n)
