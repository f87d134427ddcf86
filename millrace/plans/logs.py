"""Access-log analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.aggregates import rank_by_count, share_percent

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def typed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("timestamp", F.try_to_timestamp("timestamp", F.lit(TIME_FORMAT)))


def errors(logs: DataFrame, level: str = "level") -> DataFrame:
    return logs.where(F.upper(level) == "ERROR")


def slow_requests(logs: DataFrame, limit: float = 400, time: str = "response_time") -> DataFrame:
    return logs.where(F.col(time) > limit)


def ranking(logs: DataFrame, key: str, only_errors: bool = False, level: str = "level") -> DataFrame:
    return rank_by_count(errors(logs, level) if only_errors else logs, key)


def status_counts(logs: DataFrame, key: str = "status") -> DataFrame:
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(key)


def performance(logs: DataFrame, key: str = "url", time: str = "response_time") -> DataFrame:
    return (logs.groupBy(key).agg(F.avg(time).alias("avg_response_time"))
            .orderBy(F.desc("avg_response_time"), key))


def error_share(logs: DataFrame, level: str = "level") -> DataFrame:
    bad = F.upper(level) == "ERROR"
    return logs.agg(F.count(F.lit(1)).alias("total_requests"), F.count_if(bad).alias("total_errors"),
                    share_percent(bad).alias("error_percentage"))
