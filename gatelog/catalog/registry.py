"""Named queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatelog.catalog.expected import with_feeds
from gatelog.catalog.feeds import Feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(feeds) -> DataFrame``. ``sql`` may use the feed names as tables."""

    def register(fn: Callable[[Feeds], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Feeds(spark, sf_dir))
        if sql is not None:
            EXPECTED[name] = with_feeds(sql)
        return fn

    return register
