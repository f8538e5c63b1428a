"""Keyed hashing: deterministic buckets that survive re-partitioning.

``randomSplit``/``sample`` draw per partition, so the same row can land in a
different split when the input is re-partitioned or a task is retried on a
different layout. A bucket derived from the row key does not move.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10000


def keyed_bucket(key: Column | str, salt: str = "42", modulus: int = BUCKETS) -> Column:
    """``int(md5(key ':' salt)[0:8], 16) % modulus`` -- identical in DuckDB as
    ``('0x' || substr(md5(key || ':' || salt), 1, 8))::bigint % modulus``."""
    col = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(col.cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(modulus)


def keyed_bucket_sql(key_sql: str, salt: str = "42", modulus: int = BUCKETS) -> str:
    """The DuckDB form of :func:`keyed_bucket`."""
    return (
        f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"
        f" % {modulus})"
    )
