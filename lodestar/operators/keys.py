"""Surrogate keys without an identity column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY_BUCKETS = 4096


def key_bucket(key: Sequence[str], buckets: int = KEY_BUCKETS) -> Column:
    """Bucket of a business key, from its MD5 so that any id pattern spreads evenly."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def assign_surrogate_keys(
    rows: DataFrame,
    key: str | Sequence[str],
    surrogate: str,
    existing: DataFrame | None = None,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Give every row a new key above all keys of ``existing``.

    ``key`` identifies a row of ``rows``. Buckets number their own rows and take
    turns, so ids are unique and repeatable without a global sort: the n-th row
    of bucket b gets ``top + (n - 1) * buckets + b + 1``. Like an identity column
    the sequence has gaps. Keys stay above 0, clear of the reserved members.
    """
    keys = [key] if isinstance(key, str) else list(key)
    top = F.lit(0).cast("long")
    if existing is not None:
        highest = existing.agg(F.max(surrogate).cast("long").alias("top"))
        top = F.greatest(F.coalesce(highest.scalar(), F.lit(0).cast("long")), F.lit(0).cast("long"))
    order = Window.partitionBy("__bucket").orderBy(*keys)
    return (
        rows.withColumn("__bucket", key_bucket(keys, buckets))
        .withColumn("__n", F.row_number().over(order).cast("long"))
        .withColumn(surrogate, top + (F.col("__n") - 1) * buckets + F.col("__bucket") + 1)
        .drop("__bucket", "__n")
    )


def continue_surrogate_keys(
    rows: DataFrame, key: str | Sequence[str], surrogate: str, existing: DataFrame | None = None, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Give every row a new key above those of its own bucket in ``existing``.

    The n-th key of bucket b is ``(n - 1) * buckets + b + 1``, so buckets never meet and
    ``existing`` may leave out those that ``rows`` has nothing for. All keys of a table have
    to be given out here (or at once by :func:`assign_surrogate_keys` to an empty table)
    with the same ``buckets``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy("__bucket").orderBy(*keys)
    first = (F.col("__bucket") + 1 - buckets).cast("long")
    out = rows.withColumn("__bucket", key_bucket(keys, buckets)).withColumn("__n", F.row_number().over(order).cast("long"))
    if existing is None:
        out = out.withColumn("__top", first)
    else:
        given = existing.filter(F.col(surrogate) > 0).select(key_bucket(keys, buckets).alias("__bucket"), F.col(surrogate).cast("long").alias("t"))
        tops = given.groupBy("__bucket").agg(F.max("t").alias("t"))  # a row per bucket, so never more than ``buckets``
        out = out.join(F.broadcast(tops), "__bucket", "left").withColumn("__top", F.coalesce("t", first)).drop("t")
    return out.withColumn(surrogate, F.col("__top") + F.col("__n") * buckets).drop("__bucket", "__n", "__top")
