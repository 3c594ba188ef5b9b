"""Small reference dimensions: fiscal periods and combined code lists."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lodestar.functions.reserved import ERROR_ID, ERROR_TEXT, NA_ID, NA_TEXT
from lodestar.session import cut_lineage


def period_rollup(
    periods: DataFrame,
    key: str = "accounting_period_id",
    parent: str = "parent_id",
    name: str = "name",
    is_quarter: str = "quarter",
    is_year: str = "year_0",
) -> DataFrame:
    """Leaf periods under a quarter under a year, with both names."""

    def level(tag: str) -> DataFrame:
        return periods.select(
            F.col(key).alias(f"__{tag}id"),
            F.col(parent).alias(f"__{tag}parent"),
            F.col(name).alias(f"{tag}_name"),
            F.col(is_quarter).alias(f"__{tag}q"),
            F.col(is_year).alias(f"__{tag}y"),
        )

    quarters = level("quarter").filter("__quarterq = 'Yes' and __quartery = 'No'")
    years = level("year").filter("__yearq = 'No' and __yeary = 'Yes'")
    parents = periods.select(F.col(parent).alias(key)).distinct()
    return (
        periods.filter((F.col(is_quarter) == "No") & (F.col(is_year) == "No"))
        .join(parents, key, "left_anti")
        .join(quarters, F.col(parent) == F.col("__quarterid"))
        .join(years, F.col("__quarterparent") == F.col("__yearid"))
        .select(*periods.columns, "quarter_name", "year_name")
    )


def code_list(df: DataFrame, id: str, name: str) -> DataFrame:
    """A list of codes with the 'not available' and 'in error' members."""
    members = df.sparkSession.createDataFrame(
        [(NA_ID, NA_TEXT), (ERROR_ID, ERROR_TEXT)], "list_id bigint, list_item_name string"
    )
    rows = df.select(F.col(id).cast("long").alias("list_id"), F.col(name).alias("list_item_name"))
    return rows.unionByName(members)


def junk_dimension(lists: Mapping[str, DataFrame]) -> DataFrame:
    """Every combination of the members of several code lists.

    A product by definition. The lists are written first, so their sizes are known: those
    within ``spark.sql.autoBroadcastJoinThreshold`` are sent to the tasks, larger ones are
    paired partition by partition.
    """
    parts = [rows.select(F.col("list_id").alias(f"{n}_id"), F.col("list_item_name").alias(n)) for n, rows in lists.items()]
    return reduce(lambda a, b: a.crossJoin(b), map(cut_lineage, parts))
