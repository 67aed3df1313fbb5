"""Readers for the input Parquet tables.

Every reader selects only the columns the library uses, so the Parquet
``ReadSchema`` stays narrow even when a caller forgets to project.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Columns used per input table of the TPC-H style layout.
TPCH_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"),
    "orders": ("o_orderkey", "o_orderdate"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                 "l_quantity", "l_extendedprice"),
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: tuple[str, ...] | None = None) -> DataFrame:
    """Parquet scan of ``<sf_dir>/<name>.parquet`` projected to ``columns``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    cols = columns if columns is not None else TPCH_COLUMNS.get(name)
    return df.select(*cols) if cols else df
