"""Data-quality checks: key uniqueness (fan-out guard), tab reconciliation lives in cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_audit(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: relation, n_rows, n_keys, dup_keys (keys appearing more than once)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(F.sum("_c").cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                       F.count(F.when(F.col("_c") > 1, F.lit(1))).alias("dup_keys")) \
                  .select(F.lit(name).alias("relation"), "n_rows", "n_keys", "dup_keys")


def unique_keys_audit(relations: dict) -> DataFrame:
    """`relations`: name -> (DataFrame, key column). Union of one audit row each."""
    out = None
    for name, (df, key) in relations.items():
        a = key_audit(df, key, name)
        out = a if out is None else out.unionByName(a)
    return out

