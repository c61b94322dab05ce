"""Driver tables and the listing scan.

Tables are read lazily with parquet column pruning / filter pushdown left to
Catalyst: callers select only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


LEFTOVER_INDEX_COLUMNS = ("Unnamed: 0", "_c0", "index")


def scan_listings(df: DataFrame, key: str, target: str | None = "price",
                  columns: list[str] | None = None) -> tuple[DataFrame, str | None]:
    """Drop a leftover positional index column, keep the key and the
    requested columns (validated, unlike the reference which silently skips
    misspelt names), and report whether a target is present.

    Returns the pruned frame and the target column name (None for unlabelled
    data). Column pruning reaches the parquet scan because this is a select.
    """
    present = [c for c in df.columns if c not in LEFTOVER_INDEX_COLUMNS]
    if columns is not None:
        missing = [c for c in columns if c not in present]
        if missing:
            raise ValueError(f"columns not in table: {missing}")
        keep = [key] + [c for c in columns if c != key]
    else:
        keep = present
    has_target = target is not None and target in present
    if has_target and target not in keep:
        keep = keep + [target]
    out = df.select(*keep)
    return out, (target if has_target else None)


def features_and_target(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Split into feature frame and (key, target) frame; rows stay joined by key."""
    return df.drop(target), df.select(key, F.col(target))
