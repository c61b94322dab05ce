"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.sources.fixtures import Fixtures

NUMERIC_FEATURES = ["power", "curb_weight", "engine_cap", "no_of_owners", "depreciation", "coe",
                    "road_tax", "dereg_value", "omv", "arf"]
AS_OF = "2024-01-01"
PRED_COLS = ["pred_a", "pred_b", "pred_c"]


def fx(spark, sf_dir) -> Fixtures:
    return Fixtures(spark, sf_dir)


def rnd(c: str | Column, d: int = 6) -> Column:
    """Round computed doubles so both engines agree despite summation order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), d)


def round_all(df: DataFrame, d: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    dbl = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float") and f.name not in skip]
    return df.withColumns({c: rnd(c, d) for c in dbl}) if dbl else df


def sql_round_cols(cols: list[str], d: int = 6) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), {d}) AS {c}" for c in cols)
