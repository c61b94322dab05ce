"""Encoders as pipeline stages, fitted with the rest of a pipeline inside each training fold.

``MeanEncoder`` (E9) replaces categories by the smoothed mean of the label,
``FlagEncoder`` (E4-E7) by a vector of 0/1 flags, one per value or list token.
Both are ``Estimator``s with ``Model``s that are saved and loaded like any
other stage, so a bundle of fold models keeps its codes.

A mean code of a training row holds the row's own label. With ``foldCol`` the
state is kept by fold, and a row's own fold is left out of its code wherever
that fold took part in the fit: no label reaches its own row, in training or out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.operators.encode import MAX_ONE_HOT_VALUES, split_categories
from valuator.plans.strategy import collect_bounded, localize
from valuator.session import cut_lineage

#: Category of a row without one.
UNKNOWN = "unknown"
#: Folds whose sums are told apart.
MAX_FOLDS = 100


def _category(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))


# ------------------------------------------------------------------ E9
class _MeanParams(HasInputCols, HasOutputCols, HasLabelCol):
    foldCol = Param(Params._dummy(), "foldCol", "fold of a row, left out of its own code; '' for none", typeConverter=TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "width of the sigmoid blend", typeConverter=TypeConverters.toFloat)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows at which mean and prior weigh the same", typeConverter=TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(foldCol="", smoothing=1.0, minSamplesLeaf=1)


class MeanEncoder(Estimator, _MeanParams, DefaultParamsReadable, DefaultParamsWritable):
    """Per category w * mean + (1 - w) * prior with w = 1 / (1 + exp((minSamplesLeaf - n) / smoothing)); a
    category of one row, or of none, gets the prior, the mean of all training rows.

    A missing category is the category ``unknown``. All columns are learnt in
    one aggregate of (column, category, fold); rows without a label do not count.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol="label", foldCol="", smoothing=1.0, minSamplesLeaf=1) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MeanEncoderModel:
        fold = F.col(self.getOrDefault("foldCol")).cast("int") if self.getOrDefault("foldCol") else F.lit(None).cast("int")
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("col"), _category(c).alias("value")) for i, c in enumerate(self.getInputCols())])).alias("e")
        sums = (dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), fold.alias("fold"), each).filter("y IS NOT NULL")
                .groupBy("e.col", "e.value", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
        # written once: a fitted state must not change with its table, nor be counted again
        model = MeanEncoderModel(sums=cut_lineage(sums))
        return self._copyValues(model)


class MeanEncoderModel(Model, _MeanParams, MLReadable, MLWritable):
    """``sums``: (col, value, fold, n, s). It is written with the parameters and read back as a table; nothing grows on the driver but folds."""

    def __init__(self, sums: DataFrame | None = None) -> None:
        super().__init__()
        self.sums = sums
        self._known: tuple | None = None

    def _state(self) -> tuple[list[tuple[DataFrame, bool]], dict[int, tuple[int, float]], tuple[int, float]]:
        """Per column its categories with sums by fold; sums of all rows by fold and together."""
        if self._known is None:
            by_fold = collect_bounded(self.sums.filter("col = 0").groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), MAX_FOLDS)
            if by_fold is None:
                raise ValueError(f"foldCol must have at most {MAX_FOLDS} values")
            folds = {r["fold"]: (r["n"], r["s"]) for r in by_fold}
            total = sum(n for n, _ in folds.values()), sum(s for _, s in folds.values())
            entry = F.when(F.col("fold").isNotNull(), F.struct("fold", F.struct("n", "s")))
            # brought to the driver only where it is small, once for all rows that are transformed
            tables = [localize(self.sums.filter(F.col("col") == i).groupBy(F.col("value").alias("_value")).agg(
                F.sum("n").alias("_n"), F.sum("s").alias("_s"), F.map_from_entries(F.collect_list(entry)).alias("_by")))
                for i in range(len(self.getInputCols()))]
            self._known = tables, folds, total
        return self._known

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tables, folds, (all_n, all_s) = self._state()
        fold_col = self.getOrDefault("foldCol")
        own = F.col(fold_col).cast("int") if fold_col and fold_col in dataset.columns else F.lit(None).cast("int")
        mean = lambda n, s: F.lit(s / n if n else 0.0)
        prior = mean(all_n, all_s)
        for f, (n, s) in sorted((x for x in folds.items() if x[0] is not None)):
            prior = F.when(own == f, mean(all_n - n, all_s - s)).otherwise(prior)
        out = dataset.withColumn("_prior", prior)
        smoothing, least = self.getOrDefault("smoothing"), self.getOrDefault("minSamplesLeaf")
        for c, name, (table, is_small) in zip(self.getInputCols(), self.getOutputCols(), tables, strict=True):
            joined = out.withColumn("_value", _category(c)).join(F.broadcast(table) if is_small else table, "_value", "left")
            mine = F.try_element_at("_by", own)
            n = F.coalesce(F.col("_n"), F.lit(0)) - F.coalesce(mine["n"], F.lit(0))
            s = F.coalesce(F.col("_s"), F.lit(0.0)) - F.coalesce(mine["s"], F.lit(0.0))
            w = F.lit(1.0) / (F.lit(1.0) + F.exp((F.lit(float(least)) - n) / F.lit(smoothing)))
            code = F.when(n <= 1, F.col("_prior")).otherwise(F.col("_prior") * (F.lit(1.0) - w) + s / n * w)
            out = joined.withColumn(name, code).drop("_value", "_n", "_s", "_by")
        return out.drop("_prior")

    def names(self) -> list[str]:
        return list(self.getOutputCols())

    def write(self) -> MLWriter:
        return _MeanWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MeanReader(cls)


class _MeanWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.sums.write.parquet(f"{path}/sums")


class _MeanReader(DefaultParamsReader):
    def load(self, path: str) -> MeanEncoderModel:
        model = super().load(path)
        model.sums = self.sparkSession.read.parquet(f"{path}/sums")
        return model


# ------------------------------------------------------------------ E4-E7
class _FlagParams(HasInputCols, HasOutputCol):
    listCols = Param(Params._dummy(), "listCols", "input columns that hold comma lists", typeConverter=TypeConverters.toListString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(listCols=[])

    def _tokens(self, c: str) -> Column:
        return split_categories(c) if c in self.getOrDefault("listCols") else F.array_compact(F.array(F.col(c).cast("string")))


class FlagEncoder(Estimator, _FlagParams, DefaultParamsReadable, DefaultParamsWritable):
    """A vector of flags: one for every value of a plain column, one for every token of a list column, in order.

    Values are those of the training rows, in one aggregate; more than
    ``MAX_ONE_HOT_VALUES`` are an error. Values that were not there, and missing ones, have no flag.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, listCols=None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FlagEncoderModel:
        each = F.concat(*[_tagged(self._tokens(c), k) for k, c in enumerate(self.getInputCols())])
        seen = collect_bounded(dataset.select(F.explode(each).alias("e")).select("e.*").distinct(), MAX_ONE_HOT_VALUES)
        if seen is None:
            raise ValueError(f"more than {MAX_ONE_HOT_VALUES} values in {self.getInputCols()}")
        flags = sorted((r["col"], r["value"]) for r in seen)
        return self._copyValues(FlagEncoderModel(columns=[c for c, _ in flags], values=[v for _, v in flags]))


def _tagged(tokens: Column, column: int) -> Column:
    return F.transform(tokens, lambda v: F.struct(F.lit(column).alias("col"), v.alias("value")))


class FlagEncoderModel(Model, _FlagParams, DefaultParamsReadable, DefaultParamsWritable):
    """The flags are parameters: number of the input column, and value."""
    columns = Param(Params._dummy(), "columns", "input column of each flag", typeConverter=TypeConverters.toListInt)
    values = Param(Params._dummy(), "values", "value of each flag", typeConverter=TypeConverters.toListString)

    def __init__(self, columns: Sequence[int] = (), values: Sequence[str] = ()) -> None:
        super().__init__()
        self._set(columns=list(columns), values=list(values))

    def names(self) -> list[str]:
        return [f"{self.getInputCols()[c]}={v}" for c, v in zip(self.getOrDefault("columns"), self.getOrDefault("values"), strict=True)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = {f"_t{k}": self._tokens(c) for k, c in enumerate(self.getInputCols())}
        flags = [F.array_contains(f"_t{c}", F.lit(v)).cast("double")
                 for c, v in zip(self.getOrDefault("columns"), self.getOrDefault("values"), strict=True)]
        vector = array_to_vector(F.array(*flags) if flags else F.array().cast("array<double>"))
        out = dataset.withColumns(held).withColumn(self.getOutputCol(), vector).drop(*held)
        # the length goes into the column's metadata, which an assembler asks for
        return VectorSizeHint(inputCol=self.getOutputCol(), size=len(flags), handleInvalid="optimistic").transform(out)
