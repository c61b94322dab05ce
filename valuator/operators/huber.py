"""Boosted trees under Huber loss (M5) as a pipeline stage.

Spark's boosting knows squared and absolute loss. Here every round is a few
Spark jobs: the exact ``quantile`` of the absolute residuals is the clip of the
round, a decision tree of the library is fitted to the clipped residuals, and
the tree's leaves are given new values from two group aggregates, the median
of the leaf's residuals and the mean of what is left of them, clipped. The
prediction of a row is one column that grows by a leaf value a round; the frame is
written and read back every few rounds, so its plan stays short.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.plans.strategy import fit_quantiles, fit_row, group_quantiles
from valuator.session import cut_lineage

#: Rounds after which the training frame is written and read back.
ROUNDS_A_CUT = 5


def _clipped(c: Column, delta: float) -> Column:
    return F.greatest(F.lit(-delta), F.least(F.lit(delta), c))


def huber_loss(residual: Column, delta: float) -> Column:
    a = F.abs(residual)
    return F.when(a <= delta, a * a / 2.0).otherwise(F.lit(delta) * (a - delta / 2.0))


class _HuberParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", typeConverter=TypeConverters.toInt)
    quantile = Param(Params._dummy(), "quantile", "share of the residuals that are not clipped", typeConverter=TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(maxIter=20, maxDepth=5, stepSize=0.1, quantile=0.9, seed=42)


class HuberBoostedTrees(Estimator, _HuberParams, DefaultParamsReadable, DefaultParamsWritable):
    """Rows without a label do not count; a constant label gives no trees."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=20, maxDepth=5, stepSize=0.1,
                 quantile=0.9, seed=42) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> HuberBoostedTreesModel:
        g = self.getOrDefault
        rows = cut_lineage(dataset.select(F.col(g("featuresCol")).alias("_x"), F.col(g("labelCol")).cast("double").alias("_y")).filter("_y IS NOT NULL"))
        start = fit_quantiles(rows, ["_y"], [0.5])["_y"]
        start = start[0] if start else 0.0
        rows = rows.withColumn("_at", F.lit(start))
        trees, values, losses = [], [], []
        # what a round's quantiles, means and loss need of a row, without its features; they read it a dozen times
        seen = rows.select("_y", "_at")
        for i in range(g("maxIter")):
            delta = fit_quantiles(seen.select(F.abs(F.col("_y") - F.col("_at")).alias("_a")), ["_a"], [g("quantile")])["_a"]
            if not delta or delta[0] == 0.0:
                break
            now = rows.withColumn("_r", F.col("_y") - F.col("_at"))
            now = now.withColumn("_g", _clipped(F.col("_r"), delta[0]))
            tree = DecisionTreeRegressor(featuresCol="_x", labelCol="_g", predictionCol="_p", maxDepth=g("maxDepth"), seed=g("seed") + i).fit(now)
            tree = tree.setPredictionCol("").setLeafCol("_leaf")
            before, at = seen, tree.transform(rows).select("_y", "_at", F.col("_leaf").cast("int").alias("_leaf")).persist()
            leaves = at.select((F.col("_y") - F.col("_at")).alias("_r"), "_leaf")
            # at most 2^depth leaves
            found = {r["_leaf"]: r["_q"][0] for r in group_quantiles(leaves, ["_leaf"], "_r", [0.5]).collect()}
            middle = [found.get(j, 0.0) for j in range((tree.numNodes + 1) // 2)]
            med = F.get(F.array(*[F.lit(float(m)) for m in middle]), F.col("_leaf"))
            rest = {r["_leaf"]: r["m"] for r in leaves.groupBy("_leaf").agg(F.avg(_clipped(F.col("_r") - med, delta[0])).alias("m")).collect()}
            trees.append(tree)
            values.append([g("stepSize") * (m + rest.get(j, 0.0)) for j, m in enumerate(middle)])
            seen = at.select("_y", (F.col("_at") + _leaf_value(values[-1], "_leaf")).alias("_at")).persist()
            losses.append(fit_row(seen, F.avg(huber_loss(F.col("_y") - F.col("_at"), delta[0])).alias("v"))["v"])
            at.unpersist()
            before.unpersist()
            rows = tree.transform(rows).withColumn("_at", F.col("_at") + _leaf_value(values[-1], "_leaf")).drop("_leaf")
            if (i + 1) % ROUNDS_A_CUT == 0:
                rows = cut_lineage(rows)
        seen.unpersist()
        model = HuberBoostedTreesModel(start=start, trees=trees, values=values, losses=losses)
        return self._copyValues(model)


def _leaf_value(values: list[float], leaf: str) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col(leaf).cast("int"))


class HuberBoostedTreesModel(Model, _HuberParams, MLReadable, MLWritable):
    """``losses``: mean training loss after each round, at that round's clip."""

    def __init__(self, start: float = 0.0, trees=(), values=(), losses=()) -> None:
        super().__init__()
        self.start, self.trees, self.values, self.losses = start, list(trees), [list(v) for v in values], list(losses)

    @property
    def featureImportances(self) -> DenseVector:
        """Mean of the importances of the trees that have a split, summing to 1 (all 0 without a split); without trees there are none."""
        if not self.trees:
            raise AttributeError("no trees")
        each = [t.featureImportances.toArray() for t in self.trees]
        total = sum(each)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, total = dataset, F.lit(float(self.start))
        for i, (tree, values) in enumerate(zip(self.trees, self.values, strict=True)):
            out = tree.setFeaturesCol(self.getFeaturesCol()).setPredictionCol("").setLeafCol(f"_leaf{i}").transform(out)
            total = total + _leaf_value(values, f"_leaf{i}")
        return out.withColumn(self.getPredictionCol(), total).drop(*[f"_leaf{i}" for i in range(len(self.trees))])

    def write(self) -> MLWriter:
        return _HuberWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HuberReader(cls)


class _HuberWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        m = self.instance
        for i, tree in enumerate(m.trees):
            tree.save(f"{path}/tree-{i}")
        state = json.dumps({"start": m.start, "values": m.values, "losses": m.losses})
        self.sparkSession.range(1).select(F.lit(state).alias("state")).write.parquet(f"{path}/state")


class _HuberReader(DefaultParamsReader):
    def load(self, path: str) -> HuberBoostedTreesModel:
        m = super().load(path)
        state = json.loads(self.sparkSession.read.parquet(f"{path}/state").first()["state"])
        m.start, m.values, m.losses = state["start"], state["values"], state["losses"]
        m.trees = [DecisionTreeRegressionModel.load(f"{path}/tree-{i}") for i in range(len(m.values))]
        return m
