"""Tabular classification: feature frame, standardisation, MLlib MLP, report.

Scalars fitted on data (means, standard deviations) enter the plan as scalar
subqueries, so standardising never needs a global window or a join. MLlib
trains the multilayer perceptron (L-BFGS over partitioned data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                population: bool = True, suffix: str = "_z") -> DataFrame:
    """z-score each column with mean/std fitted on ``fit_on`` (default: ``df``).

    ``population=True`` divides by the population std (the reference's
    choice); MLlib's ``StandardScaler`` uses the sample std.
    """
    src = fit_on if fit_on is not None else df
    out = df
    for c in cols:
        mean = src.agg(F.avg(c)).scalar()
        std = src.agg(F.stddev_pop(c) if population else F.stddev_samp(c)).scalar()
        out = out.withColumn(c + suffix, F.when(std > 0, (F.col(c) - mean) / std).otherwise(F.lit(0.0)))
    return out


def train_mlp(train: DataFrame, features: Sequence[str], label: str, layers: Sequence[int],
              seed: int = 42, max_iter: int = 200):
    """Assemble -> scale (fit on train) -> MLP; returns the fitted pipeline model.

    L-BFGS runs one job per iteration over the training rows, so the training
    columns are checkpointed once (reliable, in the shared folder): iterations
    read that file instead of re-running the joins and split behind ``train``.
    """
    from tessera.session import cut_lineage
    train = cut_lineage(train.select(*features, label))
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    mlp = MultilayerPerceptronClassifier(layers=list(layers), labelCol=label, featuresCol="features",
                                         seed=seed, maxIter=max_iter)
    return Pipeline(stages=[asm, scaler, mlp]).fit(train)


def majority_baseline(train: DataFrame, label: str, by: str) -> DataFrame:
    """Per ``by`` value, the most frequent training label (ties -> smallest label)."""
    g = train.groupBy(by, label).agg(F.count(F.lit(1)).alias("_n"))
    return g.groupBy(by).agg(F.max_by(label, F.struct("_n", -F.col(label))).alias("predicted"))


def log_loss(predicted: DataFrame, label: str) -> float:
    """Mean negative log probability that a fitted model gives to the true class."""
    from pyspark.ml.functions import vector_to_array
    p = F.get(vector_to_array("probability"), F.col(label).cast("int"))
    return predicted.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("l")).first()["l"]


def frequency_log_loss(rows: DataFrame, label: str) -> float:
    """The same for guessing every class by its share of the rows."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.agg(F.sum(-F.col("n") / total * F.log(F.col("n") / total)).alias("l")).first()["l"]
