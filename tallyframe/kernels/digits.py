"""A digit model over feature vectors: class-weighted multinomial regression, an ensemble by mean vote."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.decode import class_weights
from tallyframe.operators.sheets import group_split


def train(rows: DataFrame, features: str = "x", label: str = "y", group: str = "grupo", members: int = 3, share: float = 0.2):
    """``members`` models on the training groups; each leaves out other groups."""
    weights = class_weights(rows, label).select(F.col("clase").alias(label), "peso")
    ready = rows.join(F.broadcast(weights), label).withColumn("features", array_to_vector(F.col(features).cast("array<double>")))
    out = []
    for seed in range(members):
        part = group_split(ready, group, share, seed).where("NOT validation")
        out.append(LogisticRegression(labelCol=label, weightCol="peso", maxIter=30, regParam=0.01, family="multinomial").fit(part))
    return out


def vote(rows: DataFrame, models: list, features: str = "x") -> DataFrame:
    """Adds ``probabilidades`` (the members' mean), ``digito`` and ``confianza``."""
    out = rows.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))
    names = []
    for k, model in enumerate(models):
        out = model.setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}").setPredictionCol(f"_d{k}").transform(out).withColumn(f"_p{k}", vector_to_array(f"_p{k}"))
        names.append(f"_p{k}")
    mean = F.transform(F.arrays_zip(*names), lambda z: sum((z[n] for n in names), F.lit(0.0)) / len(names))
    out = out.withColumn("probabilidades", mean).drop("features", *[c for k in range(len(models)) for c in (f"_p{k}", f"_r{k}", f"_d{k}")])
    top = F.array_max("probabilidades")
    return out.withColumn("confianza", top).withColumn("digito", (F.array_position("probabilidades", top) - 1).cast("int"))
