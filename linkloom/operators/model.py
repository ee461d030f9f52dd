"""Match models: gradient-boosted trees, a logistic baseline and a fixed linear scorer."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import FEATURE_NAMES

#: A scorer without training: weights of a few features that other engines can compute too.
LINEAR = {"name_cover_s1": 2.5, "name_jaccard": 2.0, "addr_cover_s1": 2.5, "addr_jaccard": 1.5, "num_jaccard": 0.5, "score_ratio_to_top": 1.0, "score_z": 0.3}
BIAS = -4.0


def labelled(feats: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for pairs of the truth (s1_id, cand_id)."""
    hit = edges.select("s1_id", "cand_id").distinct().withColumn("_hit", F.lit(1))
    return feats.join(hit, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_hit", F.lit(0)).cast("tinyint")).drop("_hit")


def held_out(key: Column, percent: int = 25) -> Column:
    """Whether a record is in the validation slice: md5 of its id modulo 100."""
    return F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 15), 16, 10).cast("long") % 100 < percent


def linear_score(weights: dict[str, float] | None = None, bias: float = BIAS) -> Column:
    z = F.lit(bias)
    for name, w in (weights or LINEAR).items():
        z = z + F.lit(w) * F.col(name)
    return 1.0 / (1.0 + F.exp(-z))


def train(rows: DataFrame, kind: str = "gbt", rounds: int = 40, validation: str | None = None, names: list[str] | None = None, seed: int = 17) -> PipelineModel:
    """``validation``: a boolean column that marks rows for early stopping."""
    made = VectorAssembler(inputCols=names or [c for c in FEATURE_NAMES if c in rows.columns], outputCol="features")
    data = rows.withColumn("label", F.col("label").cast("double"))
    if kind == "logistic":
        return Pipeline(stages=[made, LogisticRegression(maxIter=rounds, regParam=1e-4)]).fit(data)
    model = GBTClassifier(maxIter=rounds, maxDepth=5, maxBins=128, stepSize=0.1, subsamplingRate=0.85, featureSubsetStrategy="0.85", minInstancesPerNode=20, seed=seed)
    if validation:
        model = model.setValidationIndicatorCol(validation)
    return Pipeline(stages=[made, model]).fit(data)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``score``, the probability of a match."""
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importances(model: PipelineModel, top: int = 20) -> list[tuple[str, float]]:
    """The features of most gain and their shares."""
    names = model.stages[0].getInputCols()
    gain = model.stages[-1].featureImportances.toArray()
    return sorted(((n, float(g)) for n, g in zip(names, gain, strict=True)), key=lambda x: (-x[1], x[0]))[:top]


def leave_one_out(rows: DataFrame, group: str = "country", rounds: int = 20) -> DataFrame:
    """Every group's rows scored by a model of the other groups; null where there is no other. A model a group."""
    out = None
    for r in rows.select(group).distinct().sort(group).collect():
        own, rest = rows.where(F.col(group) == r[0]), rows.where(F.col(group) != r[0])
        got = predict(train(rest, rounds=rounds), own) if rest.select("label").distinct().count() == 2 else own.withColumn("score", F.lit(None).cast("double"))
        out = got if out is None else out.unionByName(got)
    return out
