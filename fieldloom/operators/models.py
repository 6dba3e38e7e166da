"""Probability models on Spark ML: scaled logistic baseline, boosted trees with candidates, sigmoid calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import logit
from fieldloom.operators import metrics

CLIP = 1e-7


def weights(rows: DataFrame, target: str) -> DataFrame:
    """``rows`` with label and balanced weight; both classes must be there."""
    counts = {r.label: r.n for r in rows.groupBy(F.col(target).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if set(counts) != {0, 1}:
        raise ValueError(f"{target} needs both classes")
    total = sum(counts.values())
    label = F.col(target).cast("int")
    return rows.withColumn("label", label.cast("double")).withColumn("weight", F.when(label == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0])))


def _assembled(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="keep")


def filled(rows: DataFrame, features: list[str]) -> DataFrame:
    """Missing features as 0, as a sparse matrix has them."""
    return rows.fillna(0.0, subset=features)


def logistic(train: DataFrame, features: list[str], target: str, l2: float = 1e-4, rounds: int = 50) -> PipelineModel:
    """Standardised, balanced logistic regression."""
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    model = LogisticRegression(regParam=l2, maxIter=rounds, weightCol="weight", standardization=False)
    return Pipeline(stages=[_assembled(features), scaler, model]).fit(weights(filled(train, features), target))


@dataclass(frozen=True)
class Candidate:
    depth: int
    step: float
    rounds: int = 40
    subsample: float = 0.8
    name: str = field(default="")


CANDIDATES = (Candidate(3, 0.1, name="shallow"), Candidate(4, 0.1, name="middle"), Candidate(5, 0.05, name="deep"))


def boosted(train: DataFrame, tune: DataFrame, features: list[str], target: str, candidate: Candidate, seed: int = 7) -> PipelineModel:
    """Gradient-boosted trees that stop early on the tuning rows."""
    rows = weights(filled(train, features), target).withColumn("held", F.lit(False))
    held = weights(filled(tune, features), target).withColumn("held", F.lit(True)).select(*rows.columns)
    model = GBTClassifier(featuresCol="raw", maxDepth=candidate.depth, stepSize=candidate.step, maxIter=candidate.rounds, subsamplingRate=candidate.subsample, weightCol="weight", validationIndicatorCol="held", seed=seed, maxBins=64)
    return Pipeline(stages=[_assembled(features), model]).fit(rows.unionByName(held))


def predictions(model: PipelineModel, rows: DataFrame, features: list[str], into: str = "p") -> DataFrame:
    out = model.transform(filled(rows, features))
    return out.select(*rows.columns, vector_to_array("probability")[1].alias(into))


def best(rows: list[tuple[str, dict]]) -> str:
    """Name of the report with the highest PR AUC, then the lowest log loss, then the lowest Brier score."""
    return max(rows, key=lambda r: (r[1]["pr_auc"], -r[1]["log_loss"], -r[1]["brier"]))[0]


def chosen(train: DataFrame, tune: DataFrame, features: list[str], target: str, candidates: tuple[Candidate, ...] = CANDIDATES) -> tuple[Candidate, PipelineModel, list[tuple[str, dict]]]:
    """The best candidate on the tuning rows, its model and all reports."""
    models = {c.name: boosted(train, tune, features, target, c) for c in candidates}
    reports = [(n, metrics.report(predictions(m, tune, features), [], "p", target).head().asDict()) for n, m in models.items()]
    name = best(reports)
    return next(c for c in candidates if c.name == name), models[name], reports


@dataclass(frozen=True)
class Sigmoid:
    """p -> 1 / (1 + exp(-(a * logit(p) + b)))."""

    a: float
    b: float

    def __call__(self, p: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.a) * logit(p, CLIP) + F.lit(self.b))))


def calibrated(rows: DataFrame, p: str, target: str) -> Sigmoid:
    """Logistic regression on the clipped logit; its penalty is that of unit regularisation on summed losses."""
    data = rows.select(logit(F.col(p), CLIP).alias("z"), F.col(target).cast("double").alias("label"))
    n = data.count()
    out = VectorAssembler(inputCols=["z"], outputCol="features").transform(data)
    model = LogisticRegression(regParam=1.0 / n, standardization=False, maxIter=100).fit(out)
    return Sigmoid(float(model.coefficients[0]), float(model.intercept))


def beats(report: dict, baseline: dict) -> bool:
    return report["pr_auc"] > baseline["pr_auc"] and (report["brier"] <= baseline["brier"] or report["log_loss"] <= baseline["log_loss"])


def quality_gate(report: dict, baseline: dict) -> dict[str, bool]:
    """PR AUC at least the base rate, Brier score at most the base rate, and better than the baseline."""
    rate = report["positives"] / report["n"]
    gates = {"pr_auc": report["pr_auc"] / rate >= 1, "brier": report["brier"] / rate <= 1, "baseline": beats(report, baseline)}
    return gates | {"passed": all(gates.values())}


def diagnostics(rows: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """type_name from one-hot columns, game_state, progressive, dangerous_turnover, is_shot, is_goal of feature rows."""
    from fieldloom.functions.text import one_hot_name

    kind = one_hot_name({t: F.col(f"actiontype_{t}_a0") == 1 for t in types})
    state = F.when(F.col("goalscore_diff") > 0, "leading").when(F.col("goalscore_diff") < 0, "trailing").otherwise("drawing")
    rows = rows.withColumns({"type_name": kind, "game_state": state})
    shot = F.col("type_name").isin("shot", "shot_penalty", "shot_freekick")
    return rows.withColumns(
        {
            "progressive": F.col("dx_a0") >= 10,
            "dangerous_turnover": (F.col("result_fail_a0") == 1) & (F.col("start_x_a0") < 35),
            "is_shot": shot,
            "is_goal": shot & (F.col("result_success_a0") == 1),
        }
    )
