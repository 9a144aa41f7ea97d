"""Training, prediction and evaluation with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.ml import metrics
from lociflow.operators.splits import stratified_folds, stratified_holdout

#: Trees, and their depth: the greatest that the library grows; leaves may hold a single row.
TREES, DEPTH = 300, 30
ITERATIONS = 2000


def weigh(rows: DataFrame, class_weight: str | None) -> DataFrame:
    """rows with ``weight``: 1, or for ``balanced`` inversely to the size of the class."""
    if class_weight is None:
        return rows.withColumn("weight", F.lit(1.0))
    if class_weight != "balanced":
        raise ValueError(f"unknown class weight: {class_weight}")
    counts = rows.groupBy("y").agg(F.count("*").alias("__n"))
    share = counts.crossJoin(counts.agg(F.sum("__n").alias("__all"), F.count("*").alias("__k")))
    return rows.join(share.select("y", (F.col("__all") / (F.col("__k") * F.col("__n"))).alias("weight")), "y")


def build_model(kind: str, rows: int, seed: int = 42, standardize: bool = True) -> Pipeline:
    """Logistic regression with a unit L2 penalty on the summed loss, or a random forest; columns features, y and
    weight."""
    stages, column = [], "x"
    if kind == "logistic_regression":
        if standardize:
            stages.append(StandardScaler(inputCol="x", outputCol="x_scaled", withMean=True, withStd=True))
            column = "x_scaled"
        model = LogisticRegression(
            featuresCol=column, labelCol="y", weightCol="weight", maxIter=ITERATIONS, regParam=1.0 / max(1, rows),
            elasticNetParam=0.0, standardization=False
        )
    elif kind == "random_forest":
        model = RandomForestClassifier(
            featuresCol=column, labelCol="y", weightCol="weight", numTrees=TREES, maxDepth=DEPTH,
            featureSubsetStrategy="sqrt", seed=seed
        )
    else:
        raise ValueError(f"unknown model: {kind}")
    return Pipeline(stages=[*stages, model])


def with_vector(rows: DataFrame, features: str = "features") -> DataFrame:
    return rows.withColumn("x", array_to_vector(F.col(features).cast("array<double>")))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with pred, proba (array) and score, the probability of class 1."""
    out = model.transform(with_vector(rows)).withColumn("proba", vector_to_array("probability"))
    return out.withColumn("pred", F.col("prediction").cast("int")).withColumn(
        "score", F.try_element_at("proba", F.lit(2))
    ).drop(
        "x", "x_scaled", "rawPrediction", "probability", "prediction"
    )


def fit(
    rows: DataFrame, kind: str, class_weight: str | None = "balanced", seed: int = 42, standardize: bool = True
) -> PipelineModel:
    train = with_vector(weigh(rows, class_weight)).withColumn("y", F.col("y").cast("double"))
    return build_model(kind, train.count(), seed, standardize).fit(train)


def evaluate(predicted: DataFrame, task: str, classes: int) -> DataFrame:
    return metrics.binary_metrics(predicted) if task == "binary" else metrics.multiclass_metrics(
        predicted, proba="proba", classes=classes
    )


def holdout(
    rows: DataFrame, key: str, kind: str, task: str, classes: int, test_ratio: float = 0.2, seed: int = 42, **options
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model, predictions of the test rows, and their metrics."""
    parts = stratified_holdout(rows, "y", key, test_ratio, seed)
    model = fit(parts.where("split = 'train'"), kind, seed=seed, **options)
    predicted = predict(model, parts.where("split = 'test'"))
    return model, predicted, evaluate(predicted, task, classes)


def cross_validate(
    rows: DataFrame, key: str, kind: str, task: str, classes: int, folds: int = 5, seed: int = 42, **options
) -> tuple[DataFrame, DataFrame]:
    """Predictions of all rows, each by the model that did not see it, with ``fold``; and metrics of each fold."""
    parts = stratified_folds(rows, "y", key, folds, seed)
    predictions, scores = [], []
    for k in range(folds):
        model = fit(parts.where(F.col("fold") != k), kind, seed=seed + k, **options)
        predicted = predict(model, parts.where(F.col("fold") == k))
        predictions.append(predicted)
        scores.append(evaluate(predicted, task, classes).withColumn("fold", F.lit(k)))
    union = lambda frames: frames[0] if len(frames) == 1 else union([frames[0].unionByName(frames[1]), *frames[2:]])
    return union(predictions), union(scores)


def prediction_table(predicted: DataFrame, names: Sequence[str], split: str) -> DataFrame:
    """site_id, split, true and predicted class, and a probability for each class."""
    name = F.array(*map(F.lit, names))
    return predicted.select(
        "site_id", F.lit(split).alias("split"), F.element_at(name, F.col("y").cast("int") + 1).alias("true_label"),
        F.element_at(name, F.col("pred") + 1).alias("pred_label"),
        *[F.element_at("proba", i + 1).alias(f"prob_{n}") for i, n in enumerate(names)]
    )


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_pickle(path: str, allow_code: bool = False):
    """A model from a pickle or, by the ending .joblib or .jl, a joblib file, unwrapped from ``model`` or ``predictor``.
    Unpickling runs code: it must be allowed."""
    if not allow_code:
        raise PermissionError("unpickling runs code from the file; pass allow_code=True for files you trust")
    if path.lower().endswith((".joblib", ".jl")):
        try:
            import joblib
        except ImportError as e:
            raise ImportError("this model file needs joblib") from e
        model = joblib.load(path)
    else:
        import pickle

        with open(path, "rb") as f:
            model = pickle.load(f)  # noqa: S301
    if isinstance(model, dict):
        model = next((model[k] for k in ("model", "predictor") if k in model), model)
    if not hasattr(model, "predict"):
        raise TypeError("the file holds no model with predict")
    return model


def feature_order(model, columns: Sequence[str]) -> list[str]:
    """The columns in the order that a fitted model names; a column that it lacks is an error."""
    wanted = [str(c) for c in getattr(model, "feature_names_in_", columns)]
    if missing := [c for c in wanted if c not in set(columns)]:
        raise ValueError(f"features without a column: {missing[:20]}")
    return wanted


def predict_frame(model, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows with predicted_phenotype by a fitted model with ``predict``; the model travels to the workers once."""
    order = feature_order(model, columns)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = rows.columns

    def run(batches):
        for b in batches:
            yield b[names].assign(predicted_phenotype=[float(x) for x in shared.value.predict(b[order])])

    return rows.mapInPandas(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", predicted_phenotype double"
    )
