"""Supervised baseline: TF-IDF terms to a classifier, with a stratified split and cross-validation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import cut_lineage


def stratified_split(df: DataFrame, label: str, id_col: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``is_train``: within every class, the rows below the class's hash quantile."""
    from tarn.operators.joins import lookup
    from tarn.operators.quantiles import exact_quantiles

    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_003)).cast("double")
    drawn = df.withColumn("_draw", draw)
    edges = exact_quantiles(drawn, "_draw", [share], [label]).select(label, F.col("quantile").alias("_edge"))
    return lookup(drawn, edges, [label]).withColumn("is_train", F.col("_draw") < F.col("_edge")).drop("_draw", "_edge")


def _stages(idf: list[float], features: str) -> list:
    """Counts times the smoothed inverse document frequency, scaled to length 1."""
    return [ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=features, outputCol="idf"), Normalizer(inputCol="idf", outputCol="unit", p=2.0)]


def supervised(data: DataFrame, label: str, id_col: str, idf: list[float], features: str = "features", folds: int = 5, seed: int = 42):
    """(fitted pipeline, cross-validated weighted F1, scored test rows). Labels are 0, 1, 2, ..."""
    split = cut_lineage(stratified_split(data, label, id_col, seed=seed).withColumn(label, F.col(label).cast("double")))
    learner = LogisticRegression(labelCol=label, featuresCol="unit", maxIter=30, regParam=0.01)
    pipe = Pipeline(stages=[*_stages(idf, features), learner])
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="weightedFMeasure")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=ParamGridBuilder().build(), evaluator=judge, numFolds=folds, seed=seed, parallelism=2)
    fitted = cv.fit(split.filter("is_train"))
    scored = fitted.bestModel.transform(split.filter("NOT is_train")).select(id_col, label, "prediction")
    return fitted.bestModel, float(fitted.avgMetrics[0]), scored


def fit_forest(data: DataFrame, label: str, id_col: str, idf: list[float], features: str = "features", trees: int = 200, seed: int = 42):
    """One forest at its full size on the training part; importances need no folds."""
    train = stratified_split(data, label, id_col, seed=seed).filter("is_train").withColumn(label, F.col(label).cast("double"))
    learner = RandomForestClassifier(labelCol=label, featuresCol="unit", numTrees=trees, maxDepth=6, seed=seed)
    return Pipeline(stages=[*_stages(idf, features), learner]).fit(train)


def class_report(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    pairs = scored.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    by_actual = pairs.groupBy(F.col("actual").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    by_predicted = pairs.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("called"))
    out = by_actual.join(by_predicted, "class", "full").fillna(0)
    p, r = F.coalesce(F.try_divide("hit", "called"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return out.select("class", p.alias("precision"), r.alias("recall"),
                      F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support")


def importance(model, vocab: DataFrame, k: int = 25) -> DataFrame:
    """The k most predictive terms of a tree model, or of the largest absolute coefficients of a linear one."""
    spark = vocab.sparkSession
    learner = model.stages[-1]
    if hasattr(learner, "featureImportances"):
        values = learner.featureImportances.toArray()
    else:
        values = abs(learner.coefficientMatrix.toArray()).max(axis=0)
    table = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "term_id int, importance double")
    return table.join(F.broadcast(vocab.select("term_id", "term")), "term_id").select("term", "importance").orderBy(
        F.desc("importance"), "term").limit(k)
