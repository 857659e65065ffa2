"""Machine-health model: index, split, train, evaluate, choose, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

# Feature order of training and scoring, and the tried settings.
FEATURES = ["1", "0", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11"]
EXPERIMENTS = [(20, 20), (15, 25), (25, 20)]


def indexed_name(column: str) -> str:
    return f"{column}_indexed"


def index_columns(df: DataFrame, label: str = "12", column: str = "1") -> DataFrame:
    """Index one feature column and the label; unseen values get their own index.

    Both have few distinct values (a reading in small whole steps, and a 0/1
    flag); only those distinct values pass through the driver.
    """
    stages = [StringIndexer(inputCol=column, outputCol=indexed_name(column), handleInvalid="keep"),
              StringIndexer(inputCol=label, outputCol="label", handleInvalid="keep")]
    return Pipeline(stages=stages).fit(df).transform(df)


def split_frame(df: DataFrame, train: float = 0.7, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    a, b = df.randomSplit([train, 1 - train], seed)
    return a, b


SPREAD_ROWS = 100_000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """The rows, kept, and dealt anew to the cores if one partition holds more than twice its share.

    A table of few row groups is read by as few tasks, and all training would stay in them.
    """
    kept = df.persist()
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    parts = min(-(-sum(sizes) // rows), df.sparkSession.sparkContext.defaultParallelism)
    if not parts or max(sizes) * parts <= 2 * sum(sizes):
        return kept
    dealt = kept.repartition(parts).persist()
    dealt.count()
    kept.unpersist()
    return dealt


def split_by_key(df: DataFrame, keys: Sequence[str], train: float = 0.7, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: a row falls on the same side on any partitioning, in any table, and at any time."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    inside = place < int(train * (1 << 32))
    return df.filter(inside), df.filter(~inside)


def health_pipeline(trees: int = 20, depth: int = 20, label: str = "12", column: str = "1",
                    features: Sequence[str] = FEATURES, as_category: bool = False, max_bins: int = 32,
                    seed: int = 0) -> Pipeline:
    """Index one feature, gather all, train a random forest; the label is 0 or 1 already.

    The indexed feature counts as a number, as it did for the model this
    follows; ``as_category`` keeps it a category and needs ``max_bins`` of at
    least the number of its values plus one.
    """
    if depth > 30:
        raise ValueError(f"a tree can be 30 deep at most, not {depth}")
    index = StringIndexer(inputCol=column, outputCol=indexed_name(column), handleInvalid="keep")
    plain = f"{column}_plain"
    strip = SQLTransformer(statement=f"SELECT *, `{indexed_name(column)}` + 0D AS `{plain}` FROM __THIS__")
    source = indexed_name(column) if as_category else plain
    gather = VectorAssembler(inputCols=[source if f == column else f for f in features],
                             outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, impurity="gini",
        maxBins=max_bins, seed=seed)
    return Pipeline(stages=[index, strip, gather, forest])


def score(model: PipelineModel, df: DataFrame, into: str = "result") -> DataFrame:
    """Rows of a table or stream with the model's answer: 1 healthy, 0 likely to break."""
    scored = model.transform(df)
    answer = scored["prediction"].cast("int").alias(into)
    probability = F.get(vector_to_array("probability"), F.lit(1)).alias("p_healthy")
    return scored.select(*df.columns, answer, probability)


def evaluate(scored: DataFrame, label: str = "12", score_col: str = "result") -> dict[str, float]:
    """Area under the ROC curve and the precision-recall curve."""
    frame = scored.select(
        F.col(label).cast("double").alias("label"), F.col(score_col).cast("double").alias("s")).persist()
    measure = lambda metric: BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="s", metricName=metric).evaluate(frame)
    try:
        return {"auroc": measure("areaUnderROC"), "ap": measure("areaUnderPR")}
    finally:
        frame.unpersist()


CELLS = 256


def ranked_metrics(scored: DataFrame, label: str = "12", score_col: str = "result", cells: int = CELLS) -> DataFrame:
    """Exact area under the ROC curve and average precision (mean of the precision at each step of recall), one row.

    Rows are folded to one per score, so ties count half; the scores are cut at
    quantiles into cells, the totals above a cell come from a table of cell
    totals, and only the scores of one cell are ordered together.  Null where
    one of the two classes is missing.
    """
    value = F.col(score_col).cast("double")
    positive = F.coalesce(F.col(label).cast("double") > 0, F.lit(False))
    folded = scored.filter(value.isNotNull()).groupBy(value.alias("s")).agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))
    steps = [i / cells for i in range(1, cells)]
    bounds = folded.agg(F.percentile_approx("s", steps, 100 * cells)).first()[0] or []
    cell = F.lit(0)
    if bounds:
        cell = F.size(F.filter(F.array_distinct(F.lit(bounds)), lambda b: b <= F.col("s")))
    folded = folded.withColumn("cell", cell)
    totals = folded.groupBy("cell").agg(F.sum("p").alias("cp"), F.sum("n").alias("cn"))  # a row a cell
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = totals.select("cell", F.coalesce(F.sum("cp").over(above), F.lit(0)).alias("ap"),
                           F.coalesce(F.sum("cn").over(above), F.lit(0)).alias("an"),
                           F.sum("cp").over(whole).alias("all_p"), F.sum("cn").over(whole).alias("all_n"))
    inside = Window.partitionBy("cell").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    placed = folded.join(F.broadcast(totals), "cell").withColumns({
        "tp": F.col("ap") + F.sum("p").over(inside), "fp": F.col("an") + F.sum("n").over(inside)})
    # Positives above each negative, those of the same score by half; doubled, so that all sums are whole.
    pairs = F.sum((F.col("n") * (2 * F.col("tp") - F.col("p"))).cast("decimal(38,0)"))
    precision = F.sum(F.col("p") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return placed.agg(pairs.alias("pairs"), precision.alias("precision"), F.max("all_p").alias("all_p"), F.max("all_n").alias("all_n")).select(
        (F.col("pairs").cast("double") / F.nullif(2.0 * F.col("all_p") * F.col("all_n"), F.lit(0.0))).alias("auroc"),
        F.when(F.col("all_n") > 0, F.col("precision") / F.nullif(F.col("all_p"), F.lit(0))).alias("ap"))


def importances(model: PipelineModel, features: Sequence[str] = FEATURES) -> dict[str, float]:
    """Feature importances by name."""
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist()))


def experiments(train: DataFrame, test: DataFrame, settings: Sequence[tuple[int, int]] = EXPERIMENTS,
                label: str = "12", score_col: str = "result", path: str | None = None,
                **options) -> tuple[DataFrame, PipelineModel]:
    """Train with each (trees, depth); metrics of all runs, and the model with the best AUROC, saved if asked."""
    runs, best, best_score = [], None, -1.0
    for trees, depth in settings:
        model = health_pipeline(trees, depth, label, **options).fit(train)
        metrics = evaluate(score(model, test), label, score_col)
        runs.append((trees, depth, "gini", metrics["auroc"], metrics["ap"]))
        if metrics["auroc"] > best_score:
            best, best_score = model, metrics["auroc"]
    if path:
        best.write().overwrite().save(path)
    table = train.sparkSession.createDataFrame(
        runs, "num_trees int, max_depth int, impurity string, auroc double, ap double")
    return table, best


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
