"""Click-probability model on Spark ML, its evaluation and its result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.scalars import ratio
from adlake.operators.ordered import running_total
from adlake.operators.sampling import stratified_split
from adlake.session import materialize

CATEGORICAL = ("region", "device", "subscription_tier", "ad_format", "target_region")
SCALED = ("budget", "hour_of_day")
PLAIN = ("day_of_week", "is_peak_hour", "user_click_rate", "campaign_ctr_history")
FEATURES = CATEGORICAL + SCALED + PLAIN

# Stands for a missing number in the trees' input, below every real value, so that a
# split can tell it apart.
MISSING = -999.0


def _tree_input(rows: DataFrame) -> DataFrame:
    numbers = {f"{c}_value": F.col(c).cast("double") for c in (*SCALED, *PLAIN)}
    return rows.withColumns({n: F.coalesce(c, F.lit(MISSING)) for n, c in numbers.items()})


def split(training: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Training rows with ``is_test``, stratified by the label."""
    return stratified_split(training, "clicked", "impression_id", test_fraction, seed)


def scaler_statistics(train: DataFrame, columns: tuple[str, ...] = SCALED) -> DataFrame:
    """Mean and population deviation per column, as rows (feature, mean, std)."""
    stats = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}_mean").alias("mean"),
            # A constant column is only centred.
            F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std")).alias("std"),
        )
        for c in columns
    ]
    return stats.select(F.inline(F.array(*rows)))


def scale(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """Standardize columns by the given statistics (one small row per column)."""
    scaled = {
        row["feature"]: (F.col(row["feature"]).cast("double") - row["mean"]) / row["std"]
        for row in statistics.collect()
        if row["mean"] is not None  # a column without values stays as it is
    }
    return df.withColumns(scaled) if scaled else df


def class_weight(train: DataFrame) -> DataFrame:
    """Weight of the clicked class: not clicked / clicked, with both counts."""
    clicked = F.col("clicked") == 1
    return train.agg(
        F.count_if(~clicked).alias("negatives"), F.count_if(clicked).alias("positives")
    ).withColumn("positive_weight", ratio("negatives", "positives"))


@dataclass(frozen=True)
class ClickModel:
    pipeline: PipelineModel
    statistics: DataFrame


# Rows that are equal in all that the trees see are fitted as one of their joint weight. It
# stands for at most so many, as the rounds draw it as a whole.
EQUAL_ROWS = 16
# Rows of the fit that make a task of their own worth while, and the most that one holds.
TASK_ROWS, MOST_TASK_ROWS = 1 << 14, 1 << 19


def condensed(rows: DataFrame, most: int = EQUAL_ROWS) -> DataFrame:
    """Distinct rows with ``copies``: how many equal ones each stands for, ``most`` or fewer.

    More equal rows than that are dealt evenly to several.
    """
    counts = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.ceil(F.col("_n") / most)
    return counts.select(
        *rows.columns,
        (F.col("_n") / pieces).alias("copies"),
        F.explode(F.sequence(F.lit(1).cast("long"), pieces)).alias("_piece"),
    ).drop("_piece")


def _spread(rows: DataFrame) -> DataFrame:
    """Stored rows in as many parts as keep all cores busy: narrow files give few tasks."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(cores, n // TASK_ROWS), n // MOST_TASK_ROWS))


def fit(
    train: DataFrame,
    rounds: int = 300,
    learning_rate: float = 0.05,
    depth: int = 6,
    row_share: float = 0.8,
    feature_share: float = 0.8,
    seed: int = 42,
) -> ClickModel:
    """Boosted trees over encoded categories and scaled numbers, weighted by class.

    Scaling, class weight and trees come from all of ``train``. Every level of every round
    passes over its rows, so equal ones are joined first (see ``condensed``).
    """
    statistics = materialize(scaler_statistics(train), "scaler")
    weight = class_weight(train).first()["positive_weight"] or 1.0
    fitted = _spread(materialize(condensed(train.select("clicked", *FEATURES)), "fit"))
    rows = _tree_input(scale(fitted, statistics)).withColumn(
        "weight", F.col("copies") * F.when(F.col("clicked") == 1, float(weight)).otherwise(1.0)
    )
    encoded = [f"{c}_code" for c in CATEGORICAL]
    indexer = StringIndexer(
        inputCols=list(CATEGORICAL), outputCols=encoded, handleInvalid="keep"
    ).fit(rows)
    widest = max(len(labels) for labels in indexer.labelsArray) + 1
    assembler = VectorAssembler(
        inputCols=[*encoded, *[f"{c}_value" for c in (*SCALED, *PLAIN)]], outputCol="features"
    )
    trees = GBTClassifier(
        labelCol="clicked",
        weightCol="weight",
        maxIter=rounds,
        stepSize=learning_rate,
        maxDepth=depth,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(feature_share),
        maxBins=max(32, widest),
        seed=seed,
    )
    return ClickModel(Pipeline(stages=[indexer, assembler, trees]).fit(rows), statistics)


def predict(model: ClickModel, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The predictions table: features as the model saw them, label, score and class."""
    scored = model.pipeline.transform(_tree_input(scale(rows, model.statistics)))
    probability = vector_to_array("probability")[1]
    return as_predictions(scored.withColumn("predicted_prob", probability), threshold)


def as_predictions(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Predictions table from rows that already carry ``predicted_prob``."""
    return scored.select(
        "impression_id",
        "user_id",
        *FEATURES,
        F.col("clicked").alias("actual_clicked"),
        "predicted_prob",
        (F.col("predicted_prob") >= threshold).cast("int").alias("predicted_clicked"),
    )


def feature_importance(spark: SparkSession, model: ClickModel) -> DataFrame:
    """(feature, importance), most important first; one row per feature."""
    values = model.pipeline.stages[-1].featureImportances.toArray()
    rows = list(zip(FEATURES, (float(v) for v in values)))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def train_and_score(
    training: DataFrame, test_fraction: float = 0.2, seed: int = 42, **fit_options: object
) -> tuple[ClickModel, DataFrame]:
    """Split, fit on the train part, score the test part.

    The marked rows are stored, as every round of the fit reads them.
    """
    marked = materialize(split(training, test_fraction, seed))
    model = fit(marked.filter(~F.col("is_test")), seed=seed, **fit_options)
    return model, predict(model, marked.filter("is_test"))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class, overall, macro and weighted.

    A measure without cases to divide by is 0. In the accuracy row all three
    measures hold the accuracy.
    """
    actual, predicted = F.col("actual_clicked") == 1, F.col("predicted_clicked") == 1
    counts = predictions.agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )

    def share(part, whole):
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = counts.select(
        share(tn, tn + fn).alias("p0"),
        share(tn, tn + fp).alias("r0"),
        share(2 * tn, 2 * tn + fp + fn).alias("f0"),
        (tn + fp).alias("n0"),
        share(tp, tp + fp).alias("p1"),
        share(tp, tp + fn).alias("r1"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("n1"),
        share(tp + tn, tn + fp + fn + tp).alias("acc"),
    )
    n0, n1 = F.col("n0"), F.col("n1")

    def row(label, precision, recall, f1, support):
        return F.struct(
            F.lit(label).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(c):
        return (F.col(f"{c}0") + F.col(f"{c}1")) / 2

    def weighted(c):
        return share(F.col(f"{c}0") * n0 + F.col(f"{c}1") * n1, n0 + n1)

    acc = F.col("acc")
    rows = [
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), n0),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), n1),
        row("accuracy", acc, acc, acc, n0 + n1),
        row("macro avg", macro("p"), macro("r"), macro("f"), n0 + n1),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), n0 + n1),
    ]
    return per_class.select(F.inline(F.array(*rows)))


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve, exact with tied scores: one row (auc, positives, negatives).

    Counts per distinct score are ordered by a running total; a clicked row beats
    every unclicked row with a lower score and half of those with the same score.
    """
    actual = F.col("actual_clicked") == 1
    per_score = (
        predictions.filter(F.col("predicted_prob").isNotNull())
        .groupBy("predicted_prob")
        .agg(F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg"))
    )
    ranked = running_total(per_score, ["predicted_prob"], "neg", "neg_upto")
    # Exact integers: twice the number of wins, as half wins occur.
    wins = F.col("pos").cast("decimal(19,0)") * (2 * F.col("neg_upto") - F.col("neg"))
    return ranked.agg(
        F.sum(wins).alias("_wins"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    ).select(
        (
            F.col("_wins").cast("double")
            / F.nullif(
                2 * F.col("positives").cast("double") * F.col("negatives").cast("double"),
                F.lit(0.0),
            )
        ).alias("auc"),
        "positives",
        "negatives",
    )
