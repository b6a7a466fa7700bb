"""Training and applying the text scorer."""

from __future__ import annotations

from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled(rows: DataFrame) -> DataFrame:
    """The training rows: neither text nor label NULL, the label as a whole number."""
    return rows.dropna(subset=["text", "label"]).withColumn("label", F.col("label").cast("int"))


def stratified_split(rows: DataFrame, key: str, share: float = 0.2) -> DataFrame:
    """rows with is_test: of each label the share whose hashed keys come first.

    Counted per label and hash range, so no task ranks a whole label: ranges below the cut go
    whole, and only the range of the cut is ranked.
    """
    h = F.md5(F.col(key).cast("string"))
    rows = rows.withColumn("_h", h).withColumn("_r", F.substring("_h", 1, 3))
    sizes = rows.groupBy("label", "_r").agg(F.count("*").alias("n"))
    w = Window.partitionBy("label")
    plan = sizes.select(F.col("label").alias("_label"), F.col("_r").alias("_range"), F.coalesce(F.sum("n").over(w.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.round(F.sum("n").over(w) * share).cast("long").alias("_want"))
    place = F.row_number().over(Window.partitionBy("label", "_r").orderBy("_h", key))
    joined = rows.join(plan, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_r") == F.col("_range"))).drop("_label", "_range")
    return joined.withColumn("is_test", F.col("_before") + place <= F.col("_want")).drop("_h", "_r", "_before", "_want")


def class_weights(rows: DataFrame) -> DataFrame:
    """(n, positive, negative, weight): the weight of the positive class, negatives by positives."""
    n, pos = F.count("*"), F.count_if(F.col("label") == 1)
    return rows.agg(n.alias("n"), pos.alias("positive"), (n - pos).alias("negative"), ((n - pos) / F.greatest(pos, F.lit(1))).alias("weight"))


def binary_metrics(rows: DataFrame, label: Column, predicted: Column) -> DataFrame:
    """(n, tp, fp, fn, accuracy, f1) of class 1; F1 is 0 without any positive."""
    y, p = label == 1, predicted == 1
    # Counted by condition: a filter on the prediction would be computed once more, below what it is computed from.
    counts = rows.agg(F.count_if(y.isNotNull() & p.isNotNull()).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    wrong = F.col("fp") + F.col("fn")
    return counts.select("*", F.when(F.col("n") > 0, (F.col("n") - wrong) / F.col("n")).alias("accuracy"), F.when(F.col("tp") > 0, 2 * F.col("tp") / (2 * F.col("tp") + wrong)).otherwise(F.lit(0.0)).alias("f1"))


def mean_loss(rows: DataFrame, label: Column, p: Column, weight: float = 1.0, edge: float = 1e-7) -> DataFrame:
    """(n, loss): the weighted mean cross entropy of probabilities p of class 1, which counts `weight` times.

    Rows with a NULL label, NULL or NaN p are left out; p is kept off 0 and 1 by the edge. NULL without rows.
    """
    q = F.greatest(F.least(p, F.lit(1 - edge)), F.lit(edge))
    w = F.when(label == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
    good = rows.filter(label.isNotNull() & p.isNotNull() & ~F.isnan(p))
    return good.agg(F.count("*").alias("n"), (-F.sum(w * F.when(label == 1, F.log(q)).otherwise(F.log(1 - q))) / F.sum(w)).alias("loss"))


def positive_probability(zero: Column, one: Column) -> Column:
    """The softmax share of class 1 of two logits."""
    top = F.greatest(zero, one)
    return F.exp(one - top) / (F.exp(zero - top) + F.exp(one - top))


class Scorer(Protocol):
    def __call__(self, df: DataFrame, text: Column) -> DataFrame:
        """df with column p."""


def constant_scorer(value: float = 0.0) -> Scorer:
    """The degraded mode: without a model every probability is its default."""
    return lambda df, text: df.withColumn("p", F.lit(float(value)))


def train_scorer(rows: DataFrame, features: int = 1 << 16, iterations: int = 20) -> PipelineModel:
    """A weighted logistic regression over hashed words: the task of the neural scorer, not the same model."""
    good = labelled(rows)
    weight = good.transform(class_weights).first()["weight"] or 1.0
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"), HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_x"), LogisticRegression(featuresCol="_x", labelCol="label", weightCol="_w", maxIter=iterations, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(good.withColumn("_w", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0))))


def load_scorer(path: str) -> Scorer:
    """The scorer saved at path; the degraded mode where there is none."""
    try:
        return model_scorer(PipelineModel.load(path))
    except Exception as e:  # noqa: BLE001 - the readers' errors differ by file system
        if "not exist" in str(e):
            return constant_scorer()
        raise


def model_scorer(model: PipelineModel) -> Scorer:
    def score(df: DataFrame, text: Column) -> DataFrame:
        kept = df.columns
        out = model.transform(df.withColumn("text", F.coalesce(text, F.lit(""))))
        return out.select(*(df[c] if c == "text" else F.col(c) for c in kept), vector_to_array("probability")[1].alias("p"))

    return score
