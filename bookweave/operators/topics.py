"""Topic training sets and classification."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import bounded
from .topic_dictionary import TOPICS

SIZES = (1000, 5000, 15000)  # benchmark, test, and how many there must be at least


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TOPICS.items()), "topic string, target_topic string")


def training_set(topics: DataFrame, dictionary: DataFrame, *, benchmark: int = SIZES[0], test: int = SIZES[1], least: int = SIZES[2], seed: str = "0") -> DataFrame:
    """barcode, target_topic, set. Single known subjects only; the split is by a hash order, the same on every cluster.

    Only the first ``benchmark + test`` rows of the order are numbered: top-k per task, not a sort of all.
    """
    one = topics.filter(F.col("from_metadata").isNotNull() & ~F.contains("from_metadata", F.lit(","))).join(bounded(dictionary.select(F.col("topic").alias("from_metadata"), "target_topic")), "from_metadata")
    if least and one.count() < least:
        raise ValueError(f"fewer than {least} books with a single known topic")
    key = F.md5(F.concat("barcode", F.lit(seed)))
    first = one.select("barcode", key.alias("k")).orderBy("k", "barcode").limit(benchmark + test)
    order = Window.orderBy("k", "barcode")
    first = first.withColumn("n", F.row_number().over(order)).select("barcode", F.when(F.col("n") <= benchmark, "benchmark").otherwise("test").alias("set"))
    return one.join(first, "barcode", "left").select("barcode", "target_topic", F.coalesce("set", F.lit("train")).alias("set"))


def train(prompts: DataFrame, features: int = 1 << 14):
    """prompts: prompt, target_topic. An MLlib pipeline as the offline stand-in for a hosted model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer

    index = StringIndexer(inputCol="target_topic", outputCol="label").fit(prompts)
    return Pipeline(stages=[index.setHandleInvalid("keep"), RegexTokenizer(inputCol="prompt", outputCol="words", pattern=r"\W+"), HashingTF(inputCol="words", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features"), LogisticRegression(maxIter=20), IndexToString(inputCol="prediction", outputCol="from_detection", labels=index.labels)]).fit(prompts)


def require(sets: DataFrame, *, benchmark: int = SIZES[0], test: int = SIZES[1], train: int = 6000) -> None:
    """ValueError unless every set has enough books to train and judge a classifier."""
    have = {r["set"]: r["count"] for r in sets.groupBy("set").count().collect()}
    for name, least in (("benchmark", benchmark), ("test", test), ("train", train)):
        if have.get(name, 0) < least:
            raise ValueError(f"{have.get(name, 0)} books in the {name} set, {least} needed")


def infer(prompts: DataFrame, predict: Callable[[pd.Series], pd.DataFrame] | None = None, *, model=None, source: str = "classifier") -> DataFrame:
    """barcode, from_detection, detection_source, detection_confidence of each prompt; books without a prompt have no row.

    predict: an Arrow function from prompts to (label, score), such as a hosted model; model: a pipeline of train().
    """
    known = prompts.filter("prompt is not null")
    if predict is not None:
        said = known.withColumn("said", F.pandas_udf(predict, "label string, score double")("prompt")).filter("said.label is not null")
        return said.select("barcode", F.col("said.label").alias("from_detection"), F.lit(source).alias("detection_source"), F.col("said.score").alias("detection_confidence"))
    from pyspark.ml.functions import vector_to_array

    best = F.array_max(vector_to_array("probability"))
    return model.transform(known).select("barcode", "from_detection", F.lit(source).alias("detection_source"), best.alias("detection_confidence"))


def benchmark_rows(prompts: DataFrame, predicted: DataFrame, sets: DataFrame, model_name: str) -> DataFrame:
    """The benchmark set, one row per book: prompt, target, answer, confidence, whether they match, and the model's name."""
    d = sets.filter("set = 'benchmark'").join(prompts, "barcode", "left").join(predicted, "barcode", "left")
    match = F.when(F.coalesce(F.col("from_detection") == F.col("target_topic"), F.lit(False)), "YES").otherwise("NO")
    return d.select("barcode", "prompt", "target_topic", F.col("from_detection").alias("detected_topic"), F.col("detection_confidence").alias("confidence"), match.alias("match"), F.lit(model_name).alias("model_name"))


def benchmark(predicted: DataFrame, sets: DataFrame) -> DataFrame:
    """Matches and mismatches on the benchmark set. predicted: barcode, from_detection."""
    d = sets.filter("set = 'benchmark'").join(predicted, "barcode")
    same = F.col("from_detection") == F.col("target_topic")
    return d.agg(F.count_if(same).alias("matches"), F.count_if(~F.coalesce(same, F.lit(False))).alias("mismatches"))
