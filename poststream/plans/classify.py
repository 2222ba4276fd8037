"""Queries: classifier features, labels, split, training, tuning, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokenize_skills
from ..operators import model as ml
from ..session import materialize, scratch_path
from ..sources.files import read_training
from . import fixtures as fx
from .dashboard import PRELUDE, index
from .registry import query

TRAIN_SQL = PRELUDE + """,
train_rows AS (SELECT id, CASE WHEN array_to_string(skills_array, ', ') = '' THEN NULL
                              ELSE array_to_string(skills_array, ', ') END AS skills,
                      label AS category FROM idx),
kept AS (SELECT * FROM train_rows WHERE skills IS NOT NULL AND category IS NOT NULL)"""

_BUCKET_SQL = "CAST(('0x' || substr(md5(id), 1, 8)) AS BIGINT) % {parts}"


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.drop_missing(ml.training_rows(index(spark, sf_dir)))


def _split_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read many times by the fits: extraction runs once, then a checkpoint
    return materialize(ml.holdout(_training(spark, sf_dir)))


_CSV_TEXT = "say \"hi\", ok"


@query("training_csv", f"WITH {fx.POSTS_CTE} SELECT title || chr(10) || '{_CSV_TEXT}' AS skills, "
       "category FROM posts WHERE category IS NOT NULL")
def q_training_csv(spark, sf_dir):
    """A training CSV whose fields hold quotes, commas and line breaks, written and read."""
    path = scratch_path(spark, "training-csv")
    rows = fx.texts(spark, sf_dir).select(
        F.concat("title", F.lit("\n" + _CSV_TEXT)).alias("skills"), "category")
    rows.where("category IS NOT NULL").write.option("header", True).option("escape", '"').option(
        "quoteAll", True).csv(path)
    return read_training(spark, path, multi_line=True)


@query("tokenize_skills", TRAIN_SQL + """ SELECT id,
 list_filter(regexp_split_to_array(skills, '\\s*,\\s*'), lambda t: length(t) > 0) AS tokens
 FROM train_rows""")
def q_tokenize_skills(spark, sf_dir):
    return ml.training_rows(index(spark, sf_dir)).select(
        "id", tokenize_skills("skills").alias("tokens"))


@query("skill_term_freq", TRAIN_SQL + """ SELECT token, count(*) AS n FROM (
 SELECT unnest(list_filter(regexp_split_to_array(skills, '\\s*,\\s*'), lambda t: length(t) > 0))
   AS token FROM kept) GROUP BY token""")
def q_skill_term_freq(spark, sf_dir):
    return (_training(spark, sf_dir).select(F.explode(tokenize_skills("skills")).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


@query("drop_missing", TRAIN_SQL + " SELECT id, skills, category FROM kept")
def q_drop_missing(spark, sf_dir):
    return _training(spark, sf_dir)


@query("label_index", TRAIN_SQL + """ SELECT category,
 CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS DOUBLE) AS label,
 count(*) AS n FROM kept GROUP BY category""")
def q_label_index(spark, sf_dir):
    return ml.label_index(_training(spark, sf_dir))


@query("holdout_split", TRAIN_SQL + f""" SELECT id,
 CASE WHEN {_BUCKET_SQL.format(parts=10)} < 8 THEN 'train' ELSE 'test' END AS split FROM kept""")
def q_holdout_split(spark, sf_dir):
    return ml.holdout(_training(spark, sf_dir)).select("id", "split")


@query("accuracy_metric", PRELUDE + """ SELECT avg(CAST(category = label AS DOUBLE)) AS accuracy
 FROM idx""")
def q_accuracy_metric(spark, sf_dir):
    """Accuracy operator on the rule-based category against the label."""
    return ml.accuracy(index(spark, sf_dir), "label", "category")


_FITS: dict[tuple[str, str], tuple] = {}


def _fit(spark: SparkSession, sf_dir: str):
    """(training table with its split, model), fitted once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITS:
        _FITS[key] = _fit_new(spark, sf_dir)
    return _FITS[key]


def _fit_new(spark: SparkSession, sf_dir: str):
    data = _split_training(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    indexer = ml.fit_label_indexer(data)          # whole set, before the split
    model = ml.build_classifier(indexer).fit(train)
    return data, model


@query("classify_posts", TRAIN_SQL + f""" SELECT id, category,
 CASE WHEN {_BUCKET_SQL.format(parts=10)} < 8 THEN 'train' ELSE 'test' END AS split,
 true AS label_known FROM kept""")
def q_classify_posts(spark, sf_dir):
    """Every post scored; the columns that do not depend on fitted weights: its
    split, and that the prediction is one of the training labels."""
    data, model = _fit(spark, sf_dir)
    known = ml.fit_label_indexer(data).labels
    return ml.score(data, model).select(
        "id", "category", "split", F.col("predicted_category").isin(known).alias("label_known"))


@query("predicted_categories")
def q_predicted_categories(spark, sf_dir):
    data, model = _fit(spark, sf_dir)
    return ml.score(data, model).select("id", "category", "predicted_category", "split")


def _differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Posts of both sides, and how many of them are predicted differently."""
    a = left.select("id", F.col("predicted_category").alias("left"))
    b = right.select("id", F.col("predicted_category").alias("right"))
    return a.join(b, "id", "full").agg(
        F.count("left").alias("posts"),
        F.count_if(~F.col("left").eqNullSafe(F.col("right"))).alias("differences"))


SAME_SQL = TRAIN_SQL + " SELECT count(*) AS posts, CAST(0 AS BIGINT) AS differences FROM kept"


@query("score_by_join", SAME_SQL)
def q_score_by_join(spark, sf_dir):
    """Predictions from the weights as a table against the fitted pipeline's."""
    data, model = _fit(spark, sf_dir)
    return _differences(ml.score_by_join(data, model), ml.score(data, model))


@query("saved_model_parity", SAME_SQL)
def q_saved_model_parity(spark, sf_dir):
    """The pipeline, saved and loaded, predicts what it did before."""
    data, model = _fit(spark, sf_dir)
    path = scratch_path(spark, "saved-model")
    ml.save_model(model, path)
    return _differences(ml.score(data, ml.load_model(path)), ml.score(data, model))


@query("holdout_accuracy")
def q_holdout_accuracy(spark, sf_dir):
    data, model = _fit(spark, sf_dir)
    return ml.accuracy(ml.score(data.where(F.col("split") == "test"), model))


@query("sample_predictions")
def q_sample_predictions(spark, sf_dir):
    data, model = _fit(spark, sf_dir)
    return ml.sample(ml.score(data.where(F.col("split") == "test"), model))


@query("tune_report")
def q_tune_report(spark, sf_dir):
    data = _split_training(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    pipeline = ml.build_classifier(ml.fit_label_indexer(data))
    cv = ml.tune(train, pipeline)
    return spark.createDataFrame(ml.tune_report(cv),
                                 "max_iter int, reg_param double, accuracy double")
