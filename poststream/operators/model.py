"""Multi-class category classifier on skill terms (Spark ML).

Pipeline: label indexer (fitted on the whole set, most frequent label = 0)
-> tokenizer on commas -> hashing term frequencies (20,000 slots) ->
logistic regression (multinomial for more than two labels) -> index back to
the label text.  Training is distributed by Spark ML (gradients are
tree-aggregated over partitions).

Splits and folds come from a hash of the post id, so they do not depend on
how the input happens to be partitioned (``randomSplit`` does).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..defaults import (BEST_MAX_ITER, BEST_REG_PARAM, GRID_MAX_ITER, GRID_REG_PARAM, NUM_FEATURES,
                        NUM_FOLDS, SPLIT_PARTS, TRAIN_PARTS)
from ..functions.text import skills_text
from ..session import materialize

def drop_missing(df: DataFrame, cols: Sequence[str] = ("skills", "category")) -> DataFrame:
    """Training rows need both the skills text and the category."""
    return df.na.drop(subset=list(cols))


def training_rows(index: DataFrame, skills: str = "skills_array", label: str = "label",
                  key: str = "id") -> DataFrame:
    """Training table from enriched posts: ``skills`` text as in a CSV (no
    skill -> NULL, like an empty CSV field) and the ``category`` label."""
    text = skills_text(skills)
    return index.select(F.col(key).alias("id"),
                        F.when(text == "", F.lit(None)).otherwise(text).alias("skills"),
                        F.col(label).alias("category"))


def bucket(key: str | Column, parts: int) -> Column:
    """Stable bucket 0..parts-1 of a key from the first 32 bits of its MD5."""
    c = F.col(key) if isinstance(key, str) else key
    word = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(word, F.lit(parts))


def holdout(df: DataFrame, key: str = "id", train: int = TRAIN_PARTS,
            of: int = SPLIT_PARTS) -> DataFrame:
    """Add ``split`` = train / test (train share ``train/of``), by key hash."""
    return df.withColumn("split", F.when(bucket(key, of) < train, F.lit("train"))
                         .otherwise(F.lit("test")))


def label_index(df: DataFrame, col: str = "category") -> DataFrame:
    """Label order of the indexer: frequency descending, ties alphabetical.
    One row per class; the ordering window runs over the (few) classes."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc(col))
    return counts.select(col, (F.row_number().over(w) - 1).cast("double").alias("label"), "n")


def fit_label_indexer(df: DataFrame, col: str = "category", out: str = "label"
                      ) -> StringIndexerModel:
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc",
                         handleInvalid="error").fit(df)


def build_classifier(indexer: StringIndexerModel, num_features: int = NUM_FEATURES,
                     compat: bool = False, max_iter: int = BEST_MAX_ITER,
                     reg_param: float = BEST_REG_PARAM) -> Pipeline:
    """The five-stage pipeline.  ``compat=True`` tokenizes on ``,`` alone."""
    tokenizer = RegexTokenizer(inputCol="skills", outputCol="tokens",
                               pattern="," if compat else r"\s*,\s*", gaps=True,
                               toLowercase=False, minTokenLength=1)
    hashing = HashingTF(inputCol="tokens", outputCol="features", numFeatures=num_features)
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                            regParam=reg_param)   # family "auto": multinomial for > 2 labels
    back = IndexToString(inputCol="prediction", outputCol="predicted_category",
                         labels=indexer.labels)
    return Pipeline(stages=[indexer, tokenizer, hashing, lr, back])


def _lr(pipeline: Pipeline) -> LogisticRegression:
    return next(s for s in pipeline.getStages() if isinstance(s, LogisticRegression))


def param_grid(pipeline: Pipeline, max_iter: Sequence[int] = GRID_MAX_ITER,
               reg_param: Sequence[float] = GRID_REG_PARAM):
    lr = _lr(pipeline)
    return ParamGridBuilder().addGrid(lr.maxIter, list(max_iter)) \
        .addGrid(lr.regParam, list(reg_param)).build()


def evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                             metricName="accuracy")


def tune(train: DataFrame, pipeline: Pipeline, grid=None, folds: int = NUM_FOLDS,
         key: str = "id", parallelism: int = 4) -> CrossValidatorModel:
    """k-fold grid search by accuracy; folds from the key hash (repeatable).

    Labels and features do not depend on the grid, so they are built once and
    written; only the regression is fitted per fold and grid point.
    ``bestModel`` is the whole pipeline again.
    """
    grid = grid or param_grid(pipeline)
    stages, lr = pipeline.getStages(), _lr(pipeline)
    at = stages.index(lr)
    front = Pipeline(stages=stages[:at]).fit(train)
    features = materialize(front.transform(train.withColumn("fold", bucket(key, folds).cast("int")))
                           .select("label", "features", "fold"))
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=evaluator(),
                        numFolds=folds, foldCol="fold", parallelism=parallelism).fit(features)
    cv.bestModel = PipelineModel(front.stages + [cv.bestModel] + stages[at + 1:])
    return cv


def tune_report(cv_model: CrossValidatorModel) -> list[tuple[int, float, float]]:
    """(maxIter, regParam, mean accuracy) per grid point."""
    rows = []
    for params, metric in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        named = {p.name: v for p, v in params.items()}
        rows.append((int(named["maxIter"]), float(named["regParam"]), float(metric)))
    return rows


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Apply a fitted pipeline; without a category column the label indexer
    stage is skipped, so this serves unlabeled batches and streams alike."""
    return model.transform(df)


def _stage(model: PipelineModel, kind: type):
    return next(s for s in model.stages if isinstance(s, kind))


def weights_table(spark: SparkSession, model: PipelineModel) -> tuple[DataFrame, DataFrame]:
    """The fitted regression as tables: (slot, label, weight) without zeros, and
    (label, category, intercept).  At most slots x categories rows.  Of two labels
    the regression holds one row of margins: the other's are zero."""
    lr = _stage(model, LogisticRegressionModel)
    matrix, base = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    first = lr.numClasses - len(base)           # 1 if there are two labels
    rows = [(int(slot), int(label) + first, float(matrix[label, slot]))
            for label, slot in zip(*matrix.nonzero())]
    names = _stage(model, IndexToString).getLabels()
    labels = [(i, names[i], float(base[i - first]) if i >= first else 0.0) for i in range(lr.numClasses)]
    return (spark.createDataFrame(rows, "slot int, label int, weight double"),
            spark.createDataFrame(labels, "label int, category string, intercept double"))


def slot_table(tokens: DataFrame, model: PipelineModel) -> DataFrame:
    """(token, slot) of the distinct ``tokens``, by the pipeline's own hashing stage."""
    hashing = _stage(model, HashingTF)
    one = hashing.transform(tokens.select("token").distinct()
                            .withColumn(hashing.getInputCol(), F.array("token")))
    slots = vector_to_array(F.col(hashing.getOutputCol()))
    return one.select("token", (F.array_position(slots, 1.0) - 1).cast("int").alias("slot"))


def score_by_join(df: DataFrame, model: PipelineModel, key: str = "id", skills: str = "skills"
                  ) -> DataFrame:
    """(key, margin, predicted_category): what the fitted pipeline predicts, from its
    weights as a table.  Tokens join slots and weights, margins are sums, the category
    is the one of the largest margin (of equal ones the more frequent).  ``key`` must be
    unique; a frequent token is cut down to a row per post before it meets its weights,
    and the tables are as small as the model, so posts are shuffled by key alone."""
    spark = df.sparkSession
    tokenizer = _stage(model, RegexTokenizer)
    weights, labels = weights_table(spark, model)
    pattern = tokenizer.getPattern()
    split = F.filter(F.split(F.col(skills), pattern, -1),
                     lambda t: F.length(t) >= tokenizer.getMinTokenLength())
    tokens = df.select(F.col(key), F.explode(split).alias("token"))
    shares = (tokens.join(slot_table(tokens, model), "token").join(weights, "slot")
              .select(key, "label", F.col("weight").alias("part")))
    # every category of every post, so that a post without tokens has its intercepts
    base = F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.lit(r["intercept"]).alias("part"))
                     for r in labels.collect()])
    whole = df.select(F.col(key), F.explode(base).alias("b")).select(key, "b.label", "b.part")
    margins = shares.unionByName(whole).groupBy(key, "label").agg(F.sum("part").alias("margin"))
    best = margins.groupBy(key).agg(F.max(F.struct("margin", (-F.col("label")).alias("label"))).alias("m"))
    return (best.select(key, "m.margin", (-F.col("m.label")).alias("label")).join(labels, "label")
            .select(key, "margin", F.col("category").alias("predicted_category")))


def sample(df: DataFrame, n: int = 20) -> DataFrame:
    """A few predictions to eyeball, the same ones in every run."""
    cols = ["skills", "category", "predicted_category"]
    order = (["id"] if "id" in df.columns else []) + cols
    return df.orderBy(*order).select(*cols).limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
