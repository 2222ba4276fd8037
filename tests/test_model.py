import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from poststream.operators import model as ml
from poststream.sources.files import read_training

ROWS = [("1", "python, aws", "Backend"), ("2", "react, css", "Frontend"),
        ("3", "python, django", "Backend"), ("4", "aws, terraform", "Cloud/Network"),
        ("5", "react, typescript", "Frontend"), ("6", "python, aws, docker", "Backend"),
        ("7", None, "Backend"), ("8", "css", None)]


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(ROWS * 5, "id string, skills string, category string") \
        .withColumn("id", F.concat("id", F.monotonically_increasing_id().cast("string")))


def test_read_training_all_text(spark, tmp_path):
    p = tmp_path / "train.csv"
    p.write_text('skills,category\n"python, aws",Backend\n,Frontend\n12,IA\n')
    df = read_training(spark, str(p))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    assert ml.drop_missing(df).count() == 2


def test_label_index_matches_string_indexer(spark, training):
    kept = ml.drop_missing(training)
    ours = [r.category for r in ml.label_index(kept).orderBy("label").collect()]
    assert ours == ml.fit_label_indexer(kept).labels


def test_holdout_is_stable_and_partition_independent(spark, training):
    a = {r.id: r.split for r in ml.holdout(training).collect()}
    b = {r.id: r.split for r in ml.holdout(training.repartition(7)).collect()}
    assert a == b and set(a.values()) <= {"train", "test"}


def test_hashing_slots_see_the_blank(spark):
    tf = HashingTF(numFeatures=20000)
    assert tf.indexOf("aws") != tf.indexOf(" aws")


def test_pipeline_fit_save_load_score(spark, training, tmp_path):
    kept = ml.drop_missing(training)
    model = ml.build_classifier(ml.fit_label_indexer(kept), max_iter=20).fit(kept)
    path = str(tmp_path / "model")
    ml.save_model(model, path)
    loaded = ml.load_model(path)
    unlabeled = spark.createDataFrame([("x", "python, aws"), ("y", "react, css")],
                                      "id string, skills string")
    got = {r.id: r.predicted_category for r in ml.score(unlabeled, loaded).collect()}
    assert got == {"x": "Backend", "y": "Frontend"}
    acc = ml.accuracy(ml.score(kept, loaded)).first()[0]
    assert acc > 0.8
    assert ml.sample(ml.score(kept, loaded), 3).count() == 3


def test_tune_reports_every_grid_point(spark, training):
    kept = ml.drop_missing(training)
    pipe = ml.build_classifier(ml.fit_label_indexer(kept))
    grid = ml.param_grid(pipe, [5, 10], [0.01, 0.1])
    cv = ml.tune(kept, pipe, grid, folds=2)
    rep = ml.tune_report(cv)
    assert len(rep) == 4 and {(r[0], r[1]) for r in rep} == {(5, 0.01), (5, 0.1), (10, 0.01),
                                                                (10, 0.1)}
