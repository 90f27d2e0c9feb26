"""Encoding, training, scoring, evaluation and storage of the models."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from delaylab.operators import aggregates, features, learning
from delaylab.operators.learning import ForestSettings
from delaylab.plans import jobs, model_queries, registry
from delaylab.session import new_dir

SMALL = ForestSettings(trees=3, depth=3)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return registry.stored_features(spark, sf_dir)


@pytest.fixture(scope="module")
def model(table):
    return learning.train(table, SMALL)


@pytest.fixture(scope="module")
def requests(spark, sf_dir):
    return registry.prepared_requests(spark, sf_dir)


def test_label_order_matches_the_indexer(spark):
    df = spark.createDataFrame([(c,) for c in "baccdab"], "c string")
    labels = aggregates.index_labels(df, ["c"]).orderBy("idx").collect()
    assert [r["label"] for r in labels] == ["a", "b", "c", "d"]
    assert learning.fit_indexers(df, ["c"])[0].labels == ["a", "b", "c", "d"]


def test_unseen_category_gets_the_next_index(spark):
    indexer = learning.fit_indexers(
        spark.createDataFrame([("AA",), ("DL",)], "Carrier string"), ["Carrier"]
    )[0]
    unseen = spark.createDataFrame([("ZZ",)], "Carrier string")
    assert indexer.transform(unseen).first()["Carrier_index"] == 2.0


def test_null_inputs_are_kept_when_scoring(spark, model):
    row = spark.createDataFrame(
        [(None,) * 9], "Carrier string, Origin string, Dest string, DepDelay double, "
        "Distance double, DayOfMonth int, DayOfWeek int, DayOfYear int, UUID string",
    )
    scored = learning.score(row, model).first()
    assert scored["Route"] is None and scored["Prediction"] in (0.0, 1.0, 2.0, 3.0)


def test_stored_model_predicts_the_same(spark, model, requests):
    path = new_dir(spark, "model-test")
    learning.save_model(model, path)
    learning.save_model(model, path)
    loaded = learning.load_model(path)
    assert isinstance(loaded, PipelineModel)
    assert learning.load_labeller(path).getSplits() == learning.labeller().getSplits()
    before = {(r["UUID"], r["Prediction"]) for r in learning.score(requests, model).collect()}
    after = {(r["UUID"], r["Prediction"]) for r in learning.score(requests, loaded).collect()}
    assert before == after and len(before) == requests.count()


def test_scoring_leaves_only_the_prediction(model, requests):
    scored = learning.score(requests, model)
    assert set(scored.columns) == set(requests.columns) | {"Route", "Prediction"}


def test_model_beats_a_constant(table, model):
    labels = learning.bucketize_delay(table).groupBy(learning.LABEL).count()
    top = labels.agg(F.max("count")).first()[0] / table.count()
    assert learning.evaluate_in_sample(table, model) > top
    assert learning.evaluate_holdout(table, SMALL) > top


def test_accuracy_expression_equals_the_evaluator(table, model):
    scored = learning.bucketize_delay(learning.score(table, model))
    value = aggregates.classification_accuracy(
        scored, F.col(learning.PREDICTION), F.col(learning.LABEL)
    ).first()["accuracy"]
    assert value == pytest.approx(learning.accuracy(scored))


def test_a_dictionary_over_the_limit_is_refused(table):
    with pytest.raises(ValueError, match="Route"):
        learning.train(table, SMALL, dictionary_limit=50)


def test_named_categories_are_hashed(table, requests):
    mixed = learning.train(table, SMALL, encoding={"Route": "hashed"}, partitions=3)
    assert [type(s).__name__ for s in mixed.stages][:4] == ["StringIndexerModel"] * 3 + ["FeatureHasher"]
    assert learning.score(requests, mixed).where("Prediction is null").isEmpty()


def test_hash_split_is_a_partition(table):
    seen, unseen = learning.split_by_hash(table)
    assert seen.count() + unseen.count() == table.count()
    assert 0.1 < unseen.count() / table.count() < 0.3


def test_regressor(table, requests):
    regressor = learning.train_regressor(table)
    predicted = learning.predict_delay(requests, regressor)
    assert predicted.where(F.col("Delay").isNull()).isEmpty()
    assert predicted.count() == requests.count()


def test_run_log_and_job(spark, sf_dir):
    path = new_dir(spark, "job-test")
    source = registry.features_path(spark, sf_dir)
    for trees in (2, 3):
        jobs.train(
            spark, source, f"{path}/model", f"{path}/runs", ForestSettings(trees=trees, depth=2)
        )
    runs = learning.read_runs(spark, f"{path}/runs")
    assert sorted(r["num_trees"] for r in runs.collect()) == [2, 3]
    best = learning.best_run(runs).first()["accuracy"]
    assert best == runs.agg(F.max("accuracy")).first()[0]


def test_samples(spark, table, model):
    assert 0.05 < features.sample_share(table, 0.1, 27).count() / table.count() < 0.2
    first = features.sample_by_key(table, ["FlightNum"], 10)
    assert first.count() == features.sample_by_key(table.repartition(3), ["FlightNum"], 10).count()
    times = [r["CRSDepTime"] for r in learning.preview(table, 10).collect()]
    assert len(times) == 6 and times == sorted(times)


def test_incomplete_rows_are_those_that_training_drops(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None), (4, None, None), (5, float("nan"), 0.0), (5, None, 1.0)],
        "id int, ArrDelay double, DepDelay double",
    )
    kept, dropped = features.filter_complete(rows), features.filter_incomplete(rows)
    assert [r["id"] for r in kept.collect()] == [1, 5]
    assert [r["id"] for r in dropped.collect()] == [2, 3, 4, 5]


def test_a_day_is_set_against_a_batch_of_its_own_requests(spark, sf_dir, monkeypatch):
    asked, score = [], learning.score

    def watched(requests, model):
        asked.append(requests.count())
        return score(requests, model)

    monkeypatch.setattr(learning, "score", watched)
    results = model_queries.job_daily_score(spark, sf_dir)
    assert asked == [results.count()] * 3 and asked[0] > 0
    assert results.where("NOT as_in_batch").isEmpty()
