"""What a fit costs: one shuffle of its rows, and few numbers for each of them."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from delaylab.operators import learning
from delaylab.operators.learning import ForestSettings
from delaylab.session import materialize

SMALL = ForestSettings(trees=2, depth=2)


@pytest.fixture(scope="module")
def flights(spark):
    rows = spark.sql("""SELECT CAST(id % 90 - 30 AS DOUBLE) AS ArrDelay,
        CAST(id % 80 - 30 AS DOUBLE) AS DepDelay, CAST(id % 9 * 100 AS DOUBLE) AS Distance,
        CAST(id % 28 + 1 AS INT) AS DayOfMonth, CAST(id % 7 AS INT) AS DayOfWeek,
        CAST(id % 365 + 1 AS INT) AS DayOfYear, concat('C', id % 3) AS Carrier,
        concat('A', id % 5) AS Origin, if(id % 50 = 0, NULL, concat('B', id % 4)) AS Dest
        FROM range(400)""")
    return materialize(rows, "few-flights")


def test_a_fit_reads_rows_that_are_dealt_once(spark, flights, monkeypatch):
    given = []
    fit = RandomForestClassifier.fit

    def watched(self, rows):
        given.append(rows._jdf.queryExecution().executedPlan().toString())
        return fit(self, rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    learning.train(flights, SMALL, partitions=2)
    assert "InMemoryTableScan" in given[0]
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def _given_to_the_fit(flights, monkeypatch, encoding=None):
    """Partitions of vectors as lists and labels, as the forest gets them, and the schema."""
    given = []
    fit = RandomForestClassifier.fit

    def watched(self, rows):
        listed = rows.select(vector_to_array(learning.VECTOR), learning.LABEL)
        given.extend([listed.rdd.map(tuple).glom().collect(), rows.schema])
        return fit(self, rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    model = learning.train(flights, SMALL, encoding, partitions=2)
    return model, *given


def test_rows_of_a_route_lie_together_in_a_fit(flights, monkeypatch):
    model, parts, _ = _given_to_the_fit(flights, monkeypatch)
    route = len(learning.NUMERIC) + learning.CATEGORIES.index("Route")
    assert len(parts) == 2 and sum(map(len, parts)) == flights.count()
    assert len({row[0][route] for row in parts[0]}) > 5
    for part in parts:
        places = [row[0][route] for row in part]
        assert places == sorted(places)
    again = learning.train(flights.orderBy("ArrDelay", "DepDelay"), SMALL, partitions=2)
    trees = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (model, again)]
    assert trees[0] == trees[1]


@pytest.mark.parametrize("encoding", [None, {"Route": "hashed"}, dict.fromkeys(learning.CATEGORIES, "hashed")])
def test_a_fit_gets_what_the_assembler_makes(flights, monkeypatch, encoding):
    model, parts, schema = _given_to_the_fit(flights, monkeypatch, encoding)
    labelled = learning.bucketize_delay(learning.derive_route(flights))
    for stage in model.stages[:-1]:
        labelled = stage.transform(labelled)
    made = labelled.select(vector_to_array(learning.VECTOR), learning.LABEL)
    assert sorted(sum(parts, [])) == sorted(map(tuple, made.collect()))
    assert schema[learning.VECTOR].metadata == labelled.schema[learning.VECTOR].metadata


def test_a_fit_refuses_a_null_number(flights):
    rows = materialize(flights.withColumn("Distance", F.nullif("Distance", F.lit(800.0))), "null-distance")
    with pytest.raises(Exception, match="NaN"):
        learning.train(rows, SMALL, partitions=2)


def test_the_regressor_hashes_its_texts_once(spark, flights, monkeypatch):
    given = []
    fit = LinearRegression.fit

    def watched(self, rows):
        given.append((rows.storageLevel.useMemory, rows.storageLevel.useDisk))
        return fit(self, rows)

    monkeypatch.setattr(LinearRegression, "fit", watched)
    learning.train_regressor(flights.withColumn("FlightNum", F.lit("7")))
    assert given == [(True, True)]
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


@pytest.fixture(scope="module")
def keyed(spark, flights):
    """Flights with their keys, nulls among them, and every row twice."""
    rows = flights.select(
        "*", F.expr("date_add(DATE'2024-01-01', CAST(DayOfYear AS INT))").alias("FlightDate"),
        F.nullif(F.expr("CAST(DepDelay AS STRING)"), F.lit("0.0")).alias("FlightNum"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 05:00:00' + make_interval(0, 0, 0, DayOfMonth)").alias("CRSDepTime"),
    )
    return materialize(rows.union(rows), "keyed-flights")


def _listed(df, *columns):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


@pytest.mark.parametrize("percent", [0, 20, 100])
def test_a_stored_split_is_the_split(keyed, percent):
    seen, unseen = learning.store_split(keyed, percent)
    plain_seen, plain_unseen = learning.split_by_hash(keyed, percent)
    assert unseen.columns == keyed.columns and _listed(unseen) == _listed(plain_unseen)
    assert _listed(seen, *learning.FIT_INPUTS) == _listed(plain_seen, *learning.FIT_INPUTS)
    rest = [c for c in keyed.columns if c not in learning.FIT_INPUTS]
    told = plain_seen.select(*learning.FIT_INPUTS, *rest).distinct().count()
    assert seen.distinct().count() == told
    assert bool(seen.count()) == (percent < 100) and bool(unseen.count()) == (percent > 0)


def test_a_holdout_tells_rows_apart_once(keyed, monkeypatch):
    given, plan = [], lambda df: df._jdf.queryExecution().executedPlan().toString()
    train, score = learning.train, learning.score

    def trained(rows, *args, **kwargs):
        given.extend([plan(rows), kwargs["partitions"]])
        return train(rows, *args, **kwargs)

    def scored(rows, model):
        given.append(plan(rows))
        return score(rows, model)

    monkeypatch.setattr(learning, "train", trained)
    monkeypatch.setattr(learning, "score", scored)
    outside = learning.score_holdout(keyed, SMALL)
    assert [p for p in given if "md5" in str(p)] == []
    assert given[1] == learning.default_partitions(keyed)
    assert {*keyed.columns, "Route", learning.LABEL, learning.PREDICTION} == set(outside.columns)
    held = learning.bucketize_delay(learning.split_by_hash(keyed)[1])
    assert outside.count() == held.count() > 0


def test_indexes_stay_categories(flights):
    forest = learning.train(flights, ForestSettings(trees=8, depth=4), partitions=2).stages[-1]
    assert " in {" in forest.toDebugString


def test_hashed_categories_give_a_forest_few_inputs(spark, flights, tmp_path):
    model = learning.train(flights, SMALL, {"Route": "hashed", "Dest": "hashed"}, partitions=2)
    plain = len(learning.NUMERIC) + 2
    assert model.stages[-1].numFeatures == plain + 4
    learning.save_model(model, str(tmp_path / "model"))
    again = learning.score(flights, learning.load_model(str(tmp_path / "model")))
    assert set(again.columns) == {*flights.columns, "Route", "Prediction"}
    assert again.where("Prediction IS NULL").isEmpty()


def test_hashed_routes_tell_delays_apart(spark):
    """The delay follows from the route alone, and no other input says anything."""
    rows = materialize(spark.sql("""SELECT CAST(id % 4 * 25 - 40 AS DOUBLE) AS ArrDelay,
        0D AS DepDelay, 1D AS Distance, 1 AS DayOfMonth, 1 AS DayOfWeek, 1 AS DayOfYear,
        'C' AS Carrier, concat('A', id % 40) AS Origin, 'B' AS Dest FROM range(4000)"""), "routes")
    hashed = dict.fromkeys(("Route", "Origin"), "hashed")
    model = learning.train(rows, ForestSettings(trees=5, depth=5), hashed, partitions=2)
    assert learning.evaluate_in_sample(rows, model) > 0.9
