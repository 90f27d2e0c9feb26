"""Dictionaries as tables: any size, hot labels, and models made from short ones only."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from delaylab.operators import dictionaries, learning
from delaylab.session import materialize
from tests.test_plans import plan


@pytest.fixture(scope="module")
def wide(spark):
    """200,000 labels, one of which a third of all rows has."""
    label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id").cast("string")))
    rows = spark.range(300_000).select(label.alias("c"), (F.col("id") % 5).cast("string").alias("d"))
    return materialize(rows, "wide")


def test_a_long_dictionary_encodes_every_row(spark, wide):
    table = dictionaries.build(wide, ["c", "d"])
    assert dictionaries.sizes(table, ["c", "d"]) == {"c": 200_001, "d": 5}
    asked = wide.unionByName(spark.createDataFrame([("new", None), (None, "new")], "c string, d string"))
    for head in (10, 1_000_000):
        got = dictionaries.encode(asked, table, ["c", "d"], head)
        assert got.columns == ["c", "d", "c_index", "d_index"]
        totals = got.agg(
            F.count(F.lit(1)).alias("n"), F.sum("c_index").alias("c"),
            F.count_if((F.col("c") == "hot") & (F.col("c_index") == 0)).alias("hot"),
        ).first()
        # 100,000 rows have index 0, 200,000 have one of 1..200,000 each, two are unknown.
        assert totals["n"] == 300_002 and totals["hot"] == 100_000
        assert totals["c"] == 200_000 * 200_001 / 2 + 2 * 200_001
        odd = {(r["c"], r["d"]): (r["c_index"], r["d_index"]) for r in got.where("c is null or c = 'new'").collect()}
        assert odd[("new", None)] == (200_001.0, 5.0) and odd[(None, "new")] == (200_001.0, 5.0)


def test_hot_labels_do_not_meet_in_the_shuffle(spark, wide):
    table = dictionaries.build(wide, ["c"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(dictionaries.encode(wide, table, ["c"], 10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The first labels are broadcast; rows that found theirs have a key of their own in the other join.
    assert "BroadcastHashJoin [c#" in text and "SortMergeJoin [_key#" in text
    assert "THEN c#" in text and "ELSE cast(monotonically_increasing_id() as string)" in text


def test_a_long_dictionary_is_no_model(wide):
    table = dictionaries.build(wide, ["c", "d"])
    with pytest.raises(ValueError, match="c has 200001 values"):
        dictionaries.indexers(table, ["c", "d"], 200_000)
    assert [len(m.labels) for m in dictionaries.indexers(table, ["d"], 5)] == [5]


def test_joins_and_the_model_give_the_same_indexes(spark, sf_dir):
    from delaylab.operators.features import derive_route
    from delaylab.plans import registry

    features = registry.stored_features(spark, sf_dir)
    table = learning.category_dictionary(features)
    requests = registry.prepared_requests(spark, sf_dir)
    names = ["UUID", *[f"{c}_index" for c in learning.CATEGORIES]]
    joined = learning.index_features(requests, table).select(*names)
    models = PipelineModel(dictionaries.indexers(table, learning.CATEGORIES, 20_000))
    indexed = models.transform(derive_route(requests)).select(*names)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, indexed.collect()))


def test_a_fit_follows_from_the_rows_alone(spark, sf_dir):
    """Other files, another order of the rows, another number of tasks: the same forest."""
    from delaylab.plans import registry

    features = registry.stored_features(spark, sf_dir)
    turned = materialize(features.repartition(7, "FlightNum").sortWithinPartitions("DepDelay"), "turned")
    settings = learning.ForestSettings(trees=4, depth=4)
    models = [learning.train(t, settings, partitions=3) for t in (features, turned)]
    assert models[0].stages[-1].toDebugString.split("\n")[1:] == models[1].stages[-1].toDebugString.split("\n")[1:]


def test_unknown_encodings_are_refused():
    with pytest.raises(ValueError):
        learning.hashed_categories({"Route": "one-hot"})
    assert learning.hashed_categories({"Route": "hashed", "Dest": "dictionary"}) == ["Route"]
