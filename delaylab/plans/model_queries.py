"""Registered queries that train, apply or evaluate a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.operators import features, learning
from delaylab.plans import jobs, oracle
from delaylab.plans.batch_queries import DAY, FEATURES
from delaylab.plans.registry import (
    features_path, model_path, prepared_requests, query, scorer, stored_features,
)
from delaylab.session import materialize, new_dir
from delaylab.sources import testbed


RESULT_INPUTS = ", ".join([*schemas.REQUEST.names, "Route"])


@query(
    "bucketize_delay",
    f"""SELECT FlightDate, TailNum, FlightNum, ArrDelay, {oracle.delay_class('ArrDelay')} AS ArrDelayBucket
FROM flights WHERE ArrDelay IS NOT NULL""",
    ["flights"],
)
def bucketize_delay(spark, sf_dir):
    return learning.bucketize_delay(
        testbed.flights(spark, sf_dir, "FlightDate", "TailNum", "FlightNum", "ArrDelay")
    )


_DICTIONARY = """dictionary AS (SELECT column_name, label,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx,
    CAST(count(*) OVER (PARTITION BY column_name) AS DOUBLE) AS size
  FROM (SELECT column_name, label, count(*) AS n FROM (
    SELECT 'Carrier' AS column_name, Carrier AS label FROM features
    UNION ALL SELECT 'Origin', Origin FROM features UNION ALL SELECT 'Dest', Dest FROM features
    UNION ALL SELECT 'Route', Origin || '-' || Dest FROM features) GROUP BY 1, 2)),
sizes AS (SELECT column_name, max(size) AS size FROM dictionary GROUP BY 1)"""


def _index_sql(columns: str) -> str:
    """Requests joined to the four dictionaries; a value without an entry gets the next index."""
    joins = "\n".join(
        f"LEFT JOIN (SELECT label, idx FROM dictionary WHERE column_name = '{c}') {c}_d "
        f"ON {value} = {c}_d.label"
        for c, value in (
            ("Carrier", "r.Carrier"), ("Origin", "r.Origin"), ("Dest", "r.Dest"),
            ("Route", "r.Origin || '-' || r.Dest"),
        )
    )
    return oracle.over(["features", "prepared"], "").rstrip() + f",\n{_DICTIONARY}\n" + (
        f"SELECT {columns} FROM prepared r\n{joins}"
    )


def _index(c: str) -> str:
    return f"coalesce({c}_d.idx, (SELECT size FROM sizes WHERE column_name = '{c}'))"


@query(
    "index_features",
    _index_sql("r.UUID, r.Carrier, r.Origin, r.Dest, r.Origin || '-' || r.Dest AS Route, "
               + ", ".join(f"{_index(c)} AS {c}_index" for c in learning.CATEGORIES)),
)
def index_features(spark, sf_dir):
    dictionary = learning.category_dictionary(stored_features(spark, sf_dir))
    requests = testbed.requests(spark, sf_dir).select("UUID", "Carrier", "Origin", "Dest")
    return learning.index_features(requests, dictionary)


@query(
    "assemble_features",
    _index_sql("r.UUID, " + ", ".join(
        f"CAST({value} AS DOUBLE) AS f{i}" for i, value in enumerate(
            [f"r.{c}" for c in learning.NUMERIC] + [_index(c) for c in learning.CATEGORIES]
        )
    )),
)
def assemble_features(spark, sf_dir):
    dictionary = learning.category_dictionary(stored_features(spark, sf_dir))
    indexed = learning.index_features(prepared_requests(spark, sf_dir), dictionary)
    vectors = learning.assembler().transform(indexed).select("UUID", learning.VECTOR)
    return learning.vector_slots(vectors, len(learning.NUMERIC) + len(learning.CATEGORIES))


@query(
    "train_delay_classifier",
    f"""SELECT {oracle.delay_class('ArrDelay')} AS ArrDelayBucket, count(*) AS n, 1 AS beats_majority
FROM features GROUP BY 1""",
    ["features"],
)
def train_delay_classifier(spark, sf_dir) -> DataFrame:
    """Trains the forest; flights of each actual class, and whether it beats the most frequent one."""
    table = stored_features(spark, sf_dir)
    scored = learning.bucketize_delay(learning.score(table, learning.train(table)))
    counts = scored.groupBy(learning.LABEL).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(learning.LABEL) == F.col(learning.PREDICTION)).alias("right"),
    )
    counts = materialize(counts, "classes")
    better = counts.agg(F.sum("right") > F.max("n")).scalar()
    return counts.select(learning.LABEL, "n", better.alias("beats_majority"))


def _same_again(spark, sf_dir) -> DataFrame:
    """Every request scored, and whether the model loaded anew gives the same class."""
    model = scorer(spark, sf_dir)
    requests = prepared_requests(spark, sf_dir)
    first = learning.score(requests, model)
    again = learning.score(requests, learning.load_model(model_path(spark, sf_dir))).select(
        "UUID", F.col("Prediction").alias("_again")
    )
    return first.join(again, "UUID").select(
        *schemas.REQUEST.names, "Route", F.col("Prediction").isin(0, 1, 2, 3).alias("classified"),
        (F.col("Prediction") == F.col("_again")).alias("same_again"),
    )


@query(
    "score_requests_batch",
    f"SELECT {RESULT_INPUTS}, 1 AS classified, 1 AS same_again FROM scored", ["scored"],
)
def score_requests_batch(spark, sf_dir):
    """Every request scored by the stored model, twice over."""
    return _same_again(spark, sf_dir)


def _in_sample(percent: float) -> str:
    return (
        f"substr(md5(concat_ws('|', {', '.join(learning.FLIGHT_KEY)})), 1, 8) "
        f"< '{round(percent * 0x100000000 / 100):08x}'"
    )


@query(
    "sample_predictions",
    f"""SELECT {FEATURES}, Origin || '-' || Dest AS Route, 1 AS classified FROM features
WHERE {_in_sample(0.1)}
ORDER BY CRSDepTime, FlightDate, Carrier, FlightNum, Origin, Dest, {FEATURES} LIMIT 6""",
    ["features"],
)
def sample_predictions(spark, sf_dir):
    """A glance at scored training rows."""
    scored = learning.score(stored_features(spark, sf_dir), scorer(spark, sf_dir))
    shown = learning.preview(scored)
    return shown.withColumn("classified", F.col("Prediction").isin(0, 1, 2, 3)).drop("Prediction")


@query(
    "evaluate_classifier",
    f"""SELECT count(*) AS "rows", count(*) FILTER (WHERE {_in_sample(20)}) AS held_out,
  1 AS in_sample_beats_majority, 1 AS held_out_beats_majority FROM features""",
    ["features"],
)
def evaluate_classifier(spark, sf_dir):
    """The classifier on the training rows and on rows held out by their key."""
    table = stored_features(spark, sf_dir)
    inside = learning.bucketize_delay(learning.score(table, scorer(spark, sf_dir)))
    classes = learning.score_holdout(table).select(learning.LABEL, learning.PREDICTION)
    outside = materialize(classes, "held-out")
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(outside.count()).alias("held_out"),
        F.lit(learning.beats_majority(inside)).alias("in_sample_beats_majority"),
        F.lit(learning.beats_majority(outside)).alias("held_out_beats_majority"),
    )


@query("predict_delay_regression", "SELECT UUID, 1 AS answered FROM prepared", ["prepared"])
def predict_delay_regression(spark, sf_dir):
    """Delay in minutes of every request, by the regressor; a finite number each."""
    model = learning.train_regressor(stored_features(spark, sf_dir))
    answered = F.col("Delay").isNotNull() & (F.abs("Delay") < float("inf"))
    return learning.predict_delay(prepared_requests(spark, sf_dir), model).select(
        "UUID", answered.alias("answered")
    )


@query(
    "train_pipeline",
    f"SELECT {oracle.delay_class('ArrDelay')} AS ArrDelayBucket, count(*) AS n, count(*) AS same_again "
    "FROM features GROUP BY 1",
    ["features"],
)
def train_pipeline(spark, sf_dir):
    """Profile, label, index, assemble, fit, save, reload and score, by class; rows scored alike."""
    table = stored_features(spark, sf_dir)
    path = new_dir(spark, "model")
    model = learning.train(table)
    learning.save_model(model, path)
    fitted = learning.score(table, model)
    both = learning.score(fitted.withColumnRenamed("Prediction", "_fitted"), learning.load_model(path))
    return learning.bucketize_delay(both).groupBy(learning.LABEL).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("Prediction") == F.col("_fitted")).alias("same_again"),
    )


_RECORD = """SELECT {trees} AS num_trees, 1024 AS max_memory_mb, count(*) AS train_rows,
  CAST(greatest(32, 1 + count(DISTINCT Origin || '-' || Dest)) AS INT) AS max_bins, {hashed} AS hashed,
  1 AS plausible FROM features"""


def _records(runs: DataFrame) -> DataFrame:
    """Run records; the accuracy of a fitted forest is only known to lie between 0 and 1."""
    plausible = F.col("accuracy").between(0.2, 0.9999) & F.col("run_at").isNotNull() & (F.col("partitions") > 0)
    return runs.select(
        "num_trees", "max_memory_mb", "train_rows", "max_bins", "hashed", plausible.alias("plausible")
    )


@query(
    "training_run_log",
    _RECORD.format(trees=5, hashed="''") + " UNION ALL "
    + _RECORD.format(trees=10, hashed="'Route'").replace("count(DISTINCT Origin || '-' || Dest)", "27"),
    ["features"],
)
def training_run_log(spark, sf_dir):
    """Two training runs recorded, one with dictionaries alone and one with hashed routes."""
    path = new_dir(spark, "runs")
    table = stored_features(spark, sf_dir)
    rows = learning.profile_training(table).rows
    for trees, encoding in ((5, None), (10, {"Route": "hashed"})):
        settings = learning.ForestSettings(trees=trees)
        model = learning.train(table, settings, encoding)
        quality = learning.evaluate_in_sample(table, model)
        learning.log_run(
            spark, path, model, rows, quality, encoding, learning.default_partitions(table)
        )
    return _records(learning.read_runs(spark, path))


@query("job_train", _RECORD.format(trees=20, hashed="''"), ["features"])
def job_train(spark, sf_dir):
    """Feature table to a stored model; gives the run record."""
    path = new_dir(spark, "job-train")
    jobs.train(spark, features_path(spark, sf_dir), f"{path}/model", f"{path}/runs")
    return _records(learning.best_run(learning.read_runs(spark, f"{path}/runs")))


@query(
    "job_daily_score",
    f"""SELECT {RESULT_INPUTS}, 1 AS as_in_batch FROM scored
WHERE CAST(Timestamp AS DATE) = DATE '{DAY}'""",
    ["scored"],
)
def job_daily_score(spark, sf_dir):
    """One day fetched, scored and stored twice over; that day's results set against a batch score."""
    path, model = new_dir(spark, "job-daily"), model_path(spark, sf_dir)
    requests = prepared_requests(spark, sf_dir)
    for _ in range(2):
        jobs.daily_score(spark, requests, DAY, f"{path}/tasks", model, f"{path}/results")
    results = spark.read.schema(schemas.RESULT).parquet(f"{path}/results")
    # The batch need not answer requests that the join below would drop.
    asked = requests.join(results.select("UUID"), "UUID", "semi")
    batch = learning.score(asked, scorer(spark, sf_dir)).select(
        "UUID", F.col("Prediction").alias("_batch")
    )
    same = F.col("Prediction") == F.col("_batch")
    return results.join(batch, "UUID").select(*schemas.REQUEST.names, "Route", same.alias("as_in_batch"))


def flagship(spark, sf_dir: str) -> DataFrame:
    """Flights to features, a model trained on them, requests scored, counted by delay text."""
    from delaylab.functions.text import delay_label

    path = new_dir(spark, "flagship")
    jobs.extract_features(testbed.flights(spark, sf_dir), f"{path}/features")
    jobs.train(spark, f"{path}/features", f"{path}/model", f"{path}/runs")
    requests = prepared_requests(spark, sf_dir)
    scored = learning.score(requests, learning.load_model(f"{path}/model"))
    counts = scored.groupBy("Prediction").agg(F.count(F.lit(1)).alias("requests"))
    return counts.withColumn("label", delay_label(F.col("Prediction")))
