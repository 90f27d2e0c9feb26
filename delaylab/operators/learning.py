"""Delay classifier and regressor on Spark ML: one saved model for batch and stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, FeatureHasher, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.functions.text import DELAY_SPLITS
from delaylab.operators import dictionaries
from delaylab.operators.features import derive_route, in_sample, sample_by_key, strip_ml_columns
from delaylab.session import materialize
from delaylab.sources import versions

# The inputs of the classifier in the order of the feature vector.
NUMERIC = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
CATEGORIES = ["Carrier", "Origin", "Dest", "Route"]
INDEXES = [f"{c}_index" for c in CATEGORIES]
#: What a fit reads of a feature table; routes and classes follow from it.
FIT_INPUTS = [*NUMERIC, "Carrier", "Origin", "Dest", "ArrDelay"]
LABEL = "ArrDelayBucket"
VECTOR = "Features_vec"
PREDICTION = "Prediction"

#: Distinct values above which a dictionary is refused as part of a model: it would live on the
#: driver, and its size is the forest's number of bins.
DICTIONARY_LIMIT = 20_000
#: Partitions that the training rows are dealt to, for each file of the feature table.
PARTITIONS_PER_FILE = 4
#: Slots of the categories that ``encoding`` names as hashed.
HASHED_WIDTH = 1 << 12
#: Columns of the hashed categories: their slots, and the class probabilities made of these.
HASHED = ["hashed", "hashed_rates"]

RUNS = T.StructType([
    T.StructField("run_at", T.TimestampType()),
    T.StructField("max_bins", T.IntegerType()),
    T.StructField("max_memory_mb", T.IntegerType()),
    T.StructField("num_trees", T.IntegerType()),
    T.StructField("train_rows", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("hashed", T.StringType()),
    T.StructField("partitions", T.IntegerType()),
])


@dataclass(frozen=True)
class ForestSettings:
    """Settings of the forest; bins are raised to the largest dictionary."""

    trees: int = 20
    depth: int = 5
    memory_mb: int = 1024
    least_bins: int = 32
    seed: int = 27


def labeller() -> Bucketizer:
    return Bucketizer(splits=DELAY_SPLITS, inputCol="ArrDelay", outputCol=LABEL)


def bucketize_delay(df: DataFrame) -> DataFrame:
    """Add the delay class; rows without an arrival delay cannot be labelled and are left out."""
    known = df.where(F.col("ArrDelay").isNotNull() & ~F.isnan("ArrDelay"))
    return labeller().transform(known)


@dataclass(frozen=True)
class Profile:
    """Rows of the feature table and its columns that hold nulls."""

    rows: int
    nulls: dict[str, int]


def profile_training(features: DataFrame) -> Profile:
    """Rows and nulls of every column, in one pass."""
    row = features.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in features.columns],
    ).first().asDict()
    return Profile(row["rows"], {c: row[f"null_{c}"] for c in features.columns if row[f"null_{c}"]})


def category_dictionary(features: DataFrame) -> DataFrame:
    """The stored dictionary of all categories of a feature table."""
    return dictionaries.build(derive_route(features).select(*CATEGORIES), CATEGORIES)


def fit_indexers(
    df: DataFrame, categories: list[str] = CATEGORIES, limit: int = DICTIONARY_LIMIT
) -> list[StringIndexerModel]:
    """A dictionary model per category, from one pass; unseen values get an index of their own."""
    table = dictionaries.build(df.select(*categories), categories)
    return dictionaries.indexers(table, categories, limit)


def index_features(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Route and category indexes by joins with a stored dictionary, which may have any size."""
    return dictionaries.encode(derive_route(df), dictionary, CATEGORIES)


def assembler(inputs: list[str] | None = None) -> VectorAssembler:
    columns = inputs or NUMERIC + [f"{c}_index" for c in CATEGORIES]
    return VectorAssembler(inputCols=columns, outputCol=VECTOR, handleInvalid="keep")


def vector_slots(df: DataFrame, size: int) -> DataFrame:
    """Slots of the feature vector as columns f0, f1, ..."""
    slots = vector_to_array(VECTOR)
    return df.select(
        *[c for c in df.columns if c != VECTOR], *[slots[i].alias(f"f{i}") for i in range(size)]
    )


def encoders(
    features: DataFrame, encoding: dict[str, str] | None = None,
    limit: int = DICTIONARY_LIMIT, width: int = HASHED_WIDTH,
) -> tuple[list[Transformer], list[str], int]:
    """Fitted category encoders, the columns they give, and the size of the largest dictionary.

    ``encoding`` gives "dictionary" (the default) or "hashed" per category. The data never
    choose: a dictionary that would be too large is an error. Hashed categories share ``width``
    slots. The forest keeps a number for every input of every row, so it is not given the slots
    but what naive Bayes makes of them: the probability of each delay class.
    """
    hashed = hashed_categories(encoding)
    indexed = [c for c in CATEGORIES if c not in hashed]
    stages, outputs, largest = [], [], 0
    if indexed:
        fitted = fit_indexers(features, indexed, limit)
        largest = max(len(model.labels) for model in fitted)
        stages += fitted
        outputs += [f"{c}_index" for c in indexed]
    if hashed:
        hasher = FeatureHasher(inputCols=hashed, outputCol=HASHED[0], numFeatures=width)
        rates = NaiveBayes(
            featuresCol=HASHED[0], labelCol=LABEL, probabilityCol=HASHED[1],
            rawPredictionCol="", predictionCol="",
        )
        slots = hasher.transform(features.select(LABEL, *hashed))
        stages += [hasher, rates.fit(slots)]
        outputs.append(HASHED[1])
    return stages, outputs, largest


def hashed_categories(encoding: dict[str, str] | None) -> list[str]:
    """Categories that ``encoding`` names as hashed."""
    encoding = encoding or {}
    wrong = {c: e for c, e in encoding.items() if c not in CATEGORIES or e not in ("dictionary", "hashed")}
    if wrong:
        raise ValueError(f"no such encoding: {wrong}")
    return [c for c in CATEGORIES if encoding.get(c) == "hashed"]


def default_partitions(features: DataFrame) -> int:
    """Partitions by the files of the feature table, whatever executors there are."""
    return max(1, len(features.inputFiles())) * PARTITIONS_PER_FILE


def train(
    features: DataFrame,
    settings: ForestSettings = ForestSettings(),
    encoding: dict[str, str] | None = None,
    dictionary_limit: int = DICTIONARY_LIMIT,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit dictionaries, assembler and forest as one model from route to prediction.

    ``features`` should be a stored table. Its encoded rows are dealt once to ``partitions``
    (see :func:`default_partitions`) and sorted there, both by their content; the forest draws its
    samples by partition and place, so a fit depends neither on the order of the rows nor on the
    cores at hand. Rows of one route lie together (see :func:`_place`). The dealt rows are kept, as
    columns, until the fit ends: the fit asks for its input several times, and each time would
    encode, shuffle and sort anew.
    """
    labelled = bucketize_delay(derive_route(features))
    stages, encoded, largest = encoders(labelled, encoding, dictionary_limit)
    vectors = assembler(NUMERIC + encoded)
    encode = PipelineModel(stages)
    dealt = labelled.withColumn("_dealt", F.xxhash64(*sorted(labelled.columns)))
    inputs = encode.transform(dealt).select(*NUMERIC, *encoded, LABEL)
    rows = (
        encode.transform(dealt).select(*_whole(inputs, "int"), "_dealt")
        .repartition(partitions or default_partitions(features), "_dealt")
        .sortWithinPartitions(_place(stages)).drop("_dealt").persist(StorageLevel.MEMORY_AND_DISK)
    )
    forest = RandomForestClassifier(
        featuresCol=VECTOR, labelCol=LABEL, predictionCol=PREDICTION,
        numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed,
        maxBins=max(settings.least_bins, largest + 1), maxMemoryInMB=settings.memory_mb,
    )
    try:
        fitted = forest.fit(_assembled(rows.select(*_whole(inputs, "double")), vectors))
    finally:
        rows.unpersist()
    return PipelineModel([*stages, vectors, fitted])


def _place(stages: list[Transformer]) -> Column:
    """Order of dealt rows in a partition: the index with most labels, then the hash of their content.

    The forest adds every row to a bin of each index and follows its splits once per tree and
    level; neighbours that share an index find the bins and splits they need in the processor's
    cache. Both parts are packed into one number, which Spark sorts without comparing rows.
    """
    sizes = {m.getOutputCol(): len(m.labels) for m in stages if isinstance(m, StringIndexerModel)}
    if not sizes:
        return F.col("_dealt")
    widest = max(sizes, key=sizes.get)
    bits = sizes[widest].bit_length()
    index = F.shiftleft(F.col(widest).cast("long"), 63 - bits)
    return index.bitwiseOR(F.shiftrightunsigned("_dealt", bits + 1))


def _assembled(rows: DataFrame, vectors: VectorAssembler) -> DataFrame:
    """What ``vectors`` makes of encoded rows, and their label, without a generic row for each.

    A null is NaN, as the assembler has it.
    """
    known = [c for c in vectors.getInputCols() if c not in HASHED]
    slots = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in known])
    if len(known) < len(vectors.getInputCols()):
        slots = F.concat(slots, vector_to_array(HASHED[1]))
    attributes = vectors.transform(rows).schema[VECTOR].metadata
    return rows.select(array_to_vector(slots).alias(VECTOR, metadata=attributes), LABEL)


def _whole(encoded: DataFrame, kind: str) -> list[Column]:
    """All columns, indexes and labels as ``kind`` with the attributes they have in ``encoded``.

    Integers take fewer bytes to shuffle and to keep; the assembler wants doubles.
    """
    whole = {f.name: f.metadata for f in encoded.schema.fields if f.name in [*INDEXES, LABEL]}
    return [
        F.col(c).cast(kind).alias(c, metadata=whole[c]) if c in whole else F.col(c)
        for c in encoded.columns
    ]


def score(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Predicted class of every request; a batch and a stream are scored alike."""
    routed = derive_route(requests)
    return strip_ml_columns(model.transform(routed)).drop(*HASHED)


def naive_score(requests: DataFrame) -> DataFrame:
    """Class of the departure delay: the prediction a learned model has to beat."""
    from delaylab.functions.text import delay_class

    return derive_route(requests).withColumn(PREDICTION, delay_class(F.col("DepDelay")))


def save_model(model: PipelineModel, path: str) -> None:
    """Publish the model as the current version at ``path`` and, next to it, the labeller."""

    def write(folder: str) -> None:
        model.save(f"{folder}/scorer")
        labeller().save(f"{folder}/labeller")

    versions.publish(SparkSession.active(), path, write)


def load_model(path: str) -> PipelineModel:
    """The current version of a model."""
    return load_version(versions.current(SparkSession.active(), path))


def load_version(folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/scorer")


def load_labeller(path: str) -> Bucketizer:
    return Bucketizer.load(f"{versions.current(SparkSession.active(), path)}/labeller")


def accuracy(scored: DataFrame) -> float:
    return MulticlassClassificationEvaluator(
        predictionCol=PREDICTION, labelCol=LABEL, metricName="accuracy"
    ).evaluate(scored)


#: What tells flights apart, as text in every store.
FLIGHT_KEY = ["FlightDate", "Carrier", "FlightNum", "Origin", "Dest", "CRSDepTime"]


def preview(scored: DataFrame, percent: float = 0.1, rows: int = 6) -> DataFrame:
    """A few scored rows, sampled by their key and in departure order; later columns break ties."""
    rest = [c for c in FLIGHT_KEY + scored.columns if c != "CRSDepTime"]
    sample = sample_by_key(scored, FLIGHT_KEY, percent)
    return sample.orderBy("CRSDepTime", *dict.fromkeys(rest)).limit(rows)


def beats_majority(labelled: DataFrame) -> bool:
    """Whether more rows are predicted right than the most frequent class has."""
    counts = labelled.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(PREDICTION) == F.col(LABEL)).alias("right")
    )
    return bool(counts.agg(F.sum("right") > F.max("n")).first()[0])


def evaluate_in_sample(features: DataFrame, model: PipelineModel) -> float:
    """Accuracy on the rows the model was trained on."""
    return accuracy(bucketize_delay(score(features, model)))


def split_by_hash(features: DataFrame, percent: float = 20) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows, decided by each flight's key."""
    held = in_sample(FLIGHT_KEY, percent)
    return features.where(~held), features.where(held)


def store_split(features: DataFrame, percent: float = 20) -> tuple[DataFrame, DataFrame]:
    """:func:`split_by_hash` stored: held-out rows whole, of training rows what a fit reads.

    The text of a flight's key and its MD5 take longer than the rest of a scan, and a fit scans its
    rows twice; here each row is told apart once. ``content`` stands for the columns that a training
    row loses, so that a fit deals out rows evenly which differ in nothing else.
    """
    held = F.col("held_out")
    lost = [c for c in sorted(features.columns) if c not in FIT_INPUTS]
    told = features.withColumn("held_out", in_sample(FLIGHT_KEY, percent)).select(
        *FIT_INPUTS, *[F.when(held, F.col(c)).alias(c) for c in lost],
        F.when(~held, F.xxhash64(*lost)).alias("content"), held,
    )
    split = materialize(told, "split")
    return split.where(~held).select(*FIT_INPUTS, "content"), split.where(held).select(*features.columns)


def score_holdout(
    features: DataFrame, settings: ForestSettings = ForestSettings(), percent: float = 20
) -> DataFrame:
    """Labelled and scored rows that the model has not seen.

    The split is stored first (see :func:`store_split`); its rows are dealt to as many partitions
    as those of ``features`` would be.
    """
    seen, unseen = store_split(features, percent)
    model = train(seen, settings, partitions=default_partitions(features))
    return bucketize_delay(score(unseen, model))


def evaluate_holdout(
    features: DataFrame, settings: ForestSettings = ForestSettings(), percent: float = 20
) -> float:
    """Accuracy on rows the model has not seen."""
    return accuracy(score_holdout(features, settings, percent))


def log_run(
    spark: SparkSession, path: str, model: PipelineModel, rows: int, value: float,
    encoding: dict[str, str] | None = None, partitions: int | None = None,
) -> None:
    """Append the parameters and the accuracy of a training run to the run table."""
    forest = model.stages[-1]
    run = spark.createDataFrame(
        [(
            None, forest.getOrDefault("maxBins"), forest.getOrDefault("maxMemoryInMB"),
            forest.getNumTrees, rows, value, ",".join(hashed_categories(encoding)), partitions,
        )],
        RUNS,
    ).withColumn("run_at", F.current_timestamp())
    run.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def best_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("accuracy").desc(), F.col("run_at")).limit(1)


_REGRESSION_NUMBERS = ["Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]


def train_regressor(features: DataFrame, width: int = 1 << 13) -> PipelineModel:
    """Numeric arrival delay from route ends, flight number, distance and date parts.

    Text inputs are hashed to one-hot slots, so no dictionary grows with the data. The vectors are
    kept until the fit ends: it asks for them three times, and each time would hash the texts anew.
    """
    hasher = FeatureHasher(
        inputCols=["Origin", "Dest", "FlightNum"], outputCol="hashed", numFeatures=width
    )
    vectors = VectorAssembler(
        inputCols=[*_REGRESSION_NUMBERS, "hashed"],
        outputCol=VECTOR, handleInvalid="keep",
    )
    # Incomplete rows leave the fit, never the scoring: a request always gets an answer.
    known = features.dropna(subset=["ArrDelay", *_REGRESSION_NUMBERS])
    ready = vectors.transform(hasher.transform(known)).select(VECTOR, "ArrDelay").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    line = LinearRegression(
        featuresCol=VECTOR, labelCol="ArrDelay", predictionCol="Delay",
        solver="l-bfgs", regParam=0.1, maxIter=20,
    )
    try:
        fitted = line.fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([hasher, vectors, fitted])


def predict_delay(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Add the predicted arrival delay in minutes; null where an input is null."""
    scored = model.transform(requests).drop("hashed", VECTOR)
    return scored.withColumn("Delay", F.nanvl("Delay", F.lit(None).cast("double")))
