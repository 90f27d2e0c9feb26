"""Language of documents by Bayesian fusion of several pieces of evidence.

Text: byte trigrams under one multinomial model per language, and a flat one for text in none of
them. A text that has a label of its own is scored by counts that it is taken out of, so the label
cannot speak through the text as well. Declared language (markup or metadata): how often each
language's texts declare which one, counted over all rows. Host: the languages seen on it, smoothed
towards those of its address suffix, which are smoothed towards those of all rows. All counts are
grouped aggregates over all rows; what reaches the driver is bounded by languages times trigram bins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.textbytes import LOWER, chunks, mix
from delaylab.llm.scratch import stored as materialize

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
#: Trigram bins of a text model.
BINS = 8192
#: Trigrams overlap, so a text counts as a third as many independent observations.
TEXT_WEIGHT = 1 / 3
#: Hosts whose priors are broadcast (some 150 bytes each); with more, narrow rows are joined by host.
HOSTS = 200_000
#: Pseudo-counts that pull a host to its suffix, a suffix to all documents, and all to equal shares.
HOST_PULL, SUFFIX_PULL, EVEN_PULL = 20.0, 50.0, 1.0

_TABLES = (mix(np.arange(1, 769, dtype=np.uint64)) % np.uint64(BINS)).astype(np.uint16).reshape(3, 256)[:, LOWER]


def _bins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bin of the trigram that begins at each byte; ``BINS`` where it would leave the text."""
    n = len(data)
    bins = np.full(n, BINS, np.uint16)
    if n > 2:
        bins[: n - 2] = _TABLES[0][data[:-2]] ^ _TABLES[1][data[1:-1]] ^ _TABLES[2][data[2:]]
    for back in (1, 2):
        last = offsets[1:] - back
        bins[last[last >= np.maximum(offsets[:-1], 0)]] = BINS
    return bins


def _count(languages: Sequence[str]):
    """Trigram counts per language of the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BINS + 1), np.int64)
        for batch in batches:
            named = np.array([languages.index(x) for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi, data, offsets in chunks(batch.column(0)):
                row = np.repeat(named[lo:hi], np.diff(offsets))
                at = row * (BINS + 1) + _bins(data, offsets)
                counts += np.bincount(at, minlength=counts.size).reshape(counts.shape)
        language, gram = np.nonzero(counts[:, :BINS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(language.astype(np.int32)), pa.array(gram.astype(np.int32)),
             pa.array(counts[language, gram])],
            names=["language", "gram", "n"],
        )

    return run


def count_trigrams(
    docs: DataFrame, text: str, label: str, languages: Sequence[str] = LANGUAGES
) -> np.ndarray:
    """Trigrams of all labelled texts by language and bin.

    Rows whose label is not one of ``languages``, or null, are left out.
    """
    rows = docs.where(F.col(f"`{label}`").isin(*languages)).select(
        F.col(f"`{text}`"), F.col(f"`{label}`")
    )
    counted = (
        rows.mapInArrow(_count(tuple(languages)), "language int, gram int, n long")
        .groupBy("language", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros((len(languages), BINS))
    counts[counted["language"].to_numpy(), counted["gram"].to_numpy()] = counted["n"].to_numpy()
    return counts


#: What every bin of a language has beside its count; a language without texts is flat.
_PRIOR = 0.5


def log_models(counts: np.ndarray) -> np.ndarray:
    """Log likelihood of every bin under every language, and under none (the last row)."""
    even = np.full((1, counts.shape[1]), 1.0)
    smooth = np.concatenate([counts + _PRIOR, even])
    return np.log(smooth / smooth.sum(axis=1, keepdims=True))


def without_own(counts: np.ndarray, bins: np.ndarray) -> float:
    """Log likelihood of a text under its own label's counts, less what the text put there."""
    grams, n = np.unique(bins[bins < BINS], return_counts=True)
    left = counts[grams] - n + _PRIOR
    return float(n @ np.log(left) - n.sum() * np.log(counts.sum() - n.sum() + _PRIOR * len(counts)))


def _score(shared, names: list[str], languages: tuple[str, ...], text_at: int):
    """Scores the column ``text``, or field ``text_at`` of the column ``doc``.

    ``own`` is the label under which a text was counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        model = log_models(counts)
        model = np.concatenate([model, np.zeros((len(model), 1))], axis=1)
        place = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            fields = batch.schema.names
            n = batch.num_rows
            scores, grams = np.zeros((n, len(model))), np.zeros(n, np.int64)
            labels = batch.column(fields.index("own")).to_pylist()
            text = (
                batch.column(fields.index("text")) if "text" in fields
                else batch.column(fields.index("doc")).field(text_at)
            )
            for lo, hi, data, offsets in chunks(text):
                bins = _bins(data, offsets)
                upto = np.zeros(len(data) + 1)
                for k, row in enumerate(model):
                    np.cumsum(row[bins], out=upto[1:])
                    scores[lo:hi, k] = upto[offsets[1:]] - upto[offsets[:-1]]
                grams[lo:hi] = np.maximum(np.diff(offsets) - 2, 0)
                for i in range(lo, hi):
                    k = place.get(labels[i])
                    if k is not None and grams[i]:
                        scores[i, k] = without_own(counts[k], bins[offsets[i - lo] : offsets[i - lo + 1]])
            scored = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * len(model)), pa.array(scores.ravel())
            )
            new = {"likelihoods": scored, "grams": pa.array(grams)}
            yield pa.RecordBatch.from_arrays(
                [new[c] if c in new else batch.column(fields.index(c)) for c in names], names=names
            )

    return run


def _smoothed(counts: list[Column], parent: list[Column], pull: float) -> list[Column]:
    total = sum(counts[1:], counts[0])
    return [(c + pull * p) / (total + pull) for c, p in zip(counts, parent)]


def identify(
    docs: DataFrame, text: str = "text", label: str = "lang", declared: Column | None = None,
    host: Column | None = None, suffix: Column | None = None,
    languages: Sequence[str] = LANGUAGES, least: float = 0.5,
) -> DataFrame:
    """(doc, language, confidence, kept): ``doc`` is the input row as a struct.

    ``label`` names the column that the text models learn from; it may be declared as well, as no
    text is judged by its own label. ``declared``, ``host`` and ``suffix`` are expressions over the
    input columns, or nothing. ``language`` is the one with the largest posterior (``und``: none of
    ``languages``), ``confidence`` its posterior. ``kept`` is false for ``und``, for a posterior
    below ``least``, and for texts too short for a trigram, null and empty ones among them; their
    language rests on the other evidence.

    Null and empty hosts share one prior, null suffixes another; a declared language outside
    ``languages`` is evidence of its own, as is none. Equal rows get equal results. Columns of
    any name may be present; those of text and label may be written in any case. An empty table
    gives an empty one. ``docs`` should come from files.
    """
    classes = [*languages, UNKNOWN]
    nothing = F.lit(None).cast("string")
    host, suffix = host if host is not None else nothing, suffix if suffix is not None else nothing
    spark = docs.sparkSession
    text, label = (next(c for c in docs.columns if c.lower() == n.lower()) for n in (text, label))
    counted = count_trigrams(docs, text, label, languages)
    shared = spark.sparkContext.broadcast(counted)
    declared = (declared if declared is not None else nothing).cast("string")
    known = declared.isin(*languages)
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("string").alias("own"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(suffix.cast("string"), F.lit("")).alias("suffix"),
        F.when(declared.isNull(), "none").when(known, declared).otherwise("other").alias("declared"),
    )

    def scored(names: list[str], rows: DataFrame = rows) -> DataFrame:
        schema = T.StructType([rows.schema[n] for n in names])
        schema = schema.add("likelihoods", T.ArrayType(T.DoubleType())).add("grams", "long")
        # The document brings its text along; sending that twice would double the memory.
        sent = ["own", *names] if "doc" in names else ["text", "own", *names]
        found = rows.select(*sent).mapInArrow(
            _score(shared, schema.names, tuple(languages), docs.columns.index(text)), schema
        )
        best = F.array_position("likelihoods", F.array_max("likelihoods")).cast("int") - 1
        return found.withColumn("best", best)

    # Everything learned from the corpus: what texts look like, by host and declaration.
    seen = materialize(
        scored(["host", "suffix", "declared"]).where("grams > 0")
        .groupBy("host", "suffix", "declared", "best").agg(F.count("*").alias("n")),
        "languages-seen",
    )

    def counts(*keys: str) -> DataFrame:
        return seen.groupBy(*keys).agg(*(
            F.coalesce(F.sum(F.when(F.col("best") == k, F.col("n"))), F.lit(0)).alias(f"n{k}")
            for k in range(len(classes))
        ))

    width = range(len(classes))
    overall = counts().first()
    even = [F.lit(1.0 / len(classes))] * len(classes)
    shares = _smoothed([F.lit(float(overall[f"n{k}"])) for k in width], even, EVEN_PULL)
    by_suffix = counts("suffix")
    by_suffix = by_suffix.select(
        "suffix", F.array(*_smoothed([F.col(f"n{k}") for k in width], shares, SUFFIX_PULL)).alias("above")
    )
    priors = materialize(
        counts("host", "suffix").join(by_suffix, "suffix").select(
            "host", "suffix", "above", F.array(*(F.col(f"n{k}") for k in width)).alias("seen")
        ),
        "host-priors",
    )
    said = {(r.best, r.declared): r.n for r in seen.groupBy("best", "declared").agg(F.sum("n").alias("n")).collect()}
    values = [*languages, "other", "none"]
    spoken = {}
    for k in width:
        total = sum(said.get((k, d), 0) for d in values)
        for d in values:
            spoken[k, d] = np.log((said.get((k, d), 0) + 1.0) / (total + len(values)))
    voice = F.create_map(*(
        part for d in values
        for part in (F.lit(d), F.array(*(F.lit(float(spoken[k, d])) for k in width)))
    ))

    evidence = ["host", "suffix", "declared"]
    keyed = None
    if priors.count() <= HOSTS:
        final = scored(["doc", *evidence]).join(F.broadcast(priors), ["host", "suffix"], "left")
    else:
        # Only numbers travel by host, where a host may be hot; documents are joined by number.
        keyed = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "language-rows")
        final = scored(["row", *evidence], keyed).join(priors, ["host", "suffix"], "left")
    # A document's own text is taken out of its host's counts before they judge it.
    own = [F.when((F.col("grams") > 0) & (F.col("best") == k), 1.0).otherwise(0.0) for k in width]
    seen_here = [F.coalesce(F.get("seen", F.lit(k)).cast("double"), F.lit(0.0)) - own[k] for k in width]
    above = [F.coalesce(F.get("above", F.lit(k)), shares[k]) for k in width]
    prior = _smoothed([F.greatest(c, F.lit(0.0)) for c in seen_here], above, HOST_PULL)
    spoken_here = F.element_at(voice, F.col("declared"))
    points = F.array(*(
        F.get("likelihoods", F.lit(k)) * TEXT_WEIGHT + F.get(spoken_here, F.lit(k)) + F.log(prior[k])
        for k in width
    ))
    final = final.withColumn("points", points)
    top = F.array_max("points")
    total = F.aggregate("points", F.lit(0.0), lambda s, p: s + F.exp(p - top))
    final = final.select(
        "doc" if keyed is None else "row", "grams",
        F.element_at(F.array(*map(F.lit, classes)), F.array_position("points", top).cast("int")).alias("language"),
        (1.0 / total).alias("confidence"),
    )
    kept = (F.col("grams") > 0) & (F.col("language") != UNKNOWN) & (F.col("confidence") >= least)
    if keyed is not None:
        found = materialize(final.select("row", "language", "confidence", kept.alias("kept")), "languages")
        return keyed.select("row", "doc").join(found, "row").drop("row")
    return final.select("doc", "language", "confidence", kept.alias("kept"))


def address_suffix(host: Column) -> Column:
    """The last label of a host with more than one label, else null."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def markup_language(html: Column) -> Column:
    """Language that the html tag declares, without its region."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def url_host(url: Column) -> Column:
    """Host of an address, A-Z lowered, without user and port; null without ``://``."""
    return F.nullif(F.lower(F.regexp_extract(url, r"://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def visible_text(html: Column) -> Column:
    """What stands between the tags, scripts and styles left out."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")


#: Columns of the rows that are judged together.
_CORPUS = ("doc_id", "page_id", "text", "lang", "host")


def corpus_rows(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents and pages as rows of one corpus: text, declared language and host of each.

    A document declares ``lang`` and comes from its source, a page declares the language of its
    html tag and comes from the host of its address.
    """
    one = docs.select(
        F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("page_id"), "text", "lang",
        F.col("source").alias("host"),
    )
    two = pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long"),
        visible_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("lang"),
        url_host(F.col("url")).alias("host"),
    )
    return one.unionByName(two).select(*_CORPUS)


def identify_corpus(rows: DataFrame) -> DataFrame:
    """Rows of :func:`corpus_rows` by their text, declared language, host and its suffix."""
    host = F.col("host")
    return identify(rows, "text", "lang", F.col("lang"), host, address_suffix(host))


def identify_documents(docs: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Documents by their text, their declared language and their source as host.

    With ``pages``, what is learned about languages, declarations, hosts and suffixes is learned
    from these too. Other columns of ``docs`` come along in ``doc``.
    """
    # Names that no column of the documents has.
    taken = max(map(len, docs.columns))
    host, page = "host".rjust(taken + 1, "_"), "page".rjust(taken + 2, "_")
    rows = docs.withColumns({host: F.col("source"), page: F.lit(False)})
    if pages is not None:
        only = corpus_rows(docs.limit(0), pages).select("text", "lang", F.col("host").alias(host))
        rows = rows.unionByName(only.withColumn(page, F.lit(True)), allowMissingColumns=True)
    source = F.col(host)
    found = identify(rows, "text", "lang", F.col("lang"), source, address_suffix(source))
    kept = [F.col(f"doc.`{c}`") for c in docs.columns]
    return found.where(~F.col(f"doc.{page}")).withColumn("doc", F.struct(*kept))


def keep_identified(docs: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """The documents in a known language, their columns unchanged."""
    return identify_documents(docs, pages).where("kept").select("doc.*")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of all documents, with what documents and pages teach."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return identify_documents(docs, pages).select("doc.doc_id", "language", "confidence", "kept")


QUERIES = {"op3_language_id": op3_language_id}
ORACLE: dict[str, str] = {}
