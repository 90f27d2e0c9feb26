"""Repeated passages across documents, as content-defined chunks of lines.

A rolling hash over two consecutive lines is formed at every line. A chunk begins where the hash
is smaller than at the line before and at the line behind, so a boundary depends on four lines
alone: text put in or taken out elsewhere does not shift it, and two boundaries are at least two
lines apart. Chunks that occur more than once are compared byte by byte; all but the first
occurrence are taken out. Everything is column expressions.

The texts are written once in chunks. Counting needs a hash and a number per chunk; only chunks
whose hash repeats send their bytes, to be grouped by hash and bytes with a partial aggregate, so
a passage that a third of all rows share is combined before it travels.

Chunks at the ends of a passage hold neighbouring lines too and do not repeat, and a short passage
may hold no whole chunk. So the finest chunks are compared in the same way afterwards: windows of two
lines, blank lines between them included, over the boundaries of the others as well, and single lines
that are passages by their number of words. What lies inside a chunk that is taken out is left aside:
it stands in the chunk's first occurrence too. The finest chunks alone would find the same places; the
others keep long passages, and those that a large part of the rows share, from travelling line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylab.llm.scratch import stored as materialize

#: Lines from which a repeated passage is removed.
LEAST_LINES = 2
#: Words from which a single line is a passage.
LONG_LINE = 50
#: A character that is no white space.
VISIBLE = r"[^\x20\x09-\x0D]"
WORD = VISIBLE + "+"
#: Slots of the broadcast filter that keeps most chunks that do not repeat from travelling. They
#: are the bits of at most a 64th as many rows (16 bytes each), however many hashes repeat; when they
#: fill it, more chunks travel, with the same result.
SLOTS = 1 << 26


def _minima(rolling: Column, n: Column) -> Column:
    """Numbers (from 0) of the lines at which chunks begin; the first is always 0."""
    inner = F.when(
        n > 2,
        F.filter(
            F.sequence(F.lit(1), n - 2),
            lambda i: (F.get(rolling, i) < F.get(rolling, i - 1))
            & (F.get(rolling, i) < F.get(rolling, i + 1)),
        ),
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), inner)


def chunked(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc, chunks): rows numbered, with their text in chunks (text, start, lines, hash).

    The chunks of a text, joined by line ends, are the text again. A null text has null chunks.
    """
    lined = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("doc"),
        F.split(F.col(f"`{text}`"), "\n", -1).alias("lines"),
    )
    following = F.slice("lines", F.lit(2), F.greatest(F.size("lines"), F.lit(1)))
    hashed = lined.withColumn(
        "rolling",
        F.transform(
            F.arrays_zip("lines", F.concat(following, F.array(F.lit("")))),
            lambda pair: F.xxhash64(pair),
        ),
    )
    cut = hashed.withColumn("starts", _minima(F.col("rolling"), F.size("lines"))).drop("rolling")

    def chunk(start: Column, i: Column) -> Column:
        upto = F.coalesce(F.get("starts", i + 1), F.size("lines"))
        return F.struct(
            F.array_join(F.slice("lines", start + 1, upto - start), "\n").alias("text"),
            start.alias("start"),
            (upto - start).alias("lines"),
        )

    parts = cut.select(
        "row", "doc", F.when(F.col("lines").isNotNull(), F.transform("starts", chunk)).alias("parts")
    )
    return parts.select(
        "row", "doc",
        F.transform(
            "parts",
            lambda p: F.struct(p["text"], p["start"], p["lines"], F.xxhash64(p["text"]).alias("hash")),
        ).alias("chunks"),
    )


def _in_slots(each: DataFrame, often: DataFrame) -> DataFrame:
    """Rows of ``each`` whose hash may be in ``often``; most others do not travel.

    A semi join, as the optimizer would move those that follow below any other.
    """
    word = F.expr(f"pmod(hash, {SLOTS}L) div 64")
    bits = often.groupBy(word.alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(hash, 64L) as int))")).alias("_bits")
    )
    is_set = F.expr("shiftrightunsigned(_bits, cast(pmod(hash, 64L) as int)) % 2 <> 0")
    return each.join(F.broadcast(bits), (word == F.col("_word")) & is_set, "left_semi")


def repeated_chunks(stored: DataFrame, least_lines: int = LEAST_LINES) -> DataFrame:
    """(row, at, start, upto): every occurrence after the first of a chunk of ``least_lines`` or more.

    Occurrences are ordered by row number, then by place. Blank chunks are left alone.
    """
    each = stored.select("row", F.posexplode("chunks").alias("at", "chunk")).where(
        (F.col("chunk.lines") >= least_lines) & F.col("chunk.text").rlike(VISIBLE)
    )
    often = materialize(
        each.groupBy(F.col("chunk.hash").alias("hash")).agg(F.count("*").alias("n"))
        .where("n > 1").select("hash"),
        "repeated-hashes",
    )
    candidates = each.select(
        F.col("chunk.hash").alias("hash"), F.col("chunk.text").alias("text"), "row", "at",
        F.col("chunk.start").alias("start"), (F.col("chunk.start") + F.col("chunk.lines") - 1).alias("upto"),
    )
    candidates = _in_slots(candidates, often).join(often, "hash", "left_semi")
    order = F.struct("row", "at")
    firsts = candidates.groupBy("hash", "text").agg(
        F.min(order).alias("first"), F.count("*").alias("n")
    ).where("n > 1")
    firsts = materialize(firsts.select("hash", "text", "first"), "first-chunks")
    return candidates.join(firsts, ["hash", "text"]).where(order != F.col("first")).select(
        "row", "at", "start", "upto"
    )


def _windows(stored: DataFrame, least_lines: int, long_line: int) -> DataFrame:
    """(row, start, upto, at, text, hash) of every ``least_lines`` visible lines that follow each other.

    The text holds the blank lines between them. ``at`` is the chunk that holds all of them, if any.
    A line of ``long_line`` words or more is a window by itself, too.
    """
    lined = stored.where("chunks is not null").select(
        "row",
        F.split(F.array_join(F.transform("chunks", lambda c: c["text"]), "\n"), "\n", -1).alias("lines"),
        F.flatten(F.transform("chunks", lambda c, k: F.array_repeat(k, c["lines"]))).alias("of"),
    )
    seen = lined.withColumn(
        "seen",
        F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(VISIBLE)),
    )

    def window(start: Column, k: Column) -> Column:
        upto = F.get("seen", k + (least_lines - 1))
        return F.struct(
            start.alias("start"), upto.alias("upto"),
            F.when(F.get("of", start) == F.get("of", upto), F.get("of", start)).alias("at"),
            F.array_join(F.slice("lines", start + 1, upto - start + 1), "\n").alias("text"),
        )

    def is_long(i: Column) -> Column:
        line = F.get("lines", i)
        # Words are counted only where there is room for so many.
        return (F.length(line) >= 2 * long_line - 1) & (F.regexp_count(line, F.lit(WORD)) >= long_line)

    def alone(i: Column) -> Column:
        return F.struct(
            i.alias("start"), i.alias("upto"), F.get("of", i).alias("at"), F.get("lines", i).alias("text")
        )

    both = F.concat(F.transform("seen", window), F.transform(F.filter("seen", is_long), alone))
    each = seen.select("row", F.explode(both).alias("window"))
    return each.select("row", "window.*").where("upto is not null").withColumn("hash", F.xxhash64("text"))


def repeated_windows(
    stored: DataFrame, removed: DataFrame, least_lines: int = LEAST_LINES, long_line: int = LONG_LINE
) -> DataFrame:
    """(row, start, upto): windows (see :func:`_windows`) that stand in an earlier place.

    ``removed`` are the chunks taken out (row, at). An earlier place that shares a line with the
    window, in a run of equal lines, does not count.
    """
    each = _windows(stored, least_lines, long_line)
    inside = removed.select("row", "at")
    often = materialize(
        each.select("row", "at", "hash").join(inside, ["row", "at"], "left_anti")
        .groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
        "repeated-window-hashes",
    )
    candidates = materialize(
        _in_slots(each, often).join(inside, ["row", "at"], "left_anti").drop("at")
        .join(often, "hash", "left_semi"),
        "windows",
    )
    firsts = candidates.groupBy("hash", "text").agg(
        F.min(F.struct("row", "start", "upto")).alias("first"), F.count("*").alias("n")
    ).where("n > 1")
    firsts = materialize(firsts.select("hash", "text", "first"), "first-windows")
    apart = (F.col("row") != F.col("first.row")) | (F.col("start") > F.col("first.upto"))
    return candidates.join(firsts, ["hash", "text"]).where(apart).select("row", "start", "upto")


def without_repeats(
    docs: DataFrame, text: str = "text", least_lines: int = LEAST_LINES, long_line: int = LONG_LINE
) -> DataFrame:
    """The documents, without passages that stand in an earlier place.

    Columns and their order are those of ``docs``. A passage is ``least_lines`` visible lines or
    more that follow each other, a content-defined chunk of so many lines, or a line of
    ``long_line`` words; its first place in the order of the rows of ``docs`` keeps it, every other place loses it, within a document as
    well. Shorter single lines stay wherever they stand. A line stays at its first place of all; a passage whose first place overlaps an earlier
    passage is kept in parts. Documents that lose all their text are dropped; documents that had
    none (null or empty) stay as they are. Of repeated rows the first stays. An empty table gives
    an empty one; columns of any name may be present.
    """
    stored = materialize(chunked(docs, text), "chunks")
    removed = materialize(repeated_chunks(stored, least_lines), "removed-chunks")
    gone = removed.select("row", "start", "upto").unionByName(
        repeated_windows(stored, removed, least_lines, long_line)
    )
    lost = gone.groupBy("row").agg(F.collect_list(F.struct("start", "upto")).alias("lost"))
    joined = stored.join(lost, "row", "left").select(
        "doc", "lost", F.array_join(F.transform("chunks", lambda c: c["text"]), "\n").alias("whole")
    )
    lined = joined.withColumn("lines", F.when(F.col("lost").isNotNull(), F.split("whole", "\n", -1)))
    left = F.array_except(
        F.sequence(F.lit(0), F.size("lines") - 1),
        F.flatten(F.transform("lost", lambda r: F.sequence(r["start"], r["upto"]))),
    )
    kept = F.when(F.col("lost").isNull(), F.col("whole")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    )
    rebuilt = lined.select("doc", "lost", kept.alias("kept")).where(
        F.col("lost").isNull() | F.col("kept").rlike(VISIBLE)
    )
    return rebuilt.select(*(
        F.col("kept").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns
    ))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without repeated passages: number, CRC-32 and length of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", F.crc32("text").alias("text_crc32"), F.length("text").cast("long").alias("chars")
    )


QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLE: dict[str, str] = {}
