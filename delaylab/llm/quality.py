"""Quality rules for documents: statistics of whole texts and a learned decision list.

The statistics are array expressions. The list is learned by sequential covering: a rule is grown
term by term on one part of the labelled documents, each term the threshold that gains most, then
pruned on the other part; the documents it covers are set aside and the next rule is grown, as long
as a rule shortens the description of the labels. Every labelled document is counted, in bins
between quantiles of the measures, and each step is one aggregate over these counts: the driver
sees a row for each measure and bin, never the documents. The list is applied as one ordered
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylab.llm.textbytes import spare
from delaylab.llm.scratch import stored as materialize

WINDOW = 8


@dataclass(frozen=True)
class Learning:
    """Parameters of the learner. Neither the length of the list nor that of a rule is limited."""

    #: Least share of bad documents among those that a rule covers, in both parts.
    least_precision: float = 0.95
    #: Bits that a rule must save in describing the labels, its own description taken off.
    least_saving: float = 4.0
    #: First terms that are tried, best first, before the list ends for want of a rule.
    first_terms: int = 8
    #: Quantiles of the bad and of the good documents that thresholds are put at.
    shares: tuple[float, ...] = (
        0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 0.999,
    )
    #: Rows in this number that set the accuracy of the quantiles.
    accuracy: int = 10_000


_SPACE = r"[\x20\x09-\x0D]+"
_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_bangs", "n_lines")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics of each text (null: no words) as long columns.

    ``n_words`` (runs without white space), ``word_chars`` (code points in them), ``n_symbols``
    (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word, equal to an earlier one),
    ``n_repeat_words`` (words in windows of eight that stand twice or more in the text, every
    place counted), ``n_capitals`` (A-Z), ``n_bangs`` (``!?``), ``n_lines`` (lines with a word).
    Texts are read whole. Columns of these names are replaced.
    """
    kept = spare(docs, (*_STATISTICS, "_text", "_words", "_lines", "_hashes", "_windows"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(F.col("_text"), _SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select(*(F.col(f"`{c}`") for c in kept), body.alias("_text")).select(
        "*", words.alias("_words"), lines.alias("_lines")
    )
    hashed = cut.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_words") - WINDOW
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in range(WINDOW))),
        ),
    )
    windowed = hashed.withColumn("_windows", windows)
    return windowed.select(
        *(F.col(f"`{c}`") for c in kept),
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered("_windows").alias("n_repeat_words"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("_text", F.lit("[!?]")).cast("long").alias("n_bangs"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def _covered(windows: str) -> Column:
    """Words inside windows whose hash stands twice or more.

    Most texts repeat nothing and stop at the count of distinct hashes. In the others the places
    are sorted by hash; a place whose neighbour has the same hash repeats.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(places: Column) -> Column:
        return F.array_sort(F.transform(
            F.filter(places, lambda p, k: (F.get(places, k - 1)["h"] == p["h"])
                     | (F.get(places, k + 1)["h"] == p["h"])),
            lambda p: p["i"],
        ))

    # Words from one repeated place up to the next one, at most a window.
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at"))
    total = lambda at: F.aggregate(
        at, begin,
        lambda s, i: F.struct(
            (s["n"] + F.lit(WINDOW) - F.greatest(F.lit(0), s["at"] + WINDOW - i)).alias("n"),
            i.alias("at"),
        ),
        lambda s: s["n"],
    )
    # A one-element array binds the sorted places to a variable, so they are formed once.
    counted = F.get(F.transform(F.array(placed), lambda p: total(repeats(p))), F.lit(0))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.coalesce(F.when(some, counted), F.lit(0).cast("long"))


#: What the rules may look at, from the statistics.
MEASURES = {
    "word_length": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "symbol_share": lambda: F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "copied_lines": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "capital_share": lambda: F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
    "bang_share": lambda: F.col("n_bangs") / F.greatest(F.col("n_words"), F.lit(1)),
}


@dataclass(frozen=True)
class Term:
    """A threshold on one measure: ``measure > limit`` if ``above``, else ``measure <= limit``."""

    measure: str
    above: bool
    limit: float
    bin: int

    def column(self) -> Column:
        value = MEASURES[self.measure]()
        return value > self.limit if self.above else value <= self.limit


@dataclass(frozen=True)
class Rule:
    """Documents that meet every term are bad; the counts are those of the pruning part."""

    terms: tuple[Term, ...]
    bad: int
    good: int

    def __str__(self) -> str:
        parts = [f"{t.measure} {'>' if t.above else '<='} {t.limit:.4g}" for t in self.terms]
        return " and ".join(parts) + f" -> bad ({self.bad} to {self.good})"


def verdict(rules: list[Rule]) -> Column:
    """True where the list keeps a document: one ordered conditional, good by default."""
    answer = None
    for rule in rules:
        meets = F.lit(True)
        for term in rule.terms:
            meets = meets & term.column()
        answer = F.when(meets, False) if answer is None else answer.when(meets, False)
    return F.lit(True) if answer is None else answer.otherwise(True)


class _Cells:
    """Labelled documents counted by label, part and the bin of every measure."""

    def __init__(self, counts: DataFrame, limits: dict[str, list[float]]):
        self.counts, self.limits = counts, limits

    @staticmethod
    def meets(terms: tuple[Term, ...]) -> Column:
        """Whether a cell meets every term."""
        meets = F.lit(True)
        for t in terms:
            meets = meets & (F.col(t.measure) > t.bin if t.above else F.col(t.measure) <= t.bin)
        return meets

    def without(self, rule: Rule) -> _Cells:
        return _Cells(self.counts.where(~self.meets(rule.terms)), self.limits)

    def candidates(self, terms: tuple[Term, ...]) -> tuple[int, int, list[tuple[float, Term, int, int]]]:
        """Bad and good growing documents that meet ``terms``, and what each further term gains.

        A candidate is (gain, term, bad, good); the gain is the information about the bad documents
        that stay covered. Best first.
        """
        names = list(self.limits)
        inside = self.counts.where(~F.col("prune")).where(self.meets(terms))
        each = inside.select("bad", "n", F.posexplode(F.array(*names)).alias("k", "b"))
        rows = each.groupBy("k", "b").agg(
            F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("good"),
        ).collect()
        totals = {(r.k, r.b): (r.bad, r.good) for r in rows}
        bad, good = (sum(v[i] for (k, _), v in totals.items() if k == 0) for i in (0, 1))
        found = []
        if bad:
            before = math.log2(bad / (bad + good))
            for k, m in enumerate(names):
                low_bad = low_good = 0
                for b, limit in enumerate(self.limits[m]):
                    x, y = totals.get((k, b), (0, 0))
                    low_bad, low_good = low_bad + x, low_good + y
                    for above, p, q in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                        if p:
                            gain = p * (math.log2(p / (p + q)) - before)
                            found.append((gain, Term(m, above, limit, b), p, q))
        found.sort(key=lambda c: (-c[0], c[1].measure, c[1].above, c[1].bin))
        return bad, good, [c for c in found if c[0] > 1e-9]

    def tallies(self, rules: list[tuple[Term, ...]]) -> list[tuple[int, int, int, int]]:
        """(bad, good) of the growing and (bad, good) of the pruning part, for each conjunction."""
        sums = []
        for i, terms in enumerate(rules):
            for part in (False, True):
                for bad in (True, False):
                    wanted = self.meets(terms) & (F.col("prune") == part) & (F.col("bad") == bad)
                    sums.append(F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0)).alias(f"{i}{part}{bad}"))
        row = self.counts.agg(*sums).first()
        return [tuple(row[4 * i : 4 * i + 4]) for i in range(len(rules))]


def _choices(n: int, k: int) -> float:
    """Bits that tell which k of n are meant."""
    return (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)) / math.log(2)


def _saving(rule_bits: float, covered: tuple[int, int], all_: tuple[int, int]) -> float:
    """Bits saved by describing the labels of covered documents and of the others apart."""
    (p, q), (bad, good) = covered, all_
    before = _choices(bad + good, bad)
    return before - _choices(p + q, q) - _choices(bad + good - p - q, bad - p) - rule_bits


def learn(
    labelled: DataFrame, label: str = "quality", key: str = "doc_id", settings: Learning = Learning()
) -> list[Rule]:
    """Learns the list from rows with the statistics, a key and a label (0 bad, 1 good).

    All labelled rows count; rows whose label is null or neither are left out, rows with a null
    measure too. The hash of the key decides whether a row grows or prunes rules. Without bad
    rows, and without rows, the list is empty.
    """
    names = list(MEASURES)
    rows = labelled.where(F.col(label).isin(0, 1)).select(
        (F.col(label) == 0).alias("bad"),
        (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("prune"),
        *(MEASURES[m]().cast("double").alias(m) for m in names),
    ).dropna()
    rows = materialize(rows, "labelled-statistics")
    # Thresholds from the good and the bad rows alike, so that a rare kind has its own.
    found = rows.groupBy("bad").agg(*(
        F.percentile_approx(m, list(settings.shares), settings.accuracy).alias(m) for m in names
    )).collect()
    limits = {m: sorted({float(x) for r in found for x in (r[m] or [])}) for m in names}
    binned = [
        sum((F.when(F.col(m) > x, 1).otherwise(0) for x in limits[m]), F.lit(0)).alias(m)
        for m in names
    ]
    counts = rows.select("bad", "prune", *binned).groupBy("bad", "prune", *names).agg(F.count("*").alias("n"))
    cells = _Cells(materialize(counts, "label-cells"), limits)
    rules: list[Rule] = []
    while rule := _next_rule(cells, settings):
        rules.append(rule)
        cells = cells.without(rule)
    return rules


def _next_rule(cells: _Cells, settings: Learning) -> Rule | None:
    """The next rule: grown from the best first term, or from one of the next if that fails."""
    bad, good, firsts = cells.candidates(())
    for _, first, p, q in firsts[: settings.first_terms] if bad else []:
        terms = (first,)
        while q:
            _, _, more = cells.candidates(terms)
            if not more:
                break
            _, term, p, q = more[0]
            terms += (term,)
        prefixes = [terms[:n] for n in range(len(terms), 0, -1)]
        (all_p, all_q, all_p2, all_q2), *tallies = cells.tallies([(), *prefixes])

        def worth(tally: tuple[int, int, int, int]) -> float:
            return (tally[2] - tally[3]) / max(tally[2] + tally[3], 1)

        # Drop final terms while the other part of the documents does not get worse by it.
        at = 0
        while at + 1 < len(prefixes) and worth(tallies[at + 1]) >= worth(tallies[at]):
            at += 1
        p, q, p2, q2 = tallies[at]
        precise = min(p / max(p + q, 1), p2 / (p2 + q2) if p2 + q2 else 1.0) >= settings.least_precision
        # A term names a measure, a side and a threshold; terms may come in any order.
        choices = 2 * sum(len(x) for x in cells.limits.values())
        bits = len(prefixes[at]) * math.log2(choices) - _log2_factorial(len(prefixes[at]))
        saved = _saving(bits, (p + p2, q + q2), (all_p + all_p2, all_q + all_q2))
        if precise and saved >= settings.least_saving:
            return Rule(prefixes[at], p2, q2)
    return None


def _log2_factorial(n: int) -> float:
    return math.lgamma(n + 1) / math.log(2)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Adds the statistics, ``base_failed`` and ``kept``: neither failed nor covered by a rule.

    Null and empty texts fail for want of words. Equal texts get equal verdicts. An empty table
    gives an empty one.
    """
    kept = spare(docs, (*_STATISTICS, "base_failed", "kept"))
    found = text_statistics(docs.select(*(F.col(f"`{c}`") for c in kept)), text)
    return found.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules)
    )


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents by the fixed rule and by the list learned from the labelled ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    # Statistics are formed once, and are narrow; labels join them, not the texts.
    stored = materialize(text_statistics(docs).drop("text"), "statistics")
    failed = base_failed()
    # What fails the fixed rule goes anyway and must not shape the learned ones.
    rules = learn(stored.where(~failed).join(labels, "doc_id"))
    return stored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )


QUERIES = {"op6_quality_rules": op6_quality_rules}
ORACLE: dict[str, str] = {}
