"""Allow and block lists for addresses, as a trie over host labels and path segments.

A rule is a host and a path. The trie has one level per host label, last label first, and one per
path segment. An address walks down once; every rule it passes fits. Of one host the deepest is the
longest; of several hosts the one whose host and path together have most characters decides.
Rules are broadcast in blocks of bounded size. One block needs no shuffle; with more, rounds over
addresses alone are stored one after the other, so the number of rules has no limit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.scratch import stored as materialize
from delaylab.llm.textbytes import spare

#: Rules in one broadcast trie (some 500 bytes each).
BLOCK_RULES = 200_000
_CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host is lowered A-Z; without ``://`` both are empty."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "#?":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_CAPITALS), slash + path


class Trie:
    """Rules by reversed host labels, then by path segments.

    A node holds the rules whose path ends within the next segment, by the part that they name
    (``/en/`` ends in the empty part of the segment behind ``en``), and the lengths of these parts:
    the longest that a segment begins with is looked up by its length, not searched.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for action, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            segments = path.split("/")
            node = node.setdefault("paths", {})
            for segment in segments[:-1]:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            # Of two rules for one place the block entry stands.
            known = node.setdefault("ends", {}).get(segments[-1])
            if known is None or action == "block":
                node["ends"][segments[-1]] = (action, host, path)
            node.setdefault("lengths", set()).add(len(segments[-1]))
        self._sort(self.root)

    @staticmethod
    def _sort(root: dict) -> None:
        todo = [root]
        while todo:
            node = todo.pop()
            if "lengths" in node:
                node["lengths"] = sorted(node["lengths"], reverse=True)
            for kind in ("labels", "segments"):
                todo += node.get(kind, {}).values()
            if "paths" in node:
                todo.append(node["paths"])

    def longest(self, host: str, path: str) -> tuple[str, str, str] | None:
        """The longest rule that fits."""
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                found = self._deepest(node["paths"], segments)
                if found and (best is None or _rank(*found) > _rank(*best)):
                    best = found
        return best

    @staticmethod
    def _deepest(node: dict, segments: list[str]):
        best = None
        for segment in segments:
            for length in node.get("lengths", ()):
                end = node["ends"].get(segment[:length]) if length <= len(segment) else None
                if end:
                    best = end
                    break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best


def _rank(action: str, host: str, path: str) -> tuple[int, int, bool]:
    """What makes a rule win: its length, then that of its host, then that it blocks."""
    return len(host) + len(path), len(host), action == "block"


def _judge(shared, url: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            fields = batch.schema.names
            parts = [split_url(u) for u in batch.column(fields.index(url)).to_pylist()]
            old = (batch.column(fields.index(c)).to_pylist() for c in ("rule", "verdict"))
            best = []
            for (host, path), rule, verdict in zip(parts, *old):
                found = trie.longest(host, path)
                if found and (rule is None or _rank(*found) > _parts(rule, verdict)):
                    rule, verdict = found[1] + found[2], found[0]
                best.append((rule, verdict))
            new = {
                "host": pa.array([p[0] for p in parts], pa.string()),
                "path": pa.array([p[1] for p in parts], pa.string()),
                "rule": pa.array([b[0] for b in best], pa.string()),
                "verdict": pa.array([b[1] for b in best], pa.string()),
            }
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(fields.index(n)) for n in names], names=names
            )

    return run


def _parts(rule: str, verdict: str) -> tuple[int, int, bool]:
    """Rank of the rule of an earlier block."""
    host, slash, path = rule.partition("/")
    return _rank(verdict, host, slash + path)


def _blocks(spark: SparkSession, rules, block_rules: int) -> Iterator[list[tuple[str, str, str]]]:
    """The rules in lists of about ``block_rules``, one after the other."""
    if not isinstance(rules, DataFrame):
        for at in range(0, max(len(rules), 1), block_rules):
            yield list(rules[at : at + block_rules])
        return
    rules = materialize(rules.select("action", "host", "path").distinct(), "rules")
    blocks = max(1, -(-rules.count() // block_rules))
    part = F.pmod(F.xxhash64("host", "path"), F.lit(blocks))
    for number in range(blocks):
        yield [tuple(r) for r in rules.where(part == number).collect()]


def _checked(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    for action, host, path in rules:
        if action not in ("allow", "block") or not host or path is None or (path and not path.startswith("/")):
            raise ValueError(f"not a rule: {(action, host, path)}")
    return rules


def judge_urls(
    pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]], url: str = "url",
    default: str = "allow", block_rules: int = BLOCK_RULES,
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    ``rules`` are (allow or block, host, path), as a list or as a table (action, host, path) of any
    size. A rule fits its host and all its subdomains if the address's path starts with the
    rule's. The longest rule wins: most characters of host and path together; of equally long
    ones that with the longer host; of an allow and a block entry for one place the block entry.
    ``rule`` is the winner's host and path, or null, and then ``verdict`` is ``default``.

    Null addresses and those without ``://`` have empty host and path and no rule, as have all
    addresses when there are no rules. Long addresses are read whole. Repeated rows are judged one
    by one, and no rows give none. Input columns with the name of a new one are replaced; the name
    of the address column may be written in any case.
    """
    new = ("host", "path", "rule", "verdict")
    kept = spare(pages, new)
    url = next(c for c in pages.columns if c.lower() == url.lower())
    spark = pages.sparkSession
    start = [
        F.lit("").alias("host"), F.lit("").alias("path"),
        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
    ]

    def judged(rows: DataFrame, column: str, block: list) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        trie = spark.sparkContext.broadcast(Trie(_checked(block)))
        return rows.mapInArrow(_judge(trie, column, schema.names), schema)

    blocks = _blocks(spark, rules, block_rules)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return judged(pages.select(*(F.col(f"`{c}`") for c in kept), *start), url, first)
    # Rows are numbered once; the rounds carry addresses and numbers only.
    numbered = materialize(
        pages.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_page")), "pages"
    )
    found = numbered.select("_row", F.col(f"_page.`{url}`").alias("_url"), *start)
    for block in itertools.chain([first, second], blocks):
        found = materialize(judged(found, "_url", block), "judged")
    return numbered.join(found, "_row").select(*(F.col(f"_page.`{c}`") for c in kept), *new)


#: The rules of the registered query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    """The address of every page against the rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host0,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
h AS (SELECT page_id, path, translate(host0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM q),
r(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
    max_by(verdict, length(rhost || rpath)) AS verdict
  FROM h, r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""

QUERIES = {"op7_url_filters": op7_url_filters}
ORACLE = {"op7_url_filters": _SQL}
