"""Small fixtures and plain definitions that the operators are held against."""

import re
from collections import defaultdict

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, tmp_path, rows, schema):
    """The rows as a Parquet table, in a folder of its own."""
    path = str(tmp_path / f"t{abs(hash((schema, str(rows)[:200], len(rows))))}")
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def letters(text):
    return LETTERS.findall((text or "").translate(LOWER))


def visible(text):
    return VISIBLE.findall((text or "").translate(LOWER))


def shingles(text, k):
    words = visible(text)
    size = min(k, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def components(ids, links):
    """Smallest id reachable from each."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for start in sorted(ids):
        if start in found:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = start
                todo += near[x]
    return found
