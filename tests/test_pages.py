"""Pages of a stored listing."""

import re

import pytest
from pyspark.sql import functions as F

from delaylab.operators import pages
from delaylab.session import new_dir
from tests.test_plans import plan


@pytest.fixture(scope="module")
def listing(spark):
    path = new_dir(spark, "listing")
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("a"), (F.col("id") * 37 % 2000).alias("id")
    )
    pages.store_listing(df, ["a", "id"], path, block_rows=150)
    rows = sorted((r["a"] is None, r["a"] or 0, r["id"]) for r in df.collect())
    return path, rows


@pytest.mark.parametrize("start, size", [(0, 15), (149, 2), (140, 300), (1990, 50), (2000, 5), (9000, 5), (7, 0)])
def test_pages_at_any_depth(spark, listing, start, size):
    path, rows = listing
    got = pages.read_page(spark, path, start, size).orderBy("rank").collect()
    assert [(r["a"] is None, r["a"] or 0, r["id"]) for r in got] == rows[start : start + size]
    assert [r["rank"] for r in got] == list(range(start + 1, start + 1 + len(got)))
    assert {r["total"] for r in got} <= {2000} and pages.total(spark, path) == 2000


def test_a_deep_page_reads_its_block_only(spark, listing):
    page = pages.read_page(spark, listing[0], 1500, 15)
    text = plan(page)
    # The bounds of the folder, both ten.
    assert re.search(r"PartitionFilters: \[[^\]]*block#\d+L? >= 10\), \(block#\d+L? <= 10\)", text)
    assert "GreaterThan(rank,1500), LessThanOrEqual(rank,1515)" in text and "Exchange" not in text


def test_the_place_of_a_key(spark, listing):
    path, rows = listing
    for key in ({"a": 0, "id": 0}, {"a": 3, "id": 1000}, {"a": 6, "id": 5000}, {"a": None, "id": 40},
                {"a": None, "id": None}, {"a": -1, "id": 0}):
        place = (key["a"] is None, key["a"] or 0, 10**9 if key["id"] is None else key["id"])
        assert pages.rank_of(spark, path, ["a", "id"], key) == sum(r < place for r in rows)


def test_an_empty_listing(spark):
    path = new_dir(spark, "listing")
    pages.store_listing(spark.createDataFrame([], "a int, id int"), ["a"], path)
    assert pages.total(spark, path) == 0 and pages.rank_of(spark, path, ["a"], {"a": 1}) == 0
    with pytest.raises(LookupError):
        pages.read_page(spark, path, 0, 5)


def test_a_long_listing_has_few_blocks(spark, monkeypatch):
    path = new_dir(spark, "listing")
    monkeypatch.setattr(pages, "BLOCKS", 8)
    pages.store_listing(spark.range(2000).toDF("id"), ["id"], path, block_rows=10)
    index = pages.read_index(spark, path).orderBy("block").collect()
    assert [r["rows"] for r in index] == [250] * 8 and {r["block_rows"] for r in index} == {250}
    page = pages.read_page(spark, path, 495, 10).orderBy("rank").collect()
    assert [r["id"] for r in page] == [*range(495, 505)] and {r["total"] for r in page} == {2000}
    assert pages.rank_of(spark, path, ["id"], {"id": 1234}) == 1234
