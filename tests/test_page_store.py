"""Look-ups in a store read few of its rows."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F
from quarry.sources.page_store import look_up, read_page_store, write_page_store


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "pages")
    pages = spark.range(40_000).select(F.sha1(F.col("id").cast("string")).alias("title"), F.concat(F.lit("text "), "id", F.repeat(F.sha2(F.col("id").cast("string"), 512), 2)).alias("raw"))
    odd = spark.createDataFrame([(None, "nameless"), ("same", None)] + [("same", f"copy {i}") for i in range(500)], "title string, raw string")
    write_page_store(pages.unionByName(odd), path, files=4, group_bytes=256 << 10)
    return read_page_store(spark, path)


def scanned(df) -> int:
    """Rows that the scan gave, once `df` has been worked out."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


def names(spark, *titles):
    return spark.createDataFrame([(t,) for t in titles], "title string")


def test_a_page_is_found_in_one_row_group(spark, store):
    assert store.count() == 40_502
    title = store.where("raw like 'text 17%'").agg(F.min("title")).first()[0]
    found = look_up(store, names(spark, title, title, None))
    assert [r.title for r in found.collect()] == [title]
    assert 0 < scanned(found) < 4_000


def test_a_missing_page_is_told_by_filters(spark, store):
    """Names within the bounds of some row group."""
    found = look_up(store, names(spark, *(f"{i:x}" * 20 for i in range(16))))
    assert found.collect() == [] and scanned(found) < 20_000


def test_many_names_and_copies(spark, store):
    assert look_up(store, names(spark, "same")).count() == 501
    assert look_up(store, names(spark, None)).count() == 0 and look_up(store, names(spark).where("false")).count() == 0
    some = store.where("title < '1'").select("title")
    by_join, by_filters = look_up(store, some, most=100), look_up(store, some.limit(90), most=100)
    assert by_join.count() == some.count() > 1_000 and by_filters.count() == 90 and by_join.columns == store.columns


def test_a_store_of_nothing(spark, tmp_path):
    write_page_store(spark.createDataFrame([], "title string, raw string"), str(tmp_path / "none"))
    assert look_up(read_page_store(spark, str(tmp_path / "none")), names(spark, "a")).count() == 0
