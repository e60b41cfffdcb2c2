"""Batch and live rows together equal a report over all rows."""

import pytest
from pyspark.sql import functions as F

from opinera.plans import reports, serving
from tests.test_reports import ROWS, SCHEMA


@pytest.fixture(scope="module")
def served(spark):
    base = spark.createDataFrame(ROWS, SCHEMA)
    return base, serving.Serving(base.where("recommendationid IN ('r1', 'r2', 'r5')"), base.where("recommendationid <> 'r1'"))


def _rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_merged_reports(served):
    base, both = served
    four = ("review_count", "positive_reviews", "negative_reviews", "recommendation_rate")
    assert _rows(both.games(), "appid", *four) == _rows(reports.by_game(base), "appid", *four)
    assert _rows(both.genres(), "genre", *four) == _rows(reports.by_genre(base), "genre", *four)
    assert _rows(both.playtime(), "playtime_bucket", "avg_playtime_hours", *four) == _rows(reports.by_playtime(base), "playtime_bucket", "avg_playtime_hours", *four)
    assert {r["game_type"]: (r["batch_review_count"], r["stream_review_count"], r["data_source"]) for r in both.free_paid().collect()} == {"PAID": (2, 2, "batch_plus_streaming"), "FREE": (1, 0, "batch")}
    assert [r["appid"] for r in both.top_games(2).collect()] == [30, 10]
    with pytest.raises(ValueError):
        both.top_games(101)


def test_live_pages(served):
    _, both = served
    page, total = both.reviews(1, 1)
    assert total == 2 and [r["recommendationid"] for r in page.collect()] == ["r3"]
    assert both.windows(10).count() == 1
    with pytest.raises(LookupError):
        both.windows(30)


def test_what_if(spark):
    rows = serving.what_if_rows(spark.createDataFrame([(1, "x")], "a int, b string"), {"a": [0, 1, 2], "b": ["x", "y"]})
    assert _rows(rows, "changed", "a", "b") == sorted([(None, 1, "x"), ("a", 0, "x"), ("a", 2, "x"), ("b", 1, "y")], key=repr)
    effects = serving.what_if_effects(rows.withColumn("probability", F.col("a") / 10))
    assert [(r["changed"], r["value"], round(r["delta"], 3)) for r in effects.collect()] == [("a", "2", 0.1), ("b", "y", 0.0), ("a", "0", -0.1)]


def test_evidence_and_scope(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "appid int, n string")
    found = serving.candidate_evidence(a, a.limit(1).withColumnRenamed("n", "m"), a.limit(0).withColumnRenamed("n", "k"))
    assert found.count() == 2
    sample = spark.createDataFrame([(1, "a", True), (1, "a", False), (2, "b", True)], "appid int, recommendationid string, voted_up boolean")
    assert {r["appid"]: (r["unique_reviews"], r["both_classes"]) for r in serving.sample_statistics(sample).collect()} == {1: (1, True), 2: (1, False)}
    registry = spark.createDataFrame([(3, "ACTIVE"), (1, "ACTIVE"), (2, "NEW")], "appid int, state string")
    assert serving.active_scope(registry, 2) == [1, 3]
    with pytest.raises(ValueError):
        serving.active_scope(registry, 1)
