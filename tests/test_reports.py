"""Reports over five reviews with values worked out by hand, and merges against recomputing."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinera.functions.dimensions import hours_bucket, price_bucket
from opinera.plans import reports
from opinera.plans.metrics import Report, approval, average, merged_with_provenance

SCHEMA = (
    "recommendationid string, appid int, game_name string, voted_up boolean, playtime_hours double, playtime_bucket string, playtime_at_review bigint, playtime_forever bigint, "
    "is_free boolean, price double, genres array<string>, categories array<string>, steam_purchase boolean, received_for_free boolean, "
    "platforms struct<windows:boolean,mac:boolean,linux:boolean>, votes_up bigint, votes_funny bigint, weighted_vote_score string, timestamp_created bigint"
)
_TEN = (False, 100.0, ["Action", "RPG", "Action"], ["Single-player", "Achievements", "Achievements"])
ROWS = [
    ("r1", 10, "Ten", True, 1.0, "0-2h", 60, 120, *_TEN, True, False, (True, True, False), 4, 1, "0.75", 100),
    ("r2", 10, "Ten", False, 3.0, "2-10h", 180, 240, *_TEN, False, False, (True, True, False), 2, 3, "0.25", 200),
    ("r3", 10, "Ten", True, None, "2-10h", None, None, *_TEN, True, True, (True, True, False), 6, 2, "1.00", 300),
    ("r4", 20, "Twenty", False, 20.0, "10-50h", 1200, 1800, False, 300.0, ["Strategy"], ["Multi-player"], False, False, (True, False, False), 0, 0, "0.50", None),
    ("r5", 30, "Thirty", True, 60.0, "50h+", 3600, 6000, True, 0.0, None, None, False, True, (True, False, True), 10, 4, None, 500),
]


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _by(frame, key):
    return {r[key]: r.asDict() for r in frame.collect()}


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _four(row):
    return row["review_count"], row["positive_reviews"], row["negative_reviews"], pytest.approx(row["recommendation_rate"])


def test_by_game(base):
    found = _by(reports.by_game(base), "appid")
    assert (_four(found[10]), _four(found[20]), _four(found[30])) == ((3, 2, 1, 2 / 3), (1, 0, 1, 0), (1, 1, 0, 1))


def test_by_member(base):
    genres, categories = _by(reports.by_genre(base), "genre"), _by(reports.by_category(base), "category")
    assert set(genres) == {"Action", "RPG", "Strategy", "UNKNOWN"} and _four(genres["Action"]) == (3, 2, 1, 2 / 3)
    assert _rows(reports.by_genre(base)) == _rows(reports.by_genre(base, unique=True)) and _rows(reports.by_category(base)) == _rows(reports.by_category(base, unique=True))
    twice = _by(reports.by_genre(base.unionAll(base.limit(2))), "genre")
    assert _four(twice["Action"]) == (3, 2, 1, 2 / 3)  # a repeated review counts once
    assert _four(categories["Achievements"]) == (3, 2, 1, 2 / 3) and _four(categories["UNKNOWN"]) == (1, 1, 0, 1)


def test_by_playtime(base):
    found = _by(reports.by_playtime(base), "playtime_bucket")
    assert len(found) == 4 and found["2-10h"]["review_count"] == 2 and found["2-10h"]["avg_playtime_hours"] == 3.0


def test_by_price_type(base):
    found = _by(reports.by_price_type(base), "game_type")
    paid = found["PAID"]
    assert (paid["game_count"], paid["review_count"], paid["playtime_observed_count"], paid["avg_playtime_hours"]) == (2, 4, 3, 8.0)
    assert (paid["min_price"], paid["max_price"], paid["avg_price"]) == (100.0, 300.0, 200.0) and found["FREE"]["game_count"] == 1


def test_by_platform_and_purchase(base):
    platforms, bought = _by(reports.by_platform(base), "platform"), _by(reports.by_purchase(base), "purchase_source")
    assert {p: (r["review_count"], r["positive_reviews"]) for p, r in platforms.items()} == {"WINDOWS": (5, 3), "MAC": (3, 2), "LINUX": (1, 1)}
    assert bought["STEAM_PURCHASE"]["avg_playtime_hours"] == 1.0 and bought["OTHER_SOURCE"]["avg_playtime_hours"] == pytest.approx(83 / 3)
    assert {r["acquisition_type"]: r["review_count"] for r in reports.by_gift(base).collect()} == {"RECEIVED_FOR_FREE": 2, "NOT_RECEIVED_FOR_FREE": 3}


def test_engagement_and_profile(base):
    ten, thirty = (_by(reports.engagement(base), "appid")[i] for i in (10, 30))
    assert (ten["playtime_at_review_observed_count"], ten["avg_playtime_at_review_hours"], ten["avg_playtime_forever_hours"], ten["avg_votes_up"], ten["avg_votes_funny"]) == (2, 2.0, 3.0, 4.0, 2.0)
    assert ten["avg_weighted_vote_score"] == pytest.approx(2 / 3, rel=1e-12) and thirty["avg_weighted_vote_score"] is None
    row = reports.label_profile(base).first()
    assert (row["total_rows"], row["distinct_appids"], row["positive_count"], row["free_review_count"], row["null_playtime_at_review"], row["null_genres"], row["null_price"]) == (5, 3, 3, 1, 1, 1, 0)


def test_bucket_edges(spark):
    hours = spark.createDataFrame([(None,), (-1.0,), (0.0,), (2.0,), (10.0,), (50.0,)], "h double").select(hours_bucket(F.col("h"))).collect()
    assert [r[0] for r in hours] == [None, None, "0-2h", "2-10h", "10-50h", "50h+"]
    prices = spark.createDataFrame([(True, None), (False, None), (False, 199999.0), (False, 200000.0), (False, 1e6), (None, 5.0)], "f boolean, p double").select(price_bucket(F.col("f"), F.col("p"))).collect()
    assert [r[0] for r in prices] == ["FREE", "UNKNOWN", "<200K", "200K-500K", "1M+", "<200K"]


def test_by_price(base):
    found = _by(reports.by_price(base), "price_bucket")
    assert {k: (r["game_count"], r["review_count"], r["avg_playtime_hours"]) for k, r in found.items()} == {"<200K": (2, 4, 8.0), "FREE": (1, 1, 60.0)}


def test_averages_are_exact(spark):
    rows = spark.createDataFrame([("a", 1e-7), ("a", 2e-7), ("b", 1 / 3), ("b", 1e-7), ("b", 2e-7), ("c", float("nan")), ("c", 2.0), ("d", None)], "k string, x double")
    report = Report(("k",), average("mean", lambda: F.col("x"), "seen"))
    found = _by(report.over(rows), "k")
    plain = _by(rows.groupBy("k").agg(F.avg("x").alias("mean"), F.count("x").alias("seen")), "k")
    assert found["a"]["mean"] == pytest.approx(1.5e-7, rel=1e-12) and math.isnan(found["c"]["mean"]) and found["d"]["mean"] is None
    assert all(found[k]["seen"] == plain[k]["seen"] and found[k]["mean"] == pytest.approx(plain[k]["mean"], rel=1e-12, nan_ok=True) for k in "abc")


def test_windows(base):
    rows = base.where("timestamp_created IS NOT NULL")
    found = reports.window_metrics(rows).collect()
    assert len(found) == 2 and {r["appid"]: r["review_count"] for r in found} == {10: 3, 30: 1}
    assert all((r["window_end"] - r["window_start"]).total_seconds() == 3600 for r in found)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([True, False, None]), st.one_of(st.none(), st.integers(-5, 500))), min_size=1, max_size=20), cut=st.integers(0, 20))
def test_merging_equals_recomputing(spark, rows, cut):
    frame = lambda r: spark.createDataFrame(r, "k string, up boolean, minutes int")
    report = approval(("k",), lambda: F.col("up"), *average("avg_hours", lambda: F.col("minutes") / 60, "observed"))
    merged = merged_with_provenance(report, report.partial(frame(rows[:cut])), report.partial(frame(rows[cut:]))).drop("batch_review_count", "stream_review_count", "data_source")
    for a, b in zip(_rows(merged), _rows(report.over(frame(rows))), strict=True):
        assert all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a, b, strict=True))
