"""Paged sources, catalogs, logs and tables that may not be there."""

import json

import pytest

from opinera.sources import catalog, logs, paging, staging


def test_retry():
    waits, answers = [], [paging.Response(429, retry_after="7"), paging.Response(500), paging.Response(200, {"rows": [1]})]
    assert paging.ask(lambda: answers.pop(0), paging.CRAWLER, waits.append) == {"rows": [1]} and waits == [7.0, 4.0]
    with pytest.raises(paging.Refused, match="403"):
        paging.ask(lambda: paging.Response(403), paging.CRAWLER, waits.append)
    tried = []
    with pytest.raises(paging.Refused, match="5 attempts"):
        paging.ask(lambda: tried.append(1) or paging.Response(403), paging.CHECKER, lambda _: None)
    assert len(tried) == 5
    with pytest.raises(paging.Refused, match="404"):
        paging.ask(lambda: paging.Response(404), paging.CHECKER, lambda _: None)
    assert paging.Retry(exponential=False).wait(3) == 2.0


def _fetch(cursor):
    page = 0 if cursor == "*" else int(cursor)
    rows = [{"recommendationid": str(page * 2 + i), "language": "english" if i else "german"} for i in range(2)]
    return {"rows": rows if page < 4 else [], "cursor": str(page + 1)}


def test_walk_and_crawl(tmp_path):
    assert [(n, c) for n, c, _ in paging.walk(_fetch)] == [(1, "*"), (2, "1"), (3, "2"), (4, "3")]
    assert len(list(paging.walk(lambda c: {"rows": [1], "cursor": c}))) == 1 and len(list(paging.walk(_fetch, most_pages=2))) == 2
    out, state = tmp_path / "out.jsonl", tmp_path / "state.json"
    calls = []

    def breaking(cursor):
        calls.append(cursor)
        if len(calls) == 3:
            raise paging.Refused("stop")
        return _fetch(cursor)

    with pytest.raises(paging.Refused):
        paging.crawl(breaking, 7, 3, out, state, tmp_path / "raw")
    assert paging.crawl(breaking, 7, 3, out, state, tmp_path / "raw") == 3 and calls == ["*", "1", "2", "2"]
    rows = [json.loads(x) for x in out.read_text().splitlines()]
    assert [r["review"]["recommendationid"] for r in rows] == ["1", "3", "5"] and [r["page_number"] for r in rows] == [1, 2, 3]
    assert json.loads((tmp_path / "raw/7/page_00003.json").read_text())["cursor"] == "2"
    assert paging.crawl(breaking, 7, 3, out, state) == 3 and len(calls) == 4


def test_pages_as_a_source(spark):
    def fetch(item, cursor):
        page = 0 if cursor == "*" else int(cursor)
        return {"rows": [{"item": item, "page": page}] if page < 5 else [], "cursor": str(page + 1)}

    paging.register_pages(spark, "pages_for_test", fetch)
    found = spark.read.format("pages_for_test").option("items", "3,4").option("pages", "2").load()
    assert sorted((r["item"], r["page"], json.loads(r["value"])["item"]) for r in found.collect()) == [(3, 1, "3"), (3, 2, "3"), (4, 1, "4"), (4, 2, "4")]


PAGE = """<a class="search_result_row x" data-ds-appid="10"><span class="title">A &amp; <b>B</b></span><div class="col search_released">1 Feb, 2020</div><span class="search_review_summary positive" data-tooltip-html="Good"></span></a>
<a class="other" data-ds-appid="11">no</a><a class="search_result_row" data-ds-appid="x"><span class="title">bad id</span></a><a class="search_result_row" data-ds-appid="12"></a>"""


def test_catalog(spark):
    pages = spark.createDataFrame([(PAGE, 0), (PAGE, 25), (None, 50), ("", 75)], "html string, start int")
    rows = sorted(map(tuple, catalog.search_results(pages.where("start = 0")).collect()))
    assert rows == [(10, "A & B", "1 Feb, 2020", "Good", 0), (12, None, None, None, 0)]
    known = spark.createDataFrame([(12,)], "appid int")
    assert [(r["appid"], r["catalog_start"]) for r in catalog.candidates(catalog.search_results(pages), known).collect()] == [(10, 0)]
    assert [catalog.next_start(*x) for x in ((0, 25, 25, 60), (50, 10, 25, 60), (25, 0, 25, 60))] == [25, 0, 50]
    page = lambda start: (spark.createDataFrame([(PAGE, start)], "html string, start int"), 25, 60)
    found = catalog.refresh(page, known, 25, 25, 9)
    assert (found.start, found.pages) == (25, 3) and found.fresh.count() == 1
    assert catalog.refresh(page, known, 50, 25, 1).start == 0 and catalog.unescaped("a &lt; b") == "a < b"


def test_eligibility(spark):
    rows = [(1, True, ("game", (False,))), (2, False, ("game", (False,))), (3, True, ("dlc", (False,))), (4, True, ("game", (True,))), (5, None, None), (6, True, ("game", None))]
    landed = spark.createDataFrame(rows, "appid int, success boolean, data struct<type:string,release_date:struct<coming_soon:boolean>>")
    assert {r["appid"]: r["excluded"] for r in catalog.eligibility(landed).collect()} == {1: None, 2: "METADATA_FAILED", 3: "NOT_A_GAME", 4: "COMING_SOON", 5: "METADATA_FAILED", 6: None}
    assert catalog.eligible(landed).columns == landed.columns and catalog.eligible(landed).count() == 2


def test_logs(spark, tmp_path):
    options = logs.log_options("host:9092", "reviews", 500)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "500" and options["failOnDataLoss"] == "true"
    with pytest.raises(ValueError):
        logs.log_options("h", "t", 0)
    assert logs.read_log(spark, {"rowsPerSecond": "1"}, "rate").isStreaming
    sent = logs.messages(spark.createDataFrame([(10, "x")], "appid int, event_id string")).first()
    assert sent["key"] == "10" and json.loads(sent["value"]) == {"appid": 10, "event_id": "x"}
    assert not logs.there(spark, f"{tmp_path}/none")
    logs.ensure_folder(spark, f"file://{tmp_path}/a/b")
    assert logs.there(spark, f"{tmp_path}/a/*")
    (tmp_path / "one").write_text("same")
    target = f"file://{tmp_path}/pub/x/one"
    assert [logs.publish_file(spark, f"file://{tmp_path}/one", target) for _ in range(2)] == ["published", "reused"]
    (tmp_path / "one").write_text("other")
    with pytest.raises(FileExistsError):
        logs.publish_file(spark, f"file://{tmp_path}/one", target)


def test_scratch(spark):
    rows = spark.range(5)
    kept = staging.staged(spark, rows, "kept")
    with staging.scratch(spark):
        made, path = staging.written(spark, rows, "gone")
        assert made.count() == 5 and logs.there(spark, path)
    assert not logs.there(spark, path) and kept.count() == 5


def test_probe(tmp_path):
    assert paging.probe(_fetch, 3) == paging.Feasibility(3, "TARGET_REACHED", 3) and paging.probe(_fetch, 3).feasible
    assert paging.probe(_fetch, 9) == paging.Feasibility(4, "EXHAUSTED", 4)
    same = lambda c: {"rows": [{"recommendationid": "1", "language": "english"}], "cursor": c + "x"}
    assert paging.probe(same, 2) == paging.Feasibility(1, "EXHAUSTED_STAGNANT", 4)
    from opinera.sources import files

    (tmp_path / "a").write_text("x")
    (tmp_path / "b").write_text("y")
    both = [tmp_path / "a", tmp_path / "b"]
    assert files.fingerprint(both) == files.fingerprint(both) != files.fingerprint(both[::-1])


def test_player_count():
    answers = [{"response": {"result": 42}}, {"response": {"result": 1, "player_count": True}}, {"response": {"result": 1, "player_count": 7}}]
    waits = []
    assert paging.player_count(lambda: paging.Response(200, answers.pop(0)), sleep=waits.append) == 7 and waits == [2.0, 4.0]
    with pytest.raises(paging.Refused):
        paging.player_count(lambda: paging.Response(200, {}), sleep=waits.append)
