"""The platform's own operators over landed records made from the driver's tables, each with the SQL that says the same.

Nested results are shown as text, so that both sides have plain columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.functions.dimensions import members
from opinera.operators import contracts, dashboard, learning, lifecycle, quality, ranking, snapshots, staged
from opinera.plans import landed, reports
from opinera.plans.landed import APPROVAL, SQL_GAMES, SQL_GOLD, SQL_REVIEWS
from opinera.plans.queries import query
from opinera.plans.serving import Serving
from opinera.sources import catalog, files, logs
from opinera.sources.staging import drop_folder, new_folder, staged as staged_table
from opinera.sources.tables import table
from opinera.streaming import events as ev
from opinera.streaming import contract, outbox, wiring

_LIVE = "timestamp_created >= 946684800"


def _joined(column: str):
    return F.when(F.col(column).isNotNull(), F.array_join(column, "|"))


def _flat(rows: DataFrame) -> DataFrame:
    """Arrays and the platforms as text."""
    flags = [F.when(F.col(f"platforms.{p}"), F.lit(p)) for p in ("windows", "mac", "linux")]
    return rows.withColumns({"genres": _joined("genres"), "categories": _joined("categories"), "platforms": F.concat_ws("|", *flags)})


_SHOWN = "array_to_string(genres, '|') AS genres, array_to_string(categories, '|') AS categories, concat_ws('|', 'windows', CASE WHEN mac THEN 'mac' END, CASE WHEN linux THEN 'linux' END) AS platforms"


@query(f"WITH {SQL_GAMES} SELECT appid, game_name, is_free, CAST(price AS DOUBLE) AS price, currency, {_SHOWN}, release_date FROM game")
def clean_games(spark: SparkSession, d: str) -> DataFrame:
    return _flat(landed.games(spark, d))


@query(f"""WITH {SQL_REVIEWS} SELECT recommendationid, appid, game_name, language_clean, voted_up, steam_purchase, received_for_free, timestamp_created, votes_up, votes_funny, CAST(score AS DOUBLE) AS score, playtime_at_review, playtime_forever,
CAST(voted_up AS INTEGER) AS recommendation_label, playtime_at_review / 60.0::DOUBLE AS playtime_hours, CAST(year(make_timestamp(timestamp_created * 1000000)) AS INTEGER) AS review_year FROM review""")
def clean_reviews(spark, d):
    return landed.reviews(spark, d).withColumn("score", F.col("weighted_vote_score").cast("double")).drop("weighted_vote_score", "language")


@query(f"""WITH {SQL_GOLD} SELECT recommendationid, appid, game_name, voted_up, playtime_at_review, playtime_forever, steam_purchase, received_for_free, is_free, CAST(price AS DOUBLE) AS price, currency, {_SHOWN}, release_date, timestamp_created, votes_up, votes_funny,
CAST(score AS DOUBLE) AS score, CAST(voted_up AS INTEGER) AS recommendation_label, playtime_hours, playtime_bucket FROM gold""")
def analytical_base(spark, d):
    return _flat(landed.gold(spark, d)).withColumn("score", F.col("weighted_vote_score").cast("double")).drop("weighted_vote_score")


def _by(key: str, more: str = "") -> str:
    return f"WITH {SQL_GOLD} SELECT {key}, {APPROVAL}{more} FROM gold GROUP BY {key}"


@query(_by("appid, game_name"))
def report_games(spark, d):
    return reports.by_game(landed.gold(spark, d))


_HOURS = ", avg(playtime_hours) AS avg_playtime_hours"


def _list_sql(column: str, name: str) -> str:
    members_ = f"CASE WHEN {column} IS NULL OR len({column}) = 0 THEN ['UNKNOWN'] ELSE {column} END"
    return f"WITH {SQL_GOLD}, one AS (SELECT recommendationid, {name}, bool_or(voted_up) AS voted_up FROM (SELECT recommendationid, voted_up, unnest({members_}) AS {name} FROM gold) GROUP BY ALL) SELECT {name}, {APPROVAL} FROM one GROUP BY {name}"


@query(_list_sql("genres", "genre"))
def report_genres(spark, d):
    return reports.by_genre(landed.gold(spark, d))


@query(_list_sql("categories", "category"))
def report_categories(spark, d):
    return reports.by_category(landed.gold(spark, d))


@query(_by("playtime_bucket", _HOURS))
def report_playtime(spark, d):
    return reports.by_playtime(landed.gold(spark, d))


@query(f"""WITH {SQL_GOLD}, prices AS (SELECT game_type, count(*) AS game_count, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price, avg(price) AS avg_price FROM (SELECT DISTINCT game_type, appid, price FROM gold) GROUP BY game_type)
SELECT * FROM (SELECT game_type, {APPROVAL}, count(playtime_hours) AS playtime_observed_count{_HOURS} FROM gold GROUP BY game_type) JOIN prices USING (game_type)""")
def report_free_paid(spark, d):
    return reports.by_price_type(landed.gold(spark, d))


@query(f"WITH {SQL_GOLD} SELECT platform, {APPROVAL} FROM (SELECT voted_up, 'WINDOWS' AS platform FROM gold UNION ALL SELECT voted_up, 'MAC' FROM gold WHERE mac UNION ALL SELECT voted_up, 'LINUX' FROM gold WHERE linux) GROUP BY platform")
def report_platforms(spark, d):
    return reports.by_platform(landed.gold(spark, d))


@query(f"WITH {SQL_GOLD} SELECT CASE WHEN steam_purchase THEN 'STEAM_PURCHASE' ELSE 'OTHER_SOURCE' END AS purchase_source, {APPROVAL}{_HOURS} FROM gold GROUP BY 1")
def report_purchases(spark, d):
    return reports.by_purchase(landed.gold(spark, d))


@query(f"WITH {SQL_GOLD} SELECT CASE WHEN received_for_free THEN 'RECEIVED_FOR_FREE' ELSE 'NOT_RECEIVED_FOR_FREE' END AS acquisition_type, {APPROVAL}{_HOURS} FROM gold GROUP BY 1")
def report_gifts(spark, d):
    return reports.by_gift(landed.gold(spark, d))


@query(f"WITH {SQL_GOLD} SELECT price_bucket, count(DISTINCT appid) AS game_count, count(*) AS review_count, count(*) FILTER (voted_up) AS positive_reviews, count(*) FILTER (voted_up) / count(*)::DOUBLE AS recommendation_rate{_HOURS} FROM gold GROUP BY price_bucket")
def report_prices(spark, d):
    return reports.by_price(landed.gold(spark, d))


@query(f"""WITH {SQL_GOLD} SELECT appid, game_name, count(*) AS review_count, count(*) FILTER (voted_up) AS positive_reviews, count(*) FILTER (voted_up) / count(*)::DOUBLE AS recommendation_rate,
avg(playtime_at_review / 60.0::DOUBLE) AS avg_playtime_at_review_hours, count(playtime_at_review) AS playtime_at_review_observed_count, avg(playtime_forever / 60.0::DOUBLE) AS avg_playtime_forever_hours, count(playtime_forever) AS playtime_forever_observed_count,
avg(votes_up) AS avg_votes_up, avg(votes_funny) AS avg_votes_funny, avg(score) AS avg_weighted_vote_score FROM gold GROUP BY appid, game_name""")
def report_engagement(spark, d):
    return reports.engagement(landed.gold(spark, d))


_PROFILE = """count(*) AS total_rows, count(DISTINCT recommendationid) AS unique_recommendationid, count(DISTINCT appid) AS distinct_appids, count(*) FILTER (voted_up) AS positive_count, count(*) FILTER (NOT voted_up) AS negative_count,
count(*) FILTER (is_free) AS free_review_count, count(*) FILTER (NOT is_free) AS paid_review_count, count(*) FILTER (playtime_at_review IS NULL) AS null_playtime_at_review, count(*) FILTER (playtime_forever IS NULL) AS null_playtime_forever, count(*) FILTER (price IS NULL) AS null_price,
count(*) FILTER (genres IS NULL) AS null_genres, count(*) FILTER (timestamp_created IS NULL) AS null_timestamp_created, count(*) FILTER (score IS NULL) AS null_weighted_vote_score, count(*) FILTER (voted_up) / count(*)::DOUBLE AS positive_percentage, count(*) FILTER (NOT voted_up) / count(*)::DOUBLE AS negative_percentage"""


@query(f"WITH {SQL_GOLD} SELECT {_PROFILE} FROM gold")
def report_labels(spark, d):
    return reports.label_profile(landed.gold(spark, d))


@query(f"WITH {SQL_GOLD} SELECT recommendationid, appid, playtime_forever, playtime_at_review FROM gold WHERE playtime_forever < playtime_at_review")
def playtime_anomalies(spark, d):
    return contracts.anomalies(landed.gold(spark, d)).select("recommendationid", "appid", "playtime_forever", "playtime_at_review")


@query(f"WITH {SQL_GOLD} SELECT appid, game_name, count(*) AS rows FROM gold WHERE playtime_forever < playtime_at_review GROUP BY ALL")
def anomalies_by_game(spark, d):
    return contracts.anomalies_by_game(landed.gold(spark, d))


def _total(name: str, key: str, where: str = "") -> str:
    return f"SELECT '{name}' AS report, count(*) AS rows, CAST(sum(n) AS BIGINT) AS reviews, count(*) FILTER (r IS NULL OR r NOT BETWEEN 0 AND 1) AS bad_rates FROM (SELECT count(*) AS n, avg(CAST(voted_up AS INTEGER)) AS r FROM gold {where} GROUP BY {key})"


@query(f"WITH {SQL_GOLD} {_total('game_metrics', 'appid, game_name')} UNION ALL {_total('playtime_metrics', 'playtime_bucket')} UNION ALL {_total('free_paid_metrics', 'game_type')} UNION ALL {_total('purchase_metrics', 'steam_purchase')}")
def published_totals(spark, d):
    """Reports written, read back, and added up."""
    folder, out = new_folder(spark, "published"), None
    base = landed.gold(spark, d)
    for name in ("game_metrics", "playtime_metrics", "free_paid_metrics", "purchase_metrics"):
        files.write_report(reports.PUBLISHED[name](base), f"{folder}/{name}")
        one = contracts.reconciled(spark.read.parquet(f"{folder}/{name}"), name)
        out = one if out is None else out.unionAll(one)
    return out


def _keyed_sql(table_: str, key: str, prefix: str, *rules: str) -> str:
    counts = "".join(f", CAST(coalesce(sum(b{i}), 0) AS BIGINT) AS {prefix}_invalid_{i}" for i in range(len(rules)))
    inner = "".join(f", count(*) FILTER ({r}) AS b{i}" for i, r in enumerate(rules))
    return f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS {prefix}_rows{counts}, count(*) FILTER (n > 1) AS {prefix}_duplicates FROM (SELECT {key}, count(*) AS n{inner} FROM {table_} GROUP BY {key}))"


def _wrong(contract: contracts.Contract, row: DataFrame) -> DataFrame:
    return row.withColumn("wrong", F.array_join("wrong", "; "))


def _wrong_sql(contract: contracts.Contract) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{w.replace(chr(39), chr(39) * 2)}' END" for w, c in contract.broken.items()) + ") AS wrong"


@query(f"WITH {SQL_GAMES} SELECT *, {_wrong_sql(contracts.CLEAN_GAMES)} FROM (SELECT count(*) AS landed_rows FROM part), {_keyed_sql('game', 'appid', 'game', 'appid IS NULL')}")
def contract_games(spark, d):
    return _wrong(contracts.CLEAN_GAMES, contracts.CLEAN_GAMES.findings(landed.landed_games(spark, d), landed.games(spark, d)))


_VOTES = "(SELECT count(*) AS landed_rows, count(*) FILTER (voted_up) AS landed_for, count(*) FILTER (NOT voted_up) AS landed_against, count(*) FILTER (voted_up) AS labels_for, count(*) FILTER (NOT voted_up) AS labels_against FROM review)"
_BLANK = "recommendationid IS NULL OR trim(recommendationid) = ''"


@query(f"WITH {SQL_REVIEWS} SELECT *, {_wrong_sql(contracts.CLEAN_REVIEWS)} FROM {_VOTES}, {_keyed_sql('review', 'recommendationid', 'review', 'appid IS NULL', _BLANK, 'false')}")
def contract_reviews(spark, d):
    return _wrong(contracts.CLEAN_REVIEWS, contracts.CLEAN_REVIEWS.findings(landed.landed_reviews(spark, d), landed.reviews(spark, d)))


@query(f"""WITH {SQL_GOLD} SELECT *, {_wrong_sql(contracts.BASE)} FROM {_keyed_sql('game', 'appid', 'game', 'appid IS NULL')}, {_keyed_sql('review', 'recommendationid', 'review', _BLANK)}, {_keyed_sql('gold', 'recommendationid', 'base', _BLANK)},
(SELECT count(*) AS unmatched_reviews FROM review ANTI JOIN game USING (appid))""")
def contract_base(spark, d):
    return _wrong(contracts.BASE, contracts.BASE.findings(landed.reviews(spark, d), landed.games(spark, d), landed.gold(spark, d)))


@query(f"""WITH {SQL_GOLD}, h AS (SELECT * FROM gold WHERE NOT ({_LIVE})), l AS (SELECT * FROM gold WHERE {_LIVE}), ids AS (SELECT DISTINCT recommendationid FROM gold)
SELECT *, {_wrong_sql(contracts.CURRENT)} FROM {_keyed_sql('h', 'recommendationid', 'history', 'recommendationid IS NULL')}, {_keyed_sql('l', 'recommendationid', 'live', 'recommendationid IS NULL')}, {_keyed_sql('ids', 'recommendationid', 'current', 'recommendationid IS NULL')},
(SELECT count(*) AS overlap FROM (SELECT DISTINCT recommendationid FROM h) SEMI JOIN l USING (recommendationid))""")
def contract_current(spark, d):
    """The history and the live rows are one base; of ids on both sides the historical row stays."""
    old, new = landed.history(spark, d), landed.live(spark, d)
    current = snapshots.precedence_union(["recommendationid"], [old, new], [F.col("appid")])
    return _wrong(contracts.CURRENT, contracts.CURRENT.findings(old, new, current))


@query(f"WITH {SQL_GOLD} SELECT *, {_wrong_sql(contracts.TRAINABLE)} FROM (SELECT count(*) AS rows, count(DISTINCT recommendationid) AS ids, count(*) FILTER (recommendationid IS NULL) AS null_ids, count(*) FILTER (voted_up) AS positive, count(*) FILTER (NOT voted_up) AS negative, count(DISTINCT appid) AS games FROM gold)")
def contract_training(spark, d):
    return _wrong(contracts.TRAINABLE, contracts.TRAINABLE.findings(landed.gold(spark, d)))


# what clients ask for: history and live rows together; a live row whose id the history has is left out

_SERVED = f"{SQL_GOLD}, h AS (SELECT *, 'batch' AS side FROM gold WHERE NOT ({_LIVE})), served AS (SELECT * FROM h UNION ALL SELECT *, 'stream' FROM gold WHERE {_LIVE} AND recommendationid NOT IN (SELECT recommendationid FROM h))"
_SIDES = "count(*) FILTER (side = 'batch') AS batch_review_count, count(*) FILTER (side = 'stream') AS stream_review_count, CASE WHEN count(*) FILTER (side = 'stream') = 0 THEN 'batch' WHEN count(*) FILTER (side = 'batch') = 0 THEN 'streaming' ELSE 'batch_plus_streaming' END AS data_source"


def _serving(spark, d) -> Serving:
    return Serving(landed.history(spark, d), landed.live(spark, d))


@query(f"WITH {_SERVED} SELECT appid, max(game_name) AS game_name, {APPROVAL}, {_SIDES} FROM served GROUP BY appid")
def served_games(spark, d):
    return _serving(spark, d).games()


@query(f"WITH {_SERVED} SELECT appid, max(game_name) AS game_name, {APPROVAL}, {_SIDES} FROM served GROUP BY appid ORDER BY recommendation_rate DESC, review_count DESC, appid LIMIT 10")
def served_top_games(spark, d):
    return _serving(spark, d).top_games(10)


@query(f"WITH {_SERVED} SELECT genre, {APPROVAL}, {_SIDES} FROM (SELECT side, voted_up, unnest(CASE WHEN genres IS NULL THEN ['UNKNOWN'] ELSE genres END) AS genre FROM served) GROUP BY genre")
def served_genres(spark, d):
    return _serving(spark, d).genres()


@query(f"WITH {_SERVED} SELECT playtime_bucket, {APPROVAL}{_HOURS}, count(playtime_hours) AS playtime_observed_count, {_SIDES} FROM served GROUP BY playtime_bucket")
def served_playtime(spark, d):
    return _serving(spark, d).playtime()


@query(f"WITH {_SERVED} SELECT game_type, {APPROVAL}{_HOURS}, count(playtime_hours) AS playtime_observed_count, {_SIDES} FROM served GROUP BY game_type")
def served_free_paid(spark, d):
    return _serving(spark, d).free_paid()


@query(f"WITH {_SERVED} SELECT recommendationid, appid, timestamp_created, (SELECT count(*) FROM served WHERE side = 'stream') AS total FROM served WHERE side = 'stream' ORDER BY timestamp_created DESC, recommendationid DESC, appid LIMIT 20 OFFSET 20")
def served_reviews(spark, d):
    rows = _serving(spark, d).live
    page = ranking.page(rows, [F.desc("timestamp_created"), F.desc("recommendationid"), F.asc("appid")], 2, 20)
    return page.select("recommendationid", "appid", "timestamp_created", F.lit(rows.count()).alias("total"))


@query(f"WITH {_SERVED} SELECT appid, timestamp_created // 3600 * 3600 AS window_start, timestamp_created // 3600 * 3600 + 3600 AS window_end, max(game_name) AS game_name, {APPROVAL} FROM served WHERE side = 'stream' GROUP BY ALL")
def served_windows(spark, d):
    found = _serving(spark, d).windows()
    return found.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")})


@query(f"WITH {_SERVED} SELECT count(*) AS total_reviews, count(*) FILTER (side = 'batch') AS batch_reviews, count(*) FILTER (voted_up) AS positive_reviews, count(*) FILTER (NOT voted_up) AS negative_reviews, count(*) FILTER (voted_up) / count(*)::DOUBLE AS recommendation_rate FROM served")
def dashboard_totals(spark, d):
    return dashboard.totals(_serving(spark, d).games())


@query(f"{_by('appid, game_name')} ORDER BY recommendation_rate DESC, review_count DESC, game_name, appid LIMIT 10")
def dashboard_top_games(spark, d):
    return dashboard.top_by_name(reports.by_game(landed.gold(spark, d)))


@query(_list_sql("genres", "genre") + " ORDER BY recommendation_rate DESC, genre LIMIT 7")
def dashboard_genres(spark, d):
    return dashboard.leading_genres(reports.by_genre(landed.gold(spark, d)))


@query(f"WITH {SQL_GOLD} SELECT playtime_bucket, count(*) AS review_count, CASE playtime_bucket WHEN '0-2h' THEN 0 WHEN '2-10h' THEN 1 WHEN '10-50h' THEN 2 WHEN '50h+' THEN 3 ELSE 4 END AS place, coalesce(playtime_bucket, 'MISSING') AS bucket_label FROM gold GROUP BY playtime_bucket")
def dashboard_playtime(spark, d):
    return dashboard.rarest_playtime_first(dashboard.playtime_in_order(reports.by_playtime(landed.gold(spark, d)))).select("playtime_bucket", "review_count", "place", "bucket_label")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN nullif(trim(c_mktsegment), '') END, n_name, 'Unknown game') AS game_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def names_with_fallback(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("appid"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("game_name"))
    names = table(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("appid"), F.col("n_name").alias("game_name"))
    return dashboard.named_reviews(rows, names).select("c_custkey", "game_name")


@query("SELECT p_partkey AS appid, p_name AS game_name FROM part WHERE lower(p_name || ' ' || p_partkey) LIKE '%t 1%'")
def game_search(spark, d):
    return dashboard.search(table(spark, d, "part").select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("game_name")), "T 1")


# event streams

_EVENT = """SELECT l_orderkey AS "offset", l_suppkey, CASE WHEN l_linenumber <> 3 OR l_suppkey % 4 <> 0 THEN 1 END AS id, l_suppkey % 11 = 0 AS other, CASE WHEN l_suppkey % 13 = 0 THEN -1 WHEN l_suppkey % 17 = 0 THEN 99999999 ELSE l_partkey END AS appid, l_suppkey % 23 = 0 AS bare,
 l_orderkey || '-' || l_linenumber AS recommendationid, l_partkey, CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 600 AS created, l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linenumber % 2 = 0) AS voted_up FROM lineitem"""
_REASONS = """concat_ws(';', CASE WHEN id IS NULL THEN 'MISSING_EVENT_ID' END, CASE WHEN other THEN 'UNSUPPORTED_EVENT_TYPE' END, CASE WHEN appid <= 0 THEN 'INVALID_APPID' END, CASE WHEN l_suppkey % 19 = 0 THEN 'INVALID_EVENT_TIME' END, CASE WHEN l_suppkey % 7 = 0 THEN 'MISSING_PRODUCED_AT' END,
 CASE WHEN bare THEN 'MISSING_PAYLOAD' END, CASE WHEN bare THEN 'INVALID_RECOMMENDATIONID' END, CASE WHEN bare THEN 'MISSING_TIMESTAMP_CREATED' END, CASE WHEN bare THEN 'MISSING_VOTED_UP' END, CASE WHEN appid NOT IN (SELECT p_partkey FROM part) THEN 'UNKNOWN_APPID' END)"""


@query(f"SELECT error_reason, count(*) AS events, sum(\"offset\")::BIGINT AS offsets FROM (SELECT *, {_REASONS} AS error_reason FROM ({_EVENT})) GROUP BY error_reason")
def review_event_reasons(spark, d):
    found = ev.review_events(landed.review_log(spark, d), landed.games(spark, d))
    return found.groupBy("error_reason").agg(F.count("*").alias("events"), F.sum("offset").alias("offsets"))


@query(f"SELECT CASE WHEN reason = '' THEN 'archive' ELSE 'quarantine' END AS sink, CASE WHEN reason = '' THEN NULL ELSE reason END AS error_reason, count(*) AS rows FROM (SELECT {_REASONS} AS reason FROM ({_EVENT})) WHERE reason <> '' GROUP BY ALL UNION ALL SELECT 'archive', NULL, count(*) FROM lineitem")
def review_archive(spark, d):
    found = ev.review_events(landed.review_log(spark, d), landed.games(spark, d))
    kept = ev.archive(found).select(F.lit("archive").alias("sink"), F.lit(None).cast("string").alias("error_reason"))
    return kept.unionAll(ev.quarantine(found).select(F.lit("quarantine").alias("sink"), "error_reason")).groupBy("sink", "error_reason").agg(F.count("*").alias("rows"))


_PLAYER = """SELECT event_id, user_id + 1 AS user, CASE WHEN event_id % 29 = 0 THEN 'MISSING_EVENT_ID' WHEN event_type = 'error' OR event_id % 31 = 0 THEN 'UNSUPPORTED_EVENT_TYPE' WHEN event_id % 37 = 0 THEN 'UNSUPPORTED_SCHEMA_VERSION' WHEN event_id % 41 = 0 THEN 'INVALID_APPID'
 WHEN event_id % 43 = 0 OR user_id + 1 NOT IN (SELECT p_partkey FROM part) THEN 'UNKNOWN_APPID' WHEN event_id % 59 = 0 THEN 'INVALID_PLAYER_COUNT' WHEN event_id % 47 = 0 THEN 'INVALID_EVENT_TIME' WHEN event_id % 53 = 0 THEN 'INVALID_PRODUCED_AT' WHEN event_id % 61 = 0 THEN 'KAFKA_KEY_APPID_MISMATCH' ELSE '' END AS error_reason,
 floor(value * 100)::BIGINT AS player_count, date_trunc('second', ts) AS ts FROM events"""


@query(f"SELECT error_reason, count(*) AS events, sum(event_id)::BIGINT AS offsets FROM ({_PLAYER}) GROUP BY error_reason")
def player_event_reasons(spark, d):
    found = ev.player_events(landed.player_log(spark, d), landed.games(spark, d))
    return found.groupBy("error_reason").agg(F.count("*").alias("events"), F.sum("offset").alias("offsets"))


@query(f"SELECT 'p' || event_id AS event_id, user AS appid, p_name AS game_name, player_count, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS observed_hour FROM ({_PLAYER}) JOIN part ON user = p_partkey WHERE error_reason = ''")
def player_counts(spark, d):
    games = landed.games(spark, d)
    found = ev.player_gold(ev.player_silver(ev.player_events(landed.player_log(spark, d), games)), games)
    return found.select("event_id", "appid", "game_name", "player_count", F.unix_seconds("observed_hour").alias("observed_hour"))


@query(f"SELECT appid, event_id, player_count, observed_micros FROM (SELECT user AS appid, 'p' || event_id AS event_id, player_count, epoch_us(ts) AS observed_micros, row_number() OVER (PARTITION BY user ORDER BY ts DESC, 'p' || event_id DESC) AS n FROM ({_PLAYER}) WHERE error_reason = '') WHERE n = 1")
def latest_player_counts(spark, d):
    silver = ev.player_silver(ev.player_events(landed.player_log(spark, d), landed.games(spark, d)))
    return ev.latest_players(silver).select("appid", "event_id", "player_count", "observed_micros")


#: Messages a file of a log: a trigger takes ten files, and what it shuffles lies on disk.
_MESSAGES = 1_000_000


def _landed_stream(spark, log: DataFrame) -> tuple[DataFrame, str]:
    """The log as a stream of files, and the folder they are in."""
    folder = new_folder(spark, "log")
    log.write.option("compression", "zstd").option("maxRecordsPerFile", _MESSAGES).parquet(folder)
    return logs.read_landed_log(spark, folder), folder


_VALID = f"SELECT * FROM ({_EVENT}) WHERE {_REASONS} = ''"
#: Valid reviews once each; of repeated ids any, so only what doesn't depend on which is compared.
_IDS = f"SELECT DISTINCT recommendationid FROM ({_VALID})"


@query(f"SELECT 'archive' AS \"table\", count(*) AS rows FROM lineitem UNION ALL SELECT 'quarantine', count(*) FROM ({_EVENT}) WHERE {_REASONS} <> '' UNION ALL SELECT 'reviews', count(*) FROM ({_IDS}) UNION ALL SELECT 'base', count(*) FROM ({_IDS}) UNION ALL SELECT 'recent', count(*) FROM ({_IDS})")
def review_stream(spark, d):
    """The whole review stream, from messages to what is served."""
    paths = wiring.Paths(new_folder(spark, "stream"), new_folder(spark, "state"))
    games = staged_table(spark, landed.games(spark, d), "games")  # parsed once, not in each trigger
    known = spark.createDataFrame([], "recommendationid string")
    log, folder = _landed_stream(spark, landed.review_log(spark, d))
    wiring.Reviews(paths, games, known, delay="4000 days").run(spark, log, lambda: drop_folder(spark, folder))
    plain = {n: spark.read.parquet(paths.table(n)) for n in ("archive", "quarantine", "reviews", "base")} | {"recent": ev.newest(spark, paths.table("recent"))}
    counted = [f.agg(F.lit(n).alias("table"), F.count("*").alias("rows")) for n, f in plain.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionAll(c)
    return out


@query(f"SELECT user AS appid, 'p' || event_id AS event_id, player_count FROM (SELECT *, row_number() OVER (PARTITION BY user ORDER BY ts DESC, 'p' || event_id DESC) AS n FROM ({_PLAYER}) WHERE error_reason = '') WHERE n = 1")
def player_stream(spark, d):
    paths = wiring.Paths(new_folder(spark, "stream"), new_folder(spark, "state"))
    wiring.Players(paths, landed.games(spark, d), "4000 days").run(spark, _landed_stream(spark, landed.player_log(spark, d))[0])
    return wiring.latest_table(spark, paths.table("player_latest")).select("appid", "event_id", "player_count")


@query(f"""WITH {SQL_GOLD} SELECT appid + 1 AS appid, timestamp_created // 3600 * 3600 AS window_start, count(*) AS review_count, count(*) FILTER (voted_up) AS positive_reviews, count(*) FILTER (voted_up) / count(*)::DOUBLE AS recommendation_rate,
appid + 1 || ':' || strftime(make_timestamp(timestamp_created // 3600 * 3600000000), '%Y-%m-%dT%H:%M:%SZ') || ':' || strftime(make_timestamp((timestamp_created // 3600 + 1) * 3600000000), '%Y-%m-%dT%H:%M:%SZ') AS _id FROM gold GROUP BY appid, timestamp_created // 3600""")
def stream_windows(spark, d):
    """Hourly counts as a stream updates them: each trigger gives the windows it changed, which replace what was there. Ids start at 1 there."""
    folder, base = new_folder(spark, "live"), landed.gold(spark, d).withColumn("appid", F.col("appid") + 1)
    base.repartition(4).write.parquet(f"{folder}/in")
    live = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    write = ev.upsert_once(f"{folder}/out", ["appid", "window_start"], ["review_count"])
    documents = lambda batch, n: write(contracts.require_documents(contracts.window_documents(batch)), n)
    ev.batch_sink(reports.window_metrics(live, "4000 days"), documents, f"{folder}/state", "update").awaitTermination()
    return ev.newest(spark, f"{folder}/out").select("appid", F.unix_seconds("window_start").alias("window_start"), "review_count", "positive_reviews", "recommendation_rate", "_id")


@query(f"WITH {SQL_GOLD} SELECT DISTINCT recommendationid FROM gold")
def stream_append_once(spark, d):
    """The base appended twice: each id comes in once."""
    folder, rows = new_folder(spark, "append"), landed.gold(spark, d).select("recommendationid", "appid")
    rows.write.parquet(f"{folder}/in")
    for state in ("a", "b"):
        live = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        ev.batch_sink(live, ev.append_once(f"{folder}/out", "recommendationid"), f"{folder}/{state}").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("recommendationid")


@query(f"""WITH {SQL_GOLD} SELECT recommendationid, appid, voted_up, playtime_bucket, playtime_hours, game_type, timestamp_created FROM gold""")
def recent_rows(spark, d):
    """What is served of a review, with bucket and hours derived from minutes."""
    rows = wiring.recent_reviews(landed.gold(spark, d).drop("playtime_hours", "playtime_bucket"))
    return rows.select("recommendationid", "appid", "voted_up", "playtime_bucket", "playtime_hours", "game_type", F.unix_seconds("timestamp_created").alias("timestamp_created"))


@query("SELECT l_orderkey || '-' || l_linenumber AS recommendationid, min(l_partkey) AS appid FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25)) > 0")
def outbox_events(spark, d):
    """New records of games whose first poll is done. A record's id tells its event's id."""
    polled = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("recommendationid"), F.col("l_partkey").alias("appid"))
    started = table(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("appid"))
    seen = polled.limit(0)
    _, events = outbox.split_poll(polled, seen, started)
    every = polled.groupBy("recommendationid").agg(F.min("appid").alias("appid"))
    return every.join(events.select("recommendationid"), "recommendationid", "left_semi")


_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S+00:00')"


@query(f"WITH {SQL_REVIEWS} SELECT 'REVIEW_CREATED:' || appid || ':' || recommendationid AS event_id, {_ISO.format('make_timestamp(timestamp_created * 1000000)')} AS event_time, votes_up, CASE WHEN appid <= 0 THEN 'appid must be positive' ELSE '' END AS unfit FROM review")
def review_envelopes(spark, d):
    found = contract.review_envelopes(landed.landed_reviews(spark, d), "2024-01-01T00:00:00+00:00")
    return found.select("event_id", "event_time", F.col("payload.votes_up").alias("votes_up"), "unfit")


@query(f"SELECT 'PLAYER_COUNT_SNAPSHOT:' || user_id || CASE WHEN event_id % 5 <> 0 THEN ':' || moment ELSE '' END AS event_id, CASE WHEN event_id % 5 <> 0 THEN moment END AS event_time, concat_ws(';', CASE WHEN user_id <= 0 THEN 'appid must be positive' END, CASE WHEN event_id % 7 = 0 THEN 'player_count must not be negative' END, CASE WHEN event_id % 5 = 0 THEN 'observed_at must have a zone' END) AS unfit FROM (SELECT *, {_ISO.format('ts - INTERVAL 2 HOURS')} AS moment FROM events)")
def player_envelopes(spark, d):
    """Counts observed in a zone two hours ahead; some without a zone, some negative."""
    local = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 5 == 0, "").otherwise("+02:00"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("appid"), F.when(F.col("event_id") % 7 == 0, -1).otherwise(1).alias("player_count"), local.alias("observed_at"), F.lit("2024-01-01T00:00:00Z").alias("produced_at"))
    return contract.player_envelopes(rows).select("event_id", "event_time", "unfit")


# the control plane

_TODAY = "2022-06-30"
_CANDIDATE = "SELECT p_partkey AS appid, CASE WHEN p_size % 10 = 0 THEN 'dlc' ELSE 'game' END AS app_type, release_date, p_size * 30 AS total_reviews, p_size % 7 <> 0 AS metadata_available, CASE WHEN p_size % 9 <> 0 THEN true END AS review_endpoint_available FROM part JOIN game ON appid = p_partkey"
_RELEASED = "coalesce(try_strptime(release_date, '%Y-%m-%d'), try_strptime(release_date, '%d %b, %Y'), try_strptime(release_date, '%b %d, %Y'))::DATE"
_FAILED = f"""concat_ws(';', CASE WHEN app_type <> 'game' THEN 'INVALID_APP_TYPE' END, CASE WHEN {_RELEASED} IS NULL THEN 'INVALID_RELEASE_DATE' END, CASE WHEN date_diff('day', {_RELEASED}, DATE '{_TODAY}') < 300 THEN 'GAME_TOO_NEW' END, CASE WHEN total_reviews < 500 THEN 'INSUFFICIENT_REVIEWS' END,
 CASE WHEN NOT metadata_available THEN 'METADATA_UNAVAILABLE' END, CASE WHEN review_endpoint_available IS NULL THEN 'REVIEW_ENDPOINT_UNAVAILABLE' END)"""


def _qualified(spark, d) -> DataFrame:
    games = landed.games(spark, d).select("appid", "release_date")
    sizes = table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("appid"), F.expr("CASE WHEN p_size % 10 = 0 THEN 'dlc' ELSE 'game' END").alias("app_type"), (F.col("p_size") * 30).alias("total_reviews"), (F.col("p_size") % 7 != 0).alias("metadata_available"), F.expr("CASE WHEN p_size % 9 <> 0 THEN true END").alias("review_endpoint_available"))
    return lifecycle.qualify(games.join(sizes, "appid"), lifecycle.Policy(min_release_age_days=300, min_total_reviews=500), _TODAY)


@query(f"WITH {SQL_GAMES} SELECT appid, {_FAILED} AS rules, {_FAILED} = '' AS qualified, date_diff('day', {_RELEASED}, DATE '{_TODAY}')::INTEGER AS release_age_days FROM ({_CANDIDATE})")
def qualification(spark, d):
    return _qualified(spark, d).select("appid", F.array_join("reasons.rule", ";").alias("rules"), "qualified", "release_age_days")


@query(f"WITH {SQL_GAMES} SELECT rule, count(*) AS games FROM (SELECT unnest(string_split({_FAILED}, ';')) AS rule FROM ({_CANDIDATE})) WHERE rule <> '' GROUP BY rule")
def qualification_counts(spark, d):
    return lifecycle.rejection_counts(_qualified(spark, d))


_STATE = "CASE WHEN p_size < 10 THEN 'ACTIVE' WHEN p_size < 20 THEN 'NEW' WHEN p_size < 30 THEN 'REJECTED' END"
_AFTER = f"SELECT appid, CASE WHEN state IS NULL THEN CASE WHEN good THEN 'QUALIFIED' ELSE 'REJECTED' END WHEN state IN ('NEW', 'REJECTED') AND good THEN 'QUALIFIED' ELSE state END AS state FROM (SELECT c.appid, {_FAILED} = '' AS good, {_STATE} AS state FROM ({_CANDIDATE}) c JOIN part ON p_partkey = c.appid)"


def _registry(spark, d) -> DataFrame:
    old = table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("appid"), F.expr(_STATE).alias("state")).where("state IS NOT NULL")
    return lifecycle.reconcile(old, _qualified(spark, d).select("appid", "qualified"))


@query(f"WITH {SQL_GAMES} {_AFTER}")
def registry_after_run(spark, d):
    return _registry(spark, d)


@query(f"WITH {SQL_GAMES}, r AS ({_AFTER}), c AS (SELECT {', '.join(f"count(*) FILTER (state = '{s}') AS {s.lower()}" for s in lifecycle.STATES)} FROM r) SELECT *, greatest(0, least(50, 1000 - active - onboarding - queued))::BIGINT AS capacity FROM c")
def registry_capacity(spark, d):
    return lifecycle.capacity(_registry(spark, d), 1000, 50).withColumn("capacity", F.col("capacity").cast("long"))


@query(f"WITH {SQL_GAMES}, r AS ({_AFTER}) SELECT appid, CASE WHEN n <= 25 THEN 'QUEUED' ELSE 'DEFERRED' END AS action FROM (SELECT appid, row_number() OVER (ORDER BY appid) AS n FROM r WHERE state = 'QUALIFIED')")
def registry_plan(spark, d):
    return lifecycle.onboarding_plan(_registry(spark, d), 25)


@query("SELECT p_partkey AS appid, CASE WHEN p_size % 13 = 0 THEN 'METADATA_FAILED' WHEN p_size % 10 = 0 THEN 'NOT_A_GAME' WHEN p_size % 25 = 0 THEN 'COMING_SOON' END AS excluded FROM part")
def eligibility(spark, d):
    return catalog.eligibility(landed.landed_games(spark, d)).select("appid", "excluded")


@query(f"WITH {SQL_GAMES} SELECT appid, CAST({_RELEASED} AS VARCHAR) AS released FROM game")
def release_dates(spark, d):
    return landed.games(spark, d).select("appid", lifecycle.release_date(F.col("release_date")).cast("string").alias("released"))


@query("""SELECT page_id, place::INTEGER AS place, regexp_extract(a, 'href="([^"]*)"', 1) AS target, trim(regexp_replace(a, '<[^>]*>', '', 'g')) AS label FROM (SELECT page_id, unnest(l) AS a, generate_subscripts(l, 1) - 1 AS place FROM (SELECT page_id, regexp_extract_all(html, '<a\\b[^>]*href="[^"]*"[^>]*>(?:.|\\n)*?</a>') AS l FROM pages))""")
def page_links(spark, d):
    return catalog.links(table(spark, d, "pages"), "page_id").withColumn("target", F.coalesce("target", F.lit("")))


_RESULT = """'<a href="x" class="search_result_row ds" data-ds-appid="' || CASE WHEN p_size % 5 = 0 THEN 'none' ELSE CAST(p_partkey % 500 AS {text}) END || '"><span class="title">' || p_name || ' &amp; <b>co</b></span><div class="col search_released">' || p_brand || '</div>' || CASE WHEN p_size % 3 = 0 THEN '<span class="search_review_summary positive" data-tooltip-html="' || p_type || '"></span>' ELSE '' END || '</a>'"""


@query("SELECT (p_partkey % 500)::INTEGER AS appid, p_name || ' & co' AS title, p_brand AS search_release_text, CASE WHEN p_size % 3 = 0 THEN p_type END AS search_review_summary, p_partkey AS catalog_start FROM part WHERE p_size % 5 <> 0")
def catalog_results(spark, d):
    pages = table(spark, d, "part").select(F.expr(f"'<div>' || {_RESULT.format(text='STRING')} || '</div>'").alias("html"), F.col("p_partkey").alias("start"))
    return catalog.search_results(pages)


@query("SELECT appid, arg_min(title, s) AS title FROM (SELECT (p_partkey % 500)::INTEGER AS appid, p_name || ' & co' AS title, p_partkey AS s FROM part WHERE p_size % 5 <> 0) WHERE appid NOT IN (SELECT s_suppkey FROM supplier) GROUP BY appid")
def catalog_candidates(spark, d):
    return catalog.candidates(catalog_results(spark, d), table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("appid"))).select("appid", "title")


_FOUND = """
WITH games AS (SELECT p_partkey AS appid FROM part WHERE p_size <> 7), meta AS (SELECT p_partkey AS appid, p_size % 13 <> 0 AS success, CASE WHEN p_size % 11 <> 0 THEN p_name END AS name FROM part WHERE p_size <> 8),
rev AS (SELECT l_partkey AS file_appid, CASE WHEN l_suppkey % 20 = 0 THEN -1 ELSE l_partkey END AS appid, CASE WHEN l_suppkey % 21 <> 0 THEN l_orderkey || '-' || l_linenumber END AS recommendationid, CASE WHEN l_suppkey % 22 <> 0 THEN 'english' END AS language, CASE WHEN l_suppkey % 23 <> 0 THEN l_returnflag = 'R' END AS voted_up FROM lineitem),
known AS (SELECT * FROM rev WHERE recommendationid IS NOT NULL), per_id AS (SELECT recommendationid, count(*) AS n, count(DISTINCT file_appid) AS files FROM known GROUP BY 1), per_file AS (SELECT file_appid, count(DISTINCT recommendationid) AS n FROM known GROUP BY 1)
SELECT rule, count(*) AS items FROM (
SELECT 'metadata that failed' AS rule FROM meta WHERE NOT success UNION ALL SELECT 'metadata without a name' FROM meta WHERE name IS NULL UNION ALL SELECT 'missing metadata' FROM games ANTI JOIN meta USING (appid) UNION ALL SELECT 'unexpected metadata' FROM meta ANTI JOIN games USING (appid)
UNION ALL SELECT 'missing review file' FROM games WHERE appid NOT IN (SELECT file_appid FROM rev) UNION ALL SELECT 'unexpected review file' FROM (SELECT DISTINCT file_appid FROM rev) WHERE file_appid NOT IN (SELECT appid FROM games)
UNION ALL SELECT 'review in another game''s file' FROM rev WHERE appid <> file_appid UNION ALL SELECT 'review without an id' FROM rev WHERE recommendationid IS NULL UNION ALL SELECT 'repeated review' FROM per_id WHERE n > files UNION ALL SELECT 'review of several games' FROM per_id WHERE files > 1
UNION ALL SELECT 'review that isn''t English' FROM known WHERE language IS NULL UNION ALL SELECT 'review without an opinion' FROM known WHERE voted_up IS NULL
UNION ALL SELECT 'review that is published' FROM (SELECT DISTINCT recommendationid FROM known WHERE recommendationid LIKE '1%')
UNION ALL SELECT 'wrong number of reviews' FROM games LEFT JOIN per_file ON appid = file_appid WHERE coalesce(n, 0) <> 30) GROUP BY rule"""


@query(_FOUND)
def staged_batch(spark, d):
    part, lines = table(spark, d, "part"), table(spark, d, "lineitem")
    games = part.where("p_size <> 7").select(F.col("p_partkey").alias("appid"))
    meta = part.where("p_size <> 8").selectExpr("p_partkey AS appid", "p_size % 13 <> 0 AS success", "CASE WHEN p_size % 11 <> 0 THEN p_name END AS name")
    rev = lines.selectExpr("l_partkey AS file_appid", "CASE WHEN l_suppkey % 20 = 0 THEN -1 ELSE l_partkey END AS appid", "CASE WHEN l_suppkey % 21 <> 0 THEN l_orderkey || '-' || l_linenumber END AS recommendationid", "CASE WHEN l_suppkey % 22 <> 0 THEN 'english' END AS language", "CASE WHEN l_suppkey % 23 <> 0 THEN l_returnflag = 'R' END AS voted_up")
    baseline = rev.where("recommendationid LIKE '1%'").select("recommendationid")
    return staged.findings(games, meta, rev, baseline, 30).groupBy("rule").agg(F.count("*").alias("items"))


@query("SELECT o_custkey AS appid FROM (SELECT DISTINCT o_custkey FROM orders) SEMI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey")
def key_collisions(spark, d):
    manifest = table(spark, d, "orders").select(F.col("o_custkey").alias("appid")).distinct()
    return staged.collisions(manifest, table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("appid")))


@query("SELECT 'no lines' AS kind, o_orderkey AS appid FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'lines of another', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def evidence_gaps(spark, d):
    return staged.evidence_gaps(table(spark, d, "orders").select(F.col("o_orderkey").alias("appid")), {"lines": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("appid"))})


@query(f"""WITH {SQL_GAMES}, c AS (SELECT o_custkey AS appid, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'dlc' ELSE 'game' END AS app_type, '2020-01-01' AS release_date, CAST(floor(o_totalprice / 100) AS BIGINT) AS total_reviews FROM orders)
SELECT outcome, count(*) AS candidates, CAST(sum(repeats) AS BIGINT) AS repeats FROM (SELECT CASE WHEN arg_min(app_type, o_orderkey) = 'game' AND arg_min(total_reviews, o_orderkey) >= 500 THEN 'QUALIFIED' ELSE 'REJECTED' END AS outcome, count(*) - 1 AS repeats FROM c WHERE appid > 0 GROUP BY appid UNION ALL SELECT 'FAILED', 0 FROM c WHERE appid <= 0) GROUP BY outcome""")
def candidate_outcomes(spark, d):
    """Orders as candidates, the first of a customer's counts; customer 0 has no valid id."""
    rows = table(spark, d, "orders").selectExpr("o_custkey AS appid", "o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN 'dlc' ELSE 'game' END AS app_type", "'2020-01-01' AS release_date", "CAST(floor(o_totalprice / 100) AS BIGINT) AS total_reviews", "true AS metadata_available", "true AS review_endpoint_available")
    found = lifecycle.partitioned(rows, lifecycle.Policy(), _TODAY, "o_orderkey")
    return found.groupBy("outcome").agg(F.count("*").alias("candidates"), F.sum("repeats").alias("repeats"))


@query("SELECT p_partkey AS appid, coalesce(s_name, p_name) AS name, 2000 AS target_reviews FROM part LEFT JOIN supplier ON s_suppkey = p_partkey WHERE p_size < 20")
def queue_of_registry(spark, d):
    registry = table(spark, d, "part").select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"), F.when(F.col("p_size") < 20, "QUEUED").otherwise("ACTIVE").alias("state"))
    return lifecycle.queue_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("appid"), F.col("s_name").alias("name")), registry, 2000)


@query("SELECT 'first' AS run, 0::BIGINT AS matched, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'O') AS upserted, 0::BIGINT AS deleted UNION ALL SELECT 'second', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'), (SELECT count(*) FROM orders WHERE o_orderstatus = 'O'), (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')")
def replaced_snapshot(spark, d):
    """Two snapshots one after the other in the same place, and what each did to the keys."""
    path, orders = new_folder(spark, "snapshot"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    runs = (("first", orders.where("o_orderstatus <> 'O'")), ("second", orders.where("o_orderstatus <> 'F'")))
    done = [(name, *snapshots.replace_snapshot(spark, path, rows, ["o_orderkey"]).values()) for name, rows in runs]
    return spark.createDataFrame(done, "run string, matched long, upserted long, deleted long")


@query("SELECT count(*) AS reviews, count(DISTINCT l_partkey) AS games, CAST(sum(l_linenumber) AS BIGINT) AS votes_up, count(*) AS keyed FROM lineitem")
def landed_files(spark, d):
    """Reviews landed as JSON lines, a folder of files a game, read back by the schema; the path tells the game as well."""
    folder = new_folder(spark, "landed")
    rows = landed.landed_reviews(spark, d)
    rows.select((F.col("appid") % 8).alias("shelf"), F.to_json(F.struct(*rows.columns)).alias("value")).write.partitionBy("shelf").text(folder)
    found = files.with_key_from_path(files.read_reviews(spark, folder), r"shelf=(\d+)/", "shelf_of_path")
    return found.agg(F.count("*").alias("reviews"), F.count_distinct("appid").alias("games"), F.sum("review.votes_up").cast("long").alias("votes_up"), F.count_if(F.col("shelf_of_path") == F.col("appid") % 8).alias("keyed"))


# learning

_LOG1P = "CASE WHEN {0} >= 0 THEN ln(1 + {0}) END"


@query(f"""WITH {SQL_GOLD} SELECT recommendationid, CAST(voted_up AS INTEGER)::DOUBLE AS label, {_LOG1P.format('playtime_at_review')} AS log1p_playtime_at_review, CAST(steam_purchase AS INTEGER)::DOUBLE AS steam_purchase_numeric, CAST(received_for_free AS INTEGER)::DOUBLE AS received_for_free_numeric, CAST(is_free AS INTEGER)::DOUBLE AS is_free_numeric,
{_LOG1P.format('price')} AS log1p_price, 1.0::DOUBLE AS platform_windows_numeric, CAST(mac AS INTEGER)::DOUBLE AS platform_mac_numeric, CAST(linux AS INTEGER)::DOUBLE AS platform_linux_numeric, array_to_string(list_sort(list_distinct(coalesce(genres, []))), '|') AS genres_tokens,
(playtime_at_review IS NULL)::INTEGER::DOUBLE AS playtime_missing, (price IS NULL)::INTEGER::DOUBLE AS price_missing, (is_free IS NULL)::INTEGER::DOUBLE AS is_free_missing FROM gold""")
def feature_rows(spark, d):
    rows = learning.features(landed.gold(spark, d), label=True)
    return rows.select("recommendationid", "label", *learning.NUMERIC, F.array_join("genres_tokens", "|").alias("genres_tokens"), F.col("log1p_playtime_at_review_missing").alias("playtime_missing"), F.col("log1p_price_missing").alias("price_missing"), F.col("is_free_numeric_missing").alias("is_free_missing"))


@query("SELECT attribute, importance / sum(importance) OVER () AS importance FROM (SELECT CASE WHEN p_size % 2 = 0 THEN 'genre' ELSE 'price' END AS attribute, sum(p_retailprice) AS importance FROM part GROUP BY 1)")
def attribute_importance(spark, d):
    rows = table(spark, d, "part").select(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("genre="), "p_name")).otherwise("price").alias("feature"), F.col("p_retailprice").alias("importance"))
    return learning.grouped_importance(rows)


@query("SELECT 'linestatus' AS attribute, CAST(avg(CASE WHEN l_linestatus = 'F' THEN 0.2 ELSE 0.1 END) AS DOUBLE) AS share FROM lineitem UNION ALL SELECT 'returnflag', CAST(avg(CASE WHEN l_returnflag = 'R' THEN 0.3 ELSE 0 END) AS DOUBLE) FROM lineitem")
def exact_attribution(spark, d):
    """Of a chance that adds up over two attributes, each one's exact share is what it adds."""
    adds = table(spark, d, "lineitem").agg(F.avg(F.when(F.col("l_linestatus") == "F", 0.2).otherwise(0.1)).alias("linestatus"), F.avg(F.when(F.col("l_returnflag") == "R", 0.3).otherwise(0.0)).alias("returnflag")).first()
    chances = [0.1 + (m & 1) * adds["linestatus"] + (m >> 1) * adds["returnflag"] for m in range(4)]
    return spark.createDataFrame(learning.shapley(chances, ["linestatus", "returnflag"]), "attribute string, share double")


@query("SELECT c_custkey, m.coalition::INTEGER AS coalition, CASE WHEN m.coalition & 1 = 1 THEN c_acctbal ELSE 0 END AS c_acctbal, CASE WHEN m.coalition & 2 = 2 THEN c_mktsegment ELSE 'NONE' END AS c_mktsegment FROM customer, (SELECT unnest(range(4)) AS coalition) m")
def attribute_coalitions(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return learning.coalitions(rows, {"c_acctbal": 0.0, "c_mktsegment": "NONE"}, ["c_acctbal", "c_mktsegment"])


@query("SELECT sum(n)::BIGINT AS rows, 0::BIGINT AS shared, sum(floor(n * 0.8))::BIGINT AS train_rows FROM (SELECT count(*) AS n FROM events GROUP BY event_type)")
def split_overlap(spark, d):
    """Train and test share no row and leave none out."""
    train, test = learning.split(table(spark, d, "events").select("event_id", F.col("event_type").alias("label")), "event_id")
    sides = train.select("event_id", F.lit(1).alias("t")).unionAll(test.select("event_id", F.lit(0).alias("t")))
    per_id = sides.groupBy("event_id").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    return per_id.agg(F.count("*").alias("rows"), F.count_if(F.col("n") > 1).alias("shared"), F.sum("t").alias("train_rows"))


# files

@query("SELECT l_partkey::INTEGER AS appid, count(*) AS review_count, count(*) FILTER (l_returnflag = 'R') AS positive_reviews, count(*) FILTER (l_returnflag <> 'R') AS negative_reviews, round(count(*) FILTER (l_returnflag = 'R') / count(*)::DOUBLE, 12) AS recommendation_rate FROM lineitem GROUP BY l_partkey")
def tsv_round_trip(spark, d):
    """A report as tab-separated text with twelve decimals, read again by its schema."""
    from opinera.plans.queries import rate_by_part

    folder = new_folder(spark, "tsv")
    files.write_metrics_tsv(rate_by_part(spark, d).withColumnRenamed("l_partkey", "appid"), folder)
    return files.read_metrics_tsv(spark, folder)


@query("SELECT count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events UNION ALL SELECT count(*), 0 FROM events WHERE event_id % 10 = 3")
def jsonl_with_rejects(spark, d):
    """JSON lines of which every tenth is broken: what reads, and what doesn't."""
    folder = new_folder(spark, "jsonl")
    rows = table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("value"))
    lines = rows.select(F.col("value")).unionAll(rows.where("event_id % 10 = 3").select(F.substring("value", 1, 12)))
    lines.write.text(folder)
    good, bad = files.read_jsonl_with_rejects(spark, folder, "event_id long, event_type string")
    return good.agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids")).unionAll(bad.agg(F.count("*").alias("rows"), F.lit(0).cast("long").alias("ids")))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def partitions_by_pattern(spark, d):
    """Two partitions of a table by a pattern, with their column; a pattern without any gives no rows."""
    folder = new_folder(spark, "parts")
    table(spark, d, "events").select("event_id", "event_type").write.partitionBy("event_type").parquet(folder)
    schema = "event_id long, event_type string"
    return logs.read_partitions(spark, folder, schema, "event_type={click,view}").unionByName(logs.read_partitions(spark, folder, schema, "event_type=none*"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = 1997")
def clustered_lookup(spark, d):
    """A table in ranges of its key: a lookup reads the row groups whose range has it."""
    folder = new_folder(spark, "clustered")
    logs.write_clustered(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), folder, ["o_orderdate", "o_orderkey"], 4)
    return spark.read.parquet(folder).where("o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-01'").select("o_orderkey", "o_custkey")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_upsert(spark, d):
    """Old and new rows in any order: the later one stays."""
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    return snapshots.upsert_latest(rows.where(F.col("ts") >= half), rows.where(F.col("ts") < half), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([CASE WHEN x = '' THEN 'UNKNOWN' ELSE x END FOR x IN string_split(p_name, ' ')])), '|') AS members FROM part")
def member_lists(spark, d):
    words = F.transform(F.split("p_name", " "), lambda w: F.nullif(w, F.lit("")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(members(words)), "|").alias("members"))


@query("SELECT count(*) AS rows, count(*) FILTER (o_totalprice > 300000) AS rule_0, count(*) FILTER (o_orderstatus <> 'F' AND o_orderpriority LIKE '1%') AS rule_1, count(DISTINCT o_orderkey) AS keys, 0::BIGINT AS duplicate_keys FROM orders")
def rule_profile(spark, d):
    rules = [quality.outside("o_totalprice", 0, 300000), quality.Rule("urgent and open", lambda: (F.col("o_orderstatus") != "F") & F.col("o_orderpriority").startswith("1"))]
    return quality.profile(table(spark, d, "orders"), rules, ["o_orderkey"])
