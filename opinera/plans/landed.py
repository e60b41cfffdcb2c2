"""Game and review records in their landed shape, made from the driver's tables, and the SQL that says what cleaning makes of them.

A part is a game, a line of an order is a review; sizes, flags and statuses decide which of the odd cases a record is.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.operators import cleaning
from opinera.sources.schemas import GAMES, PLAYER_EVENT, REVIEW_EVENT, REVIEWS
from opinera.sources.tables import table

_PACKAGE = """array(named_struct('name', 'default', 'title', 'Buy ' || p_name, 'is_recurring_subscription', CASE WHEN p_size % 8 = 0 THEN 'false' ELSE 'true' END, 'subs',
 array(named_struct('packageid', p_size, 'option_text', p_name || CASE WHEN p_size % 16 = 0 THEN ' - 10₫' ELSE ' - $10' END, 'price_in_cents_with_discount', CAST(round(p_retailprice * 10) AS BIGINT) * p_size * 200))))"""
_GAME = f"""named_struct('appid', p_partkey, 'success', p_size % 13 <> 0, 'data', named_struct('type', CASE WHEN p_size % 10 = 0 THEN 'dlc' ELSE 'game' END, 'name', p_name,
 'is_free', CASE WHEN p_brand = 'Brand#1' THEN true WHEN p_size <> 50 THEN false END,
 'genres', CASE WHEN p_size <> 49 THEN transform(split(p_name, ' '), x -> named_struct('id', '1', 'description', x)) END,
 'categories', CASE WHEN p_size = 48 THEN array() ELSE array(named_struct('id', 1, 'description', p_type), named_struct('id', 2, 'description', p_brand)) END,
 'platforms', named_struct('windows', true, 'mac', p_size % 2 = 0, 'linux', p_size % 3 = 0),
 'price_overview', CASE WHEN p_size % 4 <> 0 THEN named_struct('currency', 'USD', 'final', CAST(round(p_retailprice * 10) AS BIGINT) * p_size * 300) END,
 'package_groups', CASE WHEN p_size % 4 = 0 THEN {_PACKAGE} END,
 'release_date', named_struct('coming_soon', p_size % 25 = 0, 'date', CASE p_size % 4 WHEN 0 THEN '2020-01-' || lpad(p_size % 28 + 1, 2, '0') WHEN 1 THEN (p_size % 28 + 1) || ' Feb, 2021' WHEN 2 THEN 'Mar ' || (p_size % 28 + 1) || ', 2022' ELSE 'soon' END)))"""
_REVIEW = """named_struct('recommendationid', l_orderkey || '-' || l_linenumber, 'language', CASE WHEN l_linestatus = 'F' THEN ' English ' ELSE 'german' END,
 'timestamp_created', unix_seconds(CAST(l_shipdate AS TIMESTAMP)) + l_linenumber * 600, 'voted_up', l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linenumber % 2 = 0),
 'votes_up', l_linenumber, 'votes_funny', CAST(l_suppkey % 5 AS INT), 'weighted_vote_score', CASE WHEN l_linenumber <> 6 THEN CAST(l_discount AS STRING) END, 'steam_purchase', l_linestatus = 'O', 'received_for_free', l_tax < 0.02,
 'author', named_struct('playtime_at_review', CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INT) * 70 END, 'playtime_forever', CASE WHEN l_linenumber <> 1 THEN CAST(floor(l_extendedprice) AS INT) % 5000 END))"""


def _parsed(rows: DataFrame, record: str, schema: str) -> DataFrame:
    """As from JSON lines: written as JSON, then read by the landing schema."""
    return rows.select(F.from_json(F.to_json(F.expr(record)), schema).alias("r")).select("r.*")


def landed_games(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(table(spark, d, "part"), _GAME, GAMES)


def landed_reviews(spark: SparkSession, d: str) -> DataFrame:
    record = f"named_struct('appid', l_partkey, 'game_name', 'Game ' || l_partkey, 'review', {_REVIEW})"
    return _parsed(table(spark, d, "lineitem"), record, REVIEWS)


def games(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.games(landed_games(spark, d))


def reviews(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.reviews(landed_reviews(spark, d))


def gold(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.reviews_with_games(reviews(spark, d), games(spark, d))


def live(spark: SparkSession, d: str) -> DataFrame:
    """The later part of the base: what a stream has added so far."""
    return gold(spark, d).where("timestamp_created >= 946684800")


def history(spark: SparkSession, d: str) -> DataFrame:
    return gold(spark, d).where("timestamp_created < 946684800")


def review_log(spark: SparkSession, d: str) -> DataFrame:
    """Messages of review events, some broken in each of the known ways, all in the shape of a message log."""
    event = f"""named_struct('event_id', CASE WHEN l_linenumber <> 3 OR l_suppkey % 4 <> 0 THEN 'review:' || l_partkey || ':' || l_orderkey || '-' || l_linenumber END,
     'event_type', CASE WHEN l_suppkey % 11 = 0 THEN 'OTHER' ELSE 'REVIEW_CREATED' END, 'appid', CASE WHEN l_suppkey % 13 = 0 THEN -1 WHEN l_suppkey % 17 = 0 THEN 99999999 ELSE CAST(l_partkey AS INT) END,
     'event_time', CASE WHEN l_suppkey % 19 = 0 THEN 'never' ELSE date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") END, 'produced_at', CASE WHEN l_suppkey % 7 <> 0 THEN '2024-01-01T00:00:00Z' END,
     'payload', CASE WHEN l_suppkey % 23 <> 0 THEN {_REVIEW} END)"""
    rows = table(spark, d, "lineitem").withColumn("value", F.to_json(F.expr(event)).cast("binary"))
    return rows.select(F.col("l_partkey").cast("string").cast("binary").alias("key"), "value", F.lit("reviews").alias("topic"), (F.col("l_suppkey") % 3).cast("int").alias("partition"), F.col("l_orderkey").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))


def player_log(spark: SparkSession, d: str) -> DataFrame:
    event = """named_struct('event_id', CASE WHEN event_id % 29 <> 0 THEN 'p' || event_id END, 'event_type', CASE WHEN event_type = 'error' THEN 'OTHER' WHEN event_id % 31 <> 0 THEN 'PLAYER_COUNT_SNAPSHOT' END,
     'schema_version', CASE WHEN event_id % 37 = 0 THEN 2 ELSE 1 END, 'appid', CASE WHEN event_id % 41 = 0 THEN 0 WHEN event_id % 43 = 0 THEN 2147483647 ELSE CAST(user_id AS INT) + 1 END,
     'event_time', CASE WHEN event_id % 47 = 0 THEN 'x' ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END, 'produced_at', CASE WHEN event_id % 53 = 0 THEN 'x' ELSE '2024-01-01T00:00:00Z' END,
     'payload', named_struct('player_count', CASE WHEN event_id % 59 = 0 THEN -1 ELSE CAST(floor(value * 100) AS BIGINT) END))"""
    other = (F.col("user_id") + 2).cast("string")  # a fixed id would be right for the game that has it
    key = F.when(F.col("event_id") % 61 == 0, other).when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), (F.col("user_id") + 1).cast("string")))
    rows = table(spark, d, "events").withColumn("value", F.to_json(F.expr(event)).cast("binary"))
    return rows.select(key.cast("binary").alias("key"), F.col("value"), F.lit("players").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))


__all__ = ["PLAYER_EVENT", "REVIEW_EVENT", "game_sql", "gold", "games", "history", "landed_games", "landed_reviews", "live", "player_log", "review_log", "reviews"]

#: Tables of the same rows in SQL, as a WITH clause.
SQL_GAMES = """game AS (SELECT p_partkey AS appid, p_name AS game_name, CASE WHEN p_brand = 'Brand#1' THEN true WHEN p_size <> 50 THEN false END AS is_free,
 CASE WHEN p_brand = 'Brand#1' THEN 0 WHEN p_size = 50 THEN NULL WHEN p_size % 4 <> 0 THEN round(p_retailprice * 10) * p_size * 3 WHEN p_size % 8 = 0 THEN round(p_retailprice * 10) * p_size * 2 END AS price,
 CASE WHEN p_brand = 'Brand#1' OR p_size = 50 THEN NULL WHEN p_size % 4 <> 0 THEN 'USD' WHEN p_size % 16 = 0 THEN 'VND' END AS currency,
 CASE WHEN p_size <> 49 THEN string_split(p_name, ' ') END AS genres, CASE WHEN p_size = 48 THEN CAST([] AS VARCHAR[]) ELSE [p_type, p_brand] END AS categories,
 true AS windows, p_size % 2 = 0 AS mac, p_size % 3 = 0 AS linux,
 CASE p_size % 4 WHEN 0 THEN '2020-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') WHEN 1 THEN (p_size % 28 + 1) || ' Feb, 2021' WHEN 2 THEN 'Mar ' || (p_size % 28 + 1) || ', 2022' ELSE 'soon' END AS release_date FROM part)"""
SQL_REVIEWS = """review AS (SELECT l_orderkey || '-' || l_linenumber AS recommendationid, l_partkey AS appid, 'Game ' || l_partkey AS game_name, CASE WHEN l_linestatus = 'F' THEN 'english' ELSE 'german' END AS language_clean,
 l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linenumber % 2 = 0) AS voted_up, l_linestatus = 'O' AS steam_purchase, l_tax < 0.02 AS received_for_free, CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 600 AS timestamp_created,
 l_linenumber AS votes_up, CAST(l_suppkey % 5 AS INTEGER) AS votes_funny, CASE WHEN l_linenumber <> 6 THEN l_discount END AS score, CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) * 70 END AS playtime_at_review,
 CASE WHEN l_linenumber <> 1 THEN CAST(floor(l_extendedprice) AS INTEGER) % 5000 END AS playtime_forever, l_suppkey FROM lineitem)"""
SQL_GOLD = f"""{SQL_GAMES}, {SQL_REVIEWS}, gold AS (SELECT review.*, is_free, price, currency, genres, categories, windows, mac, linux, release_date, playtime_at_review / 60.0::DOUBLE AS playtime_hours,
 CASE WHEN playtime_at_review IS NULL THEN NULL WHEN playtime_at_review < 120 THEN '0-2h' WHEN playtime_at_review < 600 THEN '2-10h' WHEN playtime_at_review < 3000 THEN '10-50h' ELSE '50h+' END AS playtime_bucket,
 CASE WHEN is_free THEN 'FREE' WHEN NOT is_free THEN 'PAID' ELSE 'UNKNOWN' END AS game_type,
 CASE WHEN is_free THEN 'FREE' WHEN price IS NULL THEN 'UNKNOWN' WHEN price < 200000 THEN '<200K' WHEN price < 500000 THEN '200K-500K' WHEN price < 1000000 THEN '500K-1M' ELSE '1M+' END AS price_bucket
 FROM review JOIN game USING (appid))"""
APPROVAL = "count(*) AS review_count, count(*) FILTER (voted_up) AS positive_reviews, count(*) FILTER (NOT voted_up) AS negative_reviews, count(*) FILTER (voted_up) / count(*)::DOUBLE AS recommendation_rate"
