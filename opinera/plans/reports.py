"""The published reports over the analytical base, as specifications. Names of columns are those that readers rely on.

Two groups differ on purpose from a plain otherwise-branch: an item whose is_free isn't known is UNKNOWN, not paid, and a
paid item without a price is UNKNOWN, not in the dearest bucket.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinera.functions.dimensions import by_flag, by_member, price_bucket
from opinera.plans.metrics import Report, approval, average, count_if, count_rows, ratio

_liked = lambda: F.col("voted_up")
_hours = lambda: F.col("playtime_hours")
_seen_hours = average("avg_playtime_hours", _hours, "playtime_observed_count")

BY_GAME = approval(("appid", "game_name"), _liked)
BY_BUCKET = approval(("playtime_bucket",), _liked, *_seen_hours)
BY_SOURCE = approval(("purchase_source",), _liked, *average("avg_playtime_hours", _hours))
BY_GIFT = approval(("acquisition_type",), _liked, *average("avg_playtime_hours", _hours))
BY_TYPE = approval(("game_type",), _liked, *_seen_hours)
BY_PRICE = approval(("price_bucket",), _liked, *average("avg_playtime_hours", _hours))
ENGAGEMENT = Report(
    ("appid", "game_name"),
    (
        count_rows("review_count"), count_if("positive_reviews", _liked), ratio("recommendation_rate", "positive_reviews", "review_count"),
        *average("avg_playtime_at_review_hours", lambda: F.col("playtime_at_review") / 60.0, "playtime_at_review_observed_count"),
        *average("avg_playtime_forever_hours", lambda: F.col("playtime_forever") / 60.0, "playtime_forever_observed_count"),
        *average("avg_votes_up", lambda: F.col("votes_up")), *average("avg_votes_funny", lambda: F.col("votes_funny")),
        *average("avg_weighted_vote_score", lambda: F.expr("try_cast(weighted_vote_score AS double)")),
    ),
)


def game_type(is_free: Column) -> Column:
    return F.when(is_free, F.lit("FREE")).when(~is_free, F.lit("PAID")).otherwise(F.lit("UNKNOWN"))


def by_game(base: DataFrame) -> DataFrame:
    return BY_GAME.over(base)


def _by_list(base: DataFrame, column: str, name: str, unique: bool) -> DataFrame:
    """A review counts once for each member, however often it is there. unique: recommendationid is known to be, so nothing
    has to be shuffled to find repeats; rows are summed by game first, since a game's members are the same."""
    if unique:
        report = approval((name,), _liked)
        per_game = Report(("appid", column), report.measures).partial(base)
        return report.finish(report.merge([by_member(per_game, F.col(column), name)]))
    rows = by_member(base.select("recommendationid", "voted_up", column), F.col(column), name).drop(column)
    # of rows of one review, the liking one counts; a null id is one review that isn't counted
    once = rows.groupBy("recommendationid", name).agg(F.max("voted_up").alias("voted_up"))
    return approval((name,), _liked).over(once).join(once.groupBy(F.col(name).alias("_m")).agg(F.count("recommendationid").alias("_n")), F.col(name) == F.col("_m")).select(name, F.col("_n").alias("review_count"), "positive_reviews", "negative_reviews", F.try_divide("positive_reviews", "_n").alias("recommendation_rate"))


def by_genre(base: DataFrame, unique: bool = False) -> DataFrame:
    return _by_list(base, "genres", "genre", unique)


def by_category(base: DataFrame, unique: bool = False) -> DataFrame:
    return _by_list(base, "categories", "category", unique)


def by_playtime(base: DataFrame) -> DataFrame:
    return BY_BUCKET.over(base).drop("playtime_observed_count")


def by_price_type(base: DataFrame) -> DataFrame:
    """Reviews by what a game costs, and prices over games, not reviews: one price a game, its greatest."""
    typed = base.withColumn("game_type", game_type(F.col("is_free")))
    per_game = typed.groupBy("game_type", "appid").agg(F.max("price").alias("price"))
    prices = per_game.groupBy("game_type").agg(F.count("appid").alias("game_count"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.avg("price").alias("avg_price"))
    return BY_TYPE.over(typed).join(prices, "game_type", "left")


def by_platform(base: DataFrame) -> DataFrame:
    flags = {name.upper(): F.col(f"platforms.{name}") for name in ("windows", "mac", "linux")}
    return approval(("platform",), _liked).over(by_flag(base.select("platforms", "voted_up"), flags, "platform"))


def by_purchase(base: DataFrame) -> DataFrame:
    return BY_SOURCE.over(base.withColumn("purchase_source", F.when(F.col("steam_purchase"), F.lit("STEAM_PURCHASE")).otherwise(F.lit("OTHER_SOURCE"))))


def by_gift(base: DataFrame) -> DataFrame:
    return BY_GIFT.over(base.withColumn("acquisition_type", F.when(F.col("received_for_free"), F.lit("RECEIVED_FOR_FREE")).otherwise(F.lit("NOT_RECEIVED_FOR_FREE"))))


def by_price(base: DataFrame) -> DataFrame:
    """Summed by bucket and game first; games are the rows that leaves."""
    priced = base.withColumn("price_bucket", price_bucket(F.col("is_free"), F.col("price")))
    per_game = Report(("price_bucket", "appid"), BY_PRICE.measures).partial(priced)
    counted = per_game.groupBy("price_bucket").agg(*(s.again() for s in BY_PRICE._states()), F.count("appid").alias("game_count"))
    wanted = [m for m in BY_PRICE.measures if m.name != "negative_reviews"]
    return counted.select("price_bucket", "game_count", *(m.finish().alias(m.name) for m in wanted))


def engagement(base: DataFrame) -> DataFrame:
    return ENGAGEMENT.over(base)


def label_profile(base: DataFrame) -> DataFrame:
    """Reviews are summed by id first, and games are counted beside, so that neither distinct count multiplies the rows."""
    nulls = ("playtime_at_review", "playtime_forever", "price", "genres", "timestamp_created", "weighted_vote_score")
    counts = {"total_rows": F.lit(True), "positive_count": F.col("voted_up"), "negative_count": ~F.col("voted_up"), "free_review_count": F.col("is_free"), "paid_review_count": ~F.col("is_free")}
    counts |= {f"null_{c}": F.col(c).isNull() for c in nulls}
    per_id = base.groupBy("recommendationid").agg(*(F.count_if(c).alias(n) for n, c in counts.items()))
    summed = per_id.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts), F.count("recommendationid").alias("unique_recommendationid"))
    games = base.select("appid").distinct().agg(F.count("appid").alias("distinct_appids"))
    share = lambda c: F.try_divide(F.col(c), F.col("total_rows"))
    return summed.crossJoin(games).withColumns({"positive_percentage": share("positive_count"), "negative_percentage": share("negative_count")})  # a row beside a row


def window_metrics(live: DataFrame, delay: str = "7 days") -> DataFrame:
    """Hourly counts and share by game, over a batch or a stream of live reviews (timestamp_created in epoch seconds)."""
    timed = live.withColumn("event_time", F.timestamp_seconds("timestamp_created"))
    timed = timed.withWatermark("event_time", delay) if live.isStreaming else timed
    counted = timed.groupBy("appid", F.window("event_time", "1 hour").alias("w")).agg(
        F.max("game_name").alias("game_name"), F.count("*").alias("review_count"), F.count_if("voted_up").alias("positive_reviews"), F.count_if(~F.col("voted_up")).alias("negative_reviews")
    )
    return counted.select("appid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "game_name", "review_count", "positive_reviews", "negative_reviews", (F.col("positive_reviews") / F.col("review_count")).alias("recommendation_rate"))


#: The reports that are published, by name.
PUBLISHED = {"game_metrics": by_game, "genre_metrics": by_genre, "playtime_metrics": by_playtime, "free_paid_metrics": by_price_type, "platform_metrics": by_platform, "category_metrics": by_category, "purchase_metrics": by_purchase, "engagement_metrics": engagement, "label_profile": label_profile}
