"""What a dashboard shows of the reports: totals, selections in order, and names where they are known."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinera.functions.dimensions import UNKNOWN
from opinera.operators import ranking

BUCKETS = ("0-2h", "2-10h", "10-50h", "50h+")


def totals(games: DataFrame) -> DataFrame:
    """A row: all reviews, those of the batch, for and against, and the overall share (0 without reviews)."""
    batch = F.coalesce("batch_review_count", "review_count") if "batch_review_count" in games.columns else F.col("review_count")
    named = {"total_reviews": F.col("review_count"), "batch_reviews": batch, "positive_reviews": F.col("positive_reviews"), "negative_reviews": F.col("negative_reviews")}
    summed = games.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in named.items()))
    return summed.withColumn("recommendation_rate", F.coalesce(F.try_divide("positive_reviews", "total_reviews"), F.lit(0.0)))


def top_by_name(games: DataFrame, most: int = 10) -> DataFrame:
    """For a chart: by share, reviews, then name."""
    return ranking.top(games, [F.desc("recommendation_rate"), F.desc("review_count"), F.asc("game_name"), F.asc("appid")], most)


def leading_genres(genres: DataFrame, most: int = 7) -> DataFrame:
    return ranking.top(genres, [F.desc("recommendation_rate"), F.asc("genre")], most)


def rarest_playtime_first(playtime: DataFrame) -> DataFrame:
    return playtime.withColumn("bucket_label", F.coalesce("playtime_bucket", F.lit("MISSING"))).orderBy("review_count", "bucket_label")


def playtime_in_order(playtime: DataFrame) -> DataFrame:
    """Buckets by time, unknown ones last."""
    return playtime.withColumn("place", ranking.domain_order(F.col("playtime_bucket"), BUCKETS)).orderBy("place", "playtime_bucket")


def samples(games: DataFrame, genres: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a serving run shows of itself: ten games by share, and genres by reviews."""
    return ranking.top(games, [F.desc("recommendation_rate"), F.asc("appid")], 10), genres.orderBy(F.desc("review_count"), "genre")


def named_reviews(reviews: DataFrame, games: DataFrame) -> DataFrame:
    """Each under its own name, else the game's, else as unknown. games has a row a game."""
    names = games.groupBy("appid").agg(F.max("game_name").alias("_known"))
    own = F.nullif(F.trim("game_name"), F.lit(""))
    return reviews.join(names, "appid", "left").withColumn("game_name", F.coalesce(own, "_known", F.lit("Unknown game"))).drop("_known")


def search(games: DataFrame, text: str) -> DataFrame:
    """Games whose name or id has the text, whatever its case."""
    return games.where(F.lower(F.concat_ws(" ", "game_name", "appid")).contains(text.lower()))


def preview(frame: DataFrame, order: list[Column], most: int = 20) -> list[dict]:
    return [r.asDict() for r in ranking.top(frame, order, most).collect()]  # a page


def strongest(values: DataFrame, most: int = 25) -> DataFrame:
    """Features (feature, value) that weigh most, either way."""
    return ranking.top(values, [F.abs("value").desc(), F.asc("feature")], most)


__all__ = ["UNKNOWN", "leading_genres", "named_reviews", "playtime_in_order", "preview", "rarest_playtime_first", "samples", "search", "strongest", "top_by_name", "totals"]
