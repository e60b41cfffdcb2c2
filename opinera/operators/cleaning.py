"""Landed records to typed tables, and reviews joined to games. Rows are neither dropped nor repaired here."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinera.functions.dimensions import hours_bucket


def _default_option(data: Column) -> Column:
    """The first option of the one-off default package, if there is exactly one such package."""
    offered = F.filter(
        data["package_groups"],
        lambda p: (p["name"] == "default") & (p["is_recurring_subscription"] == "false") & (p["title"] == F.concat(F.lit("Buy "), data["name"])) & (F.size(p["subs"]) > 0),
    )
    return F.when(F.size(offered) == 1, F.get(F.get(offered, F.lit(0))["subs"], F.lit(0)))


def games(landed: DataFrame) -> DataFrame:
    """A row a game. Free games cost nothing; paid ones cost the listed price, else the default option's, in major units."""
    data = F.col("data")
    listed, option = data["price_overview"]["final"], _default_option(data)
    offered = option["price_in_cents_with_discount"]
    minor = F.when(data["is_free"], F.lit(0)).when(~data["is_free"], F.coalesce(listed, offered))
    dong = F.when(offered.isNotNull() & (F.instr(option["option_text"], "₫") > 0), F.lit("VND"))
    currency = F.when(~data["is_free"], F.when(listed.isNotNull(), data["price_overview"]["currency"]).otherwise(dong))
    described = lambda name: F.transform(data[name], lambda x: x["description"]).alias(name)
    return landed.select("appid", data["name"].alias("game_name"), data["is_free"].alias("is_free"), (minor.cast("double") / 100).alias("price"), currency.alias("currency"), described("genres"), described("categories"), data["platforms"].alias("platforms"), data["release_date"]["date"].alias("release_date"))


def reviews(landed: DataFrame) -> DataFrame:
    """A row a review, batch or stream alike. Years are UTC whatever the session's zone."""
    r, author = F.col("review"), F.col("review.author")
    same = ("voted_up", "steam_purchase", "received_for_free", "timestamp_created", "votes_up", "votes_funny", "weighted_vote_score")
    year = F.year(F.to_utc_timestamp(F.timestamp_seconds(r["timestamp_created"]), F.current_timezone()))
    return landed.select(
        r["recommendationid"].alias("recommendationid"), "appid", "game_name", r["language"].alias("language"),
        *(r[c].alias(c) for c in same),
        author["playtime_at_review"].alias("playtime_at_review"), author["playtime_forever"].alias("playtime_forever"),
        r["voted_up"].cast("int").alias("recommendation_label"),
        (author["playtime_at_review"] / F.lit(60.0)).alias("playtime_hours"),
        F.lower(F.trim(r["language"])).alias("language_clean"), year.alias("review_year"),
    )


def reviews_with_games(review_rows: DataFrame, game_rows: DataFrame) -> DataFrame:
    """The analytical base, a row a review of a known game; which side is broadcast follows its size."""
    dimension = game_rows.drop("game_name")
    joined = review_rows.join(dimension, "appid").withColumn("playtime_bucket", hours_bucket(F.col("playtime_hours")))
    return joined.select(
        "recommendationid", "appid", "game_name", "voted_up", "playtime_at_review", "playtime_forever", "steam_purchase", "received_for_free",
        "is_free", "price", "currency", "genres", "categories", "platforms", "release_date", "timestamp_created", "votes_up", "votes_funny",
        "weighted_vote_score", "recommendation_label", "playtime_hours", "playtime_bucket",
    )
