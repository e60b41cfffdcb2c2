"""Turning polled records into events exactly once, by tables: what was seen, what waits, what was sent.

A first poll of a game only marks what is there. Later polls put unseen records in the outbox under ids that follow from
the record, so sending twice is harmless downstream. A poll that ends before it meets anything seen has a gap.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinera.streaming.contract import review_event_id


def split_poll(polled: DataFrame, seen: DataFrame, started: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records to mark as seen, events to send). started: games whose first poll is done."""
    fresh = polled.join(seen.select("appid", "recommendationid"), ["appid", "recommendationid"], "left_anti").dropDuplicates(["appid", "recommendationid"])
    events = fresh.join(started.select("appid"), "appid", "left_semi").withColumn("event_id", review_event_id(F.col("appid"), F.col("recommendationid")))
    return fresh.select("appid", "recommendationid"), events


def gaps(polled: DataFrame, seen: DataFrame, started: DataFrame) -> DataFrame:
    """Started games whose poll met nothing seen: what came between is unknown."""
    met = polled.join(seen.select("appid", "recommendationid"), ["appid", "recommendationid"], "left_semi").select("appid").distinct()
    return polled.select("appid").distinct().join(started.select("appid"), "appid", "left_semi").join(met, "appid", "left_anti")


def unsent(outbox: DataFrame, sent: DataFrame) -> DataFrame:
    """What a run that ended early still has to send, in the order of creation."""
    return outbox.join(sent.select("event_id"), "event_id", "left_anti").orderBy("timestamp_created", "event_id")
