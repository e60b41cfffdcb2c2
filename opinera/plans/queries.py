"""The operators over the driver's tables, each with the SQL that says the same.

A line of an order stands for a review (returned: liked), a part for a game, the two words of a part's name for genres,
an order's status for platforms, an event for a stream's event and its props for the payload.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.functions.dimensions import UNKNOWN, bucketed, by_flag, by_member, clean_tokens
from opinera.operators import learning, lifecycle, quality, ranking, snapshots
from opinera.plans.metrics import Report, approval, average, count_rows, distinct, extreme, merged_with_provenance
from opinera.sources.staging import new_folder
from opinera.sources.tables import table
from opinera.streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


_returned = lambda: F.col("l_returnflag") == "R"
_APPROVAL = "count(*) AS review_count, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS negative_reviews, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*)::DOUBLE AS recommendation_rate"


def _lines_with_parts(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))


@query(f"SELECT l_partkey, {_APPROVAL} FROM lineitem GROUP BY l_partkey")
def rate_by_part(spark, d):
    return approval(("l_partkey",), _returned).over(table(spark, d, "lineitem"))


@query(f"SELECT l_partkey, {_APPROVAL} FROM lineitem GROUP BY l_partkey")
def rate_by_part_sql(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("opinera_lines")
    return spark.sql("SELECT l_partkey, count(*) AS review_count, count_if(l_returnflag = 'R') AS positive_reviews, count_if(l_returnflag <> 'R') AS negative_reviews, count_if(l_returnflag = 'R') / count(*) AS recommendation_rate FROM opinera_lines GROUP BY l_partkey")


@query(f"""WITH m AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS member FROM part)
SELECT member, {_APPROVAL}, count(DISTINCT l_partkey) AS part_count FROM lineitem JOIN m ON l_partkey = p_partkey GROUP BY member""")
def rate_by_member(spark, d):
    """Lines are summed by part first, so what is exploded is a row a part and not a row a line."""
    report = approval(("member",), _returned)
    per_part = Report(("l_partkey",), report.measures).partial(table(spark, d, "lineitem"))
    named = per_part.join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    exploded = by_member(named, F.split("p_name", " "), "member").withColumn("_parts", F.lit(1).cast("long"))
    counted = exploded.groupBy("member").agg(*(s.again() for s in report._states()), F.sum("_parts").alias("part_count"))
    return counted.select("member", *(m.finish().alias(m.name) for m in report.measures), "part_count")


@query(f"""SELECT CASE WHEN l_quantity < 2 THEN '0-2' WHEN l_quantity < 10 THEN '2-10' WHEN l_quantity < 30 THEN '10-30' ELSE '30+' END AS bucket, {_APPROVAL},
avg(CAST(l_quantity AS DECIMAL(18,2))) AS avg_quantity, count(l_quantity) AS observed FROM lineitem GROUP BY 1""")
def bucketed_rate(spark, d):
    lines = table(spark, d, "lineitem").withColumn("bucket", bucketed(F.col("l_quantity"), (0, 2, 10, 30), ("0-2", "2-10", "10-30", "30+")))
    return approval(("bucket",), _returned, *average("avg_quantity", lambda: F.col("l_quantity"), "observed")).over(lines)


@query(f"""WITH lines AS (SELECT p_brand, {_APPROVAL} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
prices AS (SELECT p_brand, count(*) AS part_count, min(p_retailprice) AS min_price, max(p_retailprice) AS max_price, avg(p_retailprice) AS avg_price FROM part GROUP BY p_brand)
SELECT * FROM lines LEFT JOIN prices USING (p_brand)""")
def two_grain(spark, d):
    prices = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("part_count"), F.min("p_retailprice").alias("min_price"), F.max("p_retailprice").alias("max_price"), F.avg("p_retailprice").alias("avg_price"))
    return approval(("p_brand",), _returned).over(_lines_with_parts(spark, d).select("p_brand", "l_returnflag")).join(prices, "p_brand", "left")


@query("""SELECT flag, count(*) AS orders, count(DISTINCT o_custkey) AS customers FROM (
SELECT 'OPEN' AS flag, o_custkey FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'URGENT', o_custkey FROM orders WHERE o_orderpriority LIKE '1%'
UNION ALL SELECT 'LARGE', o_custkey FROM orders WHERE o_totalprice > 200000) GROUP BY flag""")
def struct_flags(spark, d):
    flags = {"OPEN": F.col("o_orderstatus") == "O", "URGENT": F.col("o_orderpriority").startswith("1"), "LARGE": F.col("o_totalprice") > 200000}
    return by_flag(table(spark, d, "orders"), flags, "flag").groupBy("flag").agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"))


@query("""SELECT user_id, count(*) AS events, count(CASE WHEN event_type = 'purchase' THEN value END) AS observed, avg(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS avg_purchase,
avg(CAST(value AS DECIMAL(18,2))) AS avg_value, min(value) AS least, max(value) AS most FROM events GROUP BY user_id""")
def engagement(spark, d):
    report = Report(("user_id",), (count_rows("events"), *average("avg_purchase", lambda: F.when(F.col("event_type") == "purchase", F.col("value")), "observed"), *average("avg_value", lambda: F.col("value")), extreme("least", lambda: F.col("value"), "min"), extreme("most", lambda: F.col("value"), "max")))
    return report.over(table(spark, d, "events"))


@query("""SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_returnflag <> 'R') AS kept,
count(*) FILTER (l_discount = 0) AS full_price, count(*) FILTER (l_quantity IS NULL) AS null_quantity, count(*) FILTER (l_shipdate IS NULL) AS null_shipdate,
count(*) FILTER (l_returnflag = 'R') / count(*)::DOUBLE AS returned_ratio FROM lineitem""")
def profile(spark, d):
    c, lines = F.col, table(spark, d, "lineitem")
    keys = lambda key, name: lines.select(key).distinct().agg(F.count(key).alias(name))  # noqa: E731  two distinct counts in one aggregate would send each row on three times
    counts = lines.agg(
        F.count("*").alias("rows"), F.count_if(_returned()).alias("returned"), F.count_if(~_returned()).alias("kept"), F.count_if(c("l_discount") == 0).alias("full_price"),
        F.count_if(c("l_quantity").isNull()).alias("null_quantity"), F.count_if(c("l_shipdate").isNull()).alias("null_shipdate"), (F.count_if(_returned()) / F.count("*")).alias("returned_ratio"),
    )
    return counts.crossJoin(keys("l_orderkey", "orders")).crossJoin(keys("l_partkey", "parts"))  # rows beside a row


@query("""SELECT count(*) AS rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus, count(*) FILTER (n > 1) AS duplicate_keys, CAST(coalesce(sum(bad), 0) AS BIGINT) AS rule_0 FROM (
SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (l_discount IS NULL OR l_discount < 0 OR l_discount > 0.05) AS bad FROM lineitem GROUP BY ALL)""")
def duplicate_keys(spark, d):
    found = quality.profile(table(spark, d, "lineitem"), [quality.outside("l_discount", 0, 0.05)], ["l_orderkey", "l_linenumber"])
    return found.select(F.col("keys").alias("rows"), (F.col("rows") - F.col("keys")).alias("surplus"), "duplicate_keys", "rule_0")


@query("SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY o_orderstatus")
def distribution(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey")
def anti_unmatched(spark, d):
    return quality.unmatched(table(spark, d, "orders"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_custkey, c_mktsegment FROM customer SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000")
def semi_matched(spark, d):
    large = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(large, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("""SELECT o_orderkey, o_totalprice, c_name, c_mktsegment, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def gold_join(spark, d):
    wide = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return wide.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name", "r_name")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_user(spark, d):
    return snapshots.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 5")
def newest_per_user(spark, d):
    return snapshots.first_per_key(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 5).select("user_id", "event_id", "value")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice, source FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY rank) AS n FROM (
SELECT *, 0 AS rank, 'historical' AS source FROM orders WHERE o_orderstatus <> 'O' UNION ALL SELECT *, 1, 'realtime' FROM orders WHERE o_orderstatus <> 'F')) WHERE n = 1""")
def current_snapshot(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old, live = orders.where("o_orderstatus <> 'O'").withColumn("source", F.lit("historical")), orders.where("o_orderstatus <> 'F'").withColumn("source", F.lit("realtime"))
    return snapshots.precedence_union(["o_orderkey"], [old, live])


@query("""SELECT CASE WHEN a.o_orderkey IS NULL THEN 'upserted' WHEN b.o_orderkey IS NULL THEN 'deleted' ELSE 'matched' END AS action, count(*) AS keys
FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O') a FULL JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') b USING (o_orderkey) GROUP BY 1""")
def snapshot_upsert(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return snapshots.snapshot_changes(orders.where("o_orderstatus <> 'O'"), orders.where("o_orderstatus <> 'F'"), ["o_orderkey"]).groupBy("action").agg(F.count("*").alias("keys"))


@query("""WITH m AS (SELECT l_partkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS q FROM lineitem GROUP BY 1), s AS (SELECT l_partkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS q FROM lineitem WHERE l_linenumber < 7 GROUP BY 1)
SELECT coalesce(m.l_partkey, s.l_partkey) AS l_partkey, m.n AS left_n, s.n AS right_n, m.q AS left_q, s.q AS right_q FROM m FULL JOIN s ON m.l_partkey = s.l_partkey WHERE m.n IS DISTINCT FROM s.n OR abs(m.q - s.q) > 1e-12 OR m.q IS NULL OR s.q IS NULL""")
def metric_diff(spark, d):
    lines = table(spark, d, "lineitem")
    report = lambda rows: rows.groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("q"))
    return snapshots.metric_differences(report(lines), report(lines.where("l_linenumber < 7")), "l_partkey", ["n", "q"])


@query("""SELECT event_id, event_type, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS side FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)""")
def split_by_rank(spark, d):
    ranked = ranking.numbered(table(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type")
    return ranked.select("event_id", "event_type", F.when(F.col("rn") <= F.floor(F.col("n") * 0.8), "train").otherwise("test").alias("side"))


@query("SELECT event_type AS label, count(*) AS rows, CAST(floor(count(*) * 0.8) AS BIGINT) AS train_rows FROM events GROUP BY event_type")
def hash_split(spark, d):
    """The sizes of the hashed split; which rows are where is tested apart, since the hash isn't in SQL."""
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("label"))
    return learning.sided(rows, "event_id").groupBy("label").agg(F.count("*").alias("rows"), F.count_if("train").alias("train_rows"))


@query("""SELECT user_id, epoch(time_bucket(INTERVAL '1 hour', ts))::BIGINT AS window_start, epoch(time_bucket(INTERVAL '1 hour', ts))::BIGINT + 3600 AS window_end, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
count(*) FILTER (event_type = 'purchase') / count(*)::DOUBLE AS rate FROM events GROUP BY 1, 2, 3""")
def hourly_window(spark, d):
    timed = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = timed.groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return counted.select("user_id", F.unix_seconds("w.start").alias("window_start"), F.unix_seconds("w.end").alias("window_end"), "events", "purchases", (F.col("purchases") / F.col("events")).alias("rate"))


@query("SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT event_id, CAST(year(ts) AS INTEGER) AS year, strftime(ts, '%Y-%m-%d') AS day, CAST(isoyear(ts) AS VARCHAR) || '-W' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS iso_week, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS hour FROM events")
def date_parts(spark, d):
    week = F.concat(F.expr("extract(YEAROFWEEK FROM ts)").cast("string"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"))
    return table(spark, d, "events").select("event_id", F.year("ts").alias("year"), F.date_format("ts", "yyyy-MM-dd").alias("day"), week.alias("iso_week"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("hour"))


_BAD = (("ODD_USER", "user_id % 7 = 3"), ("UNSUPPORTED_EVENT_TYPE", "event_type IN ('error')"), ("LOW_VALUE", "value < 10"), ("SMALL_K", "k < 5"))
_CASES = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _BAD)


@query(f"""SELECT event_id, concat_ws(';', {_CASES}) AS reasons, CASE {' '.join(f"WHEN {c} THEN '{n}'" for n, c in _BAD)} ELSE '' END AS first_reason
FROM (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events)""")
def classify_events(spark, d):
    rules = [(n, F.expr(c)) for n, c in _BAD]
    rows = table(spark, d, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return rows.select("event_id", stream.all_reasons(rules).alias("reasons"), stream.first_reason(rules).alias("first_reason"))


@query(f"""SELECT reason, count(*) AS events FROM (SELECT unnest(string_split(concat_ws(';', {_CASES}), ';')) AS reason FROM (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events)) WHERE reason <> '' GROUP BY reason""")
def rejection_reasons(spark, d):
    return classify_events(spark, d).where("reasons <> ''").select(F.explode(F.split("reasons", ";")).alias("reason")).groupBy("reason").agg(F.count("*").alias("events"))


@query(f"""SELECT * FROM (SELECT l_partkey, {_APPROVAL} FROM lineitem GROUP BY l_partkey) ORDER BY recommendation_rate DESC, review_count DESC, l_partkey LIMIT 20""")
def top_parts(spark, d):
    return ranking.top(rate_by_part(spark, d), [F.desc("recommendation_rate"), F.desc("review_count"), F.asc("l_partkey")], 20)


@query("""WITH c AS (SELECT event_type, count(*) AS events FROM events GROUP BY 1 UNION ALL SELECT 'UNKNOWN', 0)
SELECT * FROM (SELECT * FROM c WHERE event_type <> 'UNKNOWN' ORDER BY events DESC, event_type LIMIT 2) UNION ALL SELECT * FROM c WHERE event_type = 'UNKNOWN'""")
def top_keeping_unknown(spark, d):
    counts = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("events"))
    every = counts.unionByName(spark.createDataFrame([(UNKNOWN, 0)], "event_type string, events long"))
    return ranking.top_keeping(every, [F.desc("events"), F.asc("event_type")], 3, F.col("event_type") == UNKNOWN)


@query("SELECT event_id, user_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 25 OFFSET 50")
def page_of_events(spark, d):
    return ranking.page(table(spark, d, "events").select("event_id", "user_id", "value", "ts"), [F.desc("ts"), F.desc("event_id")], 3, 25).drop("ts")


@query("""SELECT user_id, count(*) AS review_count, count(*) FILTER (event_type = 'purchase') AS positive_reviews, count(*) FILTER (event_type <> 'purchase') AS negative_reviews, count(*) FILTER (event_type = 'purchase') / count(*)::DOUBLE AS recommendation_rate,
(sum(CAST(value AS DECIMAL(18,2)))::DOUBLE / count(value)::DOUBLE) AS avg_value, count(DISTINCT event_type) AS types, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS batch_review_count, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS stream_review_count,
CASE WHEN count(*) FILTER (ts >= TIMESTAMP '2024-01-15') = 0 THEN 'batch' WHEN count(*) FILTER (ts < TIMESTAMP '2024-01-15') = 0 THEN 'streaming' ELSE 'batch_plus_streaming' END AS data_source FROM events GROUP BY user_id""")
def merge_partials(spark, d):
    report = approval(("user_id",), lambda: F.col("event_type") == "purchase", *average("avg_value", lambda: F.col("value")), distinct("types", lambda: F.col("event_type")))
    rows, cut = table(spark, d, "events"), F.lit("2024-01-15").cast("timestamp_ntz")
    return merged_with_provenance(report, report.partial(rows.where(F.col("ts") < cut)), report.partial(rows.where(F.col("ts") >= cut)))


@query("SELECT toxic AS label, count(*) AS rows, sum(count(*)) OVER () / (2.0 * count(*)) AS class_weight FROM labels GROUP BY toxic")
def class_weights(spark, d):
    return learning.class_weights(table(spark, d, "labels").withColumnRenamed("toxic", "label"))


@query("""SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM (SELECT *, (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS recall FROM (
SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 0 AND toxic = 0) AS tn, count(*) FILTER (quality = 1 AND toxic = 0) AS fn FROM labels))""")
def confusion(spark, d):
    return learning.confusion(table(spark, d, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction")))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(lower(p_type), ' '), lambda x: trim(x) <> ''))), ',') AS tokens FROM part")
def token_arrays(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(clean_tokens(F.split(F.lower("p_type"), " ")), ",").alias("tokens"))


@query("SELECT label, count(*) AS rows, CAST(sum(CASE WHEN label = m.top THEN 1 ELSE 0 END) AS BIGINT) AS hits FROM (SELECT event_type AS label FROM events), (SELECT max(event_type) AS top FROM (SELECT event_type, rank() OVER (ORDER BY count(*) DESC) AS r FROM events GROUP BY 1) WHERE r = 1) m GROUP BY label")
def majority(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("label"))
    common = rows.groupBy("label").count().agg(F.max(F.struct("count", "label"))["label"].alias("top"))
    return rows.join(F.broadcast(common)).groupBy("label").agg(F.count("*").alias("rows"), F.count_if(F.col("label") == F.col("top")).alias("hits"))  # one row beside each


@query("SELECT l_returnflag, printf('%.12f', sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) / count(*)::DOUBLE) AS rate FROM lineitem GROUP BY l_returnflag")
def fixed_decimals(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.format_string("%.12f", F.count_if(F.col("l_linestatus") == "F") / F.count("*")).alias("rate"))


@query("SELECT 'union' AS op, count(*) AS keys FROM (SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part) UNION ALL SELECT 'intersect', count(*) FROM (SELECT l_suppkey FROM lineitem INTERSECT SELECT s_suppkey FROM supplier) UNION ALL SELECT 'except', count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)")
def set_operations(spark, d):
    lines, keys = table(spark, d, "lineitem"), lambda t, c: table(spark, d, t).select(F.col(c).alias("k"))
    of = lambda c: lines.select(F.col(c).alias("k"))
    parts = (("union", of("l_partkey").union(keys("part", "p_partkey")).distinct()), ("intersect", of("l_suppkey").intersect(keys("supplier", "s_suppkey"))), ("except", keys("orders", "o_orderkey").subtract(of("l_orderkey"))))
    out = [f.agg(F.lit(n).alias("op"), F.count("*").alias("keys")) for n, f in parts]
    return out[0].unionAll(out[1]).unionAll(out[2])


@query("SELECT o_orderkey, CASE WHEN n <= 100 THEN 'QUEUED' ELSE 'DEFERRED' END AS action FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'P')")
def onboarding_cut(spark, d):
    registry = table(spark, d, "orders").select(F.col("o_orderkey").alias("appid"), F.when(F.col("o_orderstatus") == "P", "QUALIFIED").otherwise("ACTIVE").alias("state"))
    return lifecycle.onboarding_plan(registry, 100).withColumnRenamed("appid", "o_orderkey")


@query("SELECT o_orderkey, lines AND customer AS ready, lines, customer FROM (SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS lines, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS customer FROM orders)")
def readiness_gates(spark, d):
    orders = table(spark, d, "orders")
    rich = orders.join(table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    evidence = {"lines": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("appid")), "customer": rich.select(F.col("o_orderkey").alias("appid"))}
    return lifecycle.gates(orders.select(F.col("o_orderkey").alias("appid")), evidence).select(F.col("appid").alias("o_orderkey"), "ready", "lines", "customer")


@query("SELECT event_type, max(coalesce(event_id, 0)) AS mark FROM events GROUP BY event_type")
def high_water_marks(spark, d):
    rows = table(spark, d, "events").select("event_type", "ts", F.col("event_id").alias("mark"))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return lifecycle.merge_marks(*(rows.where(side).drop("ts") for side in (F.col("ts") < cut, F.col("ts") >= cut)), "event_type", "mark")


@query("SELECT event_id, event_type || ':' || user_id || ':' || event_id AS natural_key, upper(md5(natural_key)) AS digest, sha256(props) AS props_sha FROM events")
def composite_keys(spark, d):
    key = F.concat_ws(":", "event_type", "user_id", "event_id")
    return table(spark, d, "events").select("event_id", key.alias("natural_key"), F.upper(F.md5(key)).alias("digest"), F.sha2("props", 256).alias("props_sha"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def page_rows(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("SELECT conv_id, turn, role FROM conversations WHERE lower(text) LIKE '%the%' AND role = 'user'")
def name_search(spark, d):
    return table(spark, d, "conversations").where((F.col("role") == "user") & F.lower("text").contains("the")).select("conv_id", "turn", "role")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, d):
    """The events twice through a file stream and its watermark: each comes out once."""
    root = new_folder(spark, "stream")
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_ts"), "user_id", "event_type")
    for _ in range(2):
        rows.write.mode("append").parquet(f"{root}/in")
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10).parquet(f"{root}/in")
    stream.file_sink(stream.once(live, ["event_id"], "60 days"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out").select("event_id", "user_id", "event_type")


@query()
def row_fingerprint(spark, d):
    return quality.fingerprint(table(spark, d, "orders"))


@query()
def logistic_scores(spark, d):
    """A weighted logistic model of an order's status by what is known of the order and its customer, over a hashed split."""
    from pyspark.ml.feature import VectorAssembler

    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("recommendationid"), (F.col("o_orderstatus") == "F").cast("double").alias("label"), F.log1p("o_totalprice").alias("a"), F.col("c_acctbal").alias("b"))
    train, test = learning.split(rows)
    weights = learning.class_weights(train).select("label", "class_weight")
    put = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    model = learning.logistic().fit(put.transform(train.join(F.broadcast(weights), "label")))  # a row a label
    return learning.confusion(model.transform(put.transform(test)))


