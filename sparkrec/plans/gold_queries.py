"""Gold tables, catalog views and feature-store joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from sparkrec.operators import feature_store, gold, silver
from sparkrec.plans import inputs as I
from sparkrec.plans.inputs import with_
from sparkrec.plans.registry import query

ITEMS = with_(I.PRODUCTS, I.BRONZE, I.SILVER, I.ITEM_FEATURES)
USERS = with_(I.BRONZE, I.SILVER, I.USERS)
POPULAR = "ORDER BY num_purchases DESC, num_views DESC, product_id"


@query("d1_item_features", ITEMS + """
SELECT * EXCLUDE (avg_rating), round(avg_rating, 6) AS avg_rating FROM items""")
def _(spark, sf):
    return I.item_features(spark, sf).withColumn("avg_rating", F.round("avg_rating", 6))


@query("d2_user_sequences", USERS + """
SELECT user_id, array_to_string(item_sequence, ',') AS item_sequence,
  array_to_string(list_transform(event_time_sequence, lambda t: strftime(t, '%Y-%m-%d')), ',') AS event_time_sequence,
  sequence_length, last_event_time FROM users""")
def _(spark, sf):
    days = F.transform("event_time_sequence", lambda t: F.date_format(t, "yyyy-MM-dd"))
    return I.user_sequences(spark, sf).select(
        "user_id", F.array_join("item_sequence", ",").alias("item_sequence"),
        F.array_join(days, ",").alias("event_time_sequence"), "sequence_length", "last_event_time")


@query("d3_popularity_order", ITEMS + f"""
SELECT product_id, num_purchases, num_views, row_number() OVER ({POPULAR}) AS popularity_rank FROM items""")
def _(spark, sf):
    items = I.item_features(spark, sf).select("product_id", "num_purchases", "num_views")
    return gold.popularity_rank(items)


@query("d4_search", ITEMS + f"""
SELECT product_id, title, category FROM items WHERE lower(title || ' ' ||
  CASE WHEN price IS NOT NULL THEN category || ' · $' || CAST(price AS VARCHAR) ELSE category END) LIKE '%red%'
  AND lower(title || ' ' || category) LIKE '%economy%' {POPULAR} LIMIT 50""")
def _(spark, sf):
    return gold.search(I.item_features(spark, sf), " RED  economy ", 50).select("product_id", "title", "category")


@query("d4_search_batch", ITEMS + f""",
queries AS (SELECT DISTINCT ' ' || upper(p_type) || '  ' || split_part(p_name, ' ', 2) || ' ' || CAST(p_size AS VARCHAR) AS query FROM part),
texts AS (SELECT *, lower(title || ' ' || CASE WHEN price IS NOT NULL THEN category || ' · $' || CAST(price AS VARCHAR) ELSE category END) AS text FROM items),
hits AS (SELECT query, product_id, row_number() OVER (PARTITION BY query {POPULAR}) AS position FROM queries, texts
  WHERE len([t FOR t IN string_split(lower(query), ' ') IF NOT contains(text, t)]) = 0)
SELECT query AS query_id, position, product_id FROM hits WHERE position <= 20""")
def _(spark, sf):
    part = I.table(spark, sf, "part")
    words = F.concat(F.lit(" "), F.upper("p_type"), F.lit("  "), F.element_at(F.split("p_name", " "), 2), F.lit(" "), F.col("p_size").cast("string"))
    queries = part.select(words.alias("query")).distinct().select(F.col("query").alias("query_id"), "query")
    return gold.search_batch(I.item_features(spark, sf), queries, 20)


@query("d5_top_users", USERS + """
SELECT user_id, sequence_length FROM users ORDER BY sequence_length DESC, user_id LIMIT 25""")
def _(spark, sf):
    return gold.top_users(I.user_sequences(spark, sf), 25).select("user_id", "sequence_length")


@query("d6_row_count", "SELECT COUNT(*) AS rows FROM lineitem")
def _(spark, sf):
    return gold.row_count(I.table(spark, sf, "lineitem"))


@query("e1_latest_features", with_(I.EVENTS, """
clicks AS (SELECT user_id, product_id, ts AS event_time, event_id AS interaction_id FROM stream)""",
                                   I.sequences_sql("clicks", "seqs")) + """
SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id, COALESCE(array_to_string(item_sequence, ','), '') AS item_sequence,
  COALESCE(sequence_length, 0) AS sequence_length
FROM customer LEFT JOIN seqs ON seqs.user_id = 'u' || CAST(c_custkey AS VARCHAR)""")
def _(spark, sf):
    clicks = I.events(spark, sf).select(
        "user_id", "product_id", F.col("ts").alias("event_time"), F.col("event_id").alias("interaction_id"))
    features = gold.user_sequences(clicks)
    latest = feature_store.latest_features(features, "user_id", "last_event_time")
    users = I.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"))
    found = feature_store.lookup(users, latest, "user_id", ["item_sequence"])
    return found.select("user_id", F.array_join("item_sequence", ",").alias("item_sequence"),
                        F.coalesce("sequence_length", F.lit(0)).alias("sequence_length"))


SPEND = """spend AS (SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id, o_orderdate AS computed_at, o_orderkey AS order_id,
  o_totalprice AS amount FROM orders)"""


def _spend(spark, sf):
    return I.table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderdate").alias("computed_at"), F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"))


@query("e2_point_in_time", with_(SPEND, """
asked AS (SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id, l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
numbered AS (SELECT *, row_number() OVER () AS rid FROM asked),
found AS (SELECT n.rid, arg_max(s, (s.computed_at, s.order_id)) AS s FROM numbered n JOIN spend s
  ON s.user_id = n.user_id AND s.computed_at <= n.l_shipdate GROUP BY n.rid)""") + """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate,
  CASE WHEN s.computed_at >= l_shipdate - INTERVAL 30 DAY THEN s.order_id END AS order_id,
  CASE WHEN s.computed_at >= l_shipdate - INTERVAL 30 DAY THEN s.amount END AS amount
FROM numbered LEFT JOIN found USING (rid)""")
def _(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    asked = I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    joined = feature_store.point_in_time(
        asked, _spend(spark, sf), "user_id", "l_shipdate", "computed_at", timedelta(days=30), ["computed_at", "order_id"])
    return joined.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "order_id", "amount")


def _some_null(user: str = "user_id"):
    """Every tenth user is unknown: one NULL entity with a tenth of all rows."""
    return F.when(~F.col(user).endswith("0"), F.col(user)).alias(user)


@query("e2_point_in_time_null_entities", with_(SPEND, """
known AS (SELECT CASE WHEN user_id NOT LIKE '%0' THEN user_id END AS user_id, computed_at, order_id, amount FROM spend),
asked AS (SELECT CASE WHEN o_custkey % 10 <> 0 THEN 'u' || CAST(o_custkey AS VARCHAR) END AS user_id, o_orderkey, o_orderdate FROM orders),
found AS (SELECT a.o_orderkey, arg_max(k, (k.computed_at, k.order_id)) AS s FROM asked a JOIN known k
  ON k.user_id IS NOT DISTINCT FROM a.user_id AND k.computed_at <= a.o_orderdate GROUP BY a.o_orderkey)""") + """
SELECT user_id, o_orderkey, o_orderdate, CASE WHEN s.computed_at >= o_orderdate - INTERVAL 30 DAY THEN s.order_id END AS order_id,
  CASE WHEN s.computed_at >= o_orderdate - INTERVAL 30 DAY THEN s.amount END AS amount
FROM asked LEFT JOIN found USING (o_orderkey)""")
def _(spark, sf):
    asked = I.table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"), "o_orderkey", "o_orderdate")
    spend = _spend(spark, sf)
    spend = spend.select(_some_null(), *[c for c in spend.columns if c != "user_id"])
    return feature_store.point_in_time(
        asked.select(_some_null(), "o_orderkey", "o_orderdate"), spend, "user_id", "o_orderdate", "computed_at", timedelta(days=30),
        ["computed_at", "order_id"]).select("user_id", "o_orderkey", "o_orderdate", "order_id", "amount")


@query("e3_materialize", with_(SPEND, """
old AS (SELECT user_id, max((computed_at, order_id, amount)) AS r FROM spend WHERE computed_at <= TIMESTAMP '1998-01-01' GROUP BY user_id),
new AS (SELECT user_id, max((computed_at, order_id, amount)) AS r FROM spend
  WHERE computed_at > TIMESTAMP '1998-01-01' AND computed_at <= TIMESTAMP '1999-06-30' GROUP BY user_id)""") + """
SELECT user_id, COALESCE(new.r, old.r)[1] AS updated_at, COALESCE(new.r, old.r)[2] AS order_id, COALESCE(new.r, old.r)[3] AS amount,
  CASE WHEN new.r IS NULL THEN 'kept' WHEN old.r IS NULL THEN 'inserted' ELSE 'updated' END AS change
FROM old FULL OUTER JOIN new USING (user_id)""")
def _(spark, sf):
    spend = _spend(spark, sf)
    start, end = I.ntz("1998-01-01 00:00:00"), I.ntz("1999-06-30 00:00:00")

    def newest(rows):
        latest = feature_store.latest_features(rows, "user_id", "computed_at", ["order_id"])
        return latest.withColumnRenamed("computed_at", "updated_at")

    stored = newest(spend.filter(F.col("computed_at") <= start))
    return silver.merge(stored, newest(feature_store.materialize_window(spend, "computed_at", start, end)), "user_id")


ONLINE = f"online AS ({I.latest_sql('bronze', '''_ingested_at <= TIMESTAMP '2026-01-01 06:00:00' ''')})"


@query("e4_sequence_skew", with_(I.BRONZE, I.SILVER, ONLINE, I.USERS, I.sequences_sql("online", "served")) + """
SELECT COALESCE(u.user_id, s.user_id) AS user_id, array_to_string(u.item_sequence, ',') AS offline_sequence,
  array_to_string(s.item_sequence, ',') AS online_sequence
FROM users u FULL OUTER JOIN served s ON u.user_id = s.user_id WHERE u.item_sequence IS DISTINCT FROM s.item_sequence""")
def _(spark, sf):
    bronze = I.bronze_interactions(spark, sf)
    early = bronze.filter(F.col("_ingested_at") <= I.ntz("2026-01-01 06:00:00"))
    offline = I.user_sequences(spark, sf, I.silver_interactions(spark, sf, bronze))
    online = I.user_sequences(spark, sf, I.silver_interactions(spark, sf, early))
    skew = feature_store.sequence_skew(offline, online, "user_id", "item_sequence")
    return skew.select("user_id", F.array_join("offline_sequence", ",").alias("offline_sequence"),
                       F.array_join("online_sequence", ",").alias("online_sequence"))
