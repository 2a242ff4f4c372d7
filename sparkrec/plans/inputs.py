"""Logical inputs bound to the given tables, once for Spark and once as SQL.

`part` is the catalog, `lineitem` joined with `orders` the versioned interactions,
`events` the raw event stream and `embeddings` the item vectors.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkrec.operators import gold, silver
from sparkrec.operators.contracts import SILVER_INTERACTIONS
from sparkrec.session import durable

SILVER_COLUMNS = SILVER_INTERACTIONS.names
TIES = ("product_id", "event_type", "rating")
COMPUTED_AT = datetime(2026, 1, 1)
DIMS = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog with some missing prices and brands, and rare brands."""
    key = F.col("p_partkey").cast("string")
    brand_size = F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(
        F.concat(F.lit("p"), key).alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.concat_ws(" > ", "p_type", "p_brand", F.replace(brand_size, F.lit("/"), F.lit(" "))).alias("category_path"),
        F.when(F.col("p_size") % 7 == 0, F.lit(None)).when(F.col("p_size") % 3 == 0, brand_size)
        .otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_retailprice").cast("decimal(12,2)")).alias("price"),
        F.concat(F.lit("img/"), key).alias("image_url"),
    )


PRODUCTS = """products AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_type AS category,
    p_type || ' > ' || p_brand || ' > ' || p_brand || ' ' || CAST(p_size AS VARCHAR) AS category_path,
    CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 3 = 0 THEN p_brand || '/' || CAST(p_size AS VARCHAR)
         ELSE p_brand END AS brand,
    CASE WHEN p_size % 10 <> 0 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS price,
    'img/' || CAST(p_partkey AS VARCHAR) AS image_url
  FROM part)"""


def bronze_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Every version of every interaction, with load id and ingest time."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    flag = F.col("l_returnflag")
    event = (
        F.when(flag == "A", "view").when(flag == "R", "rating")
        .when(F.col("l_linestatus") == "F", "purchase").otherwise("cart")
    )
    run = F.pmod("l_suppkey", F.lit(8))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("interaction_id"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("product_id"),
        event.alias("event_type"),
        F.when(flag == "R", 1 + F.col("l_quantity").cast("int") % 5).cast("decimal(2,1)").alias("rating"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.concat(F.lit("run-"), run.cast("string")).alias("_extraction_run_id"),
        (ntz("2026-01-01 00:00:00") + F.make_dt_interval(hours=run.cast("int"))).alias("_ingested_at"),
    )


BRONZE = """bronze AS (
  SELECT l_orderkey * 8 + l_linenumber AS interaction_id, 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
    'p' || CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_returnflag = 'A' THEN 'view' WHEN l_returnflag = 'R' THEN 'rating'
         WHEN l_linestatus = 'F' THEN 'purchase' ELSE 'cart' END AS event_type,
    CASE WHEN l_returnflag = 'R' THEN CAST(1 + CAST(l_quantity AS INT) % 5 AS DECIMAL(2,1)) END AS rating,
    o_orderdate AS event_time, o_orderdate AS created_at, l_shipdate AS updated_at,
    'run-' || CAST(l_suppkey % 8 AS VARCHAR) AS _extraction_run_id,
    TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(l_suppkey % 8 AS INT)) AS _ingested_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def latest_sql(source: str, where: str = "TRUE") -> str:
    columns = ", ".join(SILVER_COLUMNS)
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY interaction_id
      ORDER BY updated_at DESC, _ingested_at DESC, product_id DESC NULLS LAST,
        event_type DESC NULLS LAST, rating DESC NULLS LAST) AS rn FROM {source} WHERE {where}) WHERE rn = 1"""


def silver_interactions(spark: SparkSession, sf: str, bronze: DataFrame | None = None) -> DataFrame:
    source = bronze_interactions(spark, sf) if bronze is None else bronze
    return silver.latest_by_key(source, ["interaction_id"], SILVER_COLUMNS, TIES)


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as a stored table, for queries that read it more than once."""
    return durable(silver_interactions(spark, sf))


def user_table(spark: SparkSession, sf: str) -> DataFrame:
    """User sequences as a stored table."""
    return durable(user_sequences(spark, sf))


SILVER = f"silver AS ({latest_sql('bronze')})"


def bronze_products(spark: SparkSession, sf: str) -> DataFrame:
    """A version of the product per sale: the price changes with each."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    run = F.pmod("l_suppkey", F.lit(8)).cast("int")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("title"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_shipdate").alias("updated_at"),
        (ntz("2026-01-01 00:00:00") + F.make_dt_interval(hours=run)).alias("_ingested_at"),
    )


BRONZE_PRODUCTS = """bronze_products AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_type AS category, p_brand AS brand,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_shipdate AS updated_at,
    TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(l_suppkey % 8 AS INT)) AS _ingested_at
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def item_features(spark: SparkSession, sf: str, interactions: DataFrame | None = None) -> DataFrame:
    source = silver_interactions(spark, sf) if interactions is None else interactions
    return gold.item_features(products(spark, sf), source, F.lit(COMPUTED_AT).cast("timestamp_ntz"))


# counted per product and kind first, then set out as columns: an independent way to the same numbers
ITEM_FEATURES = """kinds AS (SELECT product_id, event_type, COUNT(*) AS n, AVG(CAST(rating AS DOUBLE)) AS mean, MAX(event_time) AS newest
    FROM silver GROUP BY ALL),
tallies AS (SELECT product_id, SUM(n) AS total, MAX(newest) AS newest, map_from_entries(list((event_type, n))) AS by_kind,
    map_from_entries(list((event_type, mean))) AS means FROM kinds GROUP BY product_id),
audiences AS (SELECT product_id, COUNT(*) AS people FROM (SELECT DISTINCT product_id, user_id FROM silver WHERE user_id IS NOT NULL) GROUP BY product_id),
items AS (
  SELECT products.*, CAST(COALESCE(total, 0) AS BIGINT) AS num_interactions,
    CAST(COALESCE(by_kind['view'], 0) AS BIGINT) AS num_views, CAST(COALESCE(by_kind['cart'], 0) AS BIGINT) AS num_cart_adds,
    CAST(COALESCE(by_kind['purchase'], 0) AS BIGINT) AS num_purchases, CAST(COALESCE(by_kind['rating'], 0) AS BIGINT) AS num_ratings,
    means['rating'] AS avg_rating, COALESCE(people, 0) AS distinct_users, newest AS last_interaction_at,
    TIMESTAMP '2026-01-01 00:00:00' AS computed_at
  FROM products LEFT JOIN tallies USING (product_id) LEFT JOIN audiences USING (product_id))"""


def user_sequences(spark: SparkSession, sf: str, interactions: DataFrame | None = None) -> DataFrame:
    source = silver_interactions(spark, sf) if interactions is None else interactions
    return gold.user_sequences(source)


def sequences_sql(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT user_id, array_agg(product_id ORDER BY event_time, interaction_id) AS item_sequence,
    array_agg(event_time ORDER BY event_time, interaction_id) AS event_time_sequence,
    CAST(COUNT(*) AS INT) AS sequence_length, MAX(event_time) AS last_event_time
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, interaction_id DESC) AS rn
        FROM {source}) WHERE rn <= 10 GROUP BY user_id)"""


USERS = sequences_sql("silver", "users")


def events(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    """Raw stream: some event types and ratings break the intake rules."""
    source = table(spark, sf, "events") if raw is None else raw
    kind, value = F.col("event_type"), F.col("value")
    return source.select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("p"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.when(kind == "click", "cart").when(kind == "signup", "rating").otherwise(kind).alias("event_type"),
        F.when((kind == "signup") & (value > 5), F.round(value / 20, 1))
        .when((kind == "click") & (value > 300), 3.0).alias("rating"),
        "ts",
    )


EVENTS = """stream AS (
  SELECT event_id, 'u' || CAST(user_id AS VARCHAR) AS user_id,
    'p' || json_extract_string(props, '$.k') AS product_id,
    CASE WHEN event_type = 'click' THEN 'cart' WHEN event_type = 'signup' THEN 'rating' ELSE event_type END AS event_type,
    CASE WHEN event_type = 'signup' AND value > 5 THEN round(value / 20, 1)
         WHEN event_type = 'click' AND value > 300 THEN 3.0 END AS rating, ts
  FROM events)"""


def request_log(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    """Requests: path = event type, errors are 5xx, latency in seconds, cache looked up on views and clicks."""
    source = table(spark, sf, "events") if raw is None else raw
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return source.select(
        "ts", kind.alias("path"),
        F.when((kind == "error") | (k < 5), 500).otherwise(200).alias("status"),
        (F.col("value") / 1000).alias("latency"),
        F.when(kind.isin("view", "click"), F.when(k < 60, "hit").otherwise("miss")).alias("cache"),
    )


REQUESTS = """requests AS (
  SELECT ts, event_type AS path,
    CASE WHEN event_type = 'error' OR CAST(json_extract_string(props, '$.k') AS INT) < 5 THEN 500 ELSE 200 END AS status,
    value / 1000 AS latency,
    CASE WHEN event_type IN ('view', 'click') THEN
      CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 60 THEN 'hit' ELSE 'miss' END END AS cache
  FROM events)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(item_idx, product_id, vec): the item table of a model that knows part of the catalog."""
    return table(spark, sf, "embeddings").select(
        (F.col("vec_id") + 1).alias("item_idx"),
        F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("product_id"),
        F.col("embedding").alias("vec"),
    )


VECTORS = """h AS (
  SELECT vec_id + 1 AS item_idx, 'p' || CAST(vec_id AS VARCHAR) AS product_id,
    CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"""

# last known item of each user's sequence
STATES = """known AS (
  SELECT s.user_id, s.pos, h.vec FROM
    (SELECT user_id, unnest(item_sequence) AS product_id, generate_subscripts(item_sequence, 1) AS pos FROM users) s
    JOIN h ON h.product_id = s.product_id),
states AS (SELECT user_id, arg_max(vec, pos) AS state FROM known GROUP BY user_id)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
