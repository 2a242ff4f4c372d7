"""Scans, sinks, contracts, source mapping and Silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from sparkrec.functions import text
from sparkrec.operators import contracts, ingest, maintenance, silver
from sparkrec.plans import inputs as I
from sparkrec.plans.inputs import with_
from sparkrec.plans.registry import query
from sparkrec.session import durable, scratch_dir
from sparkrec.sources import incremental, sinks, staging
from sparkrec.sources.bronze import Bronze
from sparkrec.sources.tables import Table, append, sync_silver

AT = datetime(2026, 1, 2)
KEY = ["interaction_id"]
BRONZE_COLUMNS = "interaction_id, product_id, event_type, updated_at, _extraction_run_id"


def _bronze_rows(df: DataFrame) -> DataFrame:
    return df.select("interaction_id", "product_id", "event_type", "updated_at", "_extraction_run_id")


# ------------------------------------------------------------------ scans
@query("a1_incremental_scan", with_(I.BRONZE) + f"""
SELECT {BRONZE_COLUMNS} FROM bronze WHERE updated_at > TIMESTAMP '1999-01-01 00:00:00'""")
def _(spark, sf):
    return _bronze_rows(incremental.incremental_scan(
        I.bronze_interactions(spark, sf), "updated_at", I.ntz("1999-01-01 00:00:00")))


@query("a2_keyset_page", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-06-01 00:00:00', 5000)
ORDER BY o_orderdate, o_orderkey LIMIT 500""")
def _(spark, sf):
    source = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return incremental.keyset_after(source, "o_orderdate", "o_orderkey", (I.ntz("1998-06-01 00:00:00"), 5000), 500)


@query("a3_cursor_advance", """
SELECT 'run-1' AS load, COUNT(*) AS rows, MAX(o_orderdate) AS last_value FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
UNION ALL SELECT 'run-2', COUNT(*), MAX(o_orderdate) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'
  AND o_orderdate > (SELECT MAX(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01')""")
def _(spark, sf):
    source, root = I.table(spark, sf, "orders"), scratch_dir(spark)
    state = Table(spark, f"{root}/cursor")
    early = source.filter(F.col("o_orderdate") <= I.ntz("1998-01-01 00:00:00"))
    incremental.extract(early, f"{root}/staging", state, "o_orderdate", AT, "run-1")
    incremental.extract(source, f"{root}/staging", state, "o_orderdate", AT, "run-2")
    return spark.read.parquet(f"{root}/staging").groupBy("load").agg(
        F.count("*").alias("rows"), F.max("o_orderdate").alias("last_value"))


# a quarter of the files each: no price, whole prices, prices as doubles, as decimals
PRICED = contracts.Contract("staged products", tuple(
    f for f in contracts.BRONZE_PRODUCTS.fields if f.name in ("product_id", "title", "category", "price")), "product_id")


@query("a4_read_staging", with_(I.PRODUCTS) + """
SELECT product_id, title, category, CASE CAST(substr(product_id, 2) AS BIGINT) % 4 WHEN 0 THEN NULL
  WHEN 1 THEN CAST(floor(price) AS DECIMAL(12,2)) ELSE price END AS price FROM products""")
def _(spark, sf):
    path = scratch_dir(spark)
    rows = I.products(spark, sf).select("product_id", "title", "category", "price")
    part = F.substring("product_id", 2, 20).cast("long") % 4
    for at, price in enumerate((None, F.floor("price").cast("int"), F.col("price").cast("double"), F.col("price"))):
        load = rows.filter(part == at)
        load = load.drop("price") if price is None else load.withColumn("price", price)
        load.withColumn("_load", F.lit(at)).write.parquet(f"{path}/load={at}")
    return staging.read_staging(spark, path, PRICED)


@query("a5_projected_scan", "SELECT l_orderkey, l_partkey FROM lineitem")
def _(spark, sf):
    return I.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")


@query("a6_filtered_scan", with_(I.BRONZE) + f"""
SELECT {BRONZE_COLUMNS} FROM bronze WHERE _ingested_at > TIMESTAMP '2026-01-01 03:00:00'
  AND user_id IN (SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) FROM events)""")
def _(spark, sf):
    users = I.events(spark, sf).select("user_id").distinct()
    fresh = silver.after_watermark(I.bronze_interactions(spark, sf), "2026-01-01 03:00:00")
    return _bronze_rows(fresh.join(users, "user_id", "left_semi"))


@query("a7_read_as_of", with_(I.BRONZE) + """
SELECT 'snapshot' AS source, * FROM bronze WHERE _extraction_run_id < 'run-4'
UNION ALL SELECT 'current', * FROM bronze""")
def _(spark, sf):
    bronze = I.bronze_interactions(spark, sf)
    history = Table(spark, scratch_dir(spark))
    history.overwrite(bronze.filter("_extraction_run_id < 'run-4'"), AT)
    history.overwrite(bronze, AT)
    out = None
    for asked in (1, 99):  # 99 was never written: the current version answers
        rows, source, _version = history.read_as_of(asked)
        part = rows.withColumn("source", F.lit(source))
        out = part if out is None else out.unionByName(part)
    return out


@query("a8_append", with_(I.BRONZE) + "SELECT * FROM bronze")
def _(spark, sf):
    bronze, path = I.bronze_interactions(spark, sf), scratch_dir(spark)
    schema = contracts.BRONZE_INTERACTIONS.schema
    append(bronze.filter("_extraction_run_id < 'run-4'"), path, schema)
    append(bronze.filter("_extraction_run_id >= 'run-4'"), path, schema)
    return spark.read.parquet(path)


@query("a9_overwrite", with_(I.PRODUCTS) + "SELECT product_id, category, price FROM products")
def _(spark, sf):
    catalog = Table(spark, scratch_dir(spark))
    catalog.overwrite(I.products(spark, sf).select("product_id", "category", F.lit(None).cast("decimal(12,2)").alias("price")), AT)
    catalog.overwrite(I.products(spark, sf).select("product_id", "category", "price"), AT)
    return catalog.read()


@query("a10_export_snapshot", with_(I.PRODUCTS) + """
SELECT product_id, CAST(price AS DOUBLE) AS price, brand FROM products""")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.export_snapshot(I.products(spark, sf), path)
    return spark.read.parquet(path).select("product_id", "price", "brand")


@query("a12_reports", """
SELECT o_orderpriority AS name, COUNT(*) AS rows FROM orders GROUP BY o_orderpriority""")
def _(spark, sf):
    root, orders = scratch_dir(spark), I.table(spark, sf, "orders")
    counts = orders.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("rows"))
    sinks.save_report(counts.withColumn("rows", F.lit(0)), root, "priorities", datetime(2026, 1, 1, 9))
    sinks.save_report(counts, root, "priorities", datetime(2026, 1, 1, 10))
    return sinks.latest_report(spark, root, "priorities", "name string, rows long")


@query("a13_read_typed_tsv", """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS item_id, CAST(event_id AS DOUBLE) AS timestamp FROM events""")
def _(spark, sf):
    path = scratch_dir(spark)
    I.table(spark, sf, "events").select(
        F.col("user_id").alias("user_id:token"), F.col("event_id").alias("item_id:token"),
        F.col("event_id").cast("double").alias("timestamp:float"), F.col("value").alias("value:float"),
    ).write.csv(path, sep="\t", header=True)
    return staging.read_inter(spark, path)


@query("a14_read_item_metadata", with_(I.PRODUCTS) + """
SELECT product_id AS item_id, title, category AS main_category, brand AS store, CAST(price AS VARCHAR) AS price
FROM products WHERE product_id IN (SELECT 'p' || CAST(vec_id AS VARCHAR) FROM embeddings)""")
def _(spark, sf):
    path = scratch_dir(spark)
    I.products(spark, sf).select(
        F.col("product_id").alias("parent_asin"), "title", F.col("category").alias("main_category"),
        text.split_category_path("category_path").alias("categories"), F.col("brand").alias("store"),
        F.col("price").cast("string").alias("price"), F.lit(4.5).alias("average_rating"),
    ).write.json(path)
    meta = staging.read_meta(spark, path, I.vectors(spark, sf), "product_id")
    return staging.drop_leaky(meta).select(
        F.col("parent_asin").alias("item_id"), "title", "main_category", "store", "price")


PAIRS = """pairs AS (SELECT o_custkey, l_partkey, COUNT(*) AS n, MIN(o_orderdate) AS first_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""


@query("a15_insert_if_absent", with_(I.BRONZE) + """
SELECT COUNT(*) FILTER (WHERE NOT present AND place = 1) AS rows_inserted, COUNT(*) FILTER (WHERE present OR place > 1) AS rows_skipped FROM (
  SELECT row_number() OVER (PARTITION BY user_id, product_id ORDER BY updated_at, interaction_id) AS place, (user_id, product_id) IN (SELECT (user_id, product_id) FROM bronze WHERE updated_at <= TIMESTAMP '1999-01-01') AS present
  FROM bronze WHERE updated_at > TIMESTAMP '1999-01-01')""")
def _(spark, sf):
    bronze = I.bronze_interactions(spark, sf)
    cut = I.ntz("1999-01-01 00:00:00")
    return ingest.insert_counts(ingest.insert_if_absent(
        bronze.filter(F.col("updated_at") <= cut), bronze.filter(F.col("updated_at") > cut), ["user_id", "product_id"],
        ["updated_at", "interaction_id"]))


@query("a16_batch_stats", with_(I.BRONZE) + """
SELECT COUNT(*) AS rows, round(AVG(CAST(rating AS DOUBLE)), 6) AS mean_rating,
  round(AVG(CASE WHEN product_id IN (SELECT product_id FROM bronze WHERE updated_at <= TIMESTAMP '1995-06-01') THEN 0.0 ELSE 1.0 END), 6)
  AS unseen_share FROM bronze WHERE updated_at > TIMESTAMP '1995-06-01'""")
def _(spark, sf):
    bronze, root = I.bronze_interactions(spark, sf), scratch_dir(spark)
    cut = I.ntz("1995-06-01 00:00:00")
    late = bronze.filter(F.col("updated_at") > cut)
    late.filter("rating IS NULL").drop("rating").write.parquet(f"{root}/a")
    late.filter("rating IS NOT NULL").write.parquet(f"{root}/b")
    batch = staging.read_batches(spark, f"{root}/a", f"{root}/b")
    out = ingest.batch_stats(batch, bronze.filter(F.col("updated_at") <= cut), "product_id", "rating")
    return out.select("rows", F.round("mean_rating", 6).alias("mean_rating"), F.round("unseen_share", 6).alias("unseen_share"))


@query("a17_drop_unknown", with_(I.BRONZE, I.VECTORS) + """
SELECT COUNT(h.product_id) AS rows_kept, COUNT(*) - COUNT(h.product_id) AS rows_dropped
FROM bronze LEFT JOIN h ON h.product_id = bronze.product_id""")
def _(spark, sf):
    return ingest.unknown_counts(I.bronze_interactions(spark, sf), I.vectors(spark, sf), "product_id")


@query("a18_query_view", """
SELECT l_returnflag, COUNT(*) AS n, round(SUM(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf):
    return staging.query_view(
        I.table(spark, sf, "lineitem"),
        "SELECT l_returnflag, COUNT(*) AS n, round(SUM(l_quantity), 2) AS quantity FROM {t} GROUP BY l_returnflag")


@query("a19_baseline", with_(I.BRONZE) + """
SELECT 'train' AS source, product_id AS parent_asin, CAST(rating AS DOUBLE) AS rating FROM bronze WHERE _extraction_run_id < 'run-4'
UNION ALL SELECT 'current', product_id, CAST(rating AS DOUBLE) FROM bronze""")
def _(spark, sf):
    root = scratch_dir(spark)
    bronze = I.bronze_interactions(spark, sf).select(
        F.col("product_id").alias("parent_asin"), F.col("rating").cast("double").alias("rating"), "_extraction_run_id")
    bronze.filter("_extraction_run_id < 'run-4'").drop("_extraction_run_id").write.parquet(f"{root}/train")

    def facts():
        rows, info = sinks.read_baseline(spark, root)
        return rows.withColumn("source", F.lit(info["source"]))

    before = facts()
    sinks.write_baseline(bronze.drop("_extraction_run_id"), root, "7", 1, "silver_snapshot", AT)
    return before.unionByName(facts())


@query("a20_record_lineage", with_(I.BRONZE, I.SILVER) + """
SELECT 'run-x' AS run_id, 'silver' AS table_name, 1 AS version, COUNT(*) AS rows FROM silver
UNION ALL SELECT 'run-x', 'products', 2, COUNT(*) FROM part""")
def _(spark, sf):
    root = scratch_dir(spark)
    stored, catalog = Table(spark, f"{root}/silver"), Table(spark, f"{root}/products")
    stored.overwrite(I.silver_interactions(spark, sf), AT)
    catalog.overwrite(I.products(spark, sf), AT)
    catalog.overwrite(I.products(spark, sf), AT)
    sinks.record_lineage(spark, f"{root}/lineage", "run-x", {"silver": stored, "products": catalog})
    return spark.read.parquet(f"{root}/lineage")


# ------------------------------------------------------------------ contracts
RULED = contracts.Contract(
    "events",
    (
        contracts.Field("event_id", T.LongType(), unique=True),
        contracts.Field("user_id", T.StringType()),
        contracts.Field("product_id", T.StringType()),
        contracts.Field("event_type", T.StringType(), rules=(contracts.one_of(*contracts.EVENT_TYPES),)),
        contracts.Field("rating", T.DoubleType(), nullable=True, rules=(contracts.in_range(1, 5),)),
    ),
    "event_id",
)
FAILURES = """failures AS (
  SELECT 'event_type' AS column_name, 'one_of' AS check_name, event_id FROM stream
    WHERE event_type NOT IN ('view', 'cart', 'purchase', 'rating')
  UNION ALL SELECT 'rating', 'in_range_1_5', event_id FROM stream WHERE rating < 1 OR rating > 5)"""


@query("b1_validate", with_(I.EVENTS, FAILURES) + """
SELECT column_name, check_name, CAST(event_id AS VARCHAR) AS row_key, CAST(1 AS BIGINT) AS n FROM failures""")
def _(spark, sf):
    return contracts.failures(I.events(spark, sf).drop("ts"), RULED)


# two builds of four loads each, and a third that finds nothing new
@query("b1_bronze_build", with_(I.BRONZE, I.VECTORS) + """
SELECT * REPLACE (CASE WHEN _extraction_run_id < 'run-4' THEN TIMESTAMP '2026-01-02' ELSE TIMESTAMP '2026-01-03' END AS _ingested_at),
  product_id IN (SELECT product_id FROM h) AS good FROM bronze""")
def _(spark, sf):
    root, known = scratch_dir(spark), I.vectors(spark, sf)
    loads = I.bronze_interactions(spark, sf).withColumnRenamed("_extraction_run_id", "_load_id").drop("_ingested_at")
    target = Bronze(spark, f"{root}/bronze", contracts.BRONZE_INTERACTIONS)
    references = {"product_id": (known, "product_id")}
    early = F.col("_load_id") < "run-4"
    unrated = loads.filter(early & F.col("rating").isNull()).drop("rating")  # an all-NULL column is not staged
    rated = loads.filter(early & F.col("rating").isNotNull()).withColumn("rating", F.col("rating").cast("int"))
    unrated.write.parquet(f"{root}/staging/a")
    rated.write.parquet(f"{root}/staging/b")
    target.build(f"{root}/staging", datetime(2026, 1, 2), references)
    loads.filter(~early).write.parquet(f"{root}/staging/c")
    target.build(f"{root}/staging", datetime(2026, 1, 3), references)
    again = target.build(f"{root}/staging", datetime(2026, 1, 4), references)
    if again["load_ids_committed"]:
        raise RuntimeError(f"loads committed twice: {again}")
    good, bad = target.read().withColumn("good", F.lit(True)), target.rejected().drop("failures").withColumn("good", F.lit(False))
    out = good.unionByName(bad)
    return out.select(*[F.col(f.name).cast("timestamp_ntz") if f.dataType == T.TimestampType() else F.col(f.name) for f in out.schema])


@query("b2_checks", with_(I.BRONZE) + """
SELECT 'interaction_id' AS column_name, 'unique' AS check_name, CAST(interaction_id AS VARCHAR) AS row_key, COUNT(*) AS n
FROM bronze GROUP BY interaction_id HAVING COUNT(*) > 1""")
def _(spark, sf):
    bronze = I.bronze_interactions(spark, sf).select(*contracts.SILVER_INTERACTIONS.names)
    return contracts.failures(bronze, contracts.SILVER_INTERACTIONS)


@query("b3_rating_rule", with_(I.EVENTS) + """
SELECT event_id, event_type, rating FROM stream WHERE (event_type = 'rating') <> (rating IS NOT NULL)""")
def _(spark, sf):
    return I.events(spark, sf).filter(~contracts.rating_matches_event()).select("event_id", "event_type", "rating")


@query("b4_unknown_references", with_(I.BRONZE, I.VECTORS) + """
SELECT interaction_id, product_id FROM bronze WHERE product_id NOT IN (SELECT product_id FROM h)""")
def _(spark, sf):
    return contracts.unknown_references(
        I.bronze_interactions(spark, sf).select("interaction_id", "product_id"), "product_id",
        I.vectors(spark, sf), "product_id")


@query("b5_fill_missing_optional", with_(I.PRODUCTS) + """
SELECT product_id, title, brand, CAST(NULL AS VARCHAR) AS description FROM products""")
def _(spark, sf):
    filled = contracts.fill_missing_optional(I.products(spark, sf), contracts.SILVER_PRODUCTS)
    return filled.select("product_id", "title", "brand", "description")


@query("b6_conform", with_(I.EVENTS) + """
SELECT event_id, user_id, product_id, event_type, CAST(rating AS DOUBLE) AS rating FROM stream""")
def _(spark, sf):
    return contracts.conform(I.events(spark, sf), RULED)


@query("b7_skip_committed", with_(I.BRONZE) + f"""
SELECT {BRONZE_COLUMNS} FROM bronze WHERE _extraction_run_id NOT IN ('run-0', 'run-1', 'run-2')""")
def _(spark, sf):
    bronze = I.bronze_interactions(spark, sf)
    committed = bronze.filter("_extraction_run_id < 'run-3'")
    return _bronze_rows(ingest.skip_committed(bronze, committed))


@query("b8_stamp_lineage", """
SELECT o_orderkey, 'load-9' AS _extraction_run_id, TIMESTAMP '2026-01-02 00:00:00' AS _ingested_at FROM orders""")
def _(spark, sf):
    stamped = contracts.stamp_lineage(I.table(spark, sf, "orders").select("o_orderkey"), "load-9", AT)
    return stamped.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


# ------------------------------------------------------------------ source mapping and cleaning
SP = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
# every document is a product whose words and lines stand in for raw catalog fields
RAW = rf"""raw AS (SELECT doc_id, text, lang, source,
  CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '  ' ELSE '  ' || source || '  ' || lang END AS main_category,
  CASE WHEN doc_id % 5 = 0 THEN CAST([] AS VARCHAR[]) ELSE string_split(text, chr(10)) END AS categories FROM documents)"""


def _raw(spark, sf):
    doc = F.col("doc_id")
    return I.table(spark, sf, "documents").select(
        "doc_id", "text", "lang", "source",
        F.when(doc % 3 == 1, "  ").when(doc % 3 == 2, F.concat(F.lit("  "), "source", F.lit("  "), "lang")).alias("main_category"),
        F.when(doc % 5 == 0, F.array().cast("array<string>")).otherwise(F.split("text", "\n")).alias("categories"),
    )


def _md5(c):
    return F.md5(c.cast("binary"))


@query("b9_source_category", with_(RAW) + rf"""
SELECT doc_id, md5(COALESCE(CASE WHEN regexp_replace(main_category, '^{SP}+|{SP}+$', '', 'g') <> '' THEN main_category END,
  categories[1], 'unknown')) AS category FROM raw""")
def _(spark, sf):
    return _raw(spark, sf).select("doc_id", _md5(text.source_category("main_category", "categories")).alias("category"))


SQL_COLLAPSE = rf"trim(regexp_replace(x, '{SP}+', ' ', 'g'), ' ')"


@query("b10_category_path", with_(RAW) + rf"""
SELECT doc_id, md5(nullif(array_to_string(list_filter(list_transform(categories, lambda x: {SQL_COLLAPSE}), lambda x: x <> ''), ' > '), ''))
  AS category_path FROM raw""")
def _(spark, sf):
    return _raw(spark, sf).select("doc_id", _md5(text.category_path("categories")).alias("category_path"))


@query("b11_split_category_path", with_(I.PRODUCTS) + """
SELECT product_id, array_to_string(string_split(category_path, ' > '), '|') AS levels FROM products""")
def _(spark, sf):
    return I.products(spark, sf).select(
        "product_id", F.array_join(text.split_category_path("category_path"), "|").alias("levels"))


@query("b12_epoch_millis", """
SELECT event_id, date_trunc('millisecond', ts) AS event_time, round(value, 2) AS price FROM events""")
def _(spark, sf):
    events = I.table(spark, sf, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return events.select(
        "event_id", text.from_epoch_millis("ms").cast("timestamp_ntz").alias("event_time"), F.round("value", 2).alias("price"))


@query("b13_clean", rf"""
SELECT doc_id, md5(nullif({SQL_COLLAPSE.replace('(x,', '(text,')}, '')) AS cleaned FROM documents""")
def _(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", _md5(text.clean("text")).alias("cleaned"))


SQL_CLEAN_LIST = rf"list_filter(list_transform(categories, lambda x: {SQL_COLLAPSE}), lambda x: x <> '')[1:3]"
SQL_MAIN = SQL_COLLAPSE.replace("(x,", "(main_category,")
SQL_RAW = f"""CASE WHEN len({SQL_CLEAN_LIST}) > 0 THEN {SQL_CLEAN_LIST}
  WHEN nullif({SQL_MAIN}, '') IS NOT NULL THEN [{SQL_MAIN}] ELSE CAST([] AS VARCHAR[]) END"""


@query("b14_raw_categories", with_(RAW) + f"""
SELECT doc_id, CAST(len(c) AS INT) AS levels, md5(array_to_string(c, '|')) AS categories FROM (SELECT doc_id, {SQL_RAW} AS c FROM raw)""")
def _(spark, sf):
    levels = text.raw_categories("categories", "main_category")
    return _raw(spark, sf).select("doc_id", levels.alias("c")).select(
        "doc_id", F.size("c").alias("levels"), _md5(F.array_join("c", "|")).alias("categories"))


@query("b15_parse_price", """
WITH raw AS (SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN ' $' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ' '
       WHEN o_orderpriority = '5-LOW' THEN 'from ' || CAST(o_orderkey AS VARCHAR)
       WHEN o_orderstatus = 'O' THEN CAST(CAST(floor(o_totalprice / 1000) AS INT) AS VARCHAR) || ',' || '005'
       ELSE '-' || CAST(o_orderkey AS VARCHAR) END AS price FROM orders)
SELECT o_orderkey, CASE WHEN TRY_CAST(trim(replace(replace(price, '$', ''), ',', '')) AS DOUBLE) > 0
  THEN TRY_CAST(trim(replace(replace(price, '$', ''), ',', '')) AS DOUBLE) END AS price FROM raw""")
def _(spark, sf):
    key, total = F.col("o_orderkey").cast("string"), F.col("o_totalprice")
    raw = (
        F.when(F.col("o_orderstatus") == "P",
               F.concat(F.lit(" $"), total.cast("decimal(12,2)").cast("string"), F.lit(" ")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("from "), key))
        .when(F.col("o_orderstatus") == "O", F.concat(F.floor(total / 1000).cast("int").cast("string"), F.lit(",005")))
        .otherwise(F.concat(F.lit("-"), key))
    )
    return I.table(spark, sf, "orders").select("o_orderkey", text.parse_price(raw).alias("price"))


@query("b16_item_text", with_(RAW) + rf"""
SELECT doc_id, md5(concat_ws(' | ', nullif({SQL_COLLAPSE.replace('(x,', '(lang,')}, ''), nullif(array_to_string({SQL_RAW}, ' > '), '')))
  AS item_text FROM raw""")
def _(spark, sf):
    levels = text.raw_categories("categories", "main_category")
    return _raw(spark, sf).select("doc_id", _md5(text.item_text("lang", levels)).alias("item_text"))


SQL_DESCRIPTION = "CASE WHEN price IS NOT NULL THEN category || ' · $' || CAST(price AS VARCHAR) ELSE category END"


@query("b17_display_description", with_(I.PRODUCTS) + f"SELECT product_id, {SQL_DESCRIPTION} AS description FROM products")
def _(spark, sf):
    return I.products(spark, sf).select("product_id", text.display_description("category", "price").alias("description"))


@query("b18_split_description", with_(I.PRODUCTS) + """
SELECT product_id, category, COALESCE('$' || CAST(price AS VARCHAR), '') AS price FROM products""")
def _(spark, sf):
    described = I.products(spark, sf).select(
        "product_id", text.split_description(text.display_description("category", "price")).alias("d"))
    return described.select("product_id", "d.category", "d.price")


# ------------------------------------------------------------------ silver
@query("c1_latest_products", with_(I.BRONZE_PRODUCTS) + """
SELECT product_id, title, category, brand, price, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY product_id
  ORDER BY updated_at DESC, _ingested_at DESC, price DESC NULLS LAST) AS rn FROM bronze_products) WHERE rn = 1""")
def _(spark, sf):
    return silver.latest_by_key(I.bronze_products(spark, sf), ["product_id"],
                                ["product_id", "title", "category", "brand", "price", "updated_at"], ["price"])


@query("c2_latest_interactions", with_(I.BRONZE, I.SILVER) + "SELECT * FROM silver")
def _(spark, sf):
    return I.silver_interactions(spark, sf)


@query("c3_watermark", with_(I.BRONZE) + """
SELECT strftime(MAX(_ingested_at), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS watermark FROM bronze""")
def _(spark, sf):
    latest = I.bronze_interactions(spark, sf).agg(F.max("_ingested_at").cast("timestamp").alias("w"))
    return latest.select(F.lit(silver.format_watermark(latest.first().w)).alias("watermark"))


STORED = f"stored AS ({I.latest_sql('bronze', '''_ingested_at <= TIMESTAMP '2026-01-01 03:00:00' ''')})"
DELTA = f"delta AS ({I.latest_sql('bronze', '''_ingested_at > TIMESTAMP '2026-01-01 03:00:00' ''')})"
MARK = "2026-01-01 03:00:00"


def _stored_and_delta(spark, sf, bronze=None):
    bronze = I.bronze_interactions(spark, sf) if bronze is None else bronze
    stored = I.silver_interactions(spark, sf, bronze.filter(F.col("_ingested_at") <= I.ntz(MARK)))
    delta = I.silver_interactions(spark, sf, silver.after_watermark(bronze, MARK))
    return stored, delta


@query("c4_drop_stale", with_(I.BRONZE, STORED, DELTA) + """
SELECT d.* FROM delta d LEFT JOIN stored s ON s.interaction_id = d.interaction_id
WHERE s.updated_at IS NULL OR d.updated_at > s.updated_at""")
def _(spark, sf):
    stored, delta = _stored_and_delta(spark, sf)
    return silver.drop_stale(delta, stored, "interaction_id").select(*I.SILVER_COLUMNS)


MERGED = """merged AS (
  SELECT s.interaction_id AS old_key, d.interaction_id AS new_key,
    CASE WHEN d.interaction_id IS NULL THEN 'kept' WHEN s.interaction_id IS NULL THEN 'inserted'
         WHEN d.updated_at <= s.updated_at THEN 'stale'
         WHEN s IS NOT DISTINCT FROM d THEN 'unchanged' ELSE 'updated' END AS change
  FROM stored s FULL OUTER JOIN delta d ON s.interaction_id = d.interaction_id)"""


@query("c5_upsert", with_(I.BRONZE, STORED, DELTA, MERGED) + """
SELECT s.*, m.change FROM merged m JOIN stored s ON s.interaction_id = m.old_key WHERE change IN ('kept', 'stale')
UNION ALL SELECT d.*, m.change FROM merged m JOIN delta d ON d.interaction_id = m.new_key WHERE change NOT IN ('kept', 'stale')""")
def _(spark, sf):
    stored, delta = _stored_and_delta(spark, sf)
    return silver.merge(stored, delta, "interaction_id")


# a load of three orders' corrections touches few buckets; the others keep their files
@query("c5_touched_buckets", with_(I.BRONZE, I.SILVER) + """,
fixes AS (SELECT * REPLACE (updated_at + INTERVAL 100 DAY AS updated_at, CAST(5 AS DECIMAL(2,1)) AS rating)
  FROM silver WHERE interaction_id // 8 IN (SELECT DISTINCT interaction_id // 8 FROM silver ORDER BY 1 LIMIT 3)),
added AS (SELECT * REPLACE (-interaction_id AS interaction_id) FROM fixes)
SELECT *, 'kept' AS change FROM silver WHERE interaction_id NOT IN (SELECT interaction_id FROM fixes)
UNION ALL SELECT *, 'updated' FROM fixes UNION ALL SELECT *, 'inserted' FROM added""")
def _(spark, sf):
    target, rows = Table(spark, scratch_dir(spark), "interaction_id"), durable(I.silver_interactions(spark, sf))
    target.overwrite(rows, AT)
    order = F.shiftright("interaction_id", 3)
    few = rows.select(order.alias("o")).distinct().orderBy("o").limit(3)
    fixes = rows.join(F.broadcast(few), order == F.col("o"), "left_semi").withColumn(
        "updated_at", F.col("updated_at") + F.make_dt_interval(days=F.lit(100))).withColumn("rating", F.lit(5).cast("decimal(2,1)"))
    added = fixes.withColumn("interaction_id", -F.col("interaction_id"))
    fixes, added = durable(fixes), durable(added)
    target.merge(fixes.unionByName(added), AT)
    keys = fixes.select("interaction_id", F.lit("updated").alias("label")).unionByName(
        added.select("interaction_id", F.lit("inserted").alias("label")))
    return target.read().join(F.broadcast(keys), "interaction_id", "left").withColumn(
        "change", F.coalesce("label", F.lit("kept"))).drop("label")


@query("c6_full_refresh", with_(I.BRONZE, I.SILVER) + "SELECT * FROM silver")
def _(spark, sf):
    target, bronze = Table(spark, scratch_dir(spark)), durable(I.bronze_interactions(spark, sf))  # Bronze is a table
    options = {"order_ties": I.TIES, "contract": contracts.SILVER_INTERACTIONS}
    sync_silver(bronze.filter(F.col("_ingested_at") <= I.ntz(MARK)), target, "interaction_id", I.SILVER_COLUMNS, AT, **options)
    sync_silver(bronze, target, "interaction_id", I.SILVER_COLUMNS, AT, full_refresh=True, **options)
    return target.read()


@query("c7_sync_counters", with_(I.BRONZE, STORED, DELTA, MERGED) + """
SELECT 'incremental' AS mode, (SELECT COUNT(*) FROM bronze WHERE _ingested_at > TIMESTAMP '2026-01-01 03:00:00') AS rows_scanned,
  COUNT(*) FILTER (WHERE change = 'inserted') AS rows_inserted, COUNT(*) FILTER (WHERE change = 'updated') AS rows_updated,
  COUNT(*) FILTER (WHERE change IN ('inserted', 'updated')) AS rows_upserted,
  COUNT(*) FILTER (WHERE change = 'stale') AS rows_skipped_stale,
  COUNT(*) FILTER (WHERE change IN ('inserted', 'updated', 'unchanged')) AS rows_after_dedup,
  '2026-01-01T03:00:00.000000+00:00' AS watermark_before, '2026-01-01T07:00:00.000000+00:00' AS watermark_after FROM merged""")
def _(spark, sf):
    target, bronze = Table(spark, scratch_dir(spark)), I.bronze_interactions(spark, sf)
    options = {"order_ties": I.TIES}
    sync_silver(bronze.filter(F.col("_ingested_at") <= I.ntz(MARK)), target, "interaction_id", I.SILVER_COLUMNS, AT, **options)
    report = sync_silver(bronze, target, "interaction_id", I.SILVER_COLUMNS, AT, **options)
    schema = ("mode string, rows_scanned long, rows_inserted long, rows_updated long, rows_upserted long, "
              "rows_skipped_stale long, rows_after_dedup long, watermark_before string, watermark_after string")
    return spark.createDataFrame([report], schema)


@query("c8_incremental_equals_full", with_(I.BRONZE, I.SILVER, STORED, DELTA, """
merged AS (SELECT COALESCE(d, s) AS r FROM
  (SELECT s AS s, CASE WHEN s.updated_at IS NULL OR d.updated_at >= s.updated_at THEN d END AS d
   FROM stored s FULL OUTER JOIN delta d ON s.interaction_id = d.interaction_id)),
inc AS (SELECT unnest(r) FROM merged)""") + """
SELECT (SELECT COUNT(*) FROM (SELECT * FROM inc EXCEPT ALL SELECT * FROM silver)) AS only_left,
  (SELECT COUNT(*) FROM (SELECT * FROM silver EXCEPT ALL SELECT * FROM inc)) AS only_right""")
def _(spark, sf):
    bronze = durable(I.bronze_interactions(spark, sf))  # read three times
    stored, delta = _stored_and_delta(spark, sf, bronze)
    merged = silver.merge(stored, delta, "interaction_id", silver.NEWEST_INGEST).drop("change")
    return silver.difference_counts(merged, I.silver_interactions(spark, sf, bronze))


@query("c9_compact", with_(I.BRONZE, I.SILVER) + """
SELECT 1 AS files, TRUE AS compacted, COUNT(*) AS rows, CAST(SUM(interaction_id) AS BIGINT) AS key_sum FROM silver""")
def _(spark, sf):
    target = Table(spark, scratch_dir(spark))
    target.overwrite(I.silver_interactions(spark, sf).repartition(8), AT)
    compacted = target.compact(AT)
    rows = target.read().agg(F.count("*").alias("rows"), F.sum("interaction_id").alias("key_sum"))
    return rows.select(F.lit(target.file_count()).alias("files"), F.lit(compacted).alias("compacted"), "rows", "key_sum")


# every order is a snapshot whose line parts are its files
@query("c10_expired_files", """
WITH snapshots AS (SELECT o_orderkey AS snapshot_id, o_orderdate AS committed_at,
    o_orderpriority = '1-URGENT' AS is_ref FROM orders),
files AS (SELECT DISTINCT l_orderkey AS snapshot_id, 'f' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS path FROM lineitem),
marked AS (SELECT f.path, s.committed_at < TIMESTAMP '2001-01-01' AND NOT s.is_ref AS expired FROM files f JOIN snapshots s USING (snapshot_id))
SELECT path FROM marked GROUP BY path HAVING bool_and(expired)""")
def _(spark, sf):
    snapshots = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("snapshot_id"), F.col("o_orderdate").alias("committed_at"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_ref"))
    files = I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("snapshot_id"), F.concat(F.lit("f"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("path"))
    return maintenance.expired_files(snapshots, files, I.ntz("2001-01-01 00:00:00"))
