"""Training samples, item attributes and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.functions import text
from sparkrec.operators import item_features, samples
from sparkrec.plans import inputs as I
from sparkrec.plans.inputs import with_
from sparkrec.plans.registry import query
from sparkrec.session import durable, scratch_dir

MAX_LEN = 6
VOCAB = "vocab AS (SELECT product_id, row_number() OVER (ORDER BY product_id) AS item_idx FROM (SELECT DISTINCT product_id FROM products))"
INDEXED = """indexed AS (
  SELECT user_id, list(item_idx ORDER BY pos) AS items FROM (
    SELECT user_id, unnest(item_sequence) AS product_id, generate_subscripts(item_sequence, 1) AS pos FROM users)
  JOIN vocab USING (product_id) GROUP BY user_id)"""
BASE = (I.PRODUCTS, I.BRONZE, I.SILVER, I.USERS, VOCAB, INDEXED)


def vocab(spark, sf):
    return samples.item_vocab(I.products(spark, sf))


def indexed(spark, sf, users=None):
    users = I.user_sequences(spark, sf) if users is None else users
    return samples.index_sequences(users, vocab(spark, sf))


@query("f1_item_vocab", with_(I.PRODUCTS, VOCAB) + "SELECT * FROM vocab")
def _(spark, sf):
    return vocab(spark, sf)


@query("f2_catalog_meta", with_(I.PRODUCTS) + """
SELECT product_id AS item_id, title, category AS main_category, category_path, brand AS store, price FROM products""")
def _(spark, sf):
    return samples.catalog_meta(I.products(spark, sf))


EXPLODED = """exploded AS (SELECT user_id, unnest(item_sequence) AS item_id, unnest(event_time_sequence) AS ts,
  CAST(generate_subscripts(item_sequence, 1) - 1 AS INT) AS pos FROM users)"""


@query("f3_explode_sequences", with_(I.BRONZE, I.SILVER, I.USERS, EXPLODED) + "SELECT * FROM exploded")
def _(spark, sf):
    return samples.explode_sequences(I.user_sequences(spark, sf))


@query("f4_two_way_split", with_(*BASE) + """
SELECT user_id, CASE WHEN t = len(items) - 1 THEN 'valid' ELSE 'train' END AS split, CAST(t AS INT) AS t,
  array_to_string(items[1:t], ',') AS seq, items[t + 1] AS target
FROM (SELECT user_id, items, unnest(range(1, len(items))) AS t FROM indexed WHERE len(items) >= 2)""")
def _(spark, sf):
    return samples.two_way_split(indexed(spark, sf)).withColumn("seq", F.array_join("seq", ","))


LOO = f"""loo AS (SELECT user_id, t, len(items) AS n, items[greatest(1, t - {MAX_LEN} + 1):t] AS prefix, items[t + 1] AS target
  FROM (SELECT user_id, items, unnest(range(1, len(items))) AS t FROM indexed WHERE len(items) >= 3))"""
SPLIT = "CASE WHEN t < n - 2 THEN 'train' WHEN t = n - 2 THEN 'valid' ELSE 'test' END"


def padded(prefix: str, width: int) -> str:
    return f"array_to_string(list_resize({prefix}, {width}, 0), ',')"


@query("f5_leave_one_out", with_(*BASE, LOO) + f"""
SELECT user_id, {SPLIT} AS split, CAST(t AS INT) AS t, {padded('prefix', MAX_LEN)} AS seq, CAST(len(prefix) AS INT) AS seq_len, target FROM loo""")
def _(spark, sf):
    return samples.leave_one_out(indexed(spark, sf), MAX_LEN).withColumn("seq", F.array_join("seq", ","))


@query("f5_leave_one_out_history", with_(I.EVENTS, f"""
placed AS (SELECT user_id, CAST(substr(product_id, 2) AS INT) + 1 AS item, row_number() OVER w - 1 AS t,
    COUNT(*) OVER (PARTITION BY user_id) AS n,
    list(CAST(substr(product_id, 2) AS INT) + 1) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS prefix
  FROM stream WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""") + f"""
SELECT user_id, {SPLIT} AS split, CAST(t AS INT) AS t, {padded('prefix', 20)} AS seq, CAST(len(prefix) AS INT) AS seq_len, item AS target
FROM placed WHERE n >= 3 AND t >= 1""")
def _(spark, sf):
    history = I.events(spark, sf).select(
        "user_id", "ts", "event_id", (F.substring("product_id", 2, 10).cast("int") + 1).alias("item_idx"))
    out = samples.leave_one_out_history(history, [F.asc("ts"), F.asc("event_id")], 20)
    return out.withColumn("seq", F.array_join("seq", ","))


@query("f6_truncate_pad", with_(*BASE) + f"""
SELECT user_id, {padded(f'items[greatest(1, len(items) - {MAX_LEN} + 1):]', MAX_LEN)} AS seq FROM indexed""")
def _(spark, sf):
    return indexed(spark, sf).select("user_id", F.array_join(samples.truncate_pad("items", MAX_LEN), ",").alias("seq"))


COUNTS = """counts AS (SELECT p.product_id AS item_id, COUNT(e.item_id) AS train_count FROM products p LEFT JOIN (
  SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, pos DESC) AS back FROM exploded)
  WHERE back > 2) e ON e.item_id = p.product_id GROUP BY p.product_id)"""


def train_counts(spark, sf, users=None):
    inter = samples.explode_sequences(I.user_table(spark, sf) if users is None else users)
    catalog = samples.catalog_meta(I.products(spark, sf))
    return samples.train_counts(inter, catalog, [F.desc("ts"), F.desc("pos")])


COUNTED = (I.PRODUCTS, I.BRONZE, I.SILVER, I.USERS, EXPLODED, COUNTS)


@query("f7_train_counts", with_(*COUNTED) + "SELECT * FROM counts")
def _(spark, sf):
    return train_counts(spark, sf)


@query("f8_popularity_signal", with_(*COUNTED) + """
SELECT item_id, train_count, round(CASE WHEN (SELECT MAX(train_count) FROM counts) > 0
  THEN ln(1 + train_count) / ln(1 + (SELECT MAX(train_count) FROM counts)) ELSE 0 END, 6) AS popularity FROM counts""")
def _(spark, sf):
    return samples.popularity_signal(durable(train_counts(spark, sf))).withColumn("popularity", F.round("popularity", 6))


PRICES = """edges AS (SELECT quantile_cont(CAST(price AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
  FROM products WHERE price > 0)"""
BUCKET = """CASE WHEN price > 0 THEN 'p' || CAST(len(list_filter((SELECT edges FROM edges), lambda e: e <= CAST(price AS DOUBLE))) AS VARCHAR)
  ELSE '[MISSING]' END"""


@query("f9_price_edges", with_(I.PRODUCTS, PRICES) + """
SELECT CAST(i AS INT) AS edge_no, round(edges[i], 6) AS edge FROM (SELECT edges, unnest(range(1, 10)) AS i FROM edges)""")
def _(spark, sf):
    edges = item_features.price_edges(I.products(spark, sf), "price")
    return edges.select(F.posexplode("edges").alias("pos", "edge")).select(
        (F.col("pos") + 1).alias("edge_no"), F.round("edge", 6).alias("edge"))


# a load's prices are sketched once and stored; each edge has the exact rank it stands for, but for a hundredth
@query("f9_sketched_edges", """
SELECT CAST(i AS INT) AS edge_no, (SELECT COUNT(*) FROM lineitem) AS prices, TRUE AS near FROM range(1, 10) t(i)""")
def _(spark, sf):
    path = scratch_dir(spark)
    sales = durable(I.bronze_products(spark, sf).select("price", "_ingested_at"))
    item_features.price_sketches(sales, "price", "_ingested_at").write.parquet(path)
    edges = item_features.sketched_edges(spark.read.parquet(path)).first().edges
    counts = sales.agg(F.count("*").alias("prices"), *[F.count_if(F.col("price") <= e).alias(f"e{i}") for i, e in enumerate(edges, 1)])
    each = F.posexplode(F.array(*[F.col(f"e{i}") for i in range(1, len(edges) + 1)])).alias("pos", "below")
    edge_no = F.col("pos") + 1
    return counts.select("prices", each).select(
        edge_no.alias("edge_no"), "prices", (F.abs(F.col("below") / F.col("prices") - edge_no / 10) <= 0.01).alias("near"))


@query("f10_price_bucket", with_(I.PRODUCTS, PRICES) + f"SELECT product_id, {BUCKET} AS price_bucket FROM products")
def _(spark, sf):
    products = I.products(spark, sf)
    edges = F.lit(item_features.price_edges(products, "price").first().edges)
    return products.select(
        "product_id", item_features.price_bucket(text.positive_price("price"), edges).alias("price_bucket"))


TOKENS = """tokens AS (SELECT product_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM (
    SELECT product_id, list_transform(string_split(category_path, ' > ')[1:3], lambda x: replace(x, ' ', '_')) AS toks FROM products)),
freq AS (SELECT token, COUNT(DISTINCT product_id) AS n FROM tokens GROUP BY token),
mapped AS (SELECT product_id, CASE WHEN n >= 5 THEN token ELSE '[UNK]' END AS token, MIN(pos) AS pos
  FROM tokens JOIN freq USING (token) GROUP BY ALL),
cats AS (SELECT product_id, string_agg(token, ' ' ORDER BY pos) AS categories FROM mapped GROUP BY product_id)"""
STORES = """stores AS (SELECT product_id, CASE WHEN brand IS NULL THEN '[MISSING]'
  WHEN COUNT(*) OVER (PARTITION BY brand) >= 5 THEN brand ELSE '[UNK]' END AS store FROM products)"""
FEATURES = (PRICES, TOKENS, STORES, f"""feats AS (
  SELECT product_id AS item_id, COALESCE(categories, '[MISSING]') AS categories, store, {BUCKET} AS price_bucket
  FROM products JOIN stores USING (product_id) LEFT JOIN cats USING (product_id))""")
FIT = """longtok AS (
  SELECT item_id, 'categories' AS attribute, unnest(string_split(categories, ' ')) AS token, generate_subscripts(string_split(categories, ' '), 1) AS pos FROM feats
  UNION ALL SELECT item_id, 'store', store, 1 FROM feats UNION ALL SELECT item_id, 'price_bucket', price_bucket, 1 FROM feats),
fit AS (SELECT attribute, token, row_number() OVER (PARTITION BY attribute ORDER BY first) AS token_idx FROM (
  SELECT attribute, token, MIN((item_id, pos)) AS first FROM longtok GROUP BY attribute, token))"""


def meta(spark, sf):
    return samples.catalog_meta(I.products(spark, sf))


@query("f11_category_tokens", with_(I.PRODUCTS, TOKENS) + "SELECT product_id AS item_id, categories FROM cats")
def _(spark, sf):
    return item_features.frequent_categories(item_features.item_tokens(meta(spark, sf)))


@query("f12_store_tokens", with_(I.PRODUCTS, STORES) + "SELECT product_id AS item_id, store FROM stores")
def _(spark, sf):
    return item_features.frequent_store(meta(spark, sf))


@query("f13_fit_vocab", with_(I.PRODUCTS, *FEATURES, FIT) + "SELECT * FROM fit")
def _(spark, sf):
    return item_features.fit_vocab(item_features.build_features(meta(spark, sf)))


ENCODED = """enc AS (SELECT f.item_id,
    list(COALESCE(v.token_idx, u.token_idx, 0) ORDER BY l.pos) FILTER (WHERE l.attribute = 'categories' AND l.pos <= 3) AS categories,
    MAX(COALESCE(v.token_idx, u.token_idx, 0)) FILTER (WHERE l.attribute = 'store') AS store,
    MAX(COALESCE(v.token_idx, u.token_idx, 0)) FILTER (WHERE l.attribute = 'price_bucket') AS price
  FROM feats f JOIN longtok l USING (item_id) LEFT JOIN fit v ON v.attribute = l.attribute AND v.token = l.token
  LEFT JOIN fit u ON u.attribute = l.attribute AND u.token = '[UNK]' GROUP BY f.item_id)"""


KNOWN_FIT = FIT.replace("FROM longtok GROUP BY", "FROM longtok WHERE item_id IN (SELECT product_id FROM h) GROUP BY")


@query("f14_encode_features", with_(I.PRODUCTS, I.VECTORS, *FEATURES, KNOWN_FIT, ENCODED) + """
SELECT item_id, array_to_string(list_resize(categories, 3, 0), ',') AS categories, CAST(store AS INT) AS store, CAST(price AS INT) AS price FROM enc""")
def _(spark, sf):
    # fitted on the items a model knows, so the others bring unknown tokens
    features = durable(item_features.build_features(meta(spark, sf)))
    known = I.vectors(spark, sf).select(F.col("product_id").alias("item_id"))
    fitted = item_features.fit_vocab(features.join(known, "item_id", "left_semi"))
    out = item_features.encode_features(features, fitted)
    return out.withColumn("categories", F.array_join("categories", ","))


@query("f15_shared_negatives", with_(I.PRODUCTS, VOCAB) + """
SELECT o_orderkey AS batch, CAST(k AS INT) AS k,
  CAST('0x' || substr(md5(o_orderkey || '/' || k || '/42'), 1, 8) AS BIGINT) % (SELECT COUNT(*) FROM vocab) + 1 AS item_idx
FROM orders, range(4) r(k)""")
def _(spark, sf):
    batches = I.table(spark, sf, "orders").select(F.col("o_orderkey").alias("batch"))
    return samples.shared_negatives(batches, "batch", vocab(spark, sf), 4, 42)


@query("f16_catalog_assembly", with_(*COUNTED, *FEATURES, FIT, ENCODED) + """
SELECT row_number() OVER (ORDER BY item_id) AS item_idx, item_id, array_to_string(list_resize(categories, 3, 0), ',') AS categories,
  CAST(store AS INT) AS store, CAST(price AS INT) AS price, train_count FROM enc JOIN counts USING (item_id)""")
def _(spark, sf):
    users = I.user_table(spark, sf)
    inter = samples.explode_sequences(users)
    out = item_features.assemble_catalog(meta(spark, sf), train_counts(spark, sf, users), inter)
    return out.withColumn("categories", F.array_join("categories", ","))


@query("f17_dataset_facts", with_(*BASE, EXPLODED, COUNTS, *FEATURES, FIT, LOO) + f"""
SELECT (SELECT COUNT(*) FROM counts) AS items, (SELECT COUNT(*) FROM counts WHERE train_count > 0) AS items_with_train_count,
  (SELECT COUNT(*) + 1 FROM fit WHERE attribute = 'categories') AS vocab_categories,
  (SELECT COUNT(*) + 1 FROM fit WHERE attribute = 'store') AS vocab_store,
  (SELECT COUNT(*) + 1 FROM fit WHERE attribute = 'price_bucket') AS vocab_price_bucket,
  COUNT(*) FILTER (WHERE {SPLIT} = 'train') AS train_samples, COUNT(*) FILTER (WHERE {SPLIT} = 'valid') AS valid_samples,
  COUNT(*) FILTER (WHERE {SPLIT} = 'test') AS test_samples FROM loo""")
def _(spark, sf):
    fitted = item_features.fit_vocab(item_features.build_features(meta(spark, sf)))
    users = I.user_table(spark, sf)
    return item_features.dataset_facts(
        train_counts(spark, sf, users), fitted, samples.leave_one_out(indexed(spark, sf, users), MAX_LEN))
