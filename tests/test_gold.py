from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import feature_store, gold

PRODUCTS = [
    ("p001", "Wireless Mouse", "electronics", "DemoTech", "19.90"), ("p002", "Mechanical Keyboard", "electronics", "DemoTech", "59.90"),
    ("p003", "Data Engineering Book", "books", "DemoPress", "29.50"), ("p004", "Insulated Bottle", "home", "DemoHome", "14.00"),
    ("p005", "USB-C Hub", "electronics", "DemoTech", "34.90"), ("p006", "Never sold", "home", None, None),
]
EVENTS = [
    ("u001", "p001", "view", None, "02 08:00"), ("u001", "p001", "purchase", None, "02 08:05"), ("u001", "p002", "view", None, "03 09:00"),
    ("u002", "p003", "view", None, "02 10:00"), ("u002", "p003", "rating", 5.0, "02 10:30"), ("u002", "p004", "cart", None, "04 11:00"),
    ("u003", "p005", "view", None, "05 13:00"), ("u003", "p005", "purchase", None, "05 13:10"),
]


@pytest.fixture(scope="module")
def products(spark):
    df = spark.createDataFrame(PRODUCTS, "product_id string, title string, category string, brand string, price string")
    return df.select("*", F.lit(None).cast("string").alias("category_path"), F.lit("x").alias("image_url")).withColumn(
        "price", F.col("price").cast("decimal(12,2)"))


@pytest.fixture(scope="module")
def interactions(spark):
    rows = [(i, u, p, e, r, datetime.strptime(f"2026-01-{t}", "%Y-%m-%d %H:%M")) for i, (u, p, e, r, t) in enumerate(EVENTS)]
    return spark.createDataFrame(rows, "interaction_id long, user_id string, product_id string, event_type string, rating double, event_time timestamp")


def at():
    return F.lit(datetime(2026, 2, 1))


def test_item_features(products, interactions):
    got = {r.product_id: r for r in gold.item_features(products, interactions, at()).collect()}
    assert len(got) == 6
    p1, p3, p4, p6 = (got[p] for p in ("p001", "p003", "p004", "p006"))
    assert (p1.num_interactions, p1.num_views, p1.num_purchases, p1.distinct_users, p1.avg_rating) == (2, 1, 1, 1, None)
    assert (p3.num_interactions, p3.num_views, p3.num_ratings, p3.avg_rating) == (2, 1, 1, 5.0)
    assert (p4.num_cart_adds, p4.num_interactions) == (1, 1)
    assert (p6.num_interactions, p6.distinct_users, p6.avg_rating, p6.last_interaction_at) == (0, 0, None, None)


def test_gold_tables_meet_their_contracts(products, interactions):
    from sparkrec.operators import contracts

    assert contracts.validate(gold.item_features(products, interactions, at()), contracts.ITEM_FEATURES).count() == 6
    assert contracts.validate(gold.user_sequences(interactions, at()), contracts.USER_FEATURES).count() == 3


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_user_sequences(interactions, parts):
    got = {r.user_id: r for r in gold.user_sequences(interactions.repartition(parts)).collect()}
    assert got["u001"].item_sequence == ["p001", "p001", "p002"]
    assert got["u002"].item_sequence == ["p003", "p003", "p004"]
    assert got["u003"].sequence_length == 2 and got["u003"].last_event_time == datetime(2026, 1, 5, 13, 10)


def test_sequences_keep_the_newest_and_break_ties_by_id(spark):
    rows = [(i, "u", f"p{i}", datetime(2026, 1, 1) + timedelta(hours=i // 2)) for i in range(25)]
    df = spark.createDataFrame(rows, "interaction_id long, user_id string, product_id string, event_time timestamp")
    assert gold.user_sequences(df).first().item_sequence == [f"p{i}" for i in range(15, 25)]


def test_search(spark):
    items = spark.createDataFrame(
        [("p1", "Red Dead Redemption 2", "Video Games", None, 9, 1), ("p2", "Dark Souls III", "Video Games", None, 5, 1), ("p3", "controller", "Accessories", None, 7, 1)],
        "product_id string, title string, category string, price double, num_purchases long, num_views long")

    def found(query, limit=10):
        return [r.product_id for r in gold.search(items, query, limit).collect()]

    assert found("VIDEO games") == ["p1", "p2"] and found("dark games") == ["p2"]
    assert found("  ") == [] and found("video", 1) == ["p1"]


def test_top_users(spark):
    users = spark.createDataFrame([("b", 3), ("a", 3), ("c", 10)], "user_id string, sequence_length int")
    assert [r.user_id for r in gold.top_users(users, 2).collect()] == ["c", "a"]


def test_point_in_time_against_brute_force_with_hot_entities(spark, rows):
    base = datetime(2026, 1, 1)
    feats = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"e{i % 11}", base + timedelta(hours=(i * 37) % 500), i) for i in range(300)]
    events = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"e{i % 13}", base + timedelta(hours=(i * 53) % 700), i) for i in range(300)]
    f = spark.createDataFrame(feats, "entity string, at timestamp, value long").repartition(5)
    e = spark.createDataFrame(events, "entity string, ts timestamp, id long").repartition(3)
    ttl = timedelta(hours=40)
    expected = []
    for entity, ts, i in events:
        past = [(at, v) for en, at, v in feats if en == entity and at <= ts]
        best = max(past) if past else None
        expected.append((float(i), float(best[1]) if best and best[0] >= ts - ttl else None))
    for hot in (None, 9):
        got = feature_store.point_in_time(e, f, "entity", "ts", "at", ttl, ["at", "value"], ranges=hot)
        assert rows(got, "id", "value") == sorted(expected, key=repr)


def test_unknown_entity_gets_empty_sequence(spark):
    latest = spark.createDataFrame([("a", ["x"])], "user_id string, seq array<string>")
    asked = spark.createDataFrame([("a",), ("z",)], "user_id string")
    got = {r.user_id: r.seq for r in feature_store.lookup(asked, latest, "user_id", ["seq"]).collect()}
    assert got == {"a": ["x"], "z": []}


def test_sequence_skew(spark, rows):
    a = spark.createDataFrame([("u", ["x"]), ("v", ["x", "y"]), ("w", None)], "user_id string, seq array<string>")
    b = spark.createDataFrame([("u", ["x"]), ("v", ["y", "x"]), ("w", None)], "user_id string, seq array<string>")
    assert rows(feature_store.sequence_skew(a, b, "user_id", "seq"), "user_id") == [("v",)]


def test_batch_search_equals_single_searches(spark):
    titles = ["Red Widget", "red ring", "Blue ring", None, "a", "Redder Widgets", "RING red 10", "über Ring"]
    items = spark.createDataFrame(
        [(f"p{i}", t, "Tools" if i % 2 else "Toys", float(i) if i % 3 else None, i % 4, i) for i, t in enumerate(titles)],
        "product_id string, title string, category string, price double, num_purchases long, num_views long").withColumn(
        "price", F.col("price").cast("decimal(12,2)"))
    asked = ["red", " RED  widget ", "ring", "r", "to", "ü", "zzz", "red zzz", "", "  ", "$1", "tools red", "ring ring", "ber ring"]
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(asked)], "query_id long, query string")
    got = {}
    for r in gold.search_batch(items, queries, 3).orderBy("query_id", "position").collect():
        got.setdefault(r.query_id, []).append(r.product_id)
    for i, q in enumerate(asked):
        assert got.get(i, []) == [r.product_id for r in gold.search(items, q, 3).collect()], q


def test_batch_search_stores_no_more_products_of_a_text_than_it_lists(spark, monkeypatch):
    stored, durable = [], gold.durable
    monkeypatch.setattr(gold, "durable", lambda df: stored.append(durable(df)) or stored[-1])
    items = spark.range(400).select(
        F.format_string("p%03d", "id").alias("product_id"), F.when(F.col("id") % 2 == 0, "Red ring").otherwise("red RING").alias("title"),
        F.lit("Toys").alias("category"), F.lit(None).cast("decimal(12,2)").alias("price"),
        (F.col("id") % 7).alias("num_purchases"), (F.col("id") % 5).alias("num_views"))
    queries = spark.createDataFrame([(1, "ring toys"), (2, "blue")], "query_id long, query string")
    got = gold.search_batch(items, queries, 3).orderBy("position").collect()
    assert [r.product_id for r in got] == [r.product_id for r in gold.search(items, "ring toys", 3).collect()]
    texts, postings = stored[0], stored[1]
    assert texts.count() == 3 and postings.count() < 60
