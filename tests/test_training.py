import pytest
from pyspark.sql import functions as F

from sparkrec.operators import item_features, ordering, samples


def sequences(spark, data):
    return spark.createDataFrame(data, "user_id string, item_sequence array<string>")


def vocab_of(spark, *items):
    return samples.item_vocab(spark.createDataFrame([(i,) for i in items], "product_id string"))


def test_vocab_is_sorted_and_starts_at_one(spark, rows):
    assert rows(vocab_of(spark, "b", "a", "b")) == [("a", 1.0), ("b", 2.0)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_index_does_not_depend_on_partitions(spark, rows, parts):
    df = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).repartition(parts)
    expected = [(k, float(i)) for i, k in enumerate(sorted(f"k{i}" for i in range(997)), 1)]
    assert rows(ordering.dense_index(df, [F.asc("k")], "i")) == sorted(expected, key=repr)


def test_two_way_split(spark, rows):
    users = sequences(spark, [("one", ["p1"]), ("two", ["p1", "p2"]), ("three", ["p1", "p2", "p3"])])
    idx = samples.index_sequences(users, vocab_of(spark, "p1", "p2", "p3"))
    out = samples.two_way_split(idx)
    assert rows(out, "user_id", "split", "seq", "target") == [
        ("three", "train", (1.0,), 2.0), ("three", "valid", (1.0, 2.0), 3.0), ("two", "valid", (1.0,), 2.0)]
    assert rows(samples.split_facts(idx)) == [(1.0, 2.0, 1.0)]
    ten = samples.index_sequences(sequences(spark, [("u", [f"p{i}" for i in range(10)])]),
                                  vocab_of(spark, *[f"p{i}" for i in range(10)]))
    counts = {r.split: r["count"] for r in samples.two_way_split(ten).groupBy("split").count().collect()}
    assert counts == {"train": 8, "valid": 1}


def test_unknown_item_fails_the_split(spark):
    users = sequences(spark, [("u", ["p1", "zz"])])
    with pytest.raises(Exception, match="missing from the catalog"):
        samples.index_sequences(users, vocab_of(spark, "p1")).collect()
    assert samples.index_sequences(users, vocab_of(spark, "p1"), strict=False).first().items == [1]


@pytest.mark.parametrize("n,expected", [(2, {}), (3, {"valid": 1, "test": 1}),
                                        (4, {"train": 1, "valid": 1, "test": 1}), (10, {"train": 7, "valid": 1, "test": 1})])
def test_leave_one_out_sizes(spark, n, expected):
    items = [f"p{i}" for i in range(n)]
    idx = samples.index_sequences(sequences(spark, [("u", items)]), vocab_of(spark, *items))
    got = {r.split: r["count"] for r in samples.leave_one_out(idx, 4).groupBy("split").count().collect()}
    assert got == expected


def history(spark):
    """One user owns a third of all rows."""
    hot = [("hot", i, (i * 7) % 31 + 1) for i in range(400)]
    rest = [(f"u{i % 80}", i, i % 31 + 1) for i in range(800)]
    return spark.createDataFrame(hot + rest + [(None, i, i % 17 + 1) for i in range(90)], "user_id string, at int, item_idx int").repartition(7)


def test_history_split_is_the_same_with_hot_users_cut_up(spark, rows):
    df, order = history(spark), [F.asc("at")]
    plain = samples.leave_one_out_history(df, order, 5)
    cut = samples.leave_one_out_history(df, order, 5, ranges=7, block=7)
    assert rows(plain, *sorted(plain.columns)) == rows(cut, *sorted(cut.columns))
    from_arrays = samples.leave_one_out(
        df.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("at", "item_idx"))).alias("a"))
        .select("user_id", F.expr("transform(a, x -> x.item_idx)").alias("items")), 5)
    keep = ["user_id", "split", "t", "seq", "seq_len", "target"]
    assert rows(plain, *keep) == rows(from_arrays, *keep)


def test_running_values_match_with_hot_keys_cut_up(spark, rows):
    df = history(spark).withColumn("v", F.when(F.col("at") % 5 == 0, F.col("item_idx")))
    order = [F.asc("at")]
    for fn, column in ((ordering.carry_forward, "v"), (ordering.running_max, "item_idx"), (ordering.previous_value, "item_idx")):
        a = fn(df, ["user_id"], order, column, "x")
        b = fn(df, ["user_id"], order, column, "x", ranges=7)
        assert len(rows(b, "user_id", "at")) == df.count()
        assert rows(a, "user_id", "at", "x") == rows(b, "user_id", "at", "x")
    a, b = (ordering.positions(df, ["user_id"], order, "x", n) for n in (None, 9))
    assert rows(a, "user_id", "at", "x") == rows(b, "user_id", "at", "x")


def test_running_totals(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("n")).repartition(9)
    out = {r.id: (r.s, r.nxt) for r in ordering.running_totals(df, [F.asc("id")], {"s": "n"}, {"nxt": "id"}).collect()}
    total = 0
    for i in range(500):
        total += i % 7
        assert out[i] == (total, i + 1 if i < 499 else None)


def test_pad(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "x array<int>")
    assert [r.y for r in df.select(samples.truncate_pad("x", 2).alias("y")).collect()] == [[2, 3], [0, 0]]
    assert [r.y for r in df.select(samples.truncate_pad("x", 5).alias("y")).collect()] == [[1, 2, 3, 0, 0], [0] * 5]


def test_train_counts_leave_out_the_last_two(spark, rows):
    users = sequences(spark, [("u1", ["i0", "i1", "i2", "i3"]), ("u2", ["i1", "i2", "i4"])])
    inter = samples.explode_sequences(users, None)
    assert [r.user_id for r in inter.orderBy("user_id", "ts", "pos").collect()] == ["u1"] * 4 + ["u2"] * 3
    catalog = spark.createDataFrame([(f"i{i}",) for i in range(6)], "item_id string")
    counts = samples.train_counts(inter, catalog, [F.desc("ts")])
    assert {k: v for k, v in rows(counts) if v} == {"i0": 1.0, "i1": 2.0} and counts.count() == 6
    signal = {r.item_id: r.popularity for r in samples.popularity_signal(counts).collect()}
    assert signal["i1"] == 1.0 and signal["i5"] == 0.0
    zero = counts.withColumn("train_count", F.lit(0))
    assert samples.popularity_signal(zero).filter("popularity <> 0").count() == 0


def catalog(spark):
    data = [(f"i{i}", "T", "Cat", "A > B x > C", "acme" if i < 5 else "tiny", float(i + 1)) for i in range(6)]
    data.append(("zz", None, "Lone", None, None, None))
    return spark.createDataFrame(
        data, "product_id string, title string, category string, category_path string, brand string, price double")


def test_item_attributes(spark):
    features = item_features.build_features(samples.catalog_meta(catalog(spark)))
    got = {r.item_id: r for r in features.collect()}
    assert got["i0"].categories == "A B_x C" and got["zz"].categories == "[UNK]"
    assert got["i0"].store == "acme" and got["i5"].store == "[UNK]" and got["zz"].store == "[MISSING]"
    assert got["zz"].price_bucket == "[MISSING]" and got["i0"].price_bucket == "p0" and got["i5"].price_bucket == "p9"
    vocab = item_features.fit_vocab(features)
    ids = {(r.attribute, r.token): r.token_idx for r in vocab.collect()}
    assert [ids["categories", t] for t in ("A", "B_x", "C", "[UNK]")] == [1, 2, 3, 4]
    assert [ids["store", t] for t in ("acme", "[UNK]", "[MISSING]")] == [1, 2, 3]
    new = spark.createDataFrame([("n", "A Q", "other", "p77")], "item_id string, categories string, store string, price_bucket string")
    assert tuple(item_features.encode_features(new, vocab).first()) == ("n", [1, 4, 0], 2, 0)


def test_catalog_is_read_once_and_by_many_tasks(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(path):
        read.add(1)
        return path

    path = F.udf(counted, "string").asNondeterministic()("category_path")
    meta = samples.catalog_meta(catalog(spark)).withColumn("category_path", path)
    assert item_features.build_features(meta).count() == 7
    assert read.value == 7
    wide = spark.range(300_000, numPartitions=1).select(
        F.col("id").alias("item_id"), F.lit("Cat").alias("main_category"),
        F.concat_ws(" > ", F.lit("A"), F.sha2(F.col("id").cast("string"), 256)).alias("category_path"),
        F.lit("acme").alias("store"), F.lit(1.0).alias("price"))
    assert len(item_features.item_tokens(wide).inputFiles()) > 1


def test_price_edges_interpolate_and_tolerate_no_price(spark):
    import numpy as np

    values = [float(v) for v in np.random.default_rng(3).integers(1, 40, 333)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (-1.0,), (float("nan"),)], "price double").repartition(5)
    edges = item_features.price_edges(df, "price").first().edges
    assert np.allclose(edges, np.quantile(values, np.linspace(0, 1, 11)[1:-1]))
    none = item_features.price_edges(df.filter("price < 0"), "price").first().edges
    assert none == []
    shown = df.select(item_features.price_bucket(F.col("price"), F.lit([]).cast("array<double>")).alias("b"))
    assert {r.b for r in shown.collect()} == {"[MISSING]"}


def test_duplicate_catalog_and_unknown_interactions_are_errors(spark):
    twice = catalog(spark).unionByName(catalog(spark))
    with pytest.raises(ValueError, match="duplicate"):
        samples.catalog_meta(twice)
    meta = samples.catalog_meta(catalog(spark))
    counts = meta.select("item_id", F.lit(0).alias("train_count"))
    stranger = spark.createDataFrame([("nope",)], "item_id string")
    with pytest.raises(Exception, match="missing from the catalog"):
        item_features.assemble_catalog(meta, counts, stranger).collect()


def test_negatives_are_uniform_and_repeatable(spark, rows):
    batches = spark.range(3000).withColumnRenamed("id", "b")
    vocab = spark.range(10)
    one = samples.shared_negatives(batches, "b", vocab, 4, 1)
    two = samples.shared_negatives(batches.repartition(13), "b", vocab, 4, 1)
    assert rows(one) == rows(two)
    counts = {r.item_idx: r["count"] for r in one.groupBy("item_idx").count().collect()}
    assert sorted(counts) == list(range(1, 11)) and min(counts.values()) > 1000
