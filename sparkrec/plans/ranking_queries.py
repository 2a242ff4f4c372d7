"""Scoring, ranking metrics, model choice, similarity and re-ranking."""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sparkrec.functions import arrays
from sparkrec.operators import gold, metrics, ordering, rerank, samples, scoring, selection, similar
from sparkrec.plans import inputs as I, training_queries as T
from sparkrec.plans.inputs import DIMS, with_
from sparkrec.plans.registry import query
from sparkrec.session import durable, scratch_dir
from sparkrec.sources import sinks
from sparkrec.streaming import sessions

SCORED = (I.BRONZE, I.SILVER, I.USERS, I.VECTORS, I.STATES)
MAX_LEN = 10


def user_histories(spark, sf, silver: DataFrame | None = None) -> DataFrame:
    return scoring.history_vectors(
        I.user_sequences(spark, sf, silver), I.vectors(spark, sf), "item_sequence", MAX_LEN, item="product_id")


def user_states(spark, sf, silver: DataFrame | None = None) -> DataFrame:
    return scoring.last_item_states(user_histories(spark, sf, silver))


def pairs(silver: DataFrame) -> DataFrame:
    return silver.select("user_id", "product_id").distinct()


PAIR_SCORES = """pairs AS (SELECT DISTINCT user_id, product_id FROM silver),
scores AS (SELECT user_id, product_id, COALESCE(list_dot_product(state, vec), 0.0) AS score
  FROM pairs LEFT JOIN states USING (user_id) LEFT JOIN h USING (product_id))"""


WIDTH = 4  # of the seeded weights; their SQL is written out


def _weights() -> dict[str, np.ndarray]:
    rng, d = np.random.default_rng(7), WIDTH
    drawn = {
        "category": np.vstack([np.zeros(d), rng.normal(size=(63, d))]), "price": rng.normal(size=(12, d)),
        "feat_w": rng.normal(size=(d, 3 * d)) / d, "feat_b": rng.normal(size=d), "norm_w": 1 + rng.normal(size=d) / 4,
        "norm_b": rng.normal(size=d) / 4, "gate_w": rng.normal(size=(d, 2 * d + 1)) / d, "gate_b": rng.normal(size=d),
    }
    return {k: w.round(3) for k, w in drawn.items()}


def _gru() -> scoring.GRUBackbone:
    rng, d = np.random.default_rng(11), WIDTH
    return scoring.GRUBackbone(*(rng.normal(size=size).round(3) for size in ((3 * d, d), (3 * d, d), (d, d), d)))


def _sql_list(values) -> str:
    return "[" + ", ".join(_sql_list(v) if np.ndim(v) else f"{v}::DOUBLE" for v in values) + "]"


def _sql_dense(w: np.ndarray, x: str, b: np.ndarray | None = None) -> str:
    """A dense layer over the list `x`."""
    bias = np.zeros(len(w)) if b is None else b
    return "[" + ", ".join(f"list_dot_product({_sql_list(row)}, {x}) + {c}" for row, c in zip(w, bias)) + "]"


def _sql_each(formula: str) -> str:
    """A formula in which `{i}` is the place, for every place."""
    return "[" + ", ".join(formula.format(i=i) for i in range(1, WIDTH + 1)) + "]"


def _item_vector_sql(w: dict[str, np.ndarray]) -> str:
    return with_(*T.COUNTED, T.VOCAB, I.VECTORS, f"""
rows AS (SELECT item_idx, product_id AS item_id, train_count,
    CASE WHEN train_count > 0 THEN coalesce(vec[1:{WIDTH}], {_sql_list(np.zeros(WIDTH))}) ELSE {_sql_list(np.zeros(WIDTH))} END AS e,
    coalesce(vec[1:{WIDTH}], {_sql_list(np.zeros(WIDTH))}) AS store, {_sql_list(w['category'])} AS c, {_sql_list(w['price'])} AS p,
    v.item_idx % 64 AS c1, (v.item_idx * 7) % 64 AS c2, coalesce(CAST(floor(price) AS BIGINT) % 12, 0) AS price,
    ln(1 + train_count) / (SELECT ln(1 + max(train_count)) FROM counts) * CAST(train_count > 0 AS INT) AS popularity
  FROM vocab v JOIN counts ON counts.item_id = v.product_id LEFT JOIN (SELECT product_id, vec FROM h) USING (product_id)
  JOIN (SELECT product_id, price FROM products) USING (product_id)),
parts AS (SELECT *, {_sql_each("(c[c1 + 1][{i}] + c[c2 + 1][{i}]) / greatest(CAST(c1 <> 0 AS INT) + CAST(c2 <> 0 AS INT), 1)")} AS category FROM rows),
features AS (SELECT *, {_sql_dense(w['feat_w'], 'list_concat(list_concat(category, store), p[price + 1])', w['feat_b'])} AS f0 FROM parts),
centred AS (SELECT *, {_sql_each("f0[{i}] - list_avg(f0)")} AS f1 FROM features),
scaled AS (SELECT *, [(f1[i] / sqrt(list_dot_product(f1, f1) / {WIDTH} + 1e-12)) * {_sql_list(w['norm_w'])}[i] + {_sql_list(w['norm_b'])}[i]
  FOR i IN range(1, {WIDTH + 1})] AS f FROM centred),
gated AS (SELECT *, {_sql_dense(w['gate_w'], 'list_concat(list_concat(e, f), [popularity])', w['gate_b'])} AS g FROM scaled)""") + f"""
SELECT item_idx, item_id, {_sql_each("round(CAST(CAST(e[{i}] / (1 + exp(-g[{i}])) + f[{i}] * (1 - 1 / (1 + exp(-g[{i}]))) AS FLOAT) AS DOUBLE), 5)")} AS vec FROM gated"""


@query("g1_item_vectors", _item_vector_sql(_weights()))
def _(spark, sf):
    ids = I.vectors(spark, sf).select("product_id", F.slice("vec", 1, WIDTH).alias("id_vec"))
    counts = T.train_counts(spark, sf).select(F.col("item_id").alias("product_id"), "train_count")
    zero = F.array_repeat(F.lit(0.0).cast("float"), WIDTH)
    items = (
        T.vocab(spark, sf).join(counts, "product_id").join(ids, "product_id", "left")
        .join(I.products(spark, sf).select("product_id", "price"), "product_id")
        .select(
            "item_idx", F.col("product_id").alias("item_id"), "train_count",
            F.coalesce("id_vec", zero).alias("id_vec"), F.coalesce("id_vec", zero).alias("store_vec"),
            F.array(F.pmod("item_idx", F.lit(64)).cast("int"), F.pmod(F.col("item_idx") * 7, F.lit(64)).cast("int"), F.lit(0)).alias("categories"),
            F.coalesce(F.pmod(F.floor("price").cast("int"), F.lit(12)), F.lit(0)).alias("price"),
        )
    )
    vectors = scoring.item_vectors(items, _weights())
    return vectors.select("item_idx", "item_id", arrays.rounded("vec", 5).alias("vec"))


def _gru_sql(net: scoring.GRUBackbone) -> str:
    d = WIDTH
    wi, wh = net.w_input.reshape(3, d, d), net.w_hidden.reshape(3, d, d)
    return "WITH RECURSIVE " + with_(I.BRONZE, I.SILVER, I.USERS, I.VECTORS, f"""
placed AS (SELECT user_id, h.vec[1:{d}] AS x, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS t FROM
  (SELECT user_id, unnest(item_sequence) AS product_id, generate_subscripts(item_sequence, 1) AS pos FROM users) JOIN h USING (product_id)),
layers AS MATERIALIZED (SELECT user_id, t, {_sql_dense(wi[0], 'x')} AS xr, {_sql_dense(wi[1], 'x')} AS xz, {_sql_dense(wi[2], 'x')} AS xn FROM placed),
walk(user_id, t, s) AS (
  SELECT DISTINCT user_id, 0::BIGINT, {_sql_list(np.zeros(d))} FROM placed UNION ALL
  SELECT user_id, t, [(1 - z[i]) * (1 - 2 / (exp(2 * (xn[i] + r[i] * hn[i])) + 1)) + z[i] * s[i] FOR i IN range(1, {d + 1})] FROM (
    SELECT *, {_sql_each("1 / (1 + exp(-(xr[{i}] + hr[{i}])))")} AS r,
      {_sql_each("1 / (1 + exp(-(xz[{i}] + hz[{i}])))")} AS z FROM (
      SELECT l.*, s, {_sql_dense(wh[0], 's')} AS hr, {_sql_dense(wh[1], 's')} AS hz, {_sql_dense(wh[2], 's')} AS hn
      FROM walk w JOIN layers l ON l.user_id = w.user_id AND l.t = w.t + 1))),
final AS (SELECT user_id, arg_max(s, t) AS s FROM walk GROUP BY user_id)""").removeprefix("WITH ") + f"""
SELECT user_id, [round(v, 5) FOR v IN {_sql_dense(net.dense_w, 's', net.dense_b)}] AS state FROM final"""


@query("g2_user_states", _gru_sql(_gru()))
def _(spark, sf):
    narrow = I.vectors(spark, sf).withColumn("vec", F.slice("vec", 1, WIDTH))
    histories = scoring.history_vectors(I.user_sequences(spark, sf), narrow, "item_sequence", MAX_LEN, item="product_id")
    states = scoring.user_states(histories, _gru())
    return states.select("user_id", arrays.rounded("state", 5).alias("state"))


@query("g2_last_item_states", with_(*SCORED) + """
SELECT user_id, [round(x, 6) FOR x IN state] AS state FROM states""")
def _(spark, sf):
    states = scoring.user_states(user_histories(spark, sf), scoring.last_vector)
    return states.select("user_id", arrays.rounded("state", 6).alias("state"))


@query("g3_scores", with_(*SCORED, PAIR_SCORES) + "SELECT user_id, product_id, round(score, 6) AS score FROM scores")
def _(spark, sf):
    silver = I.silver_table(spark, sf)
    out = scoring.score_candidates(pairs(silver), user_states(spark, sf, silver), I.vectors(spark, sf), item="product_id")
    return out.withColumn("score", F.round("score", 6))


BEST = """full_scores AS (SELECT user_id, item_idx, product_id, round(list_dot_product(state, vec), 9) AS score FROM states CROSS JOIN h),
best AS (SELECT user_id, product_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_idx) AS rank FROM full_scores)"""


def best_items(spark, sf, n: int, states: DataFrame | None = None) -> DataFrame:
    """(user_id, product_id, score, rank) over the whole item table."""
    states = user_states(spark, sf) if states is None else states
    items = I.vectors(spark, sf)
    found = scoring.top_k(states.select(F.col("user_id").alias("query"), F.col("state").alias("vec")), items, n)
    return found.join(items.select("item_idx", "product_id"), "item_idx").select(
        F.col("query").alias("user_id"), "product_id", "score", "rank")


@query("g4_top_n", with_(*SCORED, BEST) + """
SELECT user_id, product_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM best WHERE rank <= 10""")
def _(spark, sf):
    return best_items(spark, sf, 10).withColumn("score", F.round("score", 6))


POPULAR = "popular AS (SELECT product_id, row_number() OVER (ORDER BY num_purchases DESC, num_views DESC, product_id) AS position FROM items)"


@query("g5_fallback", with_(I.PRODUCTS, *SCORED, I.ITEM_FEATURES, POPULAR, PAIR_SCORES) + """
SELECT user_id, product_id, round(score, 6) AS score, CAST(position AS INT) AS position, 'model' AS source FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, product_id) AS position FROM scores)
  WHERE position <= 10 AND user_id IN (SELECT user_id FROM scores WHERE score <> 0.0)
UNION ALL SELECT user_id, product_id, 0.0, CAST(position AS INT), 'fallback' FROM
  (SELECT DISTINCT user_id FROM users WHERE user_id NOT IN (SELECT user_id FROM scores WHERE score <> 0.0)) CROSS JOIN popular WHERE position <= 10""")
def _(spark, sf):
    silver = I.silver_table(spark, sf)
    scored = durable(scoring.score_candidates(
        pairs(silver), user_states(spark, sf, silver), I.vectors(spark, sf), item="product_id"))
    top = scoring.top_n(scored, "user_id", "product_id", 10).withColumnRenamed("rank", "position")
    useful = scored.filter("score <> 0.0").select("user_id").distinct()
    model = top.join(useful, "user_id", "left_semi").select(
        "user_id", "product_id", "score", "position", F.lit(rerank.MODEL).alias("source"))
    rest = silver.select("user_id").distinct().join(useful, "user_id", "left_anti")
    out = model.unionByName(rerank.fallback_rows(rest, I.item_features(spark, sf, silver), 10))
    return out.withColumn("score", F.round("score", 6))


@query("g6_text_vectors", with_(I.VECTORS, I.PRODUCTS) + """
SELECT product_id AS item_id, title, [round(x / greatest(sqrt(list_dot_product(vec, vec)), 1e-12), 6) FOR x IN vec] AS text_vec
FROM products JOIN h USING (product_id)""")
def _(spark, sf):
    texts = I.vectors(spark, sf).select(F.col("product_id").alias("item_id"), F.col("vec").alias("embedding"))
    products = I.products(spark, sf).select(F.col("product_id").alias("item_id"), "title")
    known = products.join(texts.select("item_id"), "item_id", "left_semi")
    out = scoring.text_vectors(known, texts)
    return out.select("item_id", "title", arrays.rounded("text_vec", 6).alias("text_vec"))


@query("g7_score_consistency", with_(*SCORED, PAIR_SCORES) + """
SELECT COUNT(*) AS pairs, TRUE AS consistent FROM scores""")
def _(spark, sf):
    silver, items = I.silver_table(spark, sf), I.vectors(spark, sf)
    asked, histories = pairs(silver), durable(user_histories(spark, sf, silver))
    direct = scoring.score_candidates(asked, scoring.last_item_states(histories), items, item="product_id")
    served = scoring.score_candidates(
        asked, scoring.user_states(histories, scoring.last_vector), items, item="product_id")
    return scoring.max_abs_difference(direct, served, ["user_id", "product_id"]).select("pairs", "consistent")


# ------------------------------------------------------------------ ranks and metrics
# validation samples whose target and last history item the model knows
SAMPLES = """flat AS (SELECT user_id, sequence_length AS n, unnest(item_sequence) AS product_id, generate_subscripts(item_sequence, 1) AS pos FROM users),
targets AS (SELECT user_id, h.item_idx AS target_idx, h.vec AS target_vec FROM flat JOIN h USING (product_id) WHERE pos = n AND n >= 2),
hist AS (SELECT user_id, arg_max(h.vec, pos) AS state FROM flat JOIN h USING (product_id) WHERE pos < n GROUP BY user_id),
sample_scores AS (SELECT user_id, target_idx, h.item_idx, round(list_dot_product(state, vec), 9) AS score,
  round(list_dot_product(state, target_vec), 9) AS bar FROM targets JOIN hist USING (user_id) CROSS JOIN h),
ranked AS (SELECT user_id AS query, 1 + COUNT(*) FILTER (WHERE score > bar AND item_idx <> target_idx) AS strict_rank,
  1 + COUNT(*) FILTER (WHERE (score > bar AND item_idx <> target_idx) OR (score = bar AND item_idx < target_idx)) AS rank
  FROM sample_scores GROUP BY user_id)"""
SAMPLED = (I.BRONZE, I.SILVER, I.USERS, I.VECTORS, SAMPLES)


def catalog_ranks(spark, sf) -> DataFrame:
    """(query, strict_rank, rank) of each user's last item given the ones before."""
    items, users = I.vectors(spark, sf), I.user_table(spark, sf).filter("sequence_length >= 2")
    before = users.select("user_id", F.expr("slice(item_sequence, 1, sequence_length - 1)").alias("seq"))
    states = scoring.last_item_states(scoring.history_vectors(before, items, "seq", MAX_LEN, item="product_id"))
    last = users.select("user_id", F.element_at("item_sequence", -1).alias("product_id"))
    targets = last.join(items.select("product_id", F.col("item_idx").alias("target_idx")), "product_id")
    queries = targets.join(states, "user_id").select(
        F.col("user_id").alias("query"), F.col("state").alias("vec"), "target_idx")
    return scoring.rank_targets(queries, items)


@query("h1_catalog_ranks", with_(*SAMPLED) + "SELECT * FROM ranked")
def _(spark, sf):
    return catalog_ranks(spark, sf)


# every order is a sample: its parts are scored by price, the first line's part is the target
ORDER_SCORES = """best_line AS (SELECT l_orderkey AS sample, l_partkey + 1 AS item_idx, MAX(l_extendedprice) AS score,
    MAX(l_quantity) AS by_quantity, MAX(l_tax * 100 + l_discount) AS by_tax FROM lineitem GROUP BY l_orderkey, l_partkey),
first_line AS (SELECT l_orderkey AS sample, MIN((l_linenumber, l_partkey))[2] + 1 AS target_idx FROM lineitem GROUP BY l_orderkey)"""


def _rank_sql(score: str) -> str:
    return f"""(SELECT sample, 1 + COUNT(*) FILTER (WHERE {score} > bar) AS strict_rank,
  CASE WHEN COUNT(*) FILTER (WHERE {score} > bar OR ({score} = bar AND item_idx < target_idx)) < 20
    THEN 1 + COUNT(*) FILTER (WHERE {score} > bar OR ({score} = bar AND item_idx < target_idx)) ELSE 21 END AS rank
  FROM (SELECT *, MAX({score}) FILTER (WHERE item_idx = target_idx) OVER (PARTITION BY sample) AS bar
        FROM best_line JOIN first_line USING (sample)) GROUP BY sample)"""


def order_scores(spark, sf, score: str = "l_extendedprice") -> DataFrame:
    lines = I.table(spark, sf, "lineitem")
    value = F.col("l_tax") * 100 + F.col("l_discount") if score == "tax" else F.col(score)
    best = lines.groupBy(F.col("l_orderkey").alias("sample"), (F.col("l_partkey") + 1).alias("item_idx")).agg(
        F.max(value).alias("score"))
    first = lines.groupBy(F.col("l_orderkey").alias("sample")).agg(
        (F.min(F.struct("l_linenumber", "l_partkey"))["l_partkey"] + 1).alias("target_idx"))
    return best.join(first, "sample")


def order_ranks(spark, sf, score: str = "l_extendedprice") -> DataFrame:
    return metrics.ranks_in_scores(order_scores(spark, sf, score))


@query("h2_ranks_in_scores", with_(ORDER_SCORES) + f"SELECT * FROM {_rank_sql('score')}")
def _(spark, sf):
    return order_ranks(spark, sf)


def _metric_sql(rank: str, ks=(10, 20), names=("ndcg", "recall", "map"), weight: str = "1") -> str:
    formula = {"ndcg": f"1 / log2({rank} + 1)", "recall": "1.0", "map": f"1.0 / {rank}"}
    return ", ".join(
        f"round(COALESCE(SUM({weight} * CASE WHEN {rank} <= {k} THEN {formula[n]} ELSE 0 END) / SUM({weight}), 0), 6) AS {n}_{k}"
        for k in ks for n in names)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("h3_ranking_metrics", with_(*SAMPLED) + f"""
SELECT COUNT(*) AS samples, {_metric_sql('rank')} FROM (SELECT CASE WHEN rank <= 20 THEN rank ELSE 21 END AS rank FROM ranked)""")
def _(spark, sf):
    ranks = catalog_ranks(spark, sf).withColumn("rank", metrics.capped("rank"))
    return _rounded(metrics.ranking_metrics(ranks))


@query("h4_coverage", with_(*SCORED, BEST) + """
SELECT COUNT(DISTINCT product_id) AS items, round(COUNT(DISTINCT product_id) / (SELECT COUNT(*) + 1 FROM h), 6) AS coverage
FROM best WHERE rank <= 10""")
def _(spark, sf):
    vocab_size = I.vectors(spark, sf).count() + 1
    return _rounded(metrics.coverage(best_items(spark, sf, 10), "product_id", vocab_size))


POP_RANKS = """pop AS (SELECT item_idx, item_id, train_count, row_number() OVER (ORDER BY train_count DESC, item_idx) AS rank
  FROM (SELECT item_id, train_count, row_number() OVER (ORDER BY item_id) AS item_idx FROM counts))"""


def indexed_counts(spark, sf, users: DataFrame | None = None) -> DataFrame:
    vocab = T.vocab(spark, sf).withColumnRenamed("product_id", "item_id")
    return vocab.join(T.train_counts(spark, sf, users), "item_id")


@query("h5_popularity_ranks", with_(*T.COUNTED, POP_RANKS) + "SELECT * FROM pop")
def _(spark, sf):
    return metrics.popularity_ranks(indexed_counts(spark, sf))


@query("h6_popularity_baseline", with_(*T.COUNTED, POP_RANKS, T.VOCAB, T.INDEXED, T.LOO) + f"""
SELECT {T.SPLIT} AS split, COUNT(*) AS samples, {_metric_sql('rank', names=('ndcg', 'recall'))}
FROM loo JOIN pop ON pop.item_idx = loo.target GROUP BY 1""")
def _(spark, sf):
    users = I.user_table(spark, sf)
    targets = samples.leave_one_out(T.indexed(spark, sf, users), T.MAX_LEN)
    return _rounded(metrics.popularity_baseline(targets, indexed_counts(spark, sf, users), ["split"]))


@query("h7_per_sample_ndcg", with_(ORDER_SCORES) + f"""
SELECT sample, round(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1) ELSE 0 END, 6) AS ndcg FROM {_rank_sql('score')}""")
def _(spark, sf):
    return _rounded(metrics.per_sample_ndcg(order_ranks(spark, sf)))


CANDIDATES = {"gru4rec": "l_quantity", "sasrec": "l_extendedprice", "gru4rec_sum": "tax"}
SQL_SCORE = {"gru4rec": "by_quantity", "sasrec": "score", "gru4rec_sum": "round(by_tax, 9)"}
MARGINS = ",\n".join(
    f"r_{c} AS (SELECT sample, CASE WHEN rank <= 10 THEN 1 / log2(rank + 1) ELSE 0 END AS ndcg FROM {_rank_sql(s)})"
    for c, s in SQL_SCORE.items()) + """,
diffs AS (SELECT 'sasrec' AS candidate, a.ndcg - b.ndcg AS d FROM r_sasrec a JOIN r_gru4rec b USING (sample)
  UNION ALL SELECT 'gru4rec_sum', a.ndcg - b.ndcg FROM r_gru4rec_sum a JOIN r_gru4rec b USING (sample)),
margins AS (SELECT candidate, COUNT(*) AS n, AVG(d) AS diff, stddev_samp(d) / sqrt(COUNT(*)) AS se FROM diffs GROUP BY candidate)"""


def _per_sample(spark, sf) -> DataFrame:
    out = None
    for name, score in CANDIDATES.items():
        part = metrics.per_sample_ndcg(order_ranks(spark, sf, score)).withColumn("candidate", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("h8_paired_margins", with_(ORDER_SCORES, MARGINS) + """
SELECT candidate, n, CAST(0 AS BIGINT) AS mismatched, round(diff, 6) AS diff, round(se, 6) AS se, round(diff / se, 4) AS z, diff > 0 AND diff > se AS eligible FROM margins""")
def _(spark, sf):
    out = selection.paired_margins(_per_sample(spark, sf), "gru4rec").withColumn("z", F.round("z", 4))
    return _rounded(out)


@query("h8_select_winner", with_(ORDER_SCORES, MARGINS) + """
SELECT COALESCE((SELECT candidate FROM margins WHERE diff > 0 AND diff > se ORDER BY diff DESC, candidate LIMIT 1), 'gru4rec') AS winner,
  'gru4rec' AS "default" """)
def _(spark, sf):
    per_sample = durable(_per_sample(spark, sf))
    params = F.when(F.col("candidate") == "sasrec", 200).otherwise(100)
    order = F.when(F.col("candidate") == "gru4rec", 0).when(F.col("candidate") == "sasrec", 1).otherwise(2)
    candidates = per_sample.groupBy("candidate").agg(F.avg("ndcg").alias("val_ndcg")).select(
        "*", params.alias("n_params"), order.alias("list_order"))
    default = selection.default_candidate(candidates)
    return selection.select_winner(candidates, selection.paired_margins(per_sample, default), default)


# the older model's vocabulary is its item table, the newer one's is the whole catalog
TRANSLATED = """valid AS (SELECT user_id AS sample, items[:-2] AS seq, items[-1] AS target FROM indexed WHERE len(items) >= 2),
trans AS (SELECT vocab.item_idx AS old, h.item_idx AS new, h.vec FROM vocab LEFT JOIN h USING (product_id)),
steps AS (SELECT sample, pos, new, vec FROM (SELECT sample, unnest(seq) AS old, generate_subscripts(seq, 1) AS pos FROM valid) JOIN trans USING (old)),
hists AS (SELECT sample, (list(new ORDER BY pos) FILTER (WHERE new IS NOT NULL)) AS history, COUNT(*) FILTER (WHERE new IS NULL) AS dropped,
  arg_max(vec, pos) FILTER (WHERE new IS NOT NULL) AS state FROM steps GROUP BY sample),
translated AS (SELECT v.sample, COALESCE(history, []) AS history, dropped, v.target AS source_target, t.new AS target_idx, state, t.vec AS target_vec
  FROM valid v JOIN trans t ON t.old = v.target LEFT JOIN hists USING (sample))"""


def _translated(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    vocab, champion = T.vocab(spark, sf), I.vectors(spark, sf)
    valid = samples.two_way_split(T.indexed(spark, sf)).filter(F.col("split") == samples.VALID).select(
        F.col("user_id").alias("sample"), "seq", "target")
    moved = metrics.translate_history(durable(valid), vocab, champion.select("product_id", "item_idx"), MAX_LEN)
    return moved, vocab, champion


@query("h9_translate_history", with_(*T.BASE, I.VECTORS, TRANSLATED) + """
SELECT sample, array_to_string(history, ',') AS history, dropped, source_target, target_idx FROM translated""")
def _(spark, sf):
    return _translated(spark, sf)[0].withColumn("history", F.array_join("history", ","))


@query("h10_champion_ranks", with_(*T.BASE, I.VECTORS, TRANSLATED, """
usable AS (SELECT sample, source_target, state, round(list_dot_product(state, target_vec), 9) AS bar FROM translated
  WHERE target_idx IS NOT NULL AND len(history) > 0),
beaten AS (SELECT sample, COUNT(*) FILTER (WHERE old <> source_target AND (s > bar OR (s = bar AND old < source_target))) AS n FROM
  (SELECT u.*, t.old, COALESCE(round(list_dot_product(state, vec), 9), 0.0) AS s FROM usable u CROSS JOIN trans t) GROUP BY sample)""") + """
SELECT sample, CASE WHEN n < 20 THEN n + 1 ELSE 21 END AS rank FROM valid LEFT JOIN beaten USING (sample)""")
def _(spark, sf):
    moved, vocab, champion = _translated(spark, sf)
    moved = durable(moved)
    steps = moved.select("sample", F.col("history").alias("seq")).withColumnRenamed("sample", "user_id")
    histories = scoring.history_vectors(steps, champion.select("item_idx", "vec"), "seq", MAX_LEN, item="item_idx")
    states = scoring.last_item_states(histories).withColumnRenamed("user_id", "sample")
    newer = vocab.join(champion.select("product_id", "vec"), "product_id", "left").select("item_idx", "vec")
    return metrics.champion_ranks(moved, states, newer, DIMS)


# ------------------------------------------------------------------ model choice over run tables
# every order is a trained version; the customer's order before it is in production
RUNS_SQL = """runs AS (SELECT o_orderkey AS run, o_totalprice AS candidate_metric,
  CAST(lag(o_orderkey) OVER w AS VARCHAR) AS production_version, lag(o_totalprice) OVER w AS production_metric,
  CASE WHEN o_orderpriority < '3' THEN CAST(lag(o_orderkey) OVER w AS VARCHAR) ELSE '-1' END AS champion_version,
  CASE WHEN o_orderstatus <> 'F' THEN lag(o_totalprice) OVER w * 0.9 END AS champion_metric
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"""


def runs(spark, sf) -> DataFrame:
    orders = I.table(spark, sf, "orders").withColumn("own", F.struct("o_orderkey", "o_totalprice"))
    chained = ordering.previous_value(orders, ["o_custkey"], [F.asc("o_orderkey")], "own", "before")
    prior, total = F.col("before.o_orderkey").cast("string"), F.col("before.o_totalprice")
    return chained.select(
        F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("candidate_metric"),
        prior.alias("production_version"), total.alias("production_metric"),
        F.when(F.col("o_orderpriority") < "3", prior).otherwise("-1").alias("champion_version"),
        F.when(F.col("o_orderstatus") != "F", total * 0.9).alias("champion_metric"))


@query("h11_decide_promotion", with_(RUNS_SQL) + """
SELECT run, CASE WHEN production_version IS NULL THEN 'first'
    WHEN champion_metric IS NOT NULL AND champion_version = production_version THEN 'same_split' ELSE 'legacy' END AS comparison,
  CASE WHEN production_version IS NULL THEN TRUE
    WHEN champion_metric IS NOT NULL AND champion_version = production_version THEN candidate_metric > champion_metric + 100
    ELSE COALESCE(candidate_metric >= production_metric, FALSE) END AS promote FROM runs""")
def _(spark, sf):
    return selection.decide_promotion(runs(spark, sf), 100.0).select("run", "comparison", "promote")


@query("h12_lift", """
SELECT o_orderkey AS run, round(o_totalprice / nullif(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1000.0 END, 0), 6) AS lift FROM orders""")
def _(spark, sf):
    popularity = F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(1000.0)
    return I.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run"),
        F.round(selection.lift_over_popularity(F.col("o_totalprice"), popularity), 6).alias("lift"))


@query("h13_metric_trend", """
SELECT o_custkey AS model, CAST(o_orderkey AS VARCHAR) AS version, o_totalprice AS metric,
  round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 4) AS change FROM orders""")
def _(spark, sf):
    versions = I.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("model"), F.col("o_orderkey").cast("string").alias("version"),
        F.col("o_totalprice").alias("metric"))
    return selection.metric_trend(versions, "metric").withColumn("change", F.round("change", 4))


@query("h13_latest_version", "SELECT CAST(MAX(o_orderkey) AS VARCHAR) AS version FROM orders")
def _(spark, sf):
    return selection.latest_version(I.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("version")))


@query("h14_early_stopping", """
WITH e AS (SELECT o_custkey AS run, o_orderkey AS epoch, o_totalprice AS metric,
  row_number() OVER w AS place, o_totalprice >= MAX(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS good
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
g AS (SELECT *, MAX(CASE WHEN good THEN place END) OVER (PARTITION BY run ORDER BY epoch) AS last_good FROM e),
s AS (SELECT *, MIN(CASE WHEN place - last_good > 2 THEN place END) OVER (PARTITION BY run) AS stop FROM g)
SELECT run, MAX(CASE WHEN good THEN epoch END) AS best_epoch, COUNT(*) AS epochs_run FROM s WHERE stop IS NULL OR place <= stop GROUP BY run""")
def _(spark, sf):
    epochs = I.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("epoch"), F.col("o_totalprice").alias("metric"))
    return selection.early_stopping(epochs, 2)


# ------------------------------------------------------------------ similarity and re-ranking
NORM = "sqrt(list_dot_product(vec, vec))"
SIMILAR = f"""unit AS (SELECT item_idx, product_id, list_transform(vec, lambda x: x / greatest({NORM}, 1e-12)) AS vec FROM h),
cosine AS (SELECT a.item_idx, a.product_id, b.item_idx AS similar_idx, b.product_id AS similar_id,
  round(list_dot_product(a.vec, b.vec), 9) AS score FROM unit a CROSS JOIN unit b WHERE a.item_idx <> b.item_idx),
top_similar AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_idx ORDER BY score DESC, similar_idx) AS rank FROM cosine) WHERE rank <= 10),
neighbours AS (SELECT product_id, list(similar_id ORDER BY rank) AS near FROM top_similar GROUP BY product_id)"""


def neighbours(spark, sf) -> DataFrame:
    items = I.vectors(spark, sf)
    found = similar.top_k_similar(items.select("item_idx", "vec"), 10)
    return similar.neighbour_lists(found, items.select("product_id", "item_idx"))


@query("i1_l2_normalize", with_(I.VECTORS) + f"""
SELECT product_id, [round(x / greatest({NORM}, 1e-12), 6) FOR x IN vec] AS v FROM h""")
def _(spark, sf):
    unit = I.vectors(spark, sf).select("product_id", arrays.l2_normalize("vec").alias("v"))
    return unit.select("product_id", arrays.rounded("v", 6).alias("v"))


@query("i2_top_k_similar", with_(I.VECTORS, SIMILAR) + """
SELECT item_idx, similar_idx, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM top_similar""")
def _(spark, sf):
    items = I.vectors(spark, sf).select("item_idx", "vec")
    return similar.top_k_similar(items, 10).withColumn("score", F.round("score", 6))


@query("i2_candidate_recall", None)
def _(spark, sf):
    items = I.vectors(spark, sf).select("item_idx", "vec")
    # every item is asked: the exact neighbours of all, and the candidates of all
    exact = similar.top_k_similar(items, 10).select("item_idx", "similar_idx")
    return similar.recall(exact, similar.similar_candidates(items, 10))


@query("a11_keyed_lookup", with_(I.VECTORS, SIMILAR) + """
SELECT product_id AS key, CAST(to_json(near) AS VARCHAR) AS value, TIMESTAMP '2026-01-09 00:00:00' AS expires_at FROM neighbours""")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.write_lookup(sinks.keyed_lookup(neighbours(spark, sf), "product_id", "similar", datetime(2026, 1, 2)), path)
    live = sinks.read_lookup(spark, path, datetime(2026, 1, 3))
    return live.withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


RECENT = """ordered AS (SELECT *, row_number() OVER w AS back, date_diff('microsecond', ts, lag(ts) OVER w) AS gap
  FROM stream WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)),
broken AS (SELECT *, MAX(CASE WHEN gap >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY back) AS gone FROM ordered),
recents AS (SELECT user_id, list(product_id ORDER BY back DESC) AS recent_items, MAX(ts) AS last_ts FROM broken
  WHERE back <= 20 AND gone = 0 GROUP BY user_id)"""
MERGED_SEQ = """merged AS (SELECT user_id, list_concat(COALESCE(item_sequence, []), COALESCE(recent_items, [])) AS joined
  FROM users FULL OUTER JOIN recents USING (user_id)),
seqs AS (SELECT user_id, joined[greatest(1, len(joined) - 9):] AS items FROM merged)"""


def recents(spark, sf) -> DataFrame:
    return sessions.recent_items(I.events(spark, sf))


@query("i3_merge_sequence", with_(I.BRONZE, I.SILVER, I.USERS, I.EVENTS, RECENT, MERGED_SEQ) + """
SELECT user_id, array_to_string(items, ',') AS items FROM seqs""")
def _(spark, sf):
    merged = rerank.merged_sequences(I.user_sequences(spark, sf), recents(spark, sf))
    return merged.withColumn("items", F.array_join("items", ","))


@query("i4_to_indices", with_(I.BRONZE, I.SILVER, I.USERS, I.EVENTS, RECENT, MERGED_SEQ, I.VECTORS) + """
SELECT s.user_id, COALESCE(string_agg(CAST(h.item_idx AS VARCHAR), ',' ORDER BY pos), '') AS indices FROM
  (SELECT user_id, unnest(items) AS product_id, generate_subscripts(items, 1) AS pos FROM seqs) s LEFT JOIN h USING (product_id) GROUP BY s.user_id""")
def _(spark, sf):
    merged = rerank.merged_sequences(I.user_sequences(spark, sf), recents(spark, sf))
    out = rerank.to_indices(merged, I.vectors(spark, sf).select("product_id", "item_idx"))
    return out.withColumn("indices", F.array_join("indices", ","))


BOOSTS = """recent_flat AS (SELECT user_id, len(recent_items) AS n, unnest(recent_items) AS recent, generate_subscripts(recent_items, 1) AS pos FROM recents),
similar_flat AS (SELECT product_id AS recent, unnest(near) AS product_id, generate_subscripts(near, 1) AS place FROM neighbours),
boosts AS (SELECT user_id, s.product_id, MIN((n - pos + 1, place)) AS boost FROM recent_flat JOIN similar_flat s USING (recent) GROUP BY user_id, s.product_id)"""


@query("i5_recency_boost", with_(*SCORED, BEST, SIMILAR, I.EVENTS, RECENT, BOOSTS) + """
SELECT user_id, product_id, round(score, 6) AS score, rank, position FROM (
  SELECT b.user_id, b.product_id, score, b.rank, boost, row_number() OVER (PARTITION BY b.user_id ORDER BY boost IS NULL, boost, rank) AS position
  FROM best b LEFT JOIN boosts x ON x.user_id = b.user_id AND x.product_id = b.product_id)""")
def _(spark, sf):
    # the boost moves items of any rank, so the whole catalog is ranked for every user
    boosts = rerank.boost_keys(recents(spark, sf), neighbours(spark, sf))
    out = rerank.boosted_ranking(durable(user_states(spark, sf)), I.vectors(spark, sf), boosts)
    return out.select("user_id", "product_id", arrays.rounded_scaled("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"),
                      F.col("position").cast("long").alias("position"))


DESCRIBED = """described AS (SELECT product_id, title, image_url,
  CASE WHEN price IS NOT NULL THEN category || ' · $' || CAST(price AS VARCHAR) ELSE category END AS description FROM products)"""


@query("i6_build_history", with_(I.PRODUCTS, DESCRIBED, I.BRONZE, I.SILVER, I.USERS, I.EVENTS, RECENT) + """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY part, pos DESC) AS INT) AS position, product_id, event_time, source, title, description FROM (
  SELECT user_id, 0 AS part, unnest(recent_items) AS product_id, generate_subscripts(recent_items, 1) AS pos, CAST(NULL AS TIMESTAMP) AS event_time, 'session' AS source FROM recents
  UNION ALL SELECT user_id, 1, unnest(item_sequence), generate_subscripts(item_sequence, 1), unnest(event_time_sequence), 'history' FROM users)
LEFT JOIN described USING (product_id)""")
def _(spark, sf):
    metadata = gold.item_metadata(I.products(spark, sf))
    return rerank.build_history(I.user_sequences(spark, sf), recents(spark, sf), metadata)


# what the page and the features and sequences below it read; the rest is neither shuffled nor stored
PAGE_SILVER = ("interaction_id", "user_id", "product_id", "event_type", "rating", "event_time")
PAGE_ITEMS = ("product_id", "title", "category", "price", "image_url", "num_purchases", "num_views")


def homepage(spark, sf) -> DataFrame:
    vectors, fresh = I.vectors(spark, sf), durable(recents(spark, sf))
    silver = durable(I.silver_interactions(spark, sf).select(*PAGE_SILVER))
    items = durable(I.item_features(spark, sf, silver).select(*PAGE_ITEMS))
    merged = rerank.merged_sequences(I.user_sequences(spark, sf, silver), fresh)
    histories = scoring.history_vectors(merged, vectors, "items", MAX_LEN, item="product_id")
    states = durable(scoring.last_item_states(histories))
    users = I.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"))

    page = rerank.homepage(
        users, states, vectors, fresh, neighbours(spark, sf), items, gold.item_metadata(items), DIMS, 10)
    return page.select("user_id", "position", "product_id", F.round("score", 6).alias("score"), "source", "title", "description", "image_url")


@query("i7_homepage", with_(I.PRODUCTS, DESCRIBED, I.BRONZE, I.SILVER, I.ITEM_FEATURES, POPULAR, I.USERS, I.EVENTS, RECENT, MERGED_SEQ,
                            I.VECTORS, """
known AS (SELECT s.user_id, s.pos, h.vec FROM
  (SELECT user_id, unnest(items) AS product_id, generate_subscripts(items, 1) AS pos FROM seqs) s JOIN h ON h.product_id = s.product_id),
states AS (SELECT user_id, arg_max(vec, pos) AS state FROM known GROUP BY user_id),
all_scores AS (SELECT user_id, p.product_id, p.position AS popularity, COALESCE(round(list_dot_product(state, vec), 9), 0.0) AS score
  FROM states CROSS JOIN popular p LEFT JOIN h ON h.product_id = p.product_id)""", SIMILAR, BOOSTS, """
placed AS (SELECT b.user_id, b.product_id, b.score,
    row_number() OVER (PARTITION BY b.user_id ORDER BY boost IS NULL, boost, score DESC, popularity) AS position
  FROM all_scores b LEFT JOIN boosts x ON x.user_id = b.user_id AND x.product_id = b.product_id
  WHERE b.user_id IN (SELECT user_id FROM all_scores WHERE score <> 0.0)),
page AS (SELECT user_id, position, product_id, score, 'model' AS source FROM placed WHERE position <= 10
  UNION ALL SELECT user_id, position, product_id, 0.0, 'fallback' FROM
  (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE 'u' || CAST(c_custkey AS VARCHAR) NOT IN (SELECT user_id FROM placed))
  CROSS JOIN popular WHERE position <= 10)""") + """
SELECT user_id, CAST(position AS INT) AS position, product_id, round(score, 6) AS score, source, title, description, image_url FROM page LEFT JOIN described USING (product_id)""")
def _(spark, sf):
    return homepage(spark, sf)


@query("i8_similar_or_fallback", with_(I.PRODUCTS, I.BRONZE, I.SILVER, I.ITEM_FEATURES, POPULAR, I.VECTORS, SIMILAR) + """
SELECT p.product_id, array_to_string(COALESCE(n.near, (SELECT list(product_id ORDER BY position) FROM popular WHERE position <= 10)), ',') AS items,
  CASE WHEN n.near IS NULL THEN 'fallback' ELSE 'similar_items' END AS source
FROM products p LEFT JOIN neighbours n ON n.product_id = p.product_id""")
def _(spark, sf):
    popular = rerank.popular_list(I.item_features(spark, sf), 10)
    out = similar.similar_or_fallback(I.products(spark, sf).select("product_id"), neighbours(spark, sf), popular)
    return out.withColumn("items", F.array_join("items", ","))
