import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.llm import language, noisy, quality, toxicity
from sparkrec.llm.common import drawn, logistic_fit

FIXTURE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FIXTURE}/documents.parquet"), spark.read.parquet(f"{FIXTURE}/labels.parquet")


@pytest.fixture(scope="module")
def labels_of_few(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (8, 1, 0), (None, 0, 1), (9, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


def test_language_of_held_out_texts(tables):
    docs, _ = tables
    got = language.label(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, rows = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 200 and right > 0.98


def test_language_on_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in language.label(odd_docs).collect()}
    assert got[2].lang_pred == got[3].lang_pred == got[7].lang_pred == "und" and got[2].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.label(no_docs).count() == 0
    unknown = language.label(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}


def test_network_learns_and_reads_whole_texts():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list(letters), 300)) for letters in ("abcde ", "vwxyz ") for _ in range(60)]
    x = np.concatenate([language.windows_of(t) for t in texts])
    y = np.repeat([0, 1], len(x) // 2)
    net = language.ByteNet.fresh(["a", "v"]).fit(x, y, epochs=3)
    which, score = language.classify(net, ["abcdeabc", "vwxyzvw", "abcde " * 100 + "vwxyz " * 400], block=2)
    assert which.tolist() == [0, 1, 1] and (score <= 1).all()
    assert bytes(language.windows_of("é" * 500).ravel()).rstrip(b"\0").decode() == "é" * 500


def test_quality_of_held_out_texts(tables):
    docs, labels = tables
    got = quality.label(docs, labels).join(labels, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.93


def test_toxicity_of_held_out_texts(tables):
    docs, labels = tables
    scored = toxicity.label(docs, labels)
    got = scored.join(labels, "doc_id").filter("held_out").groupBy("toxic").agg(F.avg("score").alias("s")).collect()
    mean = {r.toxic: r.s for r in got}
    assert mean[1] > mean[0] + 0.3 and scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


@pytest.mark.parametrize("label", [quality.label, toxicity.label])
def test_scores_on_odd_rows(label, odd_docs, no_docs, labels_of_few):
    got = label(odd_docs, labels_of_few)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert label(no_docs, labels_of_few).count() == 0
    nothing = label(odd_docs, labels_of_few.limit(0)).collect()
    assert len({r.score for r in nothing}) == 1


@pytest.fixture(scope="module")
def reader():
    words = "idiot moron worthless pathetic stupid clown scum disgusting the of and there is a reason for this and that".split()
    text = " ".join(words * 50)
    return toxicity.Restorer(noisy.CharModel(noisy.trigram_counts(text)))


@pytest.mark.parametrize("disguised,word", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooot", "idiot"), ("iiddiioott", "idiot"), ("w.o.r.t.h.l.e.s.s", "worthless"), ("$cum", "scum"),
    ("you i d i o t there", "idiot"), ("p4th3t1c!", "pathetic"), ("S-T-U-P-I-D", "stupid"), ("cl0wn,", "clown"), ("m 0 r 0 n", "moron"),
    ("iidiot", "idiot"), ("stuupid", "stupid"), ("iddiiot", "idiot"), ("id.iot", "idiot"), ("stu_pid", "stupid"), ("st-up-id", "stupid"),
    ("i,d,i,o,t", "idiot"), ("worthle$$", "worthless"), ("worthle$$!", "worthless"), ("i\td\ti\to\tt", "idiot"), ("m\no\nr\no\nn", "moron"),
    ("\uff49\uff44\uff49\uff4f\uff54", "idiot"), ("m\u043er\u043en", "moron"), ("\u0455\u0441um", "scum"), ("STU/PID", "stupid"),
])
def test_disguised_words_are_restored(reader, disguised, word):
    assert word in reader.words(disguised)


def test_plain_words_stay(reader):
    assert reader.words("The reason, and THAT is 12 3x4.") >= {"the", "reason", "and", "that", "is"}
    assert reader.words("") == set() and reader.words("?? !! 123") <= {"a", "i", "b", "e", "iz"} | reader.words("123")
    assert len(reader.words("x1" * 3000)) > 0  # long tokens are read in parts


def test_other_scripts_have_words(reader):
    assert reader.words("\u0414\u0443\u0440\u0430\u043a, \u8fd9\u662f \u0142\u00f3d\u017a") >= {"\u0434\u0443\u0440\u0430\u043a", "\u8fd9\u662f", "\u0142\u00f3d\u017a"}
    assert "moron" not in reader.words("\u043c\u043e\u0440\u0435")


def test_readings_of_letters_need_no_model(reader):
    for token in ("iidiot", "stuupiid", "mooron", "scuuum", "plain", "aabb", "\u00e9\u00e9t\u00e9"):
        assert set(noisy.squeezed(token, 4)) == set(noisy.decode(token, reader.model, 4))
    assert noisy.squeezed("iiddiioott", 4) is None


def _planted(seed: int):
    """Labelled texts: toxic ones hold words of insult, plain where learned from, disguised where held out."""
    rng = np.random.default_rng(seed)
    insults = "idiot moron worthless pathetic stupid clown scum".split()
    common = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(3, 9))) for _ in range(150)]
    forms = [lambda w: w[0] + w, lambda w: w[:2] + "." + w[2:], lambda w: "-".join(w), lambda w: w.replace("o", "0").replace("i", "1"),
             lambda w: " ".join(w), lambda w: w[:3] + "_" + w[3:], lambda w: w.replace("o", "\u043e").replace("c", "\u0441"),
             lambda w: "".join(chr(ord(c) + 0xFEE0) for c in w), lambda w: w[:-1] + w[-1] * 4]
    rows = []
    for i in range(1200):
        words, toxic = list(rng.choice(common, 30)), i % 3 == 0
        if toxic:
            for at in rng.choice(30, 3, replace=False):
                word = str(rng.choice(insults))
                words[at] = word if i < 900 else forms[rng.integers(len(forms))](word)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_disguised_toxic_texts_are_found_by_decoding(spark, monkeypatch):
    rows = _planted(3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.col("doc_id") < 900)
    held = rows[900:]

    def found() -> tuple[float, float]:
        read = model.reader()
        hit = np.array([model.score(np.array([read(t)], float))[0] >= 0.5 for _, t, _ in held])
        toxic = np.array([y for *_, y in held], bool)
        return hit[toxic].mean(), hit[~toxic].mean()

    decoded, wrong = found()
    monkeypatch.setattr(toxicity.Restorer, "_read", lambda self, token: toxicity.WORDS.findall(token))
    plain, _ = found()
    assert decoded > 0.97 and wrong < 0.03 and decoded > plain + 0.25  # 1.00, 0.00 and 0.69 as measured


def test_viterbi_equals_all_paths():
    model = noisy.CharModel(noisy.trigram_counts("idiot moron clown " * 20))

    def paths(token, i=0, a=0, b=0):
        if i == len(token):
            yield model.cost[a][b][0], ""
            return
        for letters, to, charge in noisy.arcs(token)[i]:
            x, y, more = a, b, charge
            for c in letters:
                z = int(noisy.CLASS[ord(c)])
                more += model.cost[x][y][z]
                x, y = y, z
            for cost, rest in paths(token, to, x, y):
                yield cost + more, letters + rest

    for token in ("1d10t", "m00r0nn", "c1o.w-n", "aa1bb"):
        assert noisy.decode(token, model)[0] == min(paths(token))[1]


def test_draws_are_bounded_and_repeat(spark):
    df = spark.range(5000).withColumn("k", F.lit("x")).withColumn("draw", F.xxhash64("id"))
    first = sorted(r.id for r in drawn(df, "k", 1200, "id").collect())
    assert 900 < len(first) <= 1200 and first == sorted(r.id for r in drawn(df.repartition(7), "k", 1200, "id").collect())


def test_logistic_fit():
    x = np.random.default_rng(0).normal(size=(4000, 1))
    y = (np.random.default_rng(1).random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    slope, intercept = logistic_fit(x, y, np.ones(4000), ridge=1e-9)
    assert abs(slope - 2) < 0.3 and abs(intercept + 1) < 0.2
