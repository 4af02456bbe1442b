import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from regivane.llm import language_id, queries, toxicity


TABLE = language_id.class_table()


def gram(*classes):
    return sum(ord(c) << 16 * (len(classes) - 1 - k) if c else 0 for k, c in enumerate(classes))


def test_grams():
    codes, spans = language_id.grams(["ab c", "", "--AB!", "é", "Жж"], TABLE)
    read = [codes[a:b].tolist() for a, b in spans]
    assert read[0] == [gram("", "", "", "a"), gram("", "", "a", "b"), gram("", "a", "b", ""), gram("a", "b", "", "c"), gram("b", "", "c", "")]
    assert read[1] == [] and len(read[2]) == 3 and read[2][:2] == read[0][:2] and len(read[3]) == 2
    assert read[4][:2] == [gram("", "", "", "ж"), gram("", "", "ж", "ж")]


def test_letters_are_classes_of_their_own():
    for letters in ("abcdefghijklmnopqrstuvwxyzäöüßéèñç", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "的一是不了人我在有他这为之大来以个中上们"):
        assert len({int(TABLE[ord(c)]) for c in letters}) == len(letters)


def plain_kneser_ney(texts):
    """Probability of a class after three others, straight from the definition, over lists of classes."""
    fours = Counter()
    for text in texts:
        codes, spans = language_id.grams([text], TABLE)
        for code in codes[spans[0, 0] : spans[0, 1]].tolist():
            fours[tuple(code >> 16 * k & 0xFFFF for k in (3, 2, 1, 0))] += 1
    levels = [fours]
    for _ in range(3):
        levels.append(Counter(g[1:] for g in levels[-1]))
    levels = levels[::-1]

    def prob(gram):
        if not gram:
            return 1 / 65536
        counts = levels[len(gram) - 1]
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        after = {g: n for g, n in counts.items() if g[:-1] == gram[:-1]}
        if not after:
            return prob(gram[1:])
        total = sum(after.values())
        return max(counts.get(gram, 0) - d, 0) / total + d * len(after) / total * prob(gram[1:])

    return fours, prob


def test_smoothing_equals_a_plain_version():
    texts = ["the cat sat on the mat and the dog", "другой текст и другие слова тут", "ένα κείμενο και άλλο κείμενο", "这是中文 这也是中文"]
    fours, prob = plain_kneser_ney(texts)
    pack = lambda g: sum(c << 16 * (3 - k) for k, c in enumerate(g))
    model = language_id.Smoothed(np.array([pack(g) for g in fours], dtype=np.uint64), np.array(list(fours.values())))
    letters = [0, *map(ord, "thecatждκο这中q")]
    rng = np.random.default_rng(1)
    asked = [*fours, *(tuple(int(x) for x in rng.choice(letters, 4)) for _ in range(200))]
    got = np.exp(model.log_probs(np.array([pack(g) for g in asked], dtype=np.uint64)).astype(float))
    assert np.allclose(got, [prob(g) for g in asked], rtol=1e-4)
    for context in (pack((0, *next(iter(fours))[:3])), pack((0, 5, 5, 5))):
        every = (np.uint64(context) << np.uint64(16)) | np.arange(65536, dtype=np.uint64)
        assert abs(np.exp(model.log_probs(every).astype(float)).sum() - 1) < 1e-3


def test_the_most_frequent_grams_are_kept(spark):
    rows = [("a", k, 1000 - k) for k in range(1, 900)] + [("b", k, 5) for k in range(1, 900)]
    kept = language_id._most_frequent(spark.createDataFrame(rows, "lang string, code bigint, n bigint"), 400)
    # whole steps of a count, and of the last step whole cells
    assert 100 < len(kept["a"][0]) <= 200 and set(range(1, 100)) < set(kept["a"][0].tolist()) and max(kept["a"][0]) < 300
    assert 100 < len(kept["b"][0]) <= 200


def test_a_bound_on_the_grams_leaves_their_probabilities(spark, make_docs):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdeilmnorst"), rng.integers(1, 8))) for _ in range(400)]
    rows = [(k, " ".join(words[min(399, int(rng.pareto(0.8) * 3))] for _ in range(40)), "xy"[k % 2]) for k in range(300)]
    counts = language_id._train_counts(make_docs(rows), "text", "lang").cache()
    all_ = language_id.smoothed_models(counts)
    for name in "xy":
        own = counts.where(F.col("lang") == name).where("code != 0").toPandas()
        codes = own["code"].to_numpy().view(np.uint64)
        # all grams: as one process finds them from the counts
        local = language_id.Smoothed(codes, own["n"].to_numpy())
        grams = np.concatenate([codes, rng.choice(codes, 500) ^ np.uint64(7)])
        assert np.allclose(all_[name].log_probs(grams), local.log_probs(grams), atol=1e-4)
    for bound in (len(codes), len(codes) // 4):
        few = language_id.smoothed_models(counts, bound)["y"]
        kept = codes[few.orders[3][0].find(codes)[1]]
        assert 0 < len(kept) < 0.6 * len(codes)
        assert np.allclose(few.log_probs(kept), all_["y"].log_probs(kept), atol=1e-5)
        for context in [*(kept[:3] >> np.uint64(16)), np.uint64(12345)]:
            every = (np.uint64(context) << np.uint64(16)) | np.arange(65536, dtype=np.uint64)
            assert abs(np.exp(few.log_probs(every).astype(float)).sum() - 1) < 1e-3


def test_scripts(make_docs):
    """Languages that share a script are told apart by their letters."""
    words = {
        "ru": "и в не на я быть он с что а по это она этот к но они мы весь который из у то за свой ты год от так о для",
        "uk": "і в не на я бути він з що а по це вона цей до але вони ми весь який із у то за свій ти рік від так про для є ї",
        "el": "και το να του η της με που την από για είναι ο σε τα θα δεν στο οι ένα των τον μια αυτό στην",
        "zh": "的一 是不 了人 我在 有他 这为 之大 来以 个中 上们 到说 国和 地也 子时 道出 而要 于就 下得",
        "ja": "の に は を た が で て と し れ さ ある いる も する から な こと として いや 日本 語で す",
    }
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(words[name].split(), 25)), name) for k, name in enumerate(sorted(words) * 60)]
    models = language_id.train(make_docs(rows), F.col("doc_id") < 200)
    got = language_id.identify(make_docs(rows).where("doc_id >= 200"), models).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.99 and sum(r.rejected for r in got) <= 2
    junk = [(k, " ".join("".join(rng.choice(list("бвгджзклмнпрстфхцчшщ"), 7)) for _ in range(30))) for k in range(20)]
    assert all(r.rejected for r in language_id.identify(make_docs(junk), models).collect())


def test_queries(spark, sf):
    """One row a document, held-out flags, and predictions by functions of the text alone."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for query, modulus in ((queries.op6_toxicity, 5), (queries.op8_language_id, 4)):
        rows = query(spark, sf).collect()
        assert sorted(r.doc_id for r in rows) == sorted(docs)
        held = 0 if modulus == 5 else 2
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) and 0 <= r.score <= 1 for r in rows)
        by_text = {}
        for r in rows:
            by_text.setdefault(docs[r.doc_id].text, set()).add((r.score, r.predicted if modulus == 5 else r.lang_pred))
        assert all(len(v) == 1 for v in by_text.values())
        if modulus == 5:
            assert all(r.predicted == (r.score >= 0.5) for r in rows)
        else:
            assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]) > 0.95


def test_identify(spark, sf, make_docs):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    models = language_id.train(docs, queries.crc_mod("doc_id", 4) != 2)
    odd = make_docs([(1, None), (2, ""), (3, "12 !?"), (4, "the the thing and the other thing " * 9), (5, "é" * 5), (6, "the thing " * 90_000)])
    got = {r.doc_id: r for r in language_id.identify(odd, models).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and all(got[k].rejected and got[k].lang_score == 0 for k in (1, 2, 3))
    assert got[4].lang_pred == "en" and not got[4].rejected and got[4].root == "x" and got[6].lang_pred == "en"
    held = language_id.identify(docs.where(queries.crc_mod("doc_id", 4) == 2), models).collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97 and np.mean([r.rejected for r in held]) < 0.01
    assert all(0 <= r.lang_score <= 1 for r in held)


def test_identify_without_training(make_docs):
    docs = make_docs([(1, "text", None), (2, "more", None)])
    models = language_id.train(docs, F.lit(True))
    assert {(r.lang_pred, r.rejected) for r in language_id.identify(docs, models).collect()} == {("und", True)}


def test_counts_cover_all_rows(make_docs):
    docs = make_docs([(k, "abcd") for k in range(40)]).repartition(7)
    rows = language_id._train_counts(docs, "text", "lang").collect()
    assert {r.n for r in rows} == {40} and len(rows) == 5


def test_counts_do_not_depend_on_what_is_held(make_docs, monkeypatch):
    docs = make_docs([(k, f"some words {k} and others", "en" if k % 3 else "fr") for k in range(200)])
    whole = sorted(map(tuple, language_id._train_counts(docs, "text", "lang").collect()))
    monkeypatch.setattr(language_id, "HELD_GRAMS", 8)
    assert sorted(map(tuple, language_id._train_counts(docs, "text", "lang").collect())) == whole


def test_trees_and_isotonic():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0)).astype(float)
    trees = toxicity.Trees().fit(x[:3000], y[:3000])
    assert ((trees.raw(x[3000:]) > 0) == (y[3000:] > 0.5)).mean() > 0.97
    xs, ys = toxicity.isotonic(trees.raw(x[3000:]), y[3000:])
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and 0 <= ys.min() and ys.max() <= 1
    xs, ys = toxicity.isotonic(np.array([1.0, 1.0, 2.0, 3.0]), np.array([1.0, 0.0, 0.0, 1.0]))
    assert np.allclose(np.interp([1, 2, 3], xs, ys), [1 / 3, 1 / 3, 1])


def test_features():
    e = toxicity.Extractor(toxicity.Lexicon({"=fool": 5.0, "^nasty": 4.0}))
    f = dict(zip(toxicity.FEATURES, e.features("You are a f00l, FOOL! nastyish 12"), strict=True))
    assert f["hits"] == 3 and f["weight_max"] == 5.0 and f["you_near"] == 0.25 and f["obfuscated_rate"] > 0 and f["exclaim_rate"] > 0
    assert e.features("") == [0.0] * len(toxicity.FEATURES) == e.features(" \n ")


@pytest.fixture(scope="module")
def labelled(make_docs):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    rows = []
    for k in range(1200):
        bad = k % 6 == 0
        rows.append((k, " ".join([*rng.choice(words, 40), *(rng.choice(["zvile", "zrotten"], 2) if bad else [])])))
    return make_docs(rows).withColumn("toxic", (F.col("doc_id") % 6 == 0).cast("int"))


def test_toxicity(labelled, make_docs):
    model = toxicity.fit(labelled.where("doc_id < 900").select("doc_id", "text", "toxic"))
    rows = toxicity.score(labelled.where("doc_id >= 900"), model, out="score").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.toxic) for r in rows]) > 0.98
    odd = toxicity.score(make_docs([(1, None), (2, ""), (3, "zvile " * 60_000)]), model, out="score").orderBy("doc_id").collect()
    assert odd[0].score == odd[1].score < 0.5 and odd[2].score >= 0.5 and odd[0].toxicity == "x"
    assert toxicity.score(labelled.limit(0), model).count() == 0


def test_toxicity_at_a_low_base_rate(make_docs):
    """At one toxic row of a hundred a word of high odds stays in the lexicon, though most rows with it are clean."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    rows = []
    for k in range(4000):
        bad = k % 100 == 0
        said = ["zvile"] if bad or k % 40 == 1 else []
        rows.append((k, " ".join([*rng.choice(words, 30), *said, *(["zrotten"] if bad else [])])))
    table = make_docs(rows).withColumn("toxic", (F.col("doc_id") % 100 == 0).cast("int"))
    model = toxicity.fit(table.where("doc_id < 3000").select("doc_id", "text", "toxic"))
    assert model.lexicon.weight("zvile") > np.log(8) and model.lexicon.weight("zrotten") > model.lexicon.weight("zvile")
    got = toxicity.score(table.where("doc_id >= 3000"), model, out="s").collect()
    assert all((r.s >= 0.5) == bool(r.toxic) for r in got)


def test_toxicity_with_few_labels(make_docs):
    """Folds that lack a label are left out of the calibration, not the trees."""
    rows = [(k, "zvile zrotten talk" if k < 4 else f"plain words {k} here") for k in range(24)]
    table = make_docs(rows).withColumn("toxic", (F.col("doc_id") < 4).cast("int"))
    for n in (24, 6):
        model = toxicity.fit(table.where(F.col("doc_id") < n).select("doc_id", "text", "toxic"))
        assert model.trees is not None
        scores = {r.doc_id: r.s for r in toxicity.score(table, model, out="s").collect()}
        assert min(scores[k] for k in range(4)) >= max(scores[k] for k in range(4, 24))


def test_toxicity_without_labels(labelled):
    model = toxicity.fit(labelled.limit(0).select("doc_id", "text", "toxic"))
    assert toxicity.score(labelled.limit(3), model, out="s").select("s").distinct().collect()[0].s == 0.0
    one = toxicity.fit(labelled.where("toxic = 1").select("doc_id", "text", "toxic"))
    assert toxicity.score(labelled.limit(3), one, out="s").first().s == 1.0


def test_order_statistics_are_exact(spark):
    rng = np.random.default_rng(4)
    own = {"a": np.round(rng.normal(size=501), 2), "b": rng.normal(size=40), "c": np.array([0.125])}
    table = spark.createDataFrame([(name, float(x)) for name, v in own.items() for x in v], "name string, value double").repartition(3)
    for steps in (1, 4096):
        got = language_id.order_statistics(table, lambda n: [(n - 1) // 2, n // 2, n - 1], steps)
        assert {k: (np.mean(v[:2]), v[2]) for k, v in got.items()} == {k: (np.median(v), v.max()) for k, v in own.items()}
    assert language_id.order_statistics(table.limit(0), lambda n: [0], 1) == {}


def test_calibration_takes_every_row(spark, sf):
    """Scale and limits are those of all training rows, however they are dealt."""
    docs = spark.read.parquet(sf.replace("0.001", "0.1") + "/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 8000")
    models = language_id.train(docs, F.lit(True))
    rows = [(r.text, r.lang) for r in docs.where("text IS NOT NULL AND lang IS NOT NULL").collect()]
    entropy, n, letters = models.entropies([t for t, _ in rows], TABLE)
    truth = np.array([models.langs.index(x) for _, x in rows])
    entropy, n, truth = entropy[letters], n[letters], truth[letters]
    assert len(truth) > 5000
    best = min(zip(models.losses(entropy, n, truth), language_id.SCALES, strict=True))[1]
    assert models.scale == best
    for k, name in enumerate(models.langs):
        own = entropy[truth == k, k]
        excess = np.sort((own - np.median(own)) * np.sqrt(n[truth == k]))
        assert models.limits[name][0] == pytest.approx(np.median(own), abs=1e-9)
        assert models.limits[name][1] == pytest.approx(1.5 * max(excess[int(np.ceil(len(excess) * 0.999)) - 1], 1.0), abs=1e-6)
