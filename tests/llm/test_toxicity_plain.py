"""Features, trees, calibration and scores of the toxicity operator against plain versions."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from regivane.llm import toxicity

WEIGHTS = {"=idiot": 3.0, "^stup": 2.5, "^vilest": 4.0, "=hate": 1.5}


def plain_weight(word):
    def of(w):
        return max([WEIGHTS.get("=" + w, 0.0), *(WEIGHTS.get("^" + w[:n], 0.0) for n in (4, 5, 6) if len(w) >= n)])

    return of(word) or of(word.translate(toxicity.LEET))


def plain_features(text):
    runs = [r for r in re.split(f"[{toxicity.UNICODE_SPACE}]+", text) if r]
    if not runs:
        return [0.0] * 13
    words = [[w.lower() for w in re.findall(r"[^\W_]+(?:[@$!|*0-9][^\W_]+)*", r)] for r in runs]
    weights = [max((plain_weight(w) for w in ws), default=0.0) for ws in words]
    hits, yous = [k for k, w in enumerate(weights) if w], [k for k, ws in enumerate(words) if set(ws) & toxicity.SECOND_PERSON]
    near = max((1 / (1 + min(abs(h - y) for y in yous)) for h in hits), default=0.0) if yous else 0.0
    n, chars = len(runs), len(text)
    upper, letters = sum(c.isupper() for c in text), sum(c.isalpha() or c.isupper() for c in text)
    exclaim, digits = sum(c in "!?" for c in text), sum(c.isdigit() and not c.isalpha() for c in text)
    others = sum(not (c.isupper() or c.isalpha() or c.isdigit() or c in "!?" or c.isspace()) for c in text)
    odd = sum(bool(re.search(r"[^\W\d_][@$!|*0-9]+[^\W\d_]", r)) for r in runs)
    shout = sum(len(r) > 2 and r.isupper() for r in runs)
    return [len(hits), len(hits) / n, sum(weights) / n, max(weights), near, len(yous) / n, upper / max(1, letters), shout / n, exclaim / chars, (exclaim + others) / chars, odd / n, digits / chars, math.log1p(n)]


def test_features():
    texts = ["", " \n", "You are an IDIOT, you st*pid st0pid vilestone!", "i hate this. 12 h@te you?", "Nothing here at all; a calm day.", "SHOUT at du UND dich... é漢字 🙂", "hate " * 50 + "far away you"]
    extractor = toxicity.Extractor(toxicity.Lexicon(WEIGHTS), memo=4)
    for text in texts * 2:
        assert np.allclose(extractor.features(text), plain_features(text)), text


def plain_trees(x, y, rounds, depth, rate, bins, least):
    """Raw scores of the rows that the trees are fitted on, every split tried one by one."""
    raw = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]

    def grow(rows, g, h, left):
        best = (1e-12, None)
        for f in range(x.shape[1]) if left else []:
            for cut in cuts[f]:
                low = [r for r in rows if x[r, f] <= cut]
                high = [r for r in rows if x[r, f] > cut]
                if len(low) >= least and len(high) >= least:
                    gain = sum(g[part].sum() ** 2 / (h[part].sum() + 1) for part in (low, high)) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, (low, high))
        if best[1] is None:
            return {r: rate * g[rows].sum() / (h[rows].sum() + 1) for r in rows}
        return grow(best[1][0], g, h, left - 1) | grow(best[1][1], g, h, left - 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        step = grow(list(range(len(y))), y - p, p * (1 - p), depth)
        raw = raw + np.array([step[r] for r in range(len(y))])
    return raw


def test_trees():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(70, 4)), 1)
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5) | (rng.random(70) < 0.1)).astype(float)
    options = {"rounds": 6, "depth": 3, "rate": 0.3, "bins": 8, "least": 4}
    assert np.allclose(toxicity.Trees(**options).fit(x, y).raw(x), plain_trees(x, y, **options))


def test_isotonic():
    rng = np.random.default_rng(4)
    raw = np.round(rng.normal(size=60), 1)
    y = (rng.random(60) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    values = sorted(set(raw))
    means = lambda a, b: y[(raw >= a) & (raw <= b)].mean()
    plain = [max(min(means(a, b) for b in values if b >= v) for a in values if a <= v) for v in values]
    knots = toxicity.isotonic(raw, y)
    assert np.allclose(np.interp(values, *knots), plain)


def test_scores_follow_from_the_parts(spark, make_docs):
    rng = np.random.default_rng(5)
    calm = "the day was long and we walked home by the river".split()
    docs, labels = [], []
    for k in range(300):
        words = list(rng.choice(calm, 12))
        if k % 3 == 0:
            words[int(rng.integers(12))] = "idiot"
            words[int(rng.integers(12))] = "You"
        docs.append((k, " ".join(words)))
        labels.append((k, int(k % 3 == 0)))
    table = make_docs(docs)
    model = toxicity.fit(table.select("doc_id", "text").join(spark.createDataFrame(labels, "doc_id bigint, toxic int"), "doc_id"))
    # the lexicon: smoothed odds of rows by key
    rows = {k: {key for w in t.lower().split() for key in toxicity.keys_of(w)} for k, t in docs}
    toxic = {k for k, y in labels if y}
    for key in set().union(*rows.values()):
        t, c = sum(key in rows[k] for k in toxic), sum(key in rows[k] for k in rows if k not in toxic)
        odds = math.log((t + 0.2) / (len(toxic) + 1)) - math.log((c + 0.2) / (len(docs) - len(toxic) + 1))
        assert (key in model.lexicon.weights) == (odds > math.log(toxicity.LEAST_ODDS) and t >= 3)
        if key in model.lexicon.weights:
            assert math.isclose(model.lexicon.weights[key], odds)
    extractor = toxicity.Extractor(model.lexicon)
    raw = model.trees.raw(np.array([extractor.features(t) for _, t in docs]))
    plain = 0.998 * np.interp(raw, *model.knots) + 0.002 / (1 + np.exp(-raw))
    got = [r.score for r in toxicity.score(table, model, out="score").orderBy(F.col("doc_id")).collect()]
    assert np.allclose(got, np.clip(plain, 0, 1))
