"""Toxicity scores by gradient-boosted trees over dense text features.

Features: densities of a lexicon of words and word beginnings that is learned from labelled
rows, how near second-person words stand to its hits, and rates of capitals, punctuation
and obfuscated words.  Trees are fitted on a bounded sample of labelled rows; for these the
lexicon features come from the other half of the sample, so they look as on new rows.  Raw
scores are turned into probabilities by isotonic regression over cross-fitted raw scores.

A lexicon key is kept where its smoothed rate in toxic rows is over ``LEAST_ODDS`` times that
in clean ones and enough toxic rows have it, whatever the share of toxic rows.

Defined results: null and empty texts have all-zero features and get the score of those; with
no labelled rows, or labels of one kind, the score is the share of toxic labels (0 if none);
where labels are so few that a calibration fold cannot be fitted without them, the other folds
calibrate, and where none can, the trees' own scores.  Repeated rows are scored each for
itself (labelled ones count as often as they stand); an empty table gives no rows; other
columns pass through, but for one named as the output in whichever case, which is replaced; a
text of any length is read whole, and what is kept between texts (short runs only) does not
grow with it; words of more than ``MEMO_CHARS`` characters are keys by their beginnings alone.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import MEMO_CHARS, UNICODE_SPACE, TwoGenerationCache, discard, frames_in_portions, kept_fields, materialise, per_process, portions

#: Labelled rows that the trees, the lexicon and the calibration are fitted on, at most about.
TRAINING_ROWS = 20_000
LEXICON_ENTRIES = 4_000
LEAST_ODDS = 8.0
PREFIXES = (4, 5, 6)
FOLDS = 5

#: Second-person words of the supported languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti usted ustedes tuyo vosotros".split())
#: Characters that stand for letters in obfuscated words.
LEET = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"[^\W_]+(?:[@$!|*0-9][^\W_]+)*")
_OBFUSCATED = re.compile(r"[^\W\d_][@$!|*0-9]+[^\W\d_]")
_RUN = re.compile(f"[^{UNICODE_SPACE}]+")

FEATURES = ("hits", "hit_rate", "weight_rate", "weight_max", "you_near", "you_rate", "capital_rate", "shout_rate", "exclaim_rate", "punct_rate", "obfuscated_rate", "digit_rate", "log_words")


def keys_of(word: str) -> list[str]:
    """Lexicon keys of a word: itself and its beginnings."""
    return [*([f"={word}"] if len(word) <= MEMO_CHARS else []), *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


class Lexicon:
    """Weight of a word: the largest of its keys' log-odds; plain, else with stand-ins read as letters."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def weight(self, word: str) -> float:
        best = max((self.weights.get(k, 0.0) for k in keys_of(word)), default=0.0)
        if not best and not word.isalpha():
            best = max((self.weights.get(k, 0.0) for k in keys_of(word.translate(LEET))), default=0.0)
        return best


def _point_kinds() -> np.ndarray:
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x30000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        kinds[cp] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in "!?" else 0 if c.isspace() else 5
    return kinds


class Extractor:
    """Features of whole texts; what a run of characters holds is kept in a memo."""

    def __init__(self, lexicon: Lexicon, memo: int = 1 << 17):
        self.lexicon, self.memo, self.kinds = lexicon, TwoGenerationCache(memo), _point_kinds()

    def run(self, run: str) -> tuple:
        """(weight, second person, obfuscated, all capitals) of a run; the empty tuple if nothing of these."""
        words = _WORD.findall(run)
        weight = max((self.lexicon.weight(w.lower()) for w in words), default=0.0)
        you = any(w.lower() in SECOND_PERSON for w in words)
        odd = bool(_OBFUSCATED.search(run))
        loud = len(run) > 2 and run.isupper()
        return self.memo.put(run, (weight, you, odd, loud) if weight or you or odd or loud else ())

    def features(self, text: str) -> list[float]:
        runs = _RUN.findall(text)
        if not runs:
            return [0.0] * len(FEATURES)
        get = self.memo.get
        got = [get(r) for r in runs]
        got = [self.run(r) if g is None else g for r, g in zip(runs, got, strict=True)]
        marks = [(k, g) for k, g in enumerate(got) if g]
        hits = [(k, g[0]) for k, g in marks if g[0]]
        yous = np.array([k for k, g in marks if g[1]])
        near = 0.0
        if hits and len(yous):
            at = np.array([k for k, _ in hits])
            left = np.searchsorted(yous, at)
            gap = np.minimum(np.abs(at - yous[np.maximum(left - 1, 0)]), np.abs(at - yous[np.minimum(left, len(yous) - 1)]))
            near = float((1.0 / (1.0 + gap)).max())
        kinds = np.bincount(self.kinds[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")], minlength=6)
        n, letters, chars = len(runs), max(1, kinds[1] + kinds[2]), max(1, len(text))
        weights = [w for _, w in hits]
        return [
            float(len(hits)), len(hits) / n, sum(weights) / n, max(weights, default=0.0), near, len(yous) / n,
            kinds[1] / letters, sum(g[3] for _, g in marks) / n, kinds[4] / chars, (kinds[4] + kinds[5]) / chars,
            sum(g[2] for _, g in marks) / n, kinds[3] / chars, float(np.log1p(n)),
        ]


class Trees:
    """Boosted regression trees on the logistic loss, split on quantile bins; ``least`` rows on each side of a split."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: int = 4):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        raw = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            tree = self._grow(binned, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            raw += self._value(tree, x)
        return self

    def _grow(self, binned, edges, gradient, hessian):
        """Levels of (feature, threshold) by node; leaves' values at the end."""
        node = np.zeros(len(gradient), dtype=np.int64)
        feature, threshold = [], []
        for level in range(self.depth):
            width = 1 << level
            best = [(0.0, 0, np.inf)] * width
            for f, cut in enumerate(edges):
                size = len(cut) + 1
                at = node * size + binned[:, f]
                g = np.bincount(at, gradient, width * size).reshape(width, size)
                h = np.bincount(at, hessian, width * size).reshape(width, size)
                n = np.bincount(at, minlength=width * size).reshape(width, size)
                gl, hl, nl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1], n.cumsum(1)[:, :-1]
                gr, hr = g.sum(1, keepdims=True) - gl, h.sum(1, keepdims=True) - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (g.sum(1) ** 2 / (h.sum(1) + 1))[:, None]
                gain[(nl < self.least) | (n.sum(1, keepdims=True) - nl < self.least)] = 0
                if not gain.size:
                    continue
                for k in range(width):
                    b = int(gain[k].argmax())
                    if gain[k, b] > best[k][0] + 1e-12:
                        best[k] = (float(gain[k, b]), f, float(cut[b]))
            feature.append(np.array([b[1] for b in best]))
            threshold.append(np.array([b[2] for b in best]))
            cuts = np.array([np.searchsorted(edges[b[1]], b[2], side="left") if np.isfinite(b[2]) else 1 << 30 for b in best])
            node = node * 2 + (binned[np.arange(len(node)), feature[-1][node]] > cuts[node])
        g, h = np.bincount(node, gradient, 1 << self.depth), np.bincount(node, hessian, 1 << self.depth)
        return feature, threshold, self.rate * g / (h + 1)

    def _value(self, tree, x):
        feature, threshold, leaf = tree
        node = np.zeros(len(x), dtype=np.int64)
        for f, t in zip(feature, threshold, strict=True):
            node = node * 2 + (x[np.arange(len(x)), f[node]] > t[node])
        return leaf[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((self._value(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a non-decreasing map from raw score to probability."""
    # equal raw scores have one value, whatever is pooled with them
    scores, at = np.unique(raw, return_inverse=True)
    weights = np.bincount(at)
    blocks: list[list[float]] = []  # mean, weight, first, last
    for s, v, n in zip(scores, np.bincount(at, y) / weights, weights, strict=True):
        blocks.append([float(v), float(n), s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, b = blocks.pop()
            m1, w1, a, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, a, b])
    xs = np.array([x for b in blocks for x in ((b[2], b[3]) if b[3] > b[2] else (b[2],))])
    ys = np.array([b[0] for b in blocks for _ in range(2 if b[3] > b[2] else 1)])
    return xs, ys


class Model:
    """Lexicon, trees and calibration; a constant where nothing could be fitted."""

    def __init__(self, lexicon: Lexicon, trees: Trees | None, knots, constant: float = 0.0):
        self.lexicon, self.trees, self.knots, self.constant = lexicon, trees, knots, constant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        raw = self.trees.raw(x)
        fitted = np.interp(raw, *self.knots)
        # a little of the raw score keeps the order inside a level
        return np.clip(0.998 * fitted + 0.002 / (1 + np.exp(-raw)), 0.0, 1.0)


def _lexicon(stats: pd.DataFrame, toxic: float, clean: float, size: int, tox: str, rest: str, least: int = 3) -> Lexicon:
    """Keys that are far commoner in toxic rows, with their log-odds."""
    odds = np.log((stats[tox] + 0.2) / (toxic + 1)) - np.log((stats[rest] + 0.2) / (clean + 1))
    keep = stats.assign(odds=odds)[(odds > np.log(LEAST_ODDS)) & (stats[tox] >= least)].sort_values(["odds", "key"], ascending=[False, True]).head(size)
    return Lexicon(dict(zip(keep["key"], keep["odds"].astype(float), strict=True)))


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", rows: int = TRAINING_ROWS) -> Model:
    """Fit on about ``rows`` rows of ``labelled`` (text, label, key), taken by key hash; others are not read as text."""
    spark = labelled.sparkSession
    labelled = labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    hashed = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20))
    share = min(1.0, rows / max(1, labelled.select(key).count()))
    sample = labelled.where(hashed < int(np.ceil(share * (1 << 20)))).select(F.coalesce(F.col(text), F.lit("")).alias("text"), (F.col(label) > 0).cast("int").alias("y"), F.pmod(F.xxhash64(F.lit("half"), F.col(key).cast("string")), F.lit(10)).cast("int").alias("part"))
    sample = materialise(sample, "toxic-sample")
    sizes = sample.groupBy((F.col("part") % 2).alias("half"), "y").count().toPandas()
    n = {(int(r.half), int(r.y)): float(r["count"]) for _, r in sizes.iterrows()}
    toxic, clean = (sum(v for (_, y), v in n.items() if y == k) for k in (1, 0))
    if not toxic or not clean:
        return Model(Lexicon({}), None, None, toxic / max(1.0, toxic + clean))
    stats = _key_counts(sample, n).toPandas()
    full = _lexicon(stats.assign(t=stats.t0 + stats.t1, c=stats.c0 + stats.c1), toxic, clean, LEXICON_ENTRIES, "t", "c")
    # a row's half sees the lexicon of the other half
    half = [_lexicon(stats, n.get((k, 1), 0.0), n.get((k, 0), 0.0), LEXICON_ENTRIES, f"t{k}", f"c{k}", 2) for k in (1, 0)]
    frame = _feature_rows(sample, half).toPandas()
    discard(sample)
    x, y, part = np.array(frame["x"].tolist()), frame["y"].to_numpy(float), frame["part"].to_numpy()
    # each row's raw score for the calibration comes from trees that have not seen it
    raw, used, trees = np.zeros(len(y)), np.zeros(len(y), dtype=bool), Trees().fit(x, y)
    for fold in range(FOLDS):
        own = part % FOLDS == fold
        if own.any() and len(set(y[~own])) == 2:
            raw[own] = Trees().fit(x[~own], y[~own]).raw(x[own])
            used |= own
    if len(set(y[used])) < 2:
        raw, used = trees.raw(x), np.ones(len(y), dtype=bool)
    return Model(full, trees, isotonic(raw[used], y[used]))


def _key_counts(sample: DataFrame, n: dict[tuple[int, int], float]) -> DataFrame:
    """Rows by lexicon key, half and label, of the keys that :func:`_lexicon` can take for either half or for both.

    ``n`` has the rows by half and label.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: Counter() for name in ("t0", "t1", "c0", "c1")}

        def rows() -> Iterator[pa.RecordBatch]:
            keys = list(set().union(*sums.values()))
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                columns = [pa.array(part, pa.string()), *(pa.array([c[k] for k in part], pa.int64()) for c in sums.values())]
                yield pa.RecordBatch.from_arrays(columns, ["key", *sums])
            for c in sums.values():
                c.clear()

        for batch in portions(batches):
            for text, y, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = {w.lower() for w in _WORD.findall(text)}
                sums[f"{'t' if y else 'c'}{part % 2}"].update({k for w in words for k in keys_of(w)})
                if sum(map(len, sums.values())) > 200_000:  # bounded memory; the sums meet after the shuffle
                    yield from rows()
        yield from rows()

    parts = sample.mapInArrow(counted, "key string, t0 bigint, t1 bigint, c0 bigint, c1 bigint")
    summed = parts.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("t0", "t1", "c0", "c1")))
    rows = [n.get(k, 0.0) for k in ((0, 1), (1, 1), (0, 0), (1, 0))]
    t0, t1, c0, c1 = (F.col(c) for c in ("t0", "t1", "c0", "c1"))
    keep = F.lit(False)
    for t, c, toxic, clean in ((t0, c0, rows[0], rows[2]), (t1, c1, rows[1], rows[3]), (t0 + t1, c0 + c1, rows[0] + rows[1], rows[2] + rows[3])):
        # a little below the limit, which is applied afterwards in the same arithmetic for all
        keep |= (t >= 2) & ((t + 0.2) / (toxic + 1) > 0.999 * LEAST_ODDS * (c + 0.2) / (clean + 1))
    return summed.where(keep)


def _feature_rows(sample: DataFrame, halves: list[Lexicon]) -> DataFrame:
    sent = sample.sparkSession.sparkContext.broadcast([x.weights for x in halves])

    def extracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_half = [Extractor(Lexicon(w)) for w in sent.value]
        for frame in frames_in_portions(frames):
            x = [by_half[part % 2].features(t) for t, part in zip(frame["text"], frame["part"], strict=True)]
            yield pd.DataFrame({"x": x, "y": frame["y"], "part": frame["part"]})

    return sample.mapInPandas(extracted, "x array<double>, y int, part int")


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Append ``out`` (0 to 1) for the whole text; all other columns pass through."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(pickle.dumps(model))
    schema = T.StructType([*kept_fields(docs, [out]), T.StructField(out, T.DoubleType())])
    names = [f.name for f in schema][:-1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            model = pickle.loads(sent.value)
            return model, Extractor(model.lexicon)

        model, extractor = per_process(("toxicity", hash(sent.value)), make)
        for batch in portions(batches):
            x = np.array([extractor.features(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]).reshape(-1, len(FEATURES))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.score(x))], [*names, out])

    return docs.mapInArrow(scored, schema)
