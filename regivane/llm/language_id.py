"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Every letter is a class of its own, after lower-casing (letters beyond the 16-bit code points
share the 6400 private ones), and every run of other characters is one boundary.  Four-gram
counts per language are taken over all training documents, summed inside each partition
before the shuffle; lower orders use continuation counts.  Discounts, context totals and
probabilities follow from all grams, on the executors.  A model then keeps the most frequent
grams of each language and order, ``MODEL_GRAMS`` of an order for all languages together, which
bounds what is sent to the driver and the executors and leaves the probabilities of kept grams as
they are; what the others had goes to their contexts' back-off shares, so that all still add up to
one.  Each order is a sorted array of gram hashes, found by their first bits, with
log-probabilities; grams that are not there back off.

A text gets the language of the lowest cross-entropy per character.  The score is the
calibrated posterior of that language; a text is rejected where its cross-entropy lies
beyond what the training rows of that language show, and nearer to that of the same rows
with their characters shuffled than to the language's usual text.  Calibration takes every
training row: the tasks sum the losses of each scale, and medians and limits are exact order
statistics, found by counts.

Defined results: null texts and texts without a letter get ``und``, score 0, rejected; so do
all texts where there is no training row.  Ties go to the lower language name.  Repeated rows
are learned from and predicted each for itself; an empty table gives no rows; other columns
pass through, but for those named as an output in whichever case, which are replaced; a text
of any length is read whole, and what a task holds beside the models does not grow with others.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import discard, kept_fields, materialise, per_process, portions
from regivane.llm.near_dedup import mix

ORDER, CLASS_BITS = 4, 16
CLASSES = 1 << CLASS_BITS
#: Grams of one order of all models together, and entries that a task sums before it passes them on.
MODEL_GRAMS, HELD_GRAMS = 1 << 22, 1 << 20
#: Scales that calibration tries: temperature, and power of the text's length.
SCALES = [(temperature, power) for temperature in (0.25, 0.5, 1.0, 2.0, 4.0) for power in (0.0, 0.25, 0.5, 0.75, 1.0)]
#: Share of a language's training rows whose excess of cross-entropy counts as usual.
USUAL = 0.999
_GAP = "\x00" * ORDER
#: Bytes of texts, and grams, that are worked on at once: each letter takes some ten times its bytes meanwhile.
_PORTION, _SLICE = 1 << 18, 1 << 16


def class_table() -> np.ndarray:
    """Class of every code point, after lower-casing; 0 for what is no letter."""
    table = np.zeros(0x110000, dtype=np.uint16)
    for cp in range(0x110000):
        c = chr(cp).lower()[:1] if not 0xD800 <= cp < 0xE000 else ""
        if c.isalpha():
            table[cp] = ord(c) if ord(c) < CLASSES else 0xE000 + ord(c) % 6400
    return table


def grams(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-gram codes of all texts one after the other, and where each text's begin (and end).

    A text's codes predict each of its letters and boundaries, and the boundary after it.
    """
    joined = _GAP + _GAP.join(t.replace("\x00", " ") for t in texts) + _GAP
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4")
    classes = table[points]
    keep = (points == 0) | (classes != 0)
    keep[1:] |= classes[:-1] != 0  # the first of a run of other characters
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    begins = ORDER + np.concatenate(([0], np.cumsum(lengths[:-1] + ORDER))) if len(texts) else np.zeros(0, np.int64)
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    classes = classes[keep].astype(np.uint64)
    codes = np.zeros(len(classes), dtype=np.uint64)
    for back in range(ORDER):
        codes[ORDER:] |= classes[ORDER - back : len(classes) - back] << np.uint64(CLASS_BITS * back)
    lo, hi = kept_before[begins], kept_before[begins + lengths]
    hi += (hi > lo) & (classes[hi - 1] != 0)  # the boundary after the last letter
    return codes, np.stack([lo, hi], axis=1)


def _inside(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a span."""
    edges = np.zeros(n + 1, dtype=np.int8)
    np.add.at(edges, spans[:, 0], 1)
    np.add.at(edges, spans[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def _train_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = per_process(("classes",), class_table)
        held: dict[str, list] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for name in sorted(held):
                codes, n = _summed(held.pop(name))
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(codes), pa.string()), "code": pa.array(codes.view(np.int64)), "n": pa.array(n)})

        for batch in portions(batches, size=_PORTION):
            texts, langs = batch.column(0).to_pylist(), np.asarray(batch.column(1).to_pylist(), dtype=object)
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == name and t]
                if own:
                    codes, spans = grams(own, table)
                    found = np.unique(codes[_inside(spans, len(codes))], return_counts=True)
                    held.setdefault(name, []).append(found)
                    size += len(found[0])
            if size > HELD_GRAMS:
                held = {name: [_summed(parts)] for name, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD_GRAMS // 2:  # bounded memory; the sums meet after the shuffle
                    yield from rows()
                    size = 0
        yield from rows()

    parts = docs.select(text, lang).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).mapInArrow(counted, "lang string, code bigint, n bigint")
    return parts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    codes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)])
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _mask(size: int) -> int:
    return (1 << CLASS_BITS * size) - 1


def probabilities(counts: DataFrame) -> DataFrame:
    """(lang, size, code, n, p): all grams of four classes and fewer, with counts and smoothed probabilities.

    ``counts`` has (lang, code, n) of four-grams.  Shorter grams have continuation counts: how many
    grams of one class more end so.  Discounts and totals take every gram.
    """
    level = counts.where("code != 0").select("lang", F.lit(ORDER).alias("size"), "code", "n")
    levels = level
    for size in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.lit(size).alias("size"), F.col("code").bitwiseAND(F.lit(_mask(size))).alias("code")).agg(F.count("*").alias("n"))
        levels = levels.unionByName(level)
    levels = materialise(levels.withColumn("context", F.shiftrightunsigned("code", CLASS_BITS)), "gram-levels")
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    # a row a language and order
    discounts = levels.groupBy("lang", "size").agg(F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("d"))
    contexts = levels.groupBy("lang", "size", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    met = levels.join(contexts, ["lang", "size", "context"]).join(F.broadcast(discounts), ["lang", "size"])
    own, share = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total"), F.col("d") * F.col("kinds") / F.col("total")
    terms = materialise(met.select("lang", "size", "code", "n", own.alias("own"), share.alias("share"), F.col("code").bitwiseAND(F.expr(f"shiftleft(1L, {CLASS_BITS} * (size - 1)) - 1")).alias("suffix")), "gram-terms")
    discard(levels)
    below, out = None, None
    for size in range(1, ORDER + 1):
        now = terms.where(F.col("size") == size)
        if below is not None:
            now = now.join(below.select("lang", F.col("code").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        below = now.select("lang", "size", "code", "n", (F.col("own") + F.col("share") * (F.lit(1 / CLASSES) if size == 1 else F.col("lower"))).alias("p"))
        out = below if out is None else out.unionByName(below)
    found = materialise(out, "gram-probabilities")
    discard(terms)
    return found


def _most_frequent(counts: DataFrame, grams_in_all: int, value: str = "n") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(codes, values) by language: the most frequent grams, an even share of ``grams_in_all`` for each language.

    They are taken by steps of their count (eight to a doubling) and, inside a step, by cells
    of their hash, as many whole cells as the share allows; the rest stays on the executors.
    """
    cell = (F.floor(F.log2("n") * 8) * 16 + F.pmod(F.xxhash64("code"), F.lit(16))).cast("int")
    sizes = counts.groupBy("lang", cell.alias("cell")).count().toPandas().sort_values(["lang", "cell"], ascending=[True, False])
    names = sorted(sizes["lang"].unique())
    limits = []
    for k, name in enumerate(names):
        own = sizes[sizes["lang"] == name]
        fits = own["count"].cumsum() <= grams_in_all // len(names)
        limits.append((name, k, int(own["cell"][fits].min()) if fits.any() else int(own["cell"].iloc[0])))
    if not names:
        return {}
    limits = F.broadcast(counts.sparkSession.createDataFrame(limits, "lang string, k int, least int"))  # a row a language
    kept = counts.join(limits, "lang").where(cell >= F.col("least")).select("k", "code", value).toArrow()
    k, codes, n = (kept[c].to_numpy() for c in ("k", "code", value))
    return {name: (codes[k == at].view(np.uint64), n[k == at]) for at, name in enumerate(names)}


def smoothed_models(counts: DataFrame, model_grams: int = MODEL_GRAMS) -> dict[str, Smoothed]:
    """Models by language of four-gram counts (lang, code, n), with at most ``model_grams`` grams of an order in all."""
    found = probabilities(counts)
    # each order of a language counts as a language of its own
    labelled = found.select(F.concat(F.col("size").cast("string"), "lang").alias("lang"), "code", "n", "p")
    kept = _most_frequent(labelled, model_grams * ORDER, "p")
    discard(found)
    names = sorted({label[1:] for label in kept})
    return {name: Smoothed.of_probabilities({size: kept[f"{size}{name}"] for size in range(1, ORDER + 1)}) for name in names}


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


class Table:
    """Values by 64-bit code: a sorted array of scrambled codes, and where each beginning of their bits starts."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        with np.errstate(over="ignore"):
            hashes = mix(codes)
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.append(values[order], 0).astype(np.float32)
        bits = max(1, int(len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes[:-1], np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, there or not) of each code."""
        with np.errstate(over="ignore"):
            wanted = mix(codes)
        at = self.first[wanted >> self.shift]
        got = self.hashes[at]
        behind = np.flatnonzero(got < wanted)
        while len(behind):
            at[behind] += 1
            got[behind] = self.hashes[at[behind]]
            behind = behind[got[behind] < wanted[behind]]
        there = (got == wanted) & (at < len(self.hashes) - 1)
        return self.values[at], there


class Smoothed:
    """Interpolated Kneser-Ney log-probabilities of the four-grams of one language."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """All grams from counts that one process holds; :func:`probabilities` does it for any number."""
        order = np.argsort(codes)
        grams, n = codes[order].astype(np.uint64), counts[order].astype(np.float64)
        levels = [(grams, n)]
        for size in (3, 2, 1):  # continuation counts: distinct longer grams that end so
            grams, n = np.unique(grams & np.uint64(_mask(size)), return_counts=True)
            levels.append((grams, n.astype(np.float64)))
        self.orders: list[tuple[Table, Table]] = []  # probabilities and shares left, from single classes up
        for size, (grams, n) in enumerate(reversed(levels)):
            d = _discount(n)
            context, at = np.unique(grams >> np.uint64(CLASS_BITS), return_inverse=True)
            total, kinds = np.bincount(at, n, minlength=len(context)), np.bincount(at, minlength=len(context))
            share = d * kinds / np.maximum(total, 1e-300)
            self._add(grams, np.maximum(n - d, 0) / np.maximum(total, 1e-300)[at] + share[at] * self._lower(grams, size))

    @classmethod
    def of_probabilities(cls, kept: dict[int, tuple[np.ndarray, np.ndarray]]) -> Smoothed:
        """Of (codes, probabilities) of the grams of each size that are kept."""
        out = cls.__new__(cls)
        out.orders = []
        for size in range(1, ORDER + 1):
            out._add(*kept[size])
        return out

    def _lower(self, grams: np.ndarray, size: int) -> np.ndarray:
        """Probabilities of the grams' last ``size`` classes."""
        return np.exp(self.log_probs(grams & np.uint64(_mask(size)), size).astype(np.float64)) if size else np.full(len(grams), 1 / CLASSES)

    def _add(self, grams: np.ndarray, known: np.ndarray) -> None:
        """The next order; what its grams leave to others in a context is shared as the order below has it."""
        context, at = np.unique(grams >> np.uint64(CLASS_BITS), return_inverse=True)
        lower = self._lower(grams, len(self.orders))
        left = 1 - np.bincount(at, known, minlength=len(context))
        below = 1 - np.bincount(at, lower, minlength=len(context))
        # rounding may leave nothing or less
        share = np.maximum(left, 1e-12) / np.maximum(below, 1e-12)
        self.orders.append((Table(grams, np.log(known)), Table(context, np.log(share))))

    def log_probs(self, codes: np.ndarray, size: int = ORDER) -> np.ndarray:
        """Log-probability of the last class of each gram of ``size`` classes, after those before it."""
        if not size:
            return np.full(len(codes), -np.log(CLASSES), dtype=np.float32)
        grams, shares = self.orders[size - 1]
        out, there = grams.find(codes)
        lacking = np.flatnonzero(~there)
        if len(lacking):
            rest = codes[lacking]
            share, seen = shares.find(rest >> np.uint64(CLASS_BITS))
            below = self.log_probs(rest & np.uint64((1 << CLASS_BITS * (size - 1)) - 1), size - 1)
            out[lacking] = np.where(seen, share, 0) + below
        return out


class Models:
    """Smoothed models by language, the scale of their scores and their rejection limits."""

    def __init__(self, by_lang: dict[str, Smoothed], scale=(1.0, 1.0), limits: dict | None = None):
        self.langs, self.by_lang, self.scale, self.limits = sorted(by_lang), by_lang, scale, limits or {}

    def log_probs(self, codes: np.ndarray, names: list[str]) -> np.ndarray:
        return np.stack([self.by_lang[name].log_probs(codes) for name in names], axis=1)

    def entropies(self, texts: list[str], table: np.ndarray, names: list[str] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character by text and language (of ``names``, or all), characters, letters there or not."""
        names = self.langs if names is None else names
        codes, spans = grams(texts, table)
        sums = np.zeros((len(texts), len(names)))
        n, letters = spans[:, 1] - spans[:, 0], np.zeros(len(texts), dtype=bool)
        owner = np.repeat(np.arange(len(texts)), n)
        inside = codes[_inside(spans, len(codes))] if len(texts) else codes[:0]
        for at in range(0, len(inside), _SLICE):
            own, part = owner[at : at + _SLICE], inside[at : at + _SLICE]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            sums[own[first]] += np.add.reduceat(self.log_probs(part, names), first, axis=0, dtype=np.float64)
            letters[own[first]] |= np.add.reduceat((part & np.uint64(CLASSES - 1) != 0).astype(np.int64), first) > 0
        return -sums / np.maximum(n, 1)[:, None], n, letters

    def posterior(self, entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
        temperature, power = self.scale
        z = -entropy * (temperature * np.maximum(n, 1) ** power)[:, None]
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(1, keepdims=True)

    def losses(self, entropy: np.ndarray, n: np.ndarray, truth: np.ndarray) -> list[float]:
        """The sum of the texts' log-losses at each of :data:`SCALES`."""
        out = []
        for scale in SCALES:
            p = Models(self.by_lang, scale).posterior(entropy, n)[np.arange(len(truth)), truth]
            out.append(float(-np.log(np.maximum(p, 1e-9)).sum()))
        return out


def train(docs: DataFrame, train_on: Column, text: str = "text", lang: str = "lang") -> Models:
    """Models of all languages over the rows where ``train_on`` holds; counts and calibration take every such row."""
    rows = docs.where(train_on & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = materialise(_train_counts(rows, text, lang), "gram-counts")
    models = Models(smoothed_models(counts))
    discard(counts)
    if models.langs:
        calibrate(models, rows.select(text, lang))
    return models


def calibrate(models: Models, rows: DataFrame) -> None:
    """Fit the posterior's scale by log-loss, and each language's rejection limits, on all ``rows`` (text, language)."""
    found = materialise(_entropies(rows, models), "calibration")
    sums = found.agg(*(F.sum(F.get("losses", F.lit(k))).alias(f"l{k}") for k in range(len(SCALES)))).first()
    if sums[0] is not None:
        models.scale = min(zip(sums, SCALES, strict=True))[1]
        measured = [F.struct(F.concat(F.lit(c[0]), "truth").alias("name"), F.col(c).alias("value")) for c in ("own", "shuffled")]
        medians = {name: float(np.mean(x)) for name, x in order_statistics(found.select(F.inline(F.array(*measured))), lambda n: [(n - 1) // 2, n // 2], 4096).items()}
        middle = {name[1:]: x for name, x in medians.items() if name[0] == "o"}
        middles = F.broadcast(rows.sparkSession.createDataFrame(list(middle.items()), "truth string, middle double"))  # a row a language
        excess = found.join(middles, "truth").select(F.col("truth").alias("name"), ((F.col("own") - F.col("middle")) * F.sqrt("n")).alias("value"))
        for name, (most,) in order_statistics(excess, lambda n: [math.ceil(n * USUAL) - 1], 16).items():
            models.limits[name] = (middle[name], 1.5 * max(most, 1.0), (middle[name] + medians[f"s{name}"]) / 2)
    discard(found)


def order_statistics(values: DataFrame, ranks: Callable[[int], list[int]], steps: int) -> dict[str, list[float]]:
    """For each name of ``values`` (name, value) those of its ``n`` values at ``ranks(n)``, counted from 0 in ascending order.

    They are exact: counts by cells of one of ``steps`` to a unit lead to a cell, and the different
    values of that cell are counted.  So the driver gets a row a cell that is not empty, and no group is sorted.
    """
    celled = values.withColumn("cell", F.floor(F.col("value") * steps))
    wanted: list[tuple[str, int, int]] = []
    for name, own in celled.groupBy("name", "cell").count().toPandas().sort_values(["name", "cell"]).groupby("name"):
        upto = own["count"].cumsum().to_numpy()
        for k in ranks(int(upto[-1])):
            at = int(np.searchsorted(upto, k, side="right"))
            wanted.append((name, int(own["cell"].iloc[at]), k - int(upto[at] - own["count"].iloc[at])))
    if not wanted:
        return {}
    cells = F.broadcast(values.sparkSession.createDataFrame(sorted({w[:2] for w in wanted}), "name string, cell bigint"))
    inside = celled.join(cells, ["name", "cell"]).groupBy("name", "cell", "value").count().toPandas().sort_values("value")
    parts = {key: (own["value"].to_numpy(), own["count"].cumsum().to_numpy()) for key, own in inside.groupby(["name", "cell"])}
    out: dict[str, list[float]] = {}
    for name, cell, k in wanted:
        value, upto = parts[name, cell]
        out.setdefault(name, []).append(float(value[np.searchsorted(upto, k, side="right")]))
    return out


def _shuffled(text: str) -> str:
    """The text's characters in an order that follows from the text."""
    data = text.encode("utf-32-le", "surrogatepass")
    order = np.random.default_rng(zlib.crc32(data))
    return order.permutation(np.frombuffer(data, dtype="<u4")).tobytes().decode("utf-32-le", "surrogatepass")


def _entropies(rows: DataFrame, models: Models) -> DataFrame:
    """(truth, own, shuffled, n, losses) of each text with a letter; the first of a portion has the portion's losses."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, models = per_process(("classes",), class_table), sent.value  # a worker has the models once, not their bytes as well
        number = {name: k for k, name in enumerate(models.langs)}
        for batch in portions(batches, size=_PORTION):
            known = [(t, number[x]) for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x in number]
            texts, truth = [t for t, _ in known], np.array([k for _, k in known], dtype=np.int64)
            entropy, n, letters = models.entropies(texts, table)
            texts, truth, entropy, n = [t for t, there in zip(texts, letters, strict=True) if there], truth[letters], entropy[letters], n[letters]
            if not texts:
                continue
            shuffled = np.zeros(len(texts))
            for k in np.unique(truth).tolist():
                own = np.flatnonzero(truth == k)
                shuffled[own] = models.entropies([_shuffled(texts[at]) for at in own.tolist()], table, [models.langs[k]])[0][:, 0]
            losses = pa.array([models.losses(entropy, n, truth), *[None] * (len(texts) - 1)], pa.list_(pa.float64()))
            names = pa.array([models.langs[k] for k in truth.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(entropy[np.arange(len(texts)), truth]), pa.array(shuffled), pa.array(n), losses], ["truth", "own", "shuffled", "n", "losses"])

    return rows.mapInArrow(scored, "truth string, own double, shuffled double, n bigint, losses array<double>")


def identify(docs: DataFrame, models: Models, text: str = "text", prefix: str = "") -> DataFrame:
    """Append ``lang_pred``, ``lang_score`` (0 to 1), ``cross_entropy`` (nats a character) and ``rejected``.

    Columns of these names are replaced; ``prefix`` goes before the names.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(models)
    kinds = {"lang_pred": T.StringType(), "lang_score": T.DoubleType(), "cross_entropy": T.DoubleType(), "rejected": T.BooleanType()}
    added = [T.StructField(prefix + n, k) for n, k in kinds.items()]
    schema = T.StructType([*kept_fields(docs, [f.name for f in added]), *added])
    names = [f.name for f in schema][:-4]

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, models = per_process(("classes",), class_table), sent.value  # a worker has the models once, not their bytes as well
        for batch in portions(batches, size=_PORTION):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            n_texts = len(texts)
            pred, score, best = np.full(n_texts, "und", dtype=object), np.zeros(n_texts), np.full(n_texts, np.nan)
            rejected = np.ones(n_texts, dtype=bool)
            if models.langs and n_texts:
                entropy, n, letters = models.entropies(texts, table)
                at = entropy.argmin(1)
                p = models.posterior(entropy, n)[np.arange(n_texts), at]
                pred[letters], score[letters] = np.asarray(models.langs, dtype=object)[at[letters]], p[letters]
                best[letters] = entropy[np.arange(n_texts), at][letters]
                middle, limit, halfway = (np.array([models.limits.get(x, (0.0, np.inf, np.inf))[k] for x in models.langs])[at] for k in range(3))
                odd = (best - middle) * np.sqrt(n) > limit * np.maximum(1.0, np.sqrt(n) / 20)
                # mixed or noisy text stays; what is nearer to shuffled characters goes
                rejected = ~letters | (odd & (best > halfway))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred, pa.string()), pa.array(score), pa.array(best, from_pandas=True), pa.array(rejected)], [f.name for f in schema])

    return docs.mapInArrow(identified, schema)
