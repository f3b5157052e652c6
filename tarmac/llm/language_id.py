"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are its words (runs of letters, lower-cased) and their character n-grams with
word-boundary marks, each hashed to one of ``BUCKETS`` embedding rows.  The text is the mean of its
features' embeddings, and a linear softmax over the known languages reads it.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy.

The fit uses a bounded sample: at most ``SAMPLE`` documents in all, shared evenly by the at most
``LANGUAGES`` most frequent values of the label column (ties: the smaller value), those with the smallest hashes.
Sampled texts are read whole and become bucket counts in Spark tasks; the training task gets at most
``TRAIN_FEATURES`` buckets of each, the most frequent ones.

Calibration.  A fifth of the sample is not trained on.  It sets the softmax's temperature
(least log loss), so that the score is a probability, and the score below which a prediction
is ``rejected``: the least one at which ``TARGET`` of the calibration documents at or above it
are right.  A rejected row still carries the most likely language.

Scoring is linear in the features, so a worker remembers each word's summed contributions; every word
of every text counts.  Defined results: texts that are null or hold no letter are ``und`` with score 0,
rejected; without any labelled row every text is ``und``; null labels, and null or repeated ids, are no
special cases; rows keep all their columns in ``_row``.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, text_or_empty

UNDETERMINED = "und"
BUCKETS = 1 << 15
DIMENSIONS = 16
NGRAMS = (2, 3, 4)
# Labelled documents that the model is fitted on, and label values that it can learn.
SAMPLE = 6000
LANGUAGES = 120
TRAIN_FEATURES = 4096
CALIBRATION = 5  # one sampled document in so many
EPOCHS = 6
RATE = 0.3
TARGET = 0.99
# Words that a worker remembers, and the longest of them.
CACHE_ENTRIES = 400_000
CACHED_CHARS = 40
_HASH_SPACE = 1 << 30

# Code points that are hashed together; factors of the polynomial hashes and of the final mixing.
BLOCK_CHARS = 1 << 16
_FACTOR, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_OPEN, _CLOSE = ord("<"), ord(">")
# What each code point is: 0 other, 1 a mark, 2 a letter, 255 not looked up yet.
_KIND = np.full(0x110000, 255, np.uint8)


def _kinds(points: np.ndarray) -> np.ndarray:
    found = _KIND[points]
    if (found == 255).any():
        for point in np.unique(points[found == 255]).tolist():
            _KIND[point] = {"L": 2, "M": 1}.get(unicodedata.category(chr(point))[0], 0)
        found = _KIND[points]
    return found


def subword_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every feature of some texts, text by text.

    A word is a run of letters and marks that holds a letter.  Its features are itself and its
    n-grams between boundary marks, hashed by their code points.
    """
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    kind = _kinds(points)
    edges = np.flatnonzero(np.diff(kind > 0, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if len(starts):
        lettered = np.add.reduceat(kind == 2, starts, dtype=np.int64) > 0
        starts, ends = starts[lettered], ends[lettered]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = ends - starts
    first = np.cumsum(length + 2) - (length + 2)
    total = int((length + 2).sum())
    chars = np.zeros(total + max(NGRAMS), np.uint64)
    word = np.repeat(np.arange(len(length)), length + 2)
    place = np.arange(total) - first[word]
    inner = (place > 0) & (place <= length[word])
    chars[:total][inner] = points[(starts[word] + place - 1)[inner]]
    chars[first], chars[first + length + 1] = _OPEN, _CLOSE
    powers = np.cumprod(np.full(int(length.max()) + 2, _FACTOR, np.uint64))
    hashes = np.zeros((total, len(NGRAMS) + 1), np.uint64)
    there = np.zeros(hashes.shape, bool)
    hashes[first, 0] = np.add.reduceat(chars[:total] * powers[place], first) + np.uint64(1)
    there[first, 0] = True
    left = length[word] + 2 - place
    for k, n in enumerate(NGRAMS, 1):
        gram = np.full(total, n, np.uint64)
        for i in range(n):
            gram = gram * _FACTOR + chars[i : i + total]
        hashes[:, k], there[:, k] = gram, left >= n
    buckets = ((hashes * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    return buckets[there], np.repeat(owner[starts][word], there.sum(axis=1))


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each occurs, at most ``TRAIN_FEATURES`` of them, the most frequent."""
    counts = np.zeros(BUCKETS, np.int64)
    for part in blocks(text.lower().split()):
        counts += np.bincount(subword_buckets(part)[0], minlength=BUCKETS)
    found = np.flatnonzero(counts)
    kept = found[np.argsort(-counts[found], kind="stable")[:TRAIN_FEATURES]]
    return kept, counts[kept]


def blocks(tokens: Iterable[str]) -> Iterator[list[str]]:
    """Runs of tokens of about ``BLOCK_CHARS`` characters."""
    held, size = [], 0
    for token in tokens:
        held.append(token)
        size += len(token)
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


# ---------------------------------------------------------------- training


@dataclass
class LanguageModel:
    """Languages, each bucket's contribution to their logits, and the calibration."""

    languages: list[str]
    contributions: np.ndarray  # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, summed: np.ndarray, features: np.ndarray) -> np.ndarray:
        return summed / features[:, None] + self.bias


def softmax(logits: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    z = logits / temperature
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_embeddings(
    documents: list[tuple[int, np.ndarray, np.ndarray]], languages: int, epochs: int = EPOCHS, rate: float = RATE, seed: int = 5
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, softmax weights and biases from (language, buckets, shares) of each document, by SGD."""
    rng = np.random.default_rng(seed)
    e = (rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS
    w, b = np.zeros((languages, DIMENSIONS)), np.zeros(languages)
    steps, done = max(1, epochs * len(documents)), 0
    for _ in range(epochs):
        for d in rng.permutation(len(documents)).tolist():
            label, buckets, shares = documents[d]
            own = rate * (1 - done / steps)
            done += 1
            rows = e[buckets]
            mean = shares @ rows
            g = softmax(w @ mean + b)
            g[label] -= 1
            back = w.T @ g
            w -= own * np.outer(g, mean)
            b -= 0.1 * own * g
            # steps in the gradient's direction, as long as moves the mean by its own step, however many features share it
            e[buckets] -= own / (shares @ shares) * shares[:, None] * back
    return e, w, b


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm.

    One more row, wrong in every language, keeps a faultless calibration set from claiming certainty.
    """
    wanted = np.full(logits.shape, 1 / (len(labels) + 1) / logits.shape[1])
    wanted[np.arange(len(labels)), labels] += len(labels) / (len(labels) + 1)

    def loss(t: float) -> float:
        return float(-(wanted * np.log(np.maximum(softmax(logits, math.exp(t)), 1e-300))).sum())

    low, high, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def rejection_score(scores: np.ndarray, right: np.ndarray, target: float = TARGET) -> float:
    """The least score at and above which ``target`` of the predictions are right; 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    last = np.flatnonzero(np.append(scores[order][1:] != scores[order][:-1], True))  # equal scores go together
    good = last[share[last] >= target]
    return float(scores[order][good[-1]]) if len(good) else 1.0


def fit(documents: list[tuple[str, np.ndarray, np.ndarray, bool]], target: float = TARGET) -> LanguageModel:
    """The model of (language, buckets, counts, for calibration?) rows."""
    languages = sorted({d[0] for d in documents})
    place = {v: k for k, v in enumerate(languages)}
    known = [(place[l], b, c / c.sum(), held) for l, b, c, held in documents if len(b)]
    e, w, bias = train_embeddings([d[:3] for d in known if not d[3]], len(languages))
    model = LanguageModel(languages, (e @ w.T).astype(np.float32), bias)
    held = [d for d in known if d[3]]
    if held:
        labels = np.array([d[0] for d in held])
        logits = np.stack([d[2] @ model.contributions[d[1]] for d in held]) + bias
        model.temperature = fitted_temperature(logits, labels)
        p = softmax(logits, model.temperature)
        model.reject_below = rejection_score(p.max(axis=1), p.argmax(axis=1) == labels, target)
    return model


def sampled(labelled: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """(label, held, buckets, counts) of at most ``sample`` rows of (label, id, text).

    A threshold on a hash, from the labels' counts, leaves about twice a language's share before the
    exact rank, so no task ranks more than that, however common a language is.
    """
    found = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(languages).collect()
    empty = labelled.sparkSession.createDataFrame([], "label string, held boolean, buckets binary, counts binary")
    if not found:
        return empty
    share = max(1, sample // len(found))
    cuts = F.create_map(*[F.lit(v) for r in found for v in (r["label"], min(_HASH_SPACE, -(-2 * share * _HASH_SPACE // r["n"])))])
    # the row number keeps equal rows apart, so copies cannot outgrow the share
    hashed = labelled.withColumn("_h", F.pmod(F.xxhash64("id", "text", F.monotonically_increasing_id()), F.lit(_HASH_SPACE)))
    few = hashed.where(F.col("_h") < F.coalesce(cuts[F.col("label")], F.lit(0)))

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                kept = [text_features(t) for t in part.column(2).to_pylist()]
                arrays = [pa.array([f[k].astype("<i4").tobytes() for f in kept], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], names=["label", "_h", "buckets", "counts"])

    counted = few.select("label", "_h", "text").mapInArrow(run, "label string, _h long, buckets binary, counts binary")
    by_hash = Window.partitionBy("label").orderBy("_h", "buckets")
    ranked = counted.withColumn("_r", F.row_number().over(by_hash)).where(F.col("_r") <= share)
    return ranked.select("label", (F.col("_r") % CALIBRATION == 0).alias("held"), "buckets", "counts")


def train(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
    languages: int = LANGUAGES, target: float = TARGET,
) -> LanguageModel | None:
    """Learn from all rows of ``df`` that have a label; None without any."""
    labelled = df.select(
        F.col(lang_col).cast("string").alias("label"), F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text")
    ).where("label IS NOT NULL")
    chosen = checkpointed(sampled(labelled, sample, languages))

    def run(batches: Iterable[pa.RecordBatch]):
        documents = []
        for batch in batches:
            for label, held, buckets, counts in zip(*[c.to_pylist() for c in batch.columns]):
                documents.append((label, np.frombuffer(buckets, "<i4"), np.frombuffer(counts, "<i4").astype(float), held))
        documents.sort(key=lambda d: (d[0], d[3], d[1].tobytes(), d[2].tobytes()))  # whatever order the rows come in
        if not documents:
            return
        model = fit(documents, target)
        weights = [model.bias.tobytes(), model.contributions.astype("<f4").tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.languages], pa.list_(pa.string())), pa.array(weights[:1], pa.binary()), pa.array(weights[1:], pa.binary()),
             pa.array([model.temperature], pa.float64()), pa.array([model.reject_below], pa.float64())],
            names=["languages", "bias", "contributions", "temperature", "reject_below"],
        )

    kind = "languages array<string>, bias binary, contributions binary, temperature double, reject_below double"
    fitted = chosen.repartition(1).mapInArrow(run, kind).collect()
    if not fitted:
        return None
    r = fitted[0]
    contributions = np.frombuffer(r["contributions"], "<f4").reshape(BUCKETS, -1).copy()
    return LanguageModel(list(r["languages"]), contributions, np.frombuffer(r["bias"]).copy(), r["temperature"], r["reject_below"])


# ----------------------------------------------------------------- scoring


class Identifier:
    """Predicts languages of texts; remembers the contributions of words it has met."""

    def __init__(self, model: LanguageModel, cache_entries: int = CACHE_ENTRIES):
        self.model, self.cache_entries = model, cache_entries
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages) + 1))  # summed contributions and number of features

    def _rows(self, tokens: list[str]) -> np.ndarray:
        """Summed contributions and number of features of each token."""
        out = np.zeros((len(tokens), self.table.shape[1]))
        at = 0
        for part in blocks(tokens):
            buckets, owner = subword_buckets(part)
            if len(owner):
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                out[at + owner[first], :-1] = np.add.reduceat(self.model.contributions[buckets], first, axis=0, dtype=float)
                out[at : at + len(part), -1] = np.bincount(owner, minlength=len(part))
            at += len(part)
        return out

    def _learn(self, tokens: list[str]) -> None:
        if len(self.known) + len(tokens) > self.cache_entries:
            self.known.clear()
        at = len(self.known)
        while at + len(tokens) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at : at + len(tokens)] = self._rows(tokens)
        self.known.update(zip(tokens, range(at, at + len(tokens))))

    def sums(self, texts: list[str]) -> np.ndarray:
        """Each text's summed contributions, and its number of features."""
        out = np.zeros((len(texts), self.table.shape[1]))
        split = [t.lower().split() for t in texts]
        for number, tokens in enumerate(split):
            long = [t for t in tokens if len(t) > CACHED_CHARS]
            if long:  # these are not remembered
                split[number] = [t for t in tokens if len(t) <= CACHED_CHARS]
                out[number] = self._rows(long).sum(axis=0)
        missing = set().union(*split).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.cache_entries:
                missing = set().union(*split)  # a fresh start
            self._learn(sorted(missing))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        sizes = np.array([len(tokens) for tokens in split])
        some = np.flatnonzero(sizes)
        if len(some):
            out[some] += np.add.reduceat(self.table[flat], (np.cumsum(sizes) - sizes)[some], axis=0)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, calibrated probability, rejected) of each text."""
        out = [(UNDETERMINED, 0.0, True)] * len(texts)
        sums = self.sums([t or "" for t in texts])
        some = np.flatnonzero(sums[:, -1])
        if len(some):
            p = softmax(self.model.logits(sums[some, :-1], sums[some, -1]), self.model.temperature)
            best = p.argmax(axis=1)
            for k, row in enumerate(some.tolist()):
                score = float(p[k, best[k]])
                out[row] = (self.model.languages[best[k]], score, score < self.model.reject_below)
        return out


def identify(df: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` in a struct ``_row``, with lang_pred, score and rejected."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    if model is None:
        return rows.select("_row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    kind = rows.schema["_row"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS by LANGUAGES numbers at most

    def run(batches: Iterable[pa.RecordBatch]):
        identifier = Identifier(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = identifier.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]],
                    names=["_row", "lang_pred", "score", "rejected"],
                )

    return rows.mapInArrow(run, f"_row {kind}, lang_pred string, score double, rejected boolean")
