"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

Labels say whether a document is toxic, not where.  A sentence's probability is a logistic
function of its words; a document's is the noisy-or of its sentences,
1 - prod(1 - p_s).  Training maximises the likelihood of the document labels, which makes
the sentences that explain a positive label score high; those are then reported.

A word counts through itself and its prefixes, so inflected or compounded forms of an
offending stem are recognised.  Only features that are clearly more frequent in toxic documents
are used, and their weights are never negative: harmless words cannot hide an offending
one, and a long clean document does not become toxic.  Scores use the text only.

The model is fitted on at most ``SAMPLE`` labelled documents of each label (those with the
smallest hashes of their ids), in one task; the weights are bounded by that sample and are
broadcast.  Every document is scored over its whole text.

Defined results: null and empty texts have no sentence and score 0; without labelled rows
every score is 0; a document labelled twice counts as toxic if any label says so.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_or_empty
from tarmac.operators.sampling import bounded_sample

# Labelled documents of each label that the model is fitted on.
SAMPLE = 3000
PREFIXES = (4, 5, 6, 7, 8)
# How many standard errors a feature's log odds (in toxic against other documents) lie above 0.
EVIDENCE = 2.8
STEPS = 1500
OFFENDING = 0.5
CACHE_ENTRIES = 500_000

# A sentence ends at a mark or line break; overlong runs are cut at the end of a word.
_SENTENCE = regex.compile(r"[^.!?\n]{1,300}\w*")
_WORD = regex.compile(r"\w+")

MODEL = "feature string, weight double"
BIAS = ""  # the feature name that carries the bias: no word is empty


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words) of every sentence that has a word; code points, end exclusive."""
    for found in _SENTENCE.finditer(text):
        words = _WORD.findall(found.group().lower())
        if words:
            yield found.start(), found.end(), words


# ---------------------------------------------------------------- training


def fit(documents: Iterable[tuple[str, int]], weights: tuple[float, float] = (1.0, 1.0)) -> dict[str, float]:
    """Feature weights (and the bias) from (text, label) pairs; ``weights`` of labels 0 and 1."""
    vocabulary: dict[str, int] = {}
    tokens, sentence_of, document_of, labels = [], [], [], []
    for text, label in documents:
        for _, _, words in sentences(text):
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in set(words)]
            tokens.append(np.array(ids, np.int32))
            sentence_of.append(len(ids))
            document_of.append(len(labels))
        labels.append(int(label))
    y = np.array(labels, float)
    if not tokens or y.min() == y.max():
        return {}
    token = np.concatenate(tokens)
    owner = np.repeat(np.arange(len(tokens)), sentence_of)
    doc = np.array(document_of)
    names: dict[str, int] = {}
    word_feature = [[names.setdefault(f, len(names)) for f in word_features(w)] for w in vocabulary]
    word_of = np.repeat(np.arange(len(vocabulary)), [len(f) for f in word_feature])
    feature = np.concatenate([np.array(f) for f in word_feature])
    # keep features that speak for the label
    pairs = np.unique(doc[owner].astype(np.int64) * len(vocabulary) + token)
    with_feature = np.zeros((2, len(names)))
    seen_word, seen_doc = pairs % len(vocabulary), pairs // len(vocabulary)
    first = np.concatenate([[0], np.cumsum([len(f) for f in word_feature])])
    for d in range(len(y)):  # a document counts once per feature
        own = seen_word[slice(*np.searchsorted(seen_doc, [d, d + 1]))]
        if len(own):
            found = np.unique(np.concatenate([feature[first[w] : first[w + 1]] for w in own.tolist()]))
            with_feature[int(y[d]), found] += 1
    of_label = np.array([[(y == 0).sum()], [(y == 1).sum()]])
    without = of_label - with_feature + 0.5
    with_feature += 0.5
    odds = np.log(with_feature[1] / without[1]) - np.log(with_feature[0] / without[0])
    kept = odds >= EVIDENCE * np.sqrt((1 / with_feature + 1 / without).sum(axis=0))
    use = kept[feature]
    chosen = np.flatnonzero(kept)
    word_of, feature = word_of[use], np.searchsorted(chosen, feature[use])
    telling = np.unique(word_of)  # other words weigh nothing
    here = np.isin(token, telling)
    token, owner = np.searchsorted(telling, token[here]), owner[here]
    word_of = np.searchsorted(telling, word_of)
    # sentences without such words all score the bias: they are counted per document
    active = np.unique(owner)
    plain = np.bincount(doc, minlength=len(y)) - np.bincount(doc[active], minlength=len(y))
    doc, owner = doc[active], np.searchsorted(active, owner)

    theta, bias = np.ones(len(chosen)), -4.0
    scale = np.where(y == 1, float(weights[1]), float(weights[0]))
    scale /= scale.sum()
    m, v, mb, vb = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    for step in range(1, STEPS + 1):
        rate = 0.1 * (1 - step / (STEPS + 1)) + 0.005
        word_weight = np.bincount(word_of, theta[feature], len(telling))
        z = bias + np.bincount(owner, word_weight[token], len(active))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(-np.bincount(doc, np.logaddexp(0, z), len(y)) - plain * np.logaddexp(0, bias))  # prod(1 - p_s)
        toxic = np.maximum(1 - clean, 1e-9)
        pull = np.where(y == 1, clean / toxic, -1.0) * scale
        g = pull[doc] * p
        grad = np.bincount(feature, np.bincount(token, g[owner], len(telling))[word_of], len(chosen)) - 1e-5 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        gb = g.sum() + (pull * plain).sum() / (1 + math.exp(-bias))
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        correction = math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        theta += rate * correction * m / (np.sqrt(v) + 1e-8)
        theta = np.maximum(theta - 0.002 * rate, 0)  # evidence only ever adds up
        bias += rate * correction * mb / (math.sqrt(vb) + 1e-8)
    spelled = list(names)
    model = {spelled[k]: float(w) for k, w in zip(chosen.tolist(), theta) if w > 1e-3}
    return {**model, BIAS: float(bias)}


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE,
) -> dict[str, float]:
    """Fit on a bounded sample of the labelled documents; the result's size is bounded by it.

    ``labels`` has (id, label); rows without a label are ignored.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("_label"))
    )
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = bounded_sample(known.where(F.col("_label") == label), sample, ["_id"])
        chosen = part if chosen is None else chosen.unionByName(part)
    # ``chosen`` has at most 2 * sample rows
    documents = (
        df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
        .join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]).select("_text", "_label")
    )
    share = tuple(max(1, totals.get(k, 0)) / max(1, min(sample, totals.get(k, 0))) for k in (0, 1))

    def run(batches: Iterable[pa.RecordBatch]):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())

        model = fit(rows(), share)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(model.keys()), pa.string()), pa.array(list(model.values()), pa.float64())],
            names=["feature", "weight"],
        )

    return {r["feature"]: r["weight"] for r in documents.repartition(1).mapInArrow(run, MODEL).collect()}


# ----------------------------------------------------------------- scoring


class Scorer:
    """Scores texts with a fitted model; remembers the weights of words it has met."""

    def __init__(self, model: dict[str, float]):
        self.model = model
        self.bias = model.get(BIAS, -800.0)  # without a model no sentence is toxic
        self.words: dict[str, float] = {}

    def _word(self, word: str) -> float:
        if len(self.words) > CACHE_ENTRIES:
            self.words.clear()
        found = self.words[word] = sum(self.model.get(f, 0.0) for f in word_features(word))
        return found

    def score(self, text: str) -> tuple[float, list[dict]]:
        """(probability of the document, its offending sentences)."""
        known, total, offending = self.words, 0.0, []
        for start, end, words in sentences(text):
            z = self.bias
            for word in set(words):
                weight = known.get(word)
                z += self._word(word) if weight is None else weight
            if z > 30:
                total += z
            else:
                total += math.log1p(math.exp(z))
            if z >= 0:
                offending.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-min(z, 700.0)))})
        return -math.expm1(-total), offending


SCORED = "score double, predicted int, offending array<struct<start: long, end: long, score: double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(df: DataFrame, model: dict[str, float], text_col: str = "text") -> DataFrame:
    """All columns of ``df`` in a struct ``_row``, with score, predicted and offending spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), text_or_empty(text_col).alias("_text"))
    kind = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]):
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [scorer.score(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s for s, _ in found], pa.float64()),
                     pa.array([int(s >= OFFENDING) for s, _ in found], pa.int32()), pa.array([o for _, o in found], _SPANS)],
                    names=["_row", "score", "predicted", "offending"],
                )

    return rows.mapInArrow(run, f"_row {kind}, {SCORED}")
