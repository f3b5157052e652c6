"""Scoring documents with a gated recurrent language model.

Counts.  Every word of all training documents is counted (partial counts per task, then one
aggregation).  They give the add-one unigram base score and the model's vocabulary: the words
seen at least ``LEAST_SEEN`` times (the ``VOCABULARY`` most frequent of them), the end of a
document, and a class of its own for all other words.

Rows.  Every document is split and looked up once: a checkpoint holds its token ids (two bytes
each), its sums and its rare words; training and scoring read that.

Model.  A gated recurrent unit in numpy with a class-factored softmax: P(word) = P(group) *
P(class | group) * P(word | class), classes being runs of the frequency-ordered vocabulary and groups
runs of classes.  It is trained on all training documents in ``ROUNDS`` rounds, each over the rows of
one hash bucket: every partition starts from the shared parameters, runs truncated backpropagation over
blocks of its documents (the state carried from window to window and reset where a document starts) and
emits them; an aggregation averages each row of a parameter by the tokens that trained it, and a written
table cuts the lineage.  A small table is read in one partition and several times.  A word outside
the vocabulary costs the unknown class and its smoothed share among such words.

Scoring.  Whole documents run side by side, one after the other in each lane, the state carried across
windows, so the sum is the log-likelihood of the complete document.  Words outside the bounded table of
frequent words that every task holds are looked up with a join on the word.

Defined results: null and empty texts are one end token; null ids are training rows like any
whose fold says so; without training documents all known counts are 0 and the model is
uniform over what it has; repeated rows are scored like others.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, removed, text_or_empty, written
from tarmac.operators.sampling import bounded_sample

# Words whose counts every task holds; rarer ones are joined.
FREQUENT = 100_000
# The model's vocabulary: words seen so often, at most so many.
LEAST_SEEN = 5
VOCABULARY = 1 << 15
HIDDEN = 24
LANES = 1024
WINDOW = 16
# Tokens that a partition trains on at a time, and at least so many of a round in a partition.
BLOCK = 1 << 18
SHARD_TOKENS = 1 << 21
ROUNDS = 3
# Positions that are scored together, and rows of a softmax that are held at once.
SCORED_ROWS = 1 << 16
SOFTMAX_ROWS = 1024
# Small tables are read more often, up to MAX_EPOCHS times, for at least so many updates.
MIN_UPDATES = 400
MAX_EPOCHS = 20
# Numbers of a parameter in one row of the aggregation; partial sums of a parameter before its sum.
PART = 1 << 16
PARTIAL_SUMS = 16
END = b""  # the end token: no word is empty
# Bytes of text that are split at a time (a longer text is split alone).
PIECE_BYTES = 1 << 23


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of a text column of at most ``PIECE_BYTES`` bytes, or of one row."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right")))
        yield texts.slice(at, until - at)
        at = until


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row of each word, the words in order): A-Z lower-cased, split at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    rows, found = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.not_equal(pc.binary_length(found), 0)
    if not pc.all(full, min_count=0).as_py():  # white space at an end of a text leaves empty words
        rows, found = rows.filter(full), found.filter(full)
    return rows.to_numpy(zero_copy_only=False), found


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over one text column; the empty word counts the documents."""

    def count(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for piece in pieces(batch.column(0)):
                found = split_words(piece)[1].value_counts()
                words = pa.concat_arrays([found.field("values").cast(pa.binary()), pa.array([END], pa.binary())])
                n = pa.concat_arrays([found.field("counts").cast(pa.int64()), pa.array([len(piece)], pa.int64())])
                yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ model


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


class GatedModel:
    """GRU over token ids with a class-factored softmax.

    id // size is a token's class, class // span its group.  States are columns inside: (hidden, lanes).
    """

    def __init__(self, vocabulary: int, hidden: int = HIDDEN, seed: int = 3):
        self.size = max(1, math.ceil(round(vocabulary ** (1 / 3), 9)))
        self.classes = -(-vocabulary // self.size)
        self.span = max(1, math.isqrt(max(1, self.classes - 1)) + 1)
        self.groups = -(-self.classes // self.span)
        self.vocabulary, self.hidden = vocabulary, hidden
        rng = np.random.default_rng(seed)
        f = np.float32
        h = hidden
        self.p = {
            "e": (rng.standard_normal((vocabulary, h)) * 0.3).astype(f),
            "w": (rng.standard_normal((h, 3 * h)) / math.sqrt(h)).astype(f),
            "u": (rng.standard_normal((h, 3 * h)) / math.sqrt(h) * 0.5).astype(f),
            "b": np.zeros(3 * h, f),
            "wg": np.zeros((h, self.groups), f),
            "bg": np.zeros(self.groups, f),
            "wc": np.zeros((h, self.classes), f),
            "bc": np.zeros(self.classes, f),
            "wo": np.zeros((self.classes, h, self.size), f),
            "bo": np.zeros((self.classes, self.size), f),
        }
        # places of the last class that no token has
        self.p["bo"].reshape(-1)[vocabulary:] = -1e9

    def start_from(self, counts: np.ndarray) -> None:
        """Biases of the smoothed unigram distribution over the vocabulary."""
        share = np.log((counts + 1.0) / (counts.sum() + len(counts)))
        padded = np.full(self.classes * self.size, -1e9)
        padded[: self.vocabulary] = share
        padded = padded.reshape(self.classes, self.size)
        total = np.log(np.exp(padded).sum(axis=1))
        groups = np.logaddexp.reduceat(total, np.arange(0, self.classes, self.span))
        self.p["bg"] = groups.astype(np.float32)
        self.p["bc"] = (total - np.repeat(groups, self.span)[: self.classes]).astype(np.float32)
        self.p["bo"] = np.maximum(padded - total[:, None], -1e9).astype(np.float32)

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """What the ids add to the gates, as columns; ids of several steps give a stack."""
        x = np.matmul(self.p["w"].T, np.swapaxes(self.p["e"][ids], -1, -2))
        x += self.p["b"][:, None]
        return x

    def advance(self, x: np.ndarray, h: np.ndarray):
        """The next states (columns) and what the way back needs."""
        n = self.hidden
        g = self.p["u"].T @ h
        zr = x[: 2 * n] + g[: 2 * n]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r, gc = zr[:n], zr[n:], g[2 * n :]
        c = r * gc
        c += x[2 * n :]
        np.tanh(c, out=c)
        after = h - c
        after *= z
        after += c
        return after, (z, r, c, gc)

    def step(self, ids: np.ndarray, h: np.ndarray):
        """``advance`` for states as rows."""
        after, kept = self.advance(self.inputs(ids), h.T)
        return after.T, kept

    def sorted(self, ids: np.ndarray) -> np.ndarray:
        """Order of the ids; two-byte keys sort by radix."""
        return np.argsort(ids.astype(np.uint16) if self.vocabulary <= 1 << 16 else ids, kind="stable")

    def log_probabilities(self, h: np.ndarray, ids: np.ndarray, grad: dict | None = None, scale: float = 1.0):
        """log P(id | state) of rows; with ``grad``, adds the output gradients and returns d loss / d h."""
        p, order = self.p, self.sorted(ids)
        h, ids = h[order], ids[order].astype(np.intp)
        kind = ids // self.size
        group = kind // self.span
        logp = np.zeros(len(ids), h.dtype)
        dh = None if grad is None else np.zeros_like(h)

        def softmax(keys, target, weights, biases, dweights):
            """One level: rows of equal keys in a run, each key with its own weights; gives the biases' gradient."""
            dbiases = None if dweights is None else np.zeros_like(biases)
            for at in range(0, len(ids), SOFTMAX_ROWS):
                rows = slice(at, at + SOFTMAX_ROWS)
                hk, key = h[rows], keys[rows]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                runs = list(zip(key[first].tolist(), first.tolist(), [*first[1:].tolist(), len(key)]))
                a = np.zeros((len(key), biases.shape[1]), h.dtype)
                for k, i, j in runs:
                    w = weights[k]
                    np.matmul(hk[i:j], w, out=a[i:j, : w.shape[1]])
                a += biases[key]
                own = np.arange(len(key)), target[rows]
                wanted = a[own]
                e = np.exp(a)
                ones = np.ones(e.shape[1], e.dtype)
                s = e @ ones
                if not (s.max() < 1e30 and s.min() > 1e-20):  # out of the range of plain exponentials
                    highest = a.max(axis=1, keepdims=True)
                    wanted -= highest[:, 0]
                    e = np.exp(a - highest)
                    s = e @ ones
                logp[rows] += wanted - np.log(s)
                if dweights is None:
                    continue
                e *= (scale / s)[:, None].astype(e.dtype)
                e[own] -= scale
                dbiases[key[first]] += np.add.reduceat(e, first)
                back = np.empty_like(hk)
                for k, i, j in runs:
                    w, dw = weights[k], dweights[k]
                    ek = e[i:j, : w.shape[1]]
                    dw += hk[i:j].T @ ek
                    np.matmul(ek, w.T, out=back[i:j])
                dh[rows] += back
            return dbiases

        # classes of each group; places of the last group that no class has get no probability
        own = [slice(g * self.span, (g + 1) * self.span) for g in range(self.groups)]
        places = self.groups * self.span - self.classes
        padded = np.append(p["bc"], np.full(places, -1e9, p["bc"].dtype)).reshape(self.groups, self.span)
        some = grad is not None
        with np.errstate(over="ignore", invalid="ignore"):
            dbg = softmax(np.zeros_like(ids), group, [p["wg"]], p["bg"][None], [grad["wg"]] if some else None)
            dbc = softmax(group, kind - group * self.span, [p["wc"][:, k] for k in own], padded, [grad["wc"][:, k] for k in own] if some else None)
            dbo = softmax(kind, ids - kind * self.size, p["wo"], p["bo"], grad["wo"] if some else None)
        found = np.empty_like(logp)
        found[order] = logp
        if grad is None:
            return found, None
        grad["bg"] += dbg[0]
        grad["bc"] += dbc.ravel()[: self.classes]
        grad["bo"] += dbo
        back = np.empty_like(dh)
        back[order] = dh
        return found, back

    def train(self, documents: Iterable[np.ndarray], lanes: int = LANES, window: int = WINDOW, rate: float = 0.01) -> Training:
        """Truncated backpropagation on all documents, a block of them at a time."""
        training = Training(self, lanes, window, rate)
        block, held = [], 0
        for document in documents:
            block.append(document)
            held += len(document)
            if held >= BLOCK:
                training.run(block)
                block, held = [], 0
        if block:
            training.run(block)
        return training

    def score(self, documents: list[np.ndarray], end: int, lanes: int = 1024, window: int = 16) -> np.ndarray:
        """Natural-log probability of each document's whole token sequence.

        Longest first, each document follows the others of the lane that has the fewest tokens.
        """
        out = np.zeros(len(documents))
        if not len(out):
            return out
        lengths = np.array([len(d) for d in documents])
        lanes = max(1, min(lanes, len(documents)))
        loads, dealt = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
        for d in np.argsort(-lengths, kind="stable").tolist():
            load, lane = loads[0]
            dealt[lane].append(d)
            heapq.heapreplace(loads, (load + int(lengths[d]), lane))
        loads = sorted(loads, key=lambda x: -x[0])
        laid = np.array([d for _, lane in loads for d in dealt[lane]])
        loads = np.array([load for load, _ in loads])
        first = np.cumsum(loads) - loads
        stream = np.concatenate([documents[d] for d in laid])
        owner = np.repeat(laid, lengths[laid])
        starts = np.cumsum(lengths[laid]) - lengths[laid]
        before = np.concatenate([stream[:1], stream[:-1]])
        before[starts] = end
        carried = np.ones(len(stream), np.float32)
        carried[starts] = 0

        h = np.zeros((self.hidden, lanes), np.float32)
        states, places, held = [], [], 0
        for t in range(int(loads[0])):
            active = int(np.searchsorted(-loads, -t, "left"))  # lanes longer than t
            at = first[:active] + t
            h, _ = self.advance(self.inputs(before[at]), h[:, :active] * carried[at])
            states.append(h.T)
            places.append(at)
            held += active
            if (len(states) >= window and held >= SCORED_ROWS) or t + 1 == loads[0]:
                at = np.concatenate(places)
                logp, _ = self.log_probabilities(np.concatenate(states), stream[at])
                out += np.bincount(owner[at], logp.astype(float), len(out))
                states, places, held = [], [], 0
        return out

    def parts(self, training: Training):
        """The parameters' rows times their tokens, and these tokens, in rows of bounded size."""
        salt, number = int(training.seen.sum() + training.seen.argmax()) % max(1, PARTIAL_SUMS), 0
        for name in sorted(self.p):
            weight = training.weights(name).astype(float)
            values = self.p[name].reshape(len(weight), -1)
            rows = max(1, PART // (values.shape[1] + 1))
            for at in range(0, len(weight), rows):
                w = weight[at : at + rows, None]
                numbers = np.hstack([values[at : at + rows] * w, w]).astype("<f4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([salt], pa.int32()), pa.array([numbers], pa.binary())], names=["part", "salt", "numbers"]
                )
                number += 1

    def average(self, sums: dict[int, bytes]) -> None:
        """Take the averages of summed ``parts``; rows that no token trained stay as they are."""
        number = 0
        for name in sorted(self.p):
            values = self.p[name].reshape(len(self.p[name]), -1)
            rows = max(1, PART // (values.shape[1] + 1))
            for at in range(0, len(values), rows):
                if number in sums:
                    found = np.frombuffer(sums[number], "<f4").astype(float).reshape(-1, values.shape[1] + 1)
                    some = np.flatnonzero(found[:, -1] > 0)
                    values[at + some] = found[some, :-1] / found[some, -1:]
                number += 1

    def packed(self) -> bytes:
        return b"".join(self.p[k].astype("<f4").tobytes() for k in sorted(self.p))

    def unpack(self, data: bytes) -> GatedModel:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = np.frombuffer(data, "<f4", size, at).reshape(self.p[k].shape).copy()
            at += 4 * size
        return self


class Training:
    """Parameter updates of one partition: Adam; rows and classes that a window lacks stay as they are."""

    SPARSE = ("e", "wo", "bo")

    def __init__(self, model: GatedModel, lanes: int, window: int, rate: float):
        self.model, self.lanes, self.window, self.rate = model, lanes, window, rate
        self.m = {k: np.zeros_like(v) for k, v in model.p.items() if k not in self.SPARSE}
        self.v = {k: np.zeros_like(v) for k, v in model.p.items() if k not in self.SPARSE}
        self.squares = {k: np.zeros(len(model.p[k]), np.float32) for k in self.SPARSE}
        self.updates, self.tokens = 0, 0
        self.seen = np.zeros(model.vocabulary, np.int64)  # as targets
        self.grad = {k: np.zeros_like(v) for k, v in model.p.items() if k != "e"}

    def run(self, documents: list[np.ndarray]) -> None:
        """One pass; documents are laid end to end in every lane, the last one filled up.

        Each document ends with its end token, which is also what precedes a document.
        """
        end = documents[0][-1]
        stream = np.concatenate(documents).astype(np.int32)
        before = np.concatenate([[end], stream[:-1]])
        first = np.zeros(len(stream), bool)
        first[np.cumsum([0] + [len(d) for d in documents[:-1]])] = True
        self.seen += np.bincount(stream, minlength=self.model.vocabulary)
        self.tokens += len(stream)
        lanes = max(1, min(self.lanes, len(stream) // (20 * self.window)))
        length = -(-len(stream) // lanes)
        cut = lambda v, fill: np.append(v, np.full(lanes * length - len(v), fill, v.dtype)).reshape(lanes, length)
        inputs, targets, starts = cut(before, end), cut(stream, -1), cut(first, False)
        h = np.zeros((lanes, self.model.hidden), np.float32)
        for at in range(0, length, self.window):
            own = slice(at, at + self.window)
            h = self.step(inputs[:, own], targets[:, own], starts[:, own], h)

    def step(self, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One update from a window of all lanes; states enter and leave as rows."""
        model, grad = self.model, self.grad
        p, n, (lanes, steps) = model.p, model.hidden, inputs.shape
        dtype = p["e"].dtype
        source, carried = np.ascontiguousarray(inputs.T), (~starts.T).astype(dtype)
        states, kept, befores = np.empty((steps, n, lanes), dtype), [], []
        h = h.T
        for t in range(steps):
            h = h * carried[t]
            befores.append(h)
            h, cache = model.advance(model.inputs(source[t]), h)
            states[t] = h
            kept.append(cache)
        last, wanted = h.T, targets.T.ravel()
        valid = wanted >= 0
        valid = slice(None) if valid.all() else np.flatnonzero(valid)
        ids = wanted[valid]
        if not len(ids):
            return last
        for g in grad.values():
            g.fill(0)
        rows = states.transpose(0, 2, 1).reshape(-1, n)
        out = np.zeros((steps * lanes, n), dtype)
        _, out[valid] = model.log_probabilities(rows[valid], ids, grad, 1.0 / len(ids))
        out = np.ascontiguousarray(out.reshape(steps, lanes, n).transpose(0, 2, 1))
        dh = np.zeros((n, lanes), dtype)
        dx = np.empty((steps, 3 * n, lanes), dtype)
        for t in range(steps - 1, -1, -1):
            dh += out[t]
            z, r, c, gc = kept[t]
            hb, d = befores[t], dx[t]
            dz, dr, dc = d[:n], d[n : 2 * n], d[2 * n :]
            np.multiply(dh, 1 - z, out=dc)
            np.multiply(dc, z, out=dz)
            dz *= hb - c
            dc *= 1 - c * c
            np.multiply(dc, r, out=dr)
            dg = np.concatenate([dz, dr, dr])
            dr *= gc
            dr *= 1 - r
            dg[n : 2 * n] = dr
            grad["u"] += hb @ dg.T
            dh *= z
            dh += p["u"] @ dg
            dh *= carried[t]
        embedded = p["e"][source]
        grad["b"] += dx.sum(axis=(0, 2))
        grad["w"] += np.matmul(embedded.transpose(0, 2, 1), dx.transpose(0, 2, 1)).sum(axis=0)
        source = source.ravel()
        order = model.sorted(source)
        found = source[order]
        at = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        de = np.matmul(dx.transpose(0, 2, 1), p["w"].T).reshape(-1, n)
        self.updates += 1
        self.sparse("e", found[at], np.add.reduceat(de[order], at))
        for k in ("wo", "bo"):  # classes that no target touched have no gradient and stay
            self.sparse(k, slice(None), grad[k])
        rate = self.rate * math.sqrt(1 - 0.99**self.updates) / (1 - 0.9**self.updates)
        for k in self.m:
            self.m[k] += 0.1 * (grad[k] - self.m[k])
            self.v[k] += 0.01 * (grad[k] * grad[k] - self.v[k])
            p[k] -= np.float32(rate) * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)
        return last

    def sparse(self, name: str, rows: np.ndarray | slice, grad: np.ndarray) -> None:
        """Steps of the rows that have a gradient, by the squares that each has gathered."""
        flat = grad.reshape(len(grad), -1)
        squares = self.squares[name]
        squares[rows] += np.einsum("ij,ij->i", flat, flat) / flat.shape[1]
        flat *= (5 * self.rate / (np.sqrt(squares[rows]) + 1e-7))[:, None].astype(flat.dtype)
        self.model.p[name][rows] -= grad

    def weights(self, name: str) -> np.ndarray:
        """How many tokens trained each row of a parameter."""
        if name == "e":
            return self.seen
        if name in self.SPARSE:
            return np.add.reduceat(self.seen, np.arange(0, self.model.vocabulary, self.model.size))
        return np.full(len(self.model.p[name]), self.tokens)


# -------------------------------------------------------- training, scoring


class WordTable:
    """The bounded table of frequent words: ids of the model's vocabulary, and counts."""

    def __init__(self, frequent: list[tuple[bytes, int]], vocabulary: int, least: int = LEAST_SEEN):
        known = [w for w, n in frequent if w != END and n >= least][: max(0, vocabulary - 2)]
        self.counts = dict(frequent)
        self.end, self.unknown, self.size = 0, 1, 2 + len(known)
        self.vocabulary_counts = [self.counts.get(END, 0), 0, *(self.counts[w] for w in known)]
        # by a word's place among the frequent ones; the last place is that of all other words
        self.frequent = pa.array([w for w, _ in frequent], pa.binary()).cast(pa.string())
        numbers = {w: k for k, w in enumerate(known, 2)} | {END: self.end}
        self.ids = np.array([*(numbers.get(w, self.unknown) for w, _ in frequent), self.unknown], "<u2" if self.size <= 1 << 16 else "<u4")
        self.logs = np.array([*(math.log10(n + 1) for _, n in frequent), 0.0])
        self.inside_counts = [n for w, n in frequent if w in numbers]

    def read(self, texts: pa.Array) -> list[pa.Array]:
        """Of each text: its tokens, the known ones, their base logs, those outside the vocabulary, unknown tokens, ids, rare words."""
        rows, found = split_words(texts)
        place = pc.fill_null(pc.index_in(found, value_set=self.frequent), -1).to_numpy(zero_copy_only=False)
        n = len(texts)
        per_text = lambda v: np.bincount(rows, v, n)
        ids, logs, rare = self.ids[place], self.logs[place], place < 0
        lengths = np.bincount(rows, minlength=n) + 1
        tokens = np.full(len(rows) + n, self.end, self.ids.dtype)
        tokens[np.arange(len(rows)) + rows] = ids
        unknown = ids == self.unknown
        seldom = pa.ListArray.from_arrays(_offsets(np.bincount(rows[rare], minlength=n)), found.filter(pa.array(rare)))
        return [
            pa.array(lengths, pa.int64()),
            pa.array((per_text(~rare) + (END in self.counts)).astype(np.int64)),
            pa.array(per_text(logs) + math.log10(self.counts.get(END, 0) + 1), pa.float64()),
            pa.array(per_text(logs * unknown), pa.float64()),
            pa.array(per_text(unknown).astype(np.int64)),
            pa.Array.from_buffers(pa.binary(), n, [None, _offsets(lengths * tokens.itemsize).buffers()[1], pa.py_buffer(tokens.tobytes())]),
            pc.binary_join(seldom, " "),
        ]

    def documents(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each row."""
        return [np.frombuffer(ids, self.ids.dtype) for ids in column.to_pylist()]


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


ENCODED = "n_tokens long, _known long, _base double, _outside double, _unknown long, _ids binary, _rare string"


def encode(rows: DataFrame, words_table: Broadcast) -> DataFrame:
    """Rows whose last column is a text, with what ``WordTable.read`` finds in place of it."""
    kept = rows.schema[:-1]
    names = [*kept.names, *(c.split()[0] for c in ENCODED.split(", "))]

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            at = 0
            for piece in pieces(batch.column(batch.num_columns - 1)):
                own = batch.slice(at, len(piece))
                at += len(piece)
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], *words_table.value.read(piece)], names=names)

    return rows.mapInArrow(run, ", ".join([*(f"{c.name} {c.dataType.simpleString()}" for c in kept), ENCODED]))


def most_frequent(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """The ``limit`` most frequent words, ties to the smaller word.

    A pass over the counts finds the highest power of two that enough words reach; only
    those words are sorted, so no task and not the driver gets ``limit`` rows per partition.
    """
    ladder = counts.agg(*[F.count_if(F.col("n") >= 2**j).alias(f"c{j}") for j in range(60)]).first()
    least = max([2**j for j in range(60) if ladder[f"c{j}"] >= limit], default=0)
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(limit)
    return [(bytes(r["word"]), r["n"]) for r in top.collect()]


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of the number rows of equal keys; a task holds one row for each of its keys."""

    def run(batches: Iterable[pa.RecordBatch]):
        sums: dict = {}
        for batch in batches:
            for key, salt, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                at = (key, salt if "salt" in keys else 0)
                found = np.frombuffer(numbers, "<f4").astype(float)
                sums[at] = sums[at] + found if at in sums else found
        for (key, salt), numbers in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()), pa.array([salt], pa.int32()), pa.array([numbers.astype("<f4").tobytes()], pa.binary())], names=["part", "salt", "numbers"]
            )

    return parts.repartition(*keys).mapInArrow(run, parts.schema)


def fit(documents: DataFrame, shared_words: Broadcast, counted: int, tokens: int, rounds: int = ROUNDS) -> GatedModel:
    """Train on all rows of ``documents`` (``_ids``, ``tokens`` in all); rounds of averaged partitions.

    ``counted`` are the tokens behind the word table.
    """
    spark, words_table = documents.sparkSession, shared_words.value
    counts = np.array(words_table.vocabulary_counts, float)
    counts[words_table.unknown] = max(0, counted - counts.sum())
    model = GatedModel(words_table.size)
    model.start_from(counts)
    if tokens < rounds * SHARD_TOKENS:
        rounds = 1
    shards = max(1, tokens // (rounds * SHARD_TOKENS))
    # a single partition reads a small table again until it has made enough updates
    lanes = max(1, min(LANES, 96, tokens // (20 * WINDOW))) if shards == 1 else LANES
    epochs = min(MAX_EPOCHS, max(1, -(-MIN_UPDATES * WINDOW * lanes // max(1, tokens)))) if shards == 1 else 1

    for number in range(rounds):
        rate = 0.01 * (1 - 0.8 * number / rounds)
        shared = spark.sparkContext.broadcast(model.packed())

        def run(batches: Iterable[pa.RecordBatch], rate=rate, shared=shared):
            known = shared_words.value
            own = GatedModel(known.size).unpack(shared.value)
            read = (d for b in batches for at in range(0, b.num_rows, 64) for d in known.documents(b.column(0).slice(at, 64)))
            if epochs == 1:
                training = own.train(read, lanes, rate=rate)
            else:
                own_documents = list(read)
                if not own_documents:
                    return
                training = Training(own, lanes, WINDOW, rate)
                for epoch in range(epochs):
                    training.rate = rate * (1 - 0.9 * epoch / epochs)
                    training.run(own_documents)
            if training.tokens:
                yield from own.parts(training)

        schema = "part int, salt int, numbers binary"
        bucket = documents if rounds == 1 else documents.where(F.pmod(F.xxhash64("_ids"), F.lit(rounds)) == number)
        parts = bucket.coalesce(shards).mapInArrow(run, schema)
        if parts.rdd.getNumPartitions() > 4 * PARTIAL_SUMS:
            parts = _summed(parts, "part", "salt")
        sums, path = written(_summed(parts, "part"))
        model.average({r["part"]: r["numbers"] for r in sums.select("part", "numbers").toLocalIterator()})
        removed(spark, [path])
        shared.unpersist()
    return model


def score(
    df: DataFrame,
    is_training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int = VOCABULARY,
    frequent: int = FREQUENT,
    train_documents: int | None = None,
) -> DataFrame:
    """One row per input row: id, trained_on, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from all training rows; ``train_documents`` restricts it to so many.
    """
    spark = df.sparkSession
    texts = df.select(text_or_empty(text_col).alias("text"), F.coalesce(is_training, F.lit(False)).alias("_train"))
    training = texts.where("_train").select("text")
    counts = checkpointed(count_words(training))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = total["n"], total["v"]
    known = WordTable(most_frequent(counts, frequent), vocabulary)
    shared_words = spark.sparkContext.broadcast(known)
    rows = df.select(
        F.monotonically_increasing_id().alias("_n"), F.col(id_col).alias("_id"),
        F.coalesce(is_training, F.lit(False)).alias("_train"), text_or_empty(text_col).alias("_text"),
    )
    encoded = checkpointed(encode(rows, shared_words))
    learned, learned_tokens = encoded.where("_train").select("_ids"), tokens
    if train_documents is not None:
        sample = bounded_sample(df.where(F.coalesce(is_training, F.lit(False))).select(id_col, text_col), train_documents, [id_col])
        read = checkpointed(encode(sample.select(text_or_empty(text_col).alias("_text")), shared_words))
        learned, learned_tokens = read.select("_ids"), read.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    model = fit(learned, shared_words, tokens, learned_tokens)
    smoothed = tokens + distinct + 1
    other = smoothed - sum(n + 1 for n in known.inside_counts)
    shared = spark.sparkContext.broadcast(model.packed())

    def run(batches: Iterable[pa.RecordBatch]):
        gated = GatedModel(shared_words.value.size).unpack(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("_ids")
            logp = gated.score(shared_words.value.documents(batch.column(at)), shared_words.value.end) / math.log(10)
            yield batch.set_column(at, "_model", pa.array(logp, pa.float64()))

    fields = [("_model double" if c.name == "_ids" else f"{c.name} {c.dataType.simpleString()}") for c in encoded.schema]
    scored = checkpointed(encoded.mapInArrow(run, ", ".join(fields)))
    seldom = scored.where("_rare <> ''").select("_n", F.explode(F.split("_rare", " ")).alias("_word"))
    looked_up = (
        seldom.select("_n", F.col("_word").cast("binary").alias("word")).join(counts, "word")
        .groupBy("_n").agg(F.sum(F.log10(F.col("n") + 1)).alias("_log"), F.count(F.lit(1)).alias("_hits"))
    )
    log_rare, hits = F.coalesce("_log", F.lit(0.0)), F.coalesce("_hits", F.lit(0))
    return scored.drop("_rare").join(looked_up, "_n", "left").select(
        F.col("_id").alias(id_col),
        F.col("_train").alias("trained_on"),
        "n_tokens",
        (F.col("_known") + hits).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + log_rare - F.col("n_tokens") * math.log10(smoothed)).alias("base_score"),
        (F.col("_model") + F.col("_outside") + log_rare - F.col("_unknown") * math.log10(max(1, other))).alias("score"),
    )
