"""Alignment of two tokenizers over the same bytes.

Both tokenizers read the text with one space in front.  Wherever a token of each ends at the same
byte, a group closes; tokens of the two whose byte ranges overlap are linked.  Every id
pair's links are counted over the whole corpus, and each text reports how many of its links are
the commonest choice of their second id.

Fragments.  A very long text is dealt out as byte ranges.  A range's fragment is the tokens that
end in it: an open prefix up to the first common end (its group may have begun earlier), closed
groups, and an open suffix.  Two neighbours compose by closing the group that the left suffix and the
right prefix make up; a range without a common end is one open piece.  Composition is associative, so
a tree of ``FAN`` neighbours at a time reduces a text over Spark tasks.  A range is tokenised with
enough text around it that both tokenizers provably break on either side (a single space or line break
between other characters, which no piece of either crosses); where no such place is near, the
range is moved to the next one.

Short texts take the same steps in one task.  The units between such breaks are remembered by each
worker, with their groups and links.

Counting.  Links leave a task as sums per id pair.  The at most ``FREQUENT`` commonest pairs (a
count threshold) are looked up in every task, the others by a join, so no common pair is ever a join key.
The highest count of each second id is one row per vocabulary entry, which bounds its broadcast.

Defined results: texts that are null or empty, or whose joined token bytes differ from the space and the text
for either tokenizer, have no tokens, and zeros; all other texts count, repeated rows as often as they
occur; ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import written
from tarmac.llm.encoders import byte_symbols

# Characters of a byte range of a very long text; texts of at most twice that stay whole.
RANGE_CHARS = 1 << 15
# How far from a range's end a safe break is looked for.
CONTEXT_CHARS = 1 << 10
RANGES_PER_TASK = 32
FAN = 8
# Id pairs that every task holds.
FREQUENT = 1 << 17
# Units that a worker remembers, and the characters in them.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 1 << 24
# Marks that are looked up apart from the word before them, where the second tokenizer allows it.
MARKS = ",.;:!?"
# Distinct id pairs that a counting task holds.
COUNTED_PAIRS = 1 << 21

# Both tokenizers break before the matched space or line break.
_BREAK = re.compile(r"(?<=\S)[ \n](?=\S)")


def pair_code(a: int, b: int) -> int:
    """One number for an id pair: the second tokenizer's id in the high half."""
    return b << 32 | a


@dataclass
class Fragment:
    """What one byte range knows of the groups: lists hold token ids, ``pairs`` the codes of closed links."""

    closed: bool = False
    prefix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))
    groups: list[str] = field(default_factory=list)
    pairs: list[int] = field(default_factory=list)
    suffix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))


def group_text(a: Iterable[int], b: Iterable[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def links(a: list[int], b: list[int], a_bytes: list[bytes], b_bytes: list[bytes]) -> Iterator[int]:
    """Codes of the overlapping pairs of tokens that cover the same bytes."""
    i = j = 0
    end_a, end_b = len(a_bytes[a[0]]), len(b_bytes[b[0]])
    while True:
        yield pair_code(a[i], b[j])
        step = end_a - end_b
        if step <= 0:
            i += 1
            if i == len(a):
                return
            end_a += len(a_bytes[a[i]])
        if step >= 0:
            j += 1
            if j == len(b):
                return
            end_b += len(b_bytes[b[j]])


# What a text without tokens has.
NOTHING = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


class Aligner:
    """Both tokenizers, their ids' bytes, and the units met so far."""

    def __init__(self, path_a: str, path_b: str, cache_entries: int = CACHE_ENTRIES, cache_chars: int = CACHE_CHARS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(names.values()))
        for name, number in names.items():
            known = all(c in value for c in name)
            self.a_bytes[number] = bytes(value[c] for c in name) if known else name.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]
        self.breaks = self._can_break(pieces)
        self.lead = self.b.encode("\n")  # what a text that starts with a line break begins with
        self.letters = self.a.model.tokenize if self.breaks else None
        self.symbols = byte_symbols()
        self.a_total = all(symbol in names for symbol in self.symbols)  # then the first never loses a byte
        self.a_sizes, self.b_sizes = [len(v) for v in self.a_bytes], [len(v) for v in self.b_bytes]
        # marks that no piece of the second has behind a letter (the first splits there anyway)
        follow = {p[k] for p in pieces for k in range(1, len(p)) if p[k - 1].isalpha()}
        self.marks = {m: self._bare(m) for m in MARKS if self.breaks and m not in follow}
        self.cache_entries, self.cache_chars, self.held_chars = cache_entries, cache_chars, 0
        self.known: dict[str, int] = {}
        self.bad: set[int] = set()
        self.groups: list[str] = []
        self.pairs: list[tuple[int, ...]] = []
        self.sizes: list[tuple[int, int, int]] = []  # tokens of either, groups

    def _can_break(self, pieces: list[str]) -> bool:
        """Whether no token of either crosses a single space or line break between other characters."""
        import json

        spec = json.loads(self.a.to_str())
        split = spec["pre_tokenizer"] or {}
        first = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        inside = any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        plain = self.b.encode("\n") == [self.b.piece_to_id("▁"), self.b.piece_to_id("<0x0A>")]
        return bool(first) and spec["normalizer"] is None and not inside and plain

    # -- tokens

    def _letters(self, word: str) -> list[int]:
        """The first tokenizer's ids of a space and a run of letters, which it never splits beforehand."""
        if not self.a_total:
            return self.a.encode(" " + word, add_special_tokens=False).ids
        return [t.id for t in self.letters("Ġ" + (word if word.isascii() else "".join([self.symbols[c] for c in word.encode()])))]

    def tokens(self, full: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text that starts with its added space, or of a unit; None where bytes differ."""
        word = full[1:]
        if self.a_total and self.breaks and full[0] == " " and word.isalpha():
            a = self._letters(word)
        else:
            a = self.a.encode(full, add_special_tokens=False).ids
        if full[0] == " ":
            b = self.b.encode(word)
        else:  # a unit after a line break: the added space goes, the break stays
            b = self.b.encode(full)[1:]
        expected = full.encode("utf-8", "surrogatepass")
        if b"".join([self.a_bytes[k] for k in a]) != expected or b"".join([self.b_bytes[k] for k in b]) != expected:
            return None
        return a, b

    def _bare(self, mark: str) -> tuple[str, tuple[int, ...], tuple[int, int, int]]:
        """What a mark adds to the word before it."""
        a = self.a.encode(mark, add_special_tokens=False).ids
        b = self.b.encode("\n" + mark)[len(self.lead) :]
        groups, pairs = self.whole_groups(a, b)
        return ";" + ";".join(groups), tuple(pairs), (len(a), len(b), len(groups))

    def whole_groups(self, a: list[int], b: list[int]) -> tuple[list[str], list[int]]:
        """Groups' texts and link codes of tokens that cover the same bytes."""
        if not a:
            return [], []
        if len(a) == 1 or len(b) == 1:  # every token of the other lies in it
            return [group_text(a, b)], [y << 32 | x for x in a for y in b]
        groups, pairs = [], []
        size_a, size_b = self.a_sizes, self.b_sizes
        i = j = first_i = first_j = 0
        last, end_a, end_b = len(a), size_a[a[0]], size_b[b[0]]
        while True:
            pairs.append(b[j] << 32 | a[i])
            if end_a == end_b:
                i, j = i + 1, j + 1
                if i - first_i == 1 and j - first_j == 1:
                    groups.append(f"{a[first_i]}|{b[first_j]}")
                else:
                    groups.append(group_text(a[first_i:i], b[first_j:j]))
                if i == last:
                    return groups, pairs
                first_i, first_j = i, j
                end_a, end_b = end_a + size_a[a[i]], end_b + size_b[b[j]]
            elif end_a < end_b:
                i += 1
                end_a += size_a[a[i]]
            else:
                j += 1
                end_b += size_b[b[j]]

    def units(self, text: str) -> list[str]:
        """Keys of the units of a text (the added space is not in it).

        A key is a unit without its leading space, or, where it starts with white space, all of it.
        """
        if not self.breaks:
            return [" " + text]
        pieces = text.replace("\n", " \n").split(" ")  # pieces that start with a line break had no space there
        if all(map(self._whole, set(pieces).difference(self.known))):
            return pieces
        out, current, ended = [], None, False
        for p in pieces:
            new_line = p[:1] == "\n"
            full = p if new_line and current is not None else " " + p
            begins = len(p) > new_line and not p[new_line].isspace()
            if current is not None and ended and begins:
                out.append(current)
                current = full
            else:
                current = full if current is None else current + full
            ended = bool(p) and not p[-1].isspace()
        out.append(current)
        return [self._key(u) for u in out]

    @staticmethod
    def _whole(p: str) -> bool:
        """Whether a piece is a unit beside any other such piece."""
        if not p or p[-1].isspace():
            return False
        return not p[1].isspace() if p[0] == "\n" else not p[0].isspace()

    @classmethod
    def _key(cls, full: str) -> str:
        return full[1:] if full[0] == " " and full[1:2] != "\n" and cls._whole(full[1:]) else full

    @staticmethod
    def full(key: str) -> str:
        return key if key[:1] in (" ", "\n") else " " + key

    # -- groups

    def fragment(self, a: list[int], b: list[int], start_a: int = 0, start_b: int = 0) -> Fragment:
        """Fragment of neighbouring tokens; the two first ones may start apart."""
        out = Fragment()
        at = (0, 0)
        i = j = 0
        end_a, end_b = start_a, start_b
        while i < len(a) or j < len(b):
            if j == len(b) or (i < len(a) and end_a + len(self.a_bytes[a[i]]) <= end_b + len(self.b_bytes[b[j]])):
                end_a += len(self.a_bytes[a[i]])
                i += 1
            else:
                end_b += len(self.b_bytes[b[j]])
                j += 1
            if end_a == end_b and i and j:
                group = a[at[0] : i], b[at[1] : j]
                if out.closed:
                    self._close(out, *group)
                else:
                    out.closed, out.prefix = True, group
                at = (i, j)
        rest = a[at[0] :], b[at[1] :]
        if out.closed:
            out.suffix = rest
        else:
            out.prefix = rest
        return out

    def _close(self, out: Fragment, a: list[int], b: list[int]) -> None:
        out.groups.append(group_text(a, b))
        out.pairs.extend(links(a, b, self.a_bytes, self.b_bytes))

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of two neighbouring ranges."""
        if not right.closed:
            joint = left.suffix if left.closed else left.prefix
            joint = joint[0] + right.prefix[0], joint[1] + right.prefix[1]
            return replace(left, suffix=joint) if left.closed else replace(left, prefix=joint)
        if not left.closed:
            return replace(right, prefix=(left.prefix[0] + right.prefix[0], left.prefix[1] + right.prefix[1]))
        out = Fragment(True, left.prefix, list(left.groups), list(left.pairs), right.suffix)
        self._close(out, left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1])
        out.groups += right.groups
        out.pairs += right.pairs
        return out

    def finished(self, whole: Fragment) -> Fragment:
        """The fragment of a whole text: its prefix is the first group."""
        out = Fragment(True)
        if whole.closed:
            self._close(out, *whole.prefix)
            out.groups += whole.groups
            out.pairs += whole.pairs
        return out

    # -- whole texts

    def _add(self, key: str, groups: str, pairs: tuple[int, ...], sizes: tuple[int, int, int]) -> None:
        self.known[key] = len(self.sizes)
        self.held_chars += len(key)
        self.groups.append(groups)
        self.pairs.append(pairs)
        self.sizes.append(sizes)

    def _learn_tokens(self, key: str, found: tuple[list[int], list[int]] | None) -> None:
        if found is None:
            self.bad.add(len(self.sizes))
            found = [], []
        groups, pairs = self.whole_groups(*found)
        self._add(key, ";".join(groups), tuple(pairs), (len(found[0]), len(found[1]), len(groups)))

    def _learn(self, keys: Iterable[str]) -> None:
        words, marked = set(), []
        for key in keys:
            if self.breaks and key.isalpha():
                words.add(key)
            elif key[-1:] in self.marks and key[:-1].isalpha():
                marked.append(key)
                if key[:-1] not in self.known:
                    words.add(key[:-1])
            else:
                self._learn_tokens(key, self.tokens(self.full(key)))
        ordered = list(words)
        known, groups, pairs, sizes, b_bytes = self.known, self.groups, self.pairs, self.sizes, self.b_bytes
        for word, b in zip(ordered, self.b.encode(ordered, num_threads=1) if ordered else ()):
            a = self._letters(word)
            raw = word.encode()
            known[word] = at = len(sizes)
            self.held_chars += len(word)
            if b"".join([b_bytes[k] for k in b]) != b" " + raw:
                self.bad.add(at)
                a, b = [], []
            texts, codes = self.whole_groups(a, b)
            groups.append(";".join(texts))
            pairs.append(tuple(codes))
            sizes.append((len(a), len(b), len(texts)))
        for key in marked:
            at = self.known[key[:-1]]
            more, pairs, sizes = self.marks[key[-1]]
            if at in self.bad:
                self.bad.add(len(self.sizes))
            n = self.sizes[at]
            self._add(key, self.groups[at] + more, self.pairs[at] + pairs, (n[0] + sizes[0], n[1] + sizes[1], n[2] + sizes[2]))

    def remember(self, texts: list[list[str]]) -> None:
        """Learn the new units of some texts; they are known until the next call."""
        missing = set().union(*texts).difference(self.known)
        if missing:
            if len(self.sizes) + 2 * len(missing) > self.cache_entries or self.held_chars > self.cache_chars:
                self.known.clear()
                self.bad.clear()
                self.groups, self.pairs, self.sizes, self.held_chars = [], [], [], 0
                missing = set().union(*texts)
            self._learn(missing)

    def align(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """(tokens of either, groups, the groups' text, distinct pair codes, their links) of each text."""
        keys = [self.units(text) if text else [] for text in texts]
        self.remember(keys)
        out = []
        for own in keys:
            units = list(map(self.known.__getitem__, own))
            if not units or (self.bad and not self.bad.isdisjoint(units)):
                out.append(NOTHING)
                continue
            sizes = list(map(self.sizes.__getitem__, units))
            pairs = np.fromiter(chain.from_iterable(map(self.pairs.__getitem__, units)), np.int64)
            pairs.sort()
            first = np.flatnonzero(np.diff(pairs, prepend=-1))
            counts = np.diff(first, append=len(pairs))
            groups = ";".join(map(self.groups.__getitem__, units))
            out.append((*map(sum, zip(*sizes)), groups, pairs[first], counts))
        return out

    # -- byte ranges

    def ranged(self, text: str, low: int, high: int) -> tuple[Fragment, int, int] | None:
        """Fragment of the tokens of ``text`` that end in (low, high] bytes, and how many they are of either.

        ``text`` includes its leading space or line break and both tokenizers break on its sides.
        """
        a, b = [], []
        for key in self.units(text[1:]) if text[0] == " " else self._line_units(text):
            found = self.tokens(self.full(key))
            if found is None:
                return None
            a += found[0]
            b += found[1]
        parts = []
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            ends = np.cumsum([len(table[k]) for k in ids])
            first, last = np.searchsorted(ends, [low, high], "right")
            parts.append((ids[first:last], int(ends[first - 1]) if first else 0))
        (a, start_a), (b, start_b) = parts
        return self.fragment(a, b, start_a, start_b), len(a), len(b)

    def _line_units(self, text: str) -> list[str]:
        cuts = [0, *[m.start() for m in _BREAK.finditer(text)], len(text)]
        units = [text[s:e] for s, e in zip(cuts, cuts[1:])]
        return [self._key(u) for u in units]


def byte_ranges(text: str, size: int = RANGE_CHARS, context: int = CONTEXT_CHARS) -> Iterator[tuple[str, int, int]]:
    """(text to tokenise, first byte, last byte) of the ranges of a text that starts with its added space.

    A range ends anywhere as long as safe breaks are near on both sides, else at the next safe break.
    """

    def after(at: int) -> int:
        found = _BREAK.search(text, at)
        return found.start() if found else len(text)

    start = begin = 0  # the range's first character, and where its text starts
    while start < len(text):
        end = min(start + size, len(text))
        stop = after(end) if end < len(text) else end
        before = [m.start() for m in _BREAK.finditer(text, max(start + 1, end - context), min(end + 2, len(text))) if m.start() <= end]
        if stop - end > context or not before:
            end = stop
            before = [stop]
        own = text[begin:stop]
        low = len(text[begin:start].encode("utf-8", "surrogatepass"))
        yield own, low, low + len(text[start:end].encode("utf-8", "surrogatepass"))
        start, begin = end, before[-1]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two tokenizer files; what it remembers lives as long as the worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


# ---------------------------------------------------------------- on Spark

_STATS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, counts array<long>"
_RANGES = "_part long, _parts long, _own string, _low long, _high long"
_FRAGMENT = (
    "_key long, _part long, ok boolean, closed boolean, n_a long, n_b long, pa array<int>, pb array<int>, groups array<string>, "
    "pairs array<long>, counts array<long>, sa array<int>, sb array<int>"
)
_INTS, _LONGS, _TEXTS = pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())


def _stats_arrays(found: list[tuple], digest: bool) -> list[pa.Array]:
    """Columns of ``_STATS`` from (n_a, n_b, n_groups, groups, codes, counts)."""
    text = [("" if not f[0] else hashlib.sha256(f[3].encode()).hexdigest()) if digest else f[3] for f in found]
    whole = [[f[k] for f in found] for k in (0, 1, 2)] + [[int(f[5].sum()) for f in found]]
    return [*[pa.array(v, pa.int64()) for v in whole], pa.array(text, pa.string()), *[pa.array([f[k] for f in found], _LONGS) for k in (4, 5)]]


def _aligned(rows: DataFrame, path_a: str, path_b: str, digest: bool, size: int) -> DataFrame:
    """Short texts with their results, very long ones as rows of byte ranges."""
    kind = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]):
        own = aligner(path_a, path_b)
        names = ["_row", "_key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts", "_part", "_parts", "_own", "_low", "_high"]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [t or "" for t in part.column(2).to_pylist()]
                long = [own.breaks and len(t) > 2 * size for t in texts]
                short = pa.array([k for k, l in enumerate(long) if not l], pa.int64())
                if len(short):
                    found = own.align([texts[k] for k in short.to_pylist()])
                    blank = [pa.nulls(len(short), t) for t in (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(short), part.column(1).take(short), *_stats_arrays(found, digest), *blank], names=names
                    )
                for k in (k for k, l in enumerate(long) if l):
                    ranges = list(byte_ranges(" " + texts[k], size))
                    n, same = len(ranges), pa.array([k] * len(ranges), pa.int64())
                    blank = [pa.nulls(n, t) for t in (*[pa.int64()] * 4, pa.string(), _LONGS, _LONGS)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(same), part.column(1).take(same), *blank, pa.array(range(n), pa.int64()), pa.array([n] * n, pa.int64()),
                         *[pa.array([r[c] for r in ranges], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64()))]],
                        names=names,
                    )

    return rows.mapInArrow(run, f"_row {kind}, _key long, {_STATS}, {_RANGES}")


def _fragment_batch(key: list[int], part: list[int], found: list[tuple | None]) -> pa.RecordBatch:
    """Rows of ``_FRAGMENT`` from (fragment, n_a, n_b, codes, counts) or None."""
    none = (Fragment(), 0, 0, [], [])
    rows = [f or none for f in found]
    columns = [
        pa.array(key, pa.int64()), pa.array(part, pa.int64()), pa.array([f is not None for f in found]),
        pa.array([f[0].closed for f in rows]), pa.array([f[1] for f in rows], pa.int64()), pa.array([f[2] for f in rows], pa.int64()),
        pa.array([f[0].prefix[0] for f in rows], _INTS), pa.array([f[0].prefix[1] for f in rows], _INTS),
        pa.array([f[0].groups for f in rows], _TEXTS), pa.array([f[3] for f in rows], _LONGS), pa.array([f[4] for f in rows], _LONGS),
        pa.array([f[0].suffix[0] for f in rows], _INTS), pa.array([f[0].suffix[1] for f in rows], _INTS),
    ]
    names = ["_key", "_part", "ok", "closed", "n_a", "n_b", "pa", "pb", "groups", "pairs", "counts", "sa", "sb"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _summed(codes: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their summed counts."""
    flat, weight = np.concatenate([np.zeros(0, np.int64), *codes]), np.concatenate([np.zeros(0, np.int64), *counts])
    found, at = np.unique(flat, return_inverse=True)
    out = np.zeros(len(found), np.int64)
    np.add.at(out, at, weight)
    return found, out


def _fragments(ranges: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One fragment of each byte range; links of closed groups are summed per id pair."""

    def run(batches: Iterable[pa.RecordBatch]):
        own = aligner(path_a, path_b)
        for batch in batches:
            for key, part, text, low, high in zip(*[c.to_pylist() for c in batch.columns]):
                found = own.ranged(text, low, high)
                if found is not None:
                    codes, counts = np.unique(np.array(found[0].pairs, np.int64), return_counts=True)
                    found = (*found, codes, counts)
                yield _fragment_batch([key], [part], [found])

    return ranges.mapInArrow(run, _FRAGMENT)


def _composed(fragments: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every ``FAN`` neighbours as one fragment."""

    def run(table: pa.Table) -> pa.Table:
        own = aligner(path_a, path_b)
        rows = sorted(table.to_pylist(), key=lambda r: r["_part"])
        whole, codes, counts = None, [], []
        for r in rows:
            codes.append(np.array(r["pairs"], np.int64))
            counts.append(np.array(r["counts"], np.int64))
            fragment = Fragment(r["closed"], (r["pa"], r["pb"]), r["groups"], [], (r["sa"], r["sb"]))
            whole = fragment if whole is None else own.compose(whole, fragment)
        found = None
        if all(r["ok"] for r in rows):
            codes.append(np.array(whole.pairs, np.int64))  # of the groups that the seams closed
            counts.append(np.ones(len(whole.pairs), np.int64))
            found = (whole, sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows), *_summed(codes, counts))
        return pa.Table.from_batches([_fragment_batch([rows[0]["_key"]], [rows[0]["_part"] // FAN], [found])])

    return fragments.withColumn("_at", F.expr(f"_part div {FAN}")).groupBy("_key", "_at").applyInArrow(
        lambda table: run(table.drop_columns(["_at"])), _FRAGMENT
    )


def _finished(fragments: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """Results of very long texts from their one remaining fragment."""

    def run(batches: Iterable[pa.RecordBatch]):
        own = aligner(path_a, path_b)
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                found = NOTHING
                if r["ok"]:
                    whole = own.finished(Fragment(r["closed"], (r["pa"], r["pb"]), r["groups"], [], ([], [])))
                    codes, counts = _summed(
                        [np.array(r["pairs"], np.int64), np.array(whole.pairs, np.int64)],
                        [np.array(r["counts"], np.int64), np.ones(len(whole.pairs), np.int64)],
                    )
                    found = (r["n_a"], r["n_b"], len(whole.groups), ";".join(whole.groups), codes, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["_key"]], pa.int64()), *_stats_arrays([found], digest)],
                    names=["_key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts"],
                )

    return fragments.mapInArrow(run, f"_key long, {_STATS}")


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): corpus-wide links of each id pair, from the texts' own sums."""

    def run(batches: Iterable[pa.RecordBatch]):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            own = [c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns]
            codes, counts = _summed([codes, own[0]], [counts, own[1]])
            if len(codes) > COUNTED_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["pair", "n"])
                codes, counts = codes[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["pair", "n"])

    return aligned.select("pairs", "counts").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def frequent_pairs(judged: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(codes in order, counts, whether best, least count) of all pairs at or above a count that at most ``limit`` reach."""
    step = F.floor(F.log2("n") * 8)
    ladder = judged.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).collect()
    least, total = 1 << 62, 0
    for r in sorted(ladder, key=lambda r: -r["s"]):
        total += r["k"]
        if total > limit:
            break
        least = r["least"]
    rows = judged.where(F.col("n") >= least).select("pair", "n", "best").collect()
    rows.sort(key=lambda r: r["pair"])
    return np.array([r["pair"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64), np.array([r["best"] for r in rows], bool), least


def align(
    df: DataFrame, path_a: str, path_b: str, text_col: str = "text", digest: bool = False, range_chars: int = RANGE_CHARS, frequent: int = FREQUENT
) -> DataFrame:
    """``_row`` (all columns but the text), n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``groups`` is the text `a1,a2|b1;a3|b2,b3` of the groups' ids, or its SHA-256 with ``digest``
    (the empty string without tokens).
    """
    spark = df.sparkSession
    kept = [F.col(f"`{c}`") for c in df.columns if c != text_col] or [F.lit(None).cast("string").alias("none")]
    rows = df.select(F.struct(*kept).alias("_row"), F.monotonically_increasing_id().alias("_key"), F.col(f"`{text_col}`").alias("_text"))
    first, _ = written(_aligned(rows, path_a, path_b, digest, range_chars))
    aligned = first.where("_part IS NULL").select("_row", "_key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts")
    most, ranges_in_all = first.agg(F.max("_parts"), F.count("_parts")).first()
    if most:
        ranges = first.where("_part IS NOT NULL").select("_key", "_part", "_own", "_low", "_high")
        tasks = -(-ranges_in_all // RANGES_PER_TASK)
        fragments = _fragments(ranges.repartition(tasks, "_key", "_part"), path_a, path_b)
        while most > 1:
            fragments, most = _composed(fragments, path_a, path_b), -(-most // FAN)
        heads = first.where("_part = 0").select("_row", F.col("_key").alias("_of"))
        long, _ = written(_finished(fragments, path_a, path_b, digest))
        aligned = aligned.unionByName(long.join(heads, F.col("_key") == F.col("_of")).select(*aligned.columns))
    totals, _ = written(link_counts(aligned))
    second = F.shiftright("pair", 32)
    # one row for each id of the second vocabulary
    highest = totals.groupBy(second.alias("_b")).agg(F.max("n").alias("_most"))
    judged, _ = written(
        totals.join(F.broadcast(highest), second == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))
    )
    codes, counts, best, least = frequent_pairs(judged, frequent)
    shared = spark.sparkContext.broadcast((codes, counts, best))
    kind = rows.schema["_row"].dataType.simpleString()
    stats = ["_row", "_key", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches: Iterable[pa.RecordBatch]):
        codes, counts, best = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own, weight = [part.column(k).flatten().to_numpy(zero_copy_only=False) for k in (7, 8)]
                sizes = pa.compute.list_value_length(part.column(7)).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(part.num_rows), sizes)
                place = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
                hit = codes[place] == own if len(codes) else np.zeros(len(own), bool)
                n_best, total = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(n_best, owner[hit], weight[hit] * best[place[hit]])
                np.add.at(total, owner[hit], weight[hit] * counts[place[hit]])
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=part.num_rows))]).astype(np.int32))
                rare = [pa.ListArray.from_arrays(offsets, pa.array(v[~hit], pa.int64())) for v in (own, weight)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in range(7)], pa.array(n_best), pa.array(total), *rare],
                    names=[*stats, "_best", "_sum", "_rare", "_times"],
                )

    looked_up, _ = written(
        aligned.select(*stats, "pairs", "counts").mapInArrow(
            run,
            f"_row {kind}, _key long, n_a long, n_b long, n_groups long, n_links long, groups string, "
            "_best long, _sum long, _rare array<long>, _times array<long>",
        )
    )
    rare = looked_up.select("_key", F.explode(F.arrays_zip("_rare", "_times")).alias("_p")).select(
        "_key", F.col("_p._rare").alias("pair"), F.col("_p._times").alias("_t")
    )
    joined = rare.join(judged.where(F.col("n") < least), "pair").groupBy("_key").agg(
        F.sum(F.col("_t") * F.col("n")).alias("_more"), F.sum(F.when(F.col("best"), F.col("_t")).otherwise(0)).alias("_more_best")
    )
    add = lambda known, more: (F.col(known) + F.coalesce(F.col(more), F.lit(0))).cast("long")
    return looked_up.join(joined, "_key", "left").select(
        "_row", "n_a", "n_b", "n_groups", "n_links", add("_best", "_more_best").alias("n_best"), add("_sum", "_more").alias("count_sum"), "groups"
    )
