"""SentencePiece encoding and decoding; giant texts by a max-plus parallel scan.

Encoding is a path search over the text's positions whose arcs are pieces, in the (max, +)
semiring.  For a unigram model an arc weighs its piece's score, so the best path is the
Viterbi segmentation.  For a BPE model an arc weighs 0 if merging would keep it and
the piece before it apart, and minus infinity otherwise: merging a text gives the one sequence
in which every neighbouring pair stays apart, so the path of weight 0 is the merged result.
Characters without a piece become byte pieces.  Decoding turns ids back into text.

A text up to ``chunk_chars`` long is searched in one task, word by word: when no piece holds
the space mark after another character, every path has a boundary before a space mark that
follows another character, so words are independent and are remembered.  A giant text is
cut into chunks:

1. A boundary's states are the pieces that could lie across it or end at it, read off the
   characters around it.  Each chunk yields the transfer matrix between the states before
   and after it: the best weight of any path between the two.
2. A document's matrices are combined by an associative max-plus scan, which gives the
   state that the best path has at every boundary.
3. With its two boundary states known, every chunk is traced back independently.

Defined results: null and empty texts have no ids; a space mark in a text decodes to a space;
repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, text_or_empty

CHUNK_CHARS = 1 << 15
CACHE_ENTRIES = 600_000
MARK = "▁"  # the space mark
UNKNOWN_PENALTY = 10.0  # how far below the lowest score a character without a piece lies
# Scores get an offset below this by their id, so that a unigram model's best path is unique.
TIE_BREAK = 1e-4
NEVER = -np.inf
UNIGRAM, BPE = 1, 2  # model types as the files number them
LONE = -1  # the id of a character without a piece
START = -2  # before the first piece, and at forced boundaries

_RESET = re.compile(f"(?<=[^{MARK}]){MARK}")
ID_TYPE = np.dtype("<u4")


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (message[at] & 0x7F) << shift
            shift += 7
            at += 1
            if message[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ((8 if kind == 1 else 4), at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


def model_type(path: str) -> int:
    """The type that a model file records (field 3 of its trainer settings, field 2)."""
    with open(path, "rb") as f:
        settings = b"".join(v for n, v in _fields(f.read()) if n == 2)
    return [UNIGRAM, *(v for n, v in _fields(settings) if n == 3)][-1]  # the last value of a field counts


class Pieces:
    """The pieces of a model file, for segmenting marked text (spaces are marks)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.merging = model_type(path) == BPE
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(self.names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.unknown_id = model.unk_id()
        self.silent = {i for i in range(size) if model.is_control(i)}
        offset = np.random.default_rng(11).random(size) * TIE_BREAK
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.unknown_score = min(model.get_score(i) for i in plain) - UNKNOWN_PENALTY
        self.longest = max(len(self.names[i]) for i in plain)
        self.score = {self.names[i]: model.get_score(i) for i in plain}
        # every prefix of a piece, so that a search can stop early; pieces have (id, weight)
        self.table: dict[str, tuple[int, float] | None] = {}
        for i in plain:
            for n in range(1, len(self.names[i])):
                self.table.setdefault(self.names[i][:n], None)
        for i in plain:
            self.table[self.names[i]] = (i, 0.0 if self.merging else model.get_score(i) - offset[i])
        # whether every character of a piece is a piece
        self.closed = all(c in self.score for c in set("".join(self.score)))
        self.resets = not any(MARK in self.names[i].lstrip(MARK) for i in plain)
        # words between forced boundaries; a line break without a piece stands for itself
        line = "" if "\n" in self.table else "\n"
        self.unit_pattern = re.compile(f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + ("|\n" if line else ""))
        self.units: dict[str, bytes] = {}
        self.weights: dict[str, float] = {}
        self.apart: dict[int, bool] = {}
        self.edges: dict[int, tuple[list, list]] = {}

    # ------------------------------------------------------------- arcs

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, int, float]]:
        """(end, id, weight) of the pieces that start at a position; a lone character always has one."""
        table, found = self.table, False
        for end in range(at + 1, min(len(text), at + self.longest) + 1):
            sub = text[at:end]
            if sub not in table:
                break
            piece = table[sub]
            if piece is not None:
                found = found or end == at + 1
                yield end, piece[0], piece[1]
        if not found:
            yield at + 1, LONE, 0.0 if self.merging else self.unknown_score

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, the best-scored pair first and the leftmost of equals."""
        parts = list(text)
        while True:
            best, where = NEVER, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1], NEVER)
                if score > best:
                    best, where = score, k
            if where < 0:
                return parts
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def _edges(self, piece: int) -> tuple[list, list]:
        """How a piece's first and last symbols grow while it is merged: ([(symbol, score of the next)], same for last)."""
        found = self.edges.get(piece)
        if found is None:
            parts = list(self.names[piece])
            firsts, lasts = [parts[0]], [parts[-1]]
            while len(parts) > 1:
                where = max(range(len(parts) - 1), key=lambda k: (self.score.get(parts[k] + parts[k + 1], NEVER), -k))
                parts[where : where + 2] = [parts[where] + parts[where + 1]]
                if where == 0:
                    firsts.append(parts[0])
                if where == len(parts) - 1:
                    lasts.append(parts[-1])
            found = self.edges[piece] = tuple(
                [(symbol, self.score[after] if after else NEVER) for symbol, after in zip(side, [*side[1:], None])]
                for side in (firsts, lasts)
            )
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging keeps a boundary between two pieces.

        It does unless the symbols that meet there at some moment have a merge that comes
        before the next merge on either side (before an equal one on the right, too).
        """
        if left < 0 or right < 0:
            return True
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > 4 * CACHE_ENTRIES:
                self.apart.clear()
            a, b = self.names[left], self.names[right]
            if a + b in self.score:
                known = False
            elif MARK in a[1:] or MARK in b:  # runs of marks share one score, so their merges have no fixed order
                known = self.merged(a + b) == [a, b]
            else:
                lasts, firsts = self._edges(left)[1], self._edges(right)[0]
                i = j = 0
                known = True
                while known and i < len(lasts) and j < len(firsts):
                    (x, next_left), (y, next_right) = lasts[i], firsts[j]
                    score = self.score.get(x + y)
                    known = score is None or score <= next_left or score < next_right
                    if next_left >= next_right:
                        i += 1
                    else:
                        j += 1
            self.apart[key] = known
        return known

    def search(self, text: str, start: int, before: int, stop: int) -> list[tuple[float, int, int]]:
        """Best (weight, last id, its start) per position, from one state, over pieces starting before ``stop``."""
        best = [(NEVER, START, 0)] * (max(len(text), start) + 1)
        best[start] = (0.0, before, start)
        merging = self.merging
        for at in range(start, min(stop, len(text))):
            weight, last, _ = best[at]
            if weight == NEVER:
                continue
            for end, piece, gain in self.arcs(text, at):
                if weight + gain > best[end][0] and (not merging or self.stay_apart(last, piece)):
                    best[end] = (weight + gain, piece, at)
        return best

    def _ids(self, text: str, best: list, start: int, stop: int) -> bytes:
        """Ids of the path that a search found from ``start`` to ``stop``."""
        ids: list[int] = []
        at = stop
        while at > start:
            _, piece, came = best[at]
            if piece != LONE:
                ids.append(piece)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in text[came].encode("utf-8", "surrogatepass")[::-1]]
            else:
                ids.append(self.unknown_id)
            at = came
        return np.array(ids[::-1], ID_TYPE).tobytes()

    def _bytes(self, ids: list[int], text: str) -> bytes:
        """Path ``ids``, with a negative one for each lone character: minus one less its position."""
        out: list[int] = []
        for i in ids:
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in text[-1 - i].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown_id)
        return struct.pack(f"<{len(out)}I", *out)

    def _merged_path(self, text: str) -> bytes:
        """The path of a whole word of a BPE model, longest pieces tried first.

        One piece can end at each position, so a position that leads nowhere once never does.  A path that
        fails at a position goes on with the next shorter piece; most words need no such step.
        """
        if not self.closed:
            return self._searched_path(text)
        n, longest, get, apart, known = len(text), self.longest, self.table.get, self.stay_apart, self.apart.get
        ids: list[int] = []
        open_ends: list[list[tuple[int, int]]] = []  # per position of the path: shorter pieces not tried yet
        starts: list[int] = []
        dead: set[int] = set()
        at, left, found = 0, START, None
        while at < n:
            if found is None:
                found = []
                for end in range(at + 1, min(n, at + longest) + 1):
                    piece = get(text[at:end], 0)
                    if piece:
                        found.append((end, piece[0]))
                    elif piece == 0:
                        break
                if not found:
                    found.append((at + 1, -1 - at))
            while found:
                end, right = found.pop()
                if end in dead:
                    continue
                if left >= 0 and right >= 0:
                    ok = known(left << 32 | right)
                    if ok is None:
                        ok = apart(left, right)
                    if not ok:
                        continue
                open_ends.append(found)
                starts.append(at)
                ids.append(right)
                at, left, found = end, right, None
                break
            else:
                dead.add(at)
                if not ids:
                    return self._searched_path(text)
                found, at = open_ends.pop(), starts.pop()
                ids.pop()
                left = ids[-1] if ids else START
        if n and min(ids) < 0:
            return self._bytes(ids, text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _searched_path(self, text: str) -> bytes:
        """``_merged_path`` by the search over all positions."""
        n, longest, get, apart, known = len(text), self.longest, self.table.get, self.stay_apart, self.apart.get
        last, came = [None] * (n + 1), [0] * (n + 1)
        last[0] = START
        for at in range(n):
            left = last[at]
            if left is None:
                continue
            lone, pair = True, left << 32
            for end in range(at + 1, min(n, at + longest) + 1):
                piece = get(text[at:end], 0)
                if piece is None:
                    continue
                if piece == 0:
                    break
                lone = False
                if last[end] is None:
                    right = piece[0]
                    if left >= 0:
                        ok = known(pair | right)
                        if ok is None:
                            ok = apart(left, right)
                        if not ok:
                            continue
                    last[end] = right
                    came[end] = at
            if lone or last[at + 1] is None and text[at] not in self.score:
                last[at + 1], came[at + 1] = LONE, at
        ids: list[int] = []
        at = n
        while at > 0:
            if last[at] != LONE:
                ids.append(last[at])
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in text[came[at]].encode("utf-8", "surrogatepass")[::-1]]
            else:
                ids.append(self.unknown_id)
            at = came[at]
        return struct.pack(f"<{len(ids)}I", *ids[::-1])

    def unit(self, text: str) -> bytes:
        """Ids of a word between forced boundaries."""
        found = self.units.get(text)
        if found is None:
            if len(self.units) > CACHE_ENTRIES:
                self.units.clear()
                self.weights.clear()
            if self.merging:
                found = self._merged_path(text)
            else:
                best = self.search(text, 0, START, len(text))
                found, self.weights[text] = self._ids(text, best, 0, len(text)), best[len(text)][0]
            self.units[text] = found
        return found

    def weight(self, text: str) -> float:
        if self.merging:
            return 0.0
        self.unit(text)
        return self.weights[text]

    def encode_marked(self, text: str) -> bytes:
        units = self.unit_pattern.findall(text) if self.resets else [text]
        try:
            return b"".join(map(self.units.__getitem__, units))
        except KeyError:
            return b"".join(map(self.unit, units))

    def decode(self, ids: Iterable[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            if i not in self.silent:
                out.append(self.names[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text

    # ------------------------------------------------------------ chunks

    def states(self, text: str, at: int, is_end: bool) -> list[tuple[int, int, int]]:
        """(start, end, id) of the pieces that start before a boundary and reach it; at 0 the start state."""
        if at == 0:
            return [(0, 0, START)]
        found = []
        for start in range(max(0, at - self.longest), at):
            found += [(start, end, i) for end, i, _ in self.arcs(text, start) if end == at or (end > at and not is_end)]
        return found

    def _leaving(self, best: list, text: str, first: int, states: list, entry: tuple | None) -> np.ndarray:
        """Weights of ending in each state, after a search from ``first`` on."""
        out = np.full(len(states), NEVER)
        for k, (start, end, piece) in enumerate(states):
            if start < first:  # the piece before the chunk reaches across it
                out[k] = 0.0 if entry == (start, end, piece) else NEVER
            elif start < len(best) and best[start][0] > NEVER and (not self.merging or self.stay_apart(best[start][1], piece)):
                out[k] = best[start][0] + (self.unknown_score * (not self.merging) if piece == LONE else self.table[text[start:end]][1])
        return out

    def _resets_in(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last forced boundary in [a, b)."""
        first = _RESET.search(text, a, b) if self.resets else None
        if first is None:
            return None
        last = text.rfind(MARK, a, b)
        while last > first.start() and text[last - 1] == MARK:
            last -= 1
        return first.start(), max(last, first.start())

    def transfer(self, text: str, a: int, b: int, is_end: bool) -> np.ndarray:
        """The matrix of a chunk [a, b) of ``text``, which holds ``longest`` characters around it."""
        before, after = self.states(text, a, False), self.states(text, b, is_end)
        inside = self._resets_in(text, a, b)
        if inside is None:
            rows = []
            for entry in before:
                best = self.search(text, entry[1], entry[2], b)
                rows.append(self._leaving(best, text, a, after, entry))
            return np.array(rows).reshape(len(before), len(after))
        first, last = inside
        reach = np.full(len(before), NEVER)
        for k, (_, end, piece) in enumerate(before):
            if end <= first:
                reach[k] = self.search(text[:first], end, piece, first)[first][0]
        middle = sum(self.weight(u) for u in self.unit_pattern.findall(text[first:last]))
        leave = self._leaving(self.search(text, last, START, b), text, last, after, None)
        return reach[:, None] + middle + leave[None, :]

    def trace(self, text: str, a: int, b: int, is_end: bool, entry: int, leave: int) -> bytes:
        """Ids of the pieces that start in the chunk, between two boundary states."""
        _, begin, last_id = self.states(text, a, False)[entry]
        start, end, piece = self.states(text, b, is_end)[leave]
        if start < a:
            return b""
        inside = self._resets_in(text, a, b)
        head = b""
        if inside is not None:
            first, last = inside
            head = self._ids(text, self.search(text[:first], begin, last_id, first), begin, first)
            head += self.encode_marked(text[first:last])
            begin, last_id = last, START
        best = self.search(text, begin, last_id, b)
        best[end] = (0.0, piece, start)
        return head + self._ids(text, best, begin, end)


def marked(text: str) -> str:
    return (" " + text).replace(" ", MARK) if text else ""


def chunks(text: str, size: int, longest: int) -> Iterator[tuple[int, str, int, int, bool]]:
    """(number, chunk with ``longest`` characters around it, its bounds there, whether it is the last).

    No boundary follows a space mark: it moves back to before the marks, or on to the next word.
    """
    at = number = 0
    while at < len(text):
        cut = min(at + size, len(text))
        if cut < len(text) and text[cut - 1] == MARK:
            start = cut
            while start > at and text[start - 1] == MARK:
                start -= 1
            following = _RESET.search(text, cut)
            cut = start if start > at else following.start() if following else len(text)
        low = max(0, at - longest)
        yield number, text[low : cut + longest], at - low, cut - low, cut == len(text)
        at, number = cut, number + 1


# ----------------------------------------------------------- max-plus scan


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two matrices in the (max, +) semiring."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def scanned(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefix products, the combined span doubling in each round."""
    out, span = list(matrices), 1
    while span < len(out):
        out = [m if k < span else max_plus(out[k - span], m) for k, m in enumerate(out)]
        span *= 2
    return out


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every boundary on the best path through all chunks."""
    prefix = scanned(matrices)
    states = [int(np.argmax(prefix[-1][0]))]
    for k in range(len(matrices) - 1, 0, -1):
        states.append(int(np.argmax(prefix[k - 1][0] + matrices[k][:, states[-1]])))
    return [0, *states[::-1]]


# ------------------------------------------------------------------- Spark

_LOADED: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


PARTS = "_n long, _key binary, chunk long, low long, high long, is_end boolean"


def _giant_chunks(giant: DataFrame, path: str, size: int, answer: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """Chunk rows of giant texts; ``answer`` says whether matrices or the chunks' texts are returned."""
    kind = pa.string() if answer == "part" else pa.binary()
    names = ["_n", "_key", "chunk", "low", "high", "is_end", answer]

    def run(batches: Iterable[pa.RecordBatch]):
        pieces = pieces_of(path)
        for batch in batches:
            for at in range(batch.num_rows):
                row, key, text = (batch.column(c)[at].as_py() for c in range(3))
                rows = []
                for number, chunk, low, high, is_end in chunks(marked(text), size, pieces.longest):
                    value = chunk if answer == "part" else _dumped(pieces.transfer(chunk, low, high, is_end))
                    rows.append((row, key, number, low, high, is_end, value))
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), kind)
                same = pa.array([at] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(v, t) for v, t in zip(zip(*rows), kinds)), *(batch.column(3 + c).take(same) for c in range(len(carried)))],
                    names=[*names, *carried],
                )

    schema = f"{PARTS}, {answer} {'string' if answer == 'part' else 'binary'}"
    schema += "".join(f", {c} {giant.schema[c].dataType.simpleString()}" for c in carried)
    return giant.select("_n", "_key", "_text", *carried).mapInArrow(run, schema)


def _dumped(matrix: np.ndarray) -> bytes:
    return np.array(matrix.shape, "<i8").tobytes() + matrix.astype("<f8").tobytes()


def _loaded(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f8", offset=16).reshape(np.frombuffer(data, "<i8", 2))


def encode(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """(id, text_crc32, chunks, ids): one row per input row; ids are little-endian unsigned 32-bit."""
    text = text_or_empty(text_col)
    rows = df.select(
        F.monotonically_increasing_id().alias("_n"),
        F.unhex(F.sha2(text, 256)).alias("_key"),
        F.col(id_col).alias("_id"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text.alias("_text"),
    )
    is_giant = F.length("_text") > chunk_chars
    id_type = df.schema[id_col].dataType.simpleString()

    def whole(batches: Iterable[pa.RecordBatch]):
        pieces = pieces_of(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [pieces.encode_marked(marked(t)) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([1] * len(ids), pa.int64()), pa.array(ids, pa.binary())],
                    names=["_id", "text_crc32", "chunks", "ids"],
                )

    result = f"_id {id_type}, text_crc32 long, chunks long, ids binary"
    small = rows.where(~is_giant).select("_id", "text_crc32", "_text").mapInArrow(whole, result)

    def states(table: pa.Table) -> pa.Table:
        by_chunk = dict(zip(table.column("chunk").to_pylist(), table.column("matrix").to_pylist()))  # repeated texts agree
        order = sorted(by_chunk)
        found = boundary_states([_loaded(by_chunk[c]) for c in order])
        return pa.table(
            {
                "_key": pa.array([table.column("_key")[0].as_py()] * len(order), pa.binary()),
                "chunk": pa.array(order, pa.int64()),
                "entry": pa.array(found[:-1], pa.int64()),
                "leave": pa.array(found[1:], pa.int64()),
            }
        )

    giant = rows.where(is_giant)
    matrices = _giant_chunks(giant.dropDuplicates(["_key"]), model_path, chunk_chars, "matrix")
    # a text has at most 2 GB, so its matrices are bounded
    known = checkpointed(matrices.groupBy("_key").applyInArrow(states, "_key binary, chunk long, entry long, leave long"))

    carried = ("_id", "text_crc32")

    def trace(batches: Iterable[pa.RecordBatch]):
        pieces = pieces_of(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                ids = [pieces.trace(*args) for args in zip(*(part.column(c).to_pylist() for c in range(2, 8)))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(ids, pa.binary()), part.column(8), part.column(9)],
                    names=["_n", "chunk", "ids", *carried],
                )

    parts = _giant_chunks(giant, model_path, chunk_chars, "part", carried).join(known, ["_key", "chunk"])
    traced = parts.select("_n", "chunk", "part", "low", "high", "is_end", "entry", "leave", *carried).mapInArrow(
        trace, f"_n long, chunk long, ids binary, _id {id_type}, text_crc32 long"
    )
    joined = (
        traced.groupBy("_n")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("_parts"), *[F.first(c).alias(c) for c in carried])
        .select(
            "_id", "text_crc32", F.size("_parts").cast("long").alias("chunks"),
            F.aggregate("_parts", F.lit("").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
        )
    )
    return small.unionByName(joined).withColumnRenamed("_id", id_col)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the text of its ids, in place of ``ids_col``."""
    others = [c for c in df.columns if c != ids_col]
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterable[pa.RecordBatch]):
        pieces = pieces_of(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [pieces.decode(np.frombuffer(b or b"", ID_TYPE).tolist()) for b in part.column(len(others)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in range(len(others))], pa.array(texts, pa.string())], names=[*others, out]
                )

    return df.select(*others, ids_col).mapInArrow(run, f"{fields}, `{out}` string")
