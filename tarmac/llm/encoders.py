"""Word-cached encoding with the ``tokenizers`` library.

``Tokenizer.encode`` spends most of its time on normalising and splitting.  Both work
inside white-space-free chunks, so each distinct chunk is encoded once per worker and
remembered as packed ids.  A missing chunk of plain Latin characters is split with the
pattern of the tokenizer's own file and its pre-tokens go straight to the library's BPE
model; every other chunk (controls, rare scripts, strings of special tokens) and every
file of another layout goes through the library's whole ``encode``.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import regex

ID_TYPE = np.dtype("<u4")
# Entries after which a worker's cache starts afresh (about 150 MB).
CACHE_ENTRIES = 500_000
# Characters of one text that are split at a time.
SEGMENT_CHARS = 1 << 20

# Characters whose NFC form is themselves and whose lower case does not depend on context.
PLAIN = "\x21-\x7eÀ-įı-ɏ"


def byte_symbols() -> list[str]:
    """The printable character that byte-level BPE uses for each byte."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def _split_pattern(spec: dict):
    """The pre-token pattern if the file has the layout that chunk-wise splitting relies on."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != {"Regex": "\\s+"}:
        return None
    if [p["type"] for p in pre] != ["Split", "ByteLevel"] or not pre[0]["invert"] or pre[0]["behavior"] != "Removed":
        return None
    if pre[1]["add_prefix_space"] or pre[1]["use_regex"] or spec["post_processor"]:
        return None
    return regex.compile(pre[0]["pattern"]["Regex"])


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """Cut a long text at spaces into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


class WordEncoder:
    """Token ids of texts as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = _split_pattern(spec)
        # plain chunks hold no character that starts a special token's string
        starts = "".join(regex.escape(c) for c in {t["content"][0] for t in spec["added_tokens"]})
        self.is_plain = regex.compile(f"[[{PLAIN}]--[{starts}]]*" if starts else f"[{PLAIN}]*", regex.V1).fullmatch
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.cache_entries = cache_entries
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, ID_TYPE).tobytes()

    def _piece(self, piece: str) -> bytes:
        word = piece if piece.isascii() else "".join([self.symbols[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(word)]
        found = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _chunk(self, chunk: str) -> bytes:
        if not self.is_plain(chunk):
            return self._whole(chunk)
        pieces, lowered = self.pieces, chunk.lower()
        if chunk.isalpha():  # one run of letters is one pre-token
            return pieces.get(lowered) or self._piece(lowered)
        return b"".join([pieces.get(p) or self._piece(p) for p in self.pattern.findall(lowered)])

    def encode(self, text: str) -> bytes:
        if self.pattern is None:
            return self._whole(text)
        return b"".join(self._segment(part) for part in segments(text))

    def _segment(self, part: str) -> bytes:
        words = part.replace("\n", " ").split(" ")
        cache = self.chunks
        missing = set(words).difference(cache)
        if missing:
            if len(cache) > self.cache_entries:
                cache.clear()
                missing = set(words)
            if len(self.pieces) > self.cache_entries:
                self.pieces.clear()
            chunk = self._chunk
            for word in missing:
                cache[word] = chunk(word)
        return b"".join(map(cache.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file; its cache lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
