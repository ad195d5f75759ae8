"""Byte-pair merges by a segment tree over the ranks of adjacent pairs.

The leaf of a symbol holds ``rank * width + position`` of the pair that begins there, or
``NONE`` if that pair never merges; an inner node holds the smaller of its children. The
root is thus the leftmost pair of the lowest rank. A merge changes at most three leaves,
and each change climbs one path to the root. Pieces of equal padded width are merged
side by side with numpy; the few very long ones use the same tree one at a time.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import RaggedCache, slices, starts_of

WORD_BPE = "word_bpe_49k.json"
NONE = np.iinfo(np.int64).max
WORDS_KEPT = 150_000
#: From this width on a piece is merged alone; cells of one batch of trees.
ALONE, CELLS = 512, 1 << 20

# Fixed values of the tokenizer's format: white space of its pattern, and the pattern within a word.
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")


def vocabulary_path(name: str = WORD_BPE) -> str:
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """Ranks of pairs of symbol ids, and the id that each pair becomes."""

    def __init__(self, ranked: list[tuple[int, int, int]], size: int):
        """``ranked``: (left, right, merged) in rank order; ``size``: number of symbols."""
        self.size = size
        pairs = np.array([a * size + b for a, b, _ in ranked], np.int64)
        self.order = np.argsort(pairs, kind="stable")
        self.keys = np.append(pairs[self.order], NONE)
        self.order = np.append(self.order, 0)
        self.merged = np.array([m for _, _, m in ranked], np.int64)
        self.rank_of = {int(k): int(r) for k, r in zip(self.keys[:-1], self.order)}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it never merges; a negative symbol stands for no symbol."""
        wanted = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    def apply(self, pieces: list[list[int]]) -> list[list[int]]:
        """The symbols of each piece once no pair of it merges any more."""
        out: list[list[int]] = [[]] * len(pieces)
        widths: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) < 2:
                out[i] = list(p)
            elif len(p) > ALONE:
                out[i] = self._one(p)
            else:
                widths.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in widths.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                chosen = members[k : k + step]
                for i, symbols in zip(chosen, self._many([pieces[i] for i in chosen], width)):
                    out[i] = symbols
        return out

    def _many(self, pieces: list[list[int]], width: int) -> list[list[int]]:
        rows = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, rows)
        # One more column on the right is "no symbol", also reached as column -1 from the left end.
        symbols = np.full((rows, width + 1), -1, np.int64)
        symbols[np.arange(width + 1) < lengths[:, None]] = np.fromiter((s for p in pieces for s in p), np.int64)
        place = np.arange(width + 1)
        after = np.where(place + 1 < lengths[:, None], place + 1, width)
        before = np.broadcast_to(place - 1, after.shape).copy()
        ranks = self.ranks(symbols[:, :-1], symbols[:, 1:])
        tree = np.full((rows, 2 * width), NONE, np.int64)
        tree[:, width:] = np.where(ranks >= 0, ranks * width + place[:-1], NONE)
        for level in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * level], tree[:, 2 * level + 1], out=tree[:, level])

        def put(which: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[which, node] = value
            while node.size and node[0] > 1:
                node = node >> 1
                tree[which, node] = np.minimum(tree[which, 2 * node], tree[which, 2 * node + 1])

        def key(which: np.ndarray, at: np.ndarray) -> np.ndarray:
            ranks = self.ranks(symbols[which, at], symbols[which, after[which, at]])
            return np.where(ranks >= 0, ranks * width + at, NONE)

        live = np.flatnonzero(tree[:, 1] < NONE)
        while live.size:
            rank, at = np.divmod(tree[live, 1], width)
            right = after[live, at]
            beyond = after[live, right]
            symbols[live, at] = self.merged[rank]
            symbols[live, right] = -1
            after[live, at] = beyond
            before[live, beyond] = at
            put(live, right, np.full(live.size, NONE))
            put(live, at, key(live, at))
            left = before[live, at]
            has = left >= 0
            put(live[has], left[has], key(live[has], left[has]))
            live = live[tree[live, 1] < NONE]
        kept = symbols >= 0
        flat, ends = symbols[kept].tolist(), starts_of(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def _one(self, piece: list[int]) -> list[int]:
        width = 1 << (len(piece) - 1).bit_length()
        none = int(NONE)
        symbols = [*piece, -1]
        after = [*range(1, len(piece) + 1), len(piece)]
        before = [*range(-1, len(piece))]
        merged = self.merged.tolist()

        def key(at: int) -> int:
            if symbols[after[at]] < 0:
                return none
            rank = self.rank_of.get(symbols[at] * self.size + symbols[after[at]], -1)
            return none if rank < 0 else rank * width + at

        tree = [none] * width + [key(i) for i in range(len(piece))] + [none] * (width - len(piece))
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            right = after[at]
            symbols[at], symbols[right] = merged[rank], -1
            after[at] = after[right]
            before[after[at]] = at
            put(right, none)
            put(at, key(at))
            if before[at] >= 0:
                put(before[at], key(before[at]))
        return [s for s in symbols if s >= 0]


def _numbered(keys: list[bytes]) -> dict[bytes, int]:
    return {k: i for i, k in enumerate(dict.fromkeys(keys))}


class WordEncoder(RaggedCache):
    """Ids of texts: special tokens, then words, then pieces of words, then merges."""

    def __init__(self, path: str):
        super().__init__(WORDS_KEPT)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.token_array = pa.array(self.tokens, pa.large_string())
        end = spec["model"]["end_of_word_suffix"]
        self.inner = [vocab[c] for c in byte_symbols()]
        self.final = [vocab[c + end] for c in byte_symbols()]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], len(self.tokens))
        # Separators that Arrow takes for white space and the pattern does not, and special tokens.
        self.odd = "|".join([r"[\x1c-\x1f]", *map(re.escape, self.special)])
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def split(self, texts: pa.Array) -> pa.Array:
        return pc.utf8_split_whitespace(texts)

    def parts(self, text: str) -> list[str]:
        cut = self._cut.split(text)
        return [w for p in cut for w in ([p] if p in self.special else _SPACES.split(p)) if w]

    def learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[bytes] = []
        counts = np.empty(len(parts), np.int64)
        for i, word in enumerate(parts):
            if word in self.special:
                counts[i] = -1
                pieces.append(b"")
                continue
            if not word.isascii():  # lower case is taken a character at a time: a last sigma is an ordinary one
                word = unicodedata.normalize("NFC", word).replace("\u03a3", "\u03c3")
            found = _PIECE.findall(word.lower())
            counts[i] = len(found)
            pieces += [p.encode() for p in found]
        distinct = _numbered(pieces)  # equal pieces are merged once
        inner, final = self.inner, self.final
        merged = self.merges.apply([[inner[b] for b in p[:-1]] + [final[b] for b in p[-1:]] for p in distinct])
        ids = [merged[distinct[p]] for p in pieces]
        at = starts_of(np.abs(counts))
        for i in np.flatnonzero(counts < 0):
            ids[at[i]] = [self.special[parts[i]]]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        return flat, np.diff(starts_of(lengths)[at])

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The tokens of each run of ids joined by one space, as the format without a decoder does."""
        tokens = self.token_array.take(pa.array(flat))
        lists = pa.LargeListArray.from_arrays(pa.array(starts_of(counts)), tokens)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process for ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array) and the text decoded from them, of each text.

    A null text is empty: no ids, an empty decoded text. Rows with a null or repeated
    doc_id are encoded like any other row; other columns are not looked at.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for part in slices(batches):
            flat, counts = coder.encode(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(starts_of(counts), pa.int32()), pa.array(flat, pa.int32()))
            decoded = coder.decode(flat, counts).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, decoded], ["doc_id", "ids", "decoded"])

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(encode, "doc_id long, ids array<int>, decoded string")
