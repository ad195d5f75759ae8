"""Ids of a byte-level tokenizer for whole texts, computed once for each distinct piece.

A space before a character that is not white space always begins a new piece of the
tokenizer's own splitting pattern, so a text may be cut there and the pieces encoded
alone. So do, in a text without white space side by side, a single line break, the character after it,
and most ASCII punctuation after a letter, which leaves fewer different pieces. Each task
keeps a bounded dictionary from piece to ids; it saves time only.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from lamina.llm.common import RaggedCache, ragged, starts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

BYTE_BPE = "byte_bpe_50k.json"
PIECES_KEPT = 1_500_000
#: Bytes of pieces that a task remembers, and what a piece takes besides its own bytes and ids.
KEPT_BYTES, PIECE_BYTES = 64_000_000, 150

_CUT = re.compile(r" (?=\S)")
_INSIDE = re.compile(r"\S+")
#: Stands before a piece that has no space in front of it; no text reaches the tokenizer with it.
_BARE = "\0"
#: Punctuation but the apostrophe, which may begin a contraction, after a Latin letter.
_STOP = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"
#: Ordinary new pieces that the tokenizer gets as one text.
TOGETHER = 256


def vocabulary_path(name: str = BYTE_BPE) -> str:
    return public_tokenizers.path(name)


class PieceEncoder(RaggedCache):
    """Encodes lists of texts. The special tokens' own strings count as special, as in the library."""

    def __init__(self, path: str):
        super().__init__(PIECES_KEPT)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([r"[\s\pZ\x{85}\x1c-\x1f]{2}", r"\x00", *map(re.escape, self.specials)])
        # A byte-level token has a character for each of its bytes.
        size = self.tokenizer.get_vocab_size()
        self.sizes = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)], np.int64)

    def forget(self) -> None:
        super().forget()
        self.bytes = 0

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.bytes > KEPT_BYTES:
            self.thin()
        return super().encode(texts)

    def thin(self) -> None:
        super().thin()
        self.bytes = sum(map(len, self.known)) + PIECE_BYTES * len(self.known) + 4 * len(self.flat)
        if self.bytes > KEPT_BYTES // 2:
            self.forget()

    def split(self, texts: pa.Array) -> pa.Array:
        lines = pc.replace_substring(texts, "\n", f" {_BARE}\n {_BARE}")
        stops = pc.replace_substring_regex(lines, _STOP, rf"\1 {_BARE}\2")
        return pc.split_pattern(pc.binary_join_element_wise(_BARE, stops, ""), " ")

    def parts(self, text: str) -> list[str]:
        """Pieces without the space before them; those that have none are marked."""
        if _BARE in text or any(s in text for s in self.specials):
            return [_BARE + text]
        parts = _CUT.split(text)
        parts[0] = _BARE + parts[0]
        return parts

    def learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of a space and then no more white space also stay apart when they follow each
        other in one text, which is much cheaper than a text each; byte lengths part their ids."""
        plain = [i for i, p in enumerate(parts) if p[:1] != _BARE and _INSIDE.fullmatch(p)]
        groups = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        rest = sorted(set(range(len(parts))).difference(plain))
        texts = [" " + " ".join([parts[i] for i in g]) for g in groups]
        texts += [parts[i][1:] if parts[i][:1] == _BARE else " " + parts[i] for i in rest]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        together = int(lengths[: len(groups)].sum())
        ends = np.cumsum([1 + len(parts[i].encode()) for i in plain])
        cuts = np.searchsorted(np.cumsum(self.sizes[flat[:together]]), ends) + 1
        lengths = np.concatenate([np.diff(cuts, prepend=0), lengths[len(groups) :]])
        self.bytes += sum(map(len, parts)) + PIECE_BYTES * len(parts) + 4 * len(flat)
        # Back to the order of the parts.
        back = np.empty(len(parts), np.int64)
        back[plain + rest] = np.arange(len(parts))
        return ragged(flat, starts_of(lengths), back)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process for ``path``."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
