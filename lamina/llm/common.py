"""Helpers of the text operators: bounded slices of Arrow batches, words, ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A slice of documents worked on at once ends at this many bytes of text, or this many rows.
#: It bounds a task's memory; a longer single text is a slice of its own. Only the sequences
#: of packing, which are made up within a slice, depend on it.
SLICE_BYTES = 4_000_000
SLICE_ROWS = 4096


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def apart(docs: DataFrame, keep: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """``docs`` with all columns but ``keep`` named by their place, so that none clashes with a new one."""
    return docs.toDF(*[c if c in keep else f"in_{i}" for i, c in enumerate(docs.columns)])


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``limit`` bytes of ``text``, or a single row.

    After each batch Arrow gives back the memory that its work has left unused.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = int(np.searchsorted(ends, base + limit, side="right"))
            end = min(max(end, begin + 1), begin + rows)
            yield batch.slice(begin, end - begin)
            begin = end
        # What the pool holds and does not use would stay with the worker, through later stages as well.
        pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts as str; null counts as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def words_of(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """All words of all texts in order, with A-Z in lower case, and the number of words of each text.

    ``bytes.split`` cuts exactly at 0x20 and 0x09-0x0D, ``bytes.lower`` changes exactly A-Z.
    """
    flat: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = t.encode("utf-8", "replace").lower().split()
        counts[i] = len(words)
        flat += words
    return flat, counts


def coded(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """A code per word, and the distinct words that the codes stand for."""
    if not words:
        return np.empty(0, np.int32), []
    encoded = pa.array(words, pa.large_binary()).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each run begins when runs of these lengths stand one after another; one more at the end."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run; an empty run gives 0."""
    out = np.zeros(len(counts), values.dtype)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts_of(counts)[:-1][full])
    return out


def ragged(flat: np.ndarray, starts: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs numbered ``picks`` of ``flat`` one after another, and their lengths."""
    lengths = (starts[1:] - starts[:-1])[picks]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    where = np.arange(total) + np.repeat(starts[picks] - (ends - lengths), lengths)
    return flat[where], lengths


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch with the columns in the order and types of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


class _Numbered(dict):
    """Numbers keys as they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class RaggedCache:
    """Values of texts that are joined from the values of their parts, each part worked out once.

    ``split`` cuts ordinary texts in Arrow and ``parts`` any other text; ``learn`` gives the
    values of new parts. When more than about ``kept`` parts are remembered, those that few calls
    asked for go: the memory saves time and changes no result.
    """

    #: An RE2 pattern of texts that ``parts`` has to cut.
    odd = ""

    def __init__(self, kept: int):
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        self.known = _Numbered()
        self.flat = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.uses = np.empty(0, np.uint8)

    def thin(self) -> None:
        """Keep the parts that several calls asked for since the last time; none when they are too many."""
        again = np.flatnonzero(self.uses > 1)
        if 2 * len(again) > len(self.uses):
            return self.forget()
        words = list(self.known)
        flat, lengths = ragged(self.flat, self.starts, again)
        self.known = _Numbered(zip([words[i] for i in again.tolist()], range(len(again))))
        self.flat, self.starts, self.uses = flat, starts_of(lengths), np.zeros(len(again), np.uint8)

    def split(self, texts: pa.Array) -> pa.Array:
        raise NotImplementedError

    def parts(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values of all parts one after another, and how many each has."""
        raise NotImplementedError

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All values one after another, and the number of values of each text; null is empty."""
        if len(self.known) > self.kept:
            self.thin()
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        odd = pc.match_substring_regex(texts, self.odd)
        lists = self.split(pc.if_else(odd, "", texts))
        if pc.any(odd).as_py():
            own = [self.parts(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            lists = pc.if_else(odd, pa.array(own, lists.type), lists)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        learned = len(self.known)
        words = encoded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > learned:
            flat, lengths = self.learn(list(islice(self.known, learned, None)))
            self.flat = np.concatenate([self.flat, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            self.uses = np.concatenate([self.uses, np.zeros(len(lengths), np.uint8)])
        self.uses[numbers] = np.minimum(self.uses[numbers], 1) + 1
        flat, lengths = ragged(self.flat, self.starts, numbers[encoded.indices.to_numpy(zero_copy_only=False)])
        return flat, np.diff(starts_of(lengths)[starts_of(counts)])
