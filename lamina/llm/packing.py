"""Packing documents into fixed-length sequences, balanced by estimated attention cost.

A sequence costs ``linear * tokens`` plus ``quadratic * tokens**2`` of each piece in it,
as attention stays within a document. Each slice of documents (a few megabytes of text)
is packed on its own, so nothing is shuffled: its documents, longest first, go to the
cheapest sequence that still has room, and are cut where the room ends. A slice opens
exactly as many full sequences as its tokens fill; the tokens left over fill sequences
whose lengths are falling powers of two, so no sequence is padded.

Null texts are empty and hold the end id alone. Rows with a null or repeated doc_id
are packed like any other row.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.byte_ids import encoder
from lamina.llm.common import record, slices, starts_of

SEQUENCE = 2048
#: Cost of a token, and of a pair of tokens in one piece: a layer of width 4096 spends about
#: as much on attention scores at 24,576 tokens as on everything else.
LINEAR, QUADRATIC = 1.0, 1 / 24_576

Piece = tuple[int, int, int, int, int]


def sequence_lengths(tokens: int, longest: int = SEQUENCE) -> list[int]:
    """Full sequences, then falling powers of two for the rest."""
    full, rest = divmod(tokens, longest)
    return [longest] * full + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def assign(
    lengths: list[int], longest: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[Piece]:
    """(document, start in it, length, sequence, offset in it) of each piece.

    Equal lengths keep their order; equal costs go to the sequence with the smaller number.
    """
    room = sequence_lengths(sum(lengths), longest)
    used = [0] * len(room)
    open_now = [(0.0, s) for s, size in enumerate(room) if size == longest]
    later = [s for s, size in enumerate(room) if size < longest]
    pieces = []
    for document in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        start = 0
        while start < lengths[document]:
            if not open_now:  # the full sequences are full: on to the next shorter one
                open_now.append((0.0, later.pop(0)))
            cost, s = open_now[0]
            n = min(lengths[document] - start, room[s] - used[s])
            pieces.append((document, start, n, s, used[s]))
            used[s] += n
            start += n
            if used[s] == room[s]:
                heapq.heappop(open_now)
            else:
                heapq.heapreplace(open_now, (cost + linear * n + quadratic * n * n, s))
    return pieces


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long"
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    longest: int = SEQUENCE,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece; ``with_ids`` adds its ids as an array.

    A sequence id is the number of the task (upper bits) and of the sequence in it, so it
    depends on how the input is split into tasks, but never on a repeated attempt.
    """
    schema = _SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _SCHEMA

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 33
        coder = encoder(vocabulary)
        for part in slices(batches):
            flat, counts = coder.encode(part.column("text"))
            # The end id stands after each document's own ids.
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts += 1
            begins = starts_of(counts)
            document, start, length, number, offset = np.array(assign(counts.tolist(), longest, linear, quadratic)).T
            at = begins[document] + start
            raw = flat.tobytes()
            found = {
                "doc_id": part.column("doc_id").take(pa.array(document)),
                "start": start,
                "length": length,
                "doc_tokens": counts[document],
                "sequence_id": sequence + number,
                "offset": offset,
                "ids_crc32": [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())],
            }
            if with_ids:
                found["ids"] = [flat[a : a + n].astype(np.int32) for a, n in zip(at, length)]
            yield record(found, schema)
            sequence += int(number.max()) + 1

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(packed, _PIECES + (", ids array<int>" if with_ids else ""))
