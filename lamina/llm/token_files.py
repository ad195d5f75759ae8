"""Token ids as files: frequency-ranked ids, one to four bytes each, control bytes apart.

The commonest id gets rank 0. A rank takes as many bytes as it needs; two bits a
rank, four ranks a control byte, say how many, and the control bytes stand apart from
the data bytes. A reader turns control bytes into lengths with one table lookup and
gathers the data bytes with numpy. One row of the Parquet files is a block of whole
documents in ascending doc_id order; blocks and files follow each other in that order.

Null texts are empty and hold the end id only. Rows with a null doc_id come first;
rows that share a doc_id stand next to each other in an order that their ids fix.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.byte_ids import encoder
from lamina.llm.common import record, slices, starts_of
from lamina.session import discard, fresh_path

#: A block closes once it has this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: Bytes of text that a task encodes at once: the more, the fewer times a frequent piece is looked up.
ENCODE_BYTES = 12_000_000

_CONTROL = np.arange(256)
#: Fixed by the format: the four lengths, 1 to 4, that each control byte stands for.
LENGTHS = np.stack([(_CONTROL >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8)


def _width(lengths: np.ndarray) -> np.dtype:
    """Numbers that hold ranks of these lengths: bytes that no rank has need not be masked."""
    return np.dtype("<u2" if lengths.max(initial=1) <= 2 else "<u4")


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype(np.uint32)
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = ranks.astype(_width(lengths)).view(np.uint8).reshape(-1, _width(lengths).itemsize)
    return control.tobytes(), raw[np.arange(raw.shape[1]) < lengths[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks that ``pack_ranks`` packed."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    raw = np.zeros((count, _width(lengths).itemsize), np.uint8)
    raw[np.arange(raw.shape[1]) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return raw.view(_width(lengths)).ravel().astype("<u4", copy=False)


_IDS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())]
)


def document_ids(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens and the ids (little-endian, 16 bits where the vocabulary fits) of each text and its end.

    One more row of each task has ``counts`` in place of ids: how often it met each id.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        size = coder.tokenizer.get_vocab_size()
        kind, total = id_type(size), np.zeros(size, np.int64)
        for part in slices(batches, limit=ENCODE_BYTES):
            flat, counts = coder.encode(part.column("text"))
            ends = starts_of(counts)
            flat = flat.astype(kind)
            end = np.array([end_id], kind).tobytes()
            ids = [flat[a:b].tobytes() + end for a, b in zip(ends, ends[1:])]
            total += np.bincount(flat, minlength=size)
            total[end_id] += len(counts)
            none = [None] * len(counts)
            yield record({"doc_id": part.column("doc_id"), "n_tokens": counts + 1, "ids": ids, "counts": none}, _IDS)
        yield record({"doc_id": [None], "n_tokens": [None], "ids": [None], "counts": [total.tobytes()]}, _IDS)

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(encode, "doc_id long, n_tokens long, ids binary, counts binary")


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def id_ranks(counts: DataFrame, size: int) -> np.ndarray:
    """The rank of each id by falling sum of ``counts``, a row per task; ties go to the smaller id.

    The result has one entry per id of the vocabulary, so its size is fixed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for own in batch.column("counts").to_pylist():
                total += np.frombuffer(own, np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": seen, "n": total[seen]})

    found = counts.select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    totals = np.zeros(size, np.int64)
    for row in found.collect():  # at most one row per id of the vocabulary
        totals[row.id] = row.n
    ranks = np.empty(size, np.int64)
    ranks[np.argsort(-totals, kind="stable")] = np.arange(size)
    return ranks


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Encode all documents and write them to ``path/blocks``, with the id of each rank in ``path/ranks``."""
    spark = docs.sparkSession
    size = encoder(vocabulary).tokenizer.get_vocab_size()
    # The digest is stored, so neither the counts nor the bounds of the ranges read the ids again.
    found = document_ids(docs, vocabulary, end_id).withColumn("digest", F.xxhash64("ids"))
    path_of_ids = fresh_path(spark, "ids")
    found.drop("n_tokens").write.option("compression", "zstd").parquet(path_of_ids)
    found = spark.read.schema(found.drop("n_tokens").schema).parquet(path_of_ids)
    ids = found.filter("counts is null")
    ranks = id_ranks(found.filter("counts is not null"), size).astype(np.uint32)
    ranked = spark.createDataFrame([(int(r), i) for i, r in enumerate(ranks)], "rank long, id long")
    ranked.coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(ranks)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, kind = shared.value, id_type(size)
        kept: list[tuple[int | None, np.ndarray]] = []
        held = before = 0

        def closed() -> pa.RecordBatch:
            control, data = pack_ranks(np.concatenate([r for _, r in kept]))
            row = {"before": [before], "doc_ids": [[d for d, _ in kept]], "counts": [[len(r) for _, r in kept]]}
            return record(row | {"n_ids": [held], "control": [control], "data": [data]}, _BLOCK)

        for batch in batches:
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                kept.append((doc_id, ranks[np.frombuffer(own, kind)]))
                held += len(kept[-1][1])
                if held >= BLOCK_IDS:
                    yield closed()
                    kept, held, before = [], 0, before + held
        if kept:
            yield closed()

    # The digest spreads rows that share an id over several parts, still in one fixed order.
    order = ["doc_id", "digest"]
    ordered = ids.select(*order, "ids").repartitionByRange(*order).sortWithinPartitions(*order, "ids")
    written = ordered.select("doc_id", "ids").mapInArrow(
        blocks, "before long, doc_ids array<long>, counts array<long>, n_ids long, control binary, data binary"
    )
    # A range partition is one task; its number is its place in the order.
    numbered = written.withColumn("part", F.spark_partition_id())
    numbered.write.option("compression", "none").parquet(f"{path}/blocks")
    discard(spark, path_of_ids)


_BLOCK = pa.schema(
    [("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    + [("n_ids", pa.int64()), ("control", pa.binary()), ("data", pa.binary())]
)
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, each with the number of ids in all blocks before it (``start``).

    A block knows the ids before it in its part; the parts, one row each, are summed up here.
    There are at most as many parts as shuffle partitions, so that table may be broadcast.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    part_starts = part_sums.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    return blocks.join(F.broadcast(part_starts), "part").withColumn("start", F.col("part_start") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array) of each document in the files."""
    return _documents(spark, path, "doc_id long, start long, ids array<int>", _with_ids)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files."""
    return _documents(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", _with_digest)


def _with_ids(doc_ids, starts, ids) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(starts - starts[0], pa.int32()), pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1]), lists], names=["doc_id", "start", "ids"]
    )


def _with_digest(doc_ids, starts, ids) -> pa.RecordBatch:
    raw, base = ids.astype("<u4", copy=False), starts[0]
    crcs = [zlib.crc32(raw[a - base : b - base]) for a, b in zip(starts, starts[1:])]
    found = {"doc_id": doc_ids, "start": starts[:-1], "n_tokens": np.diff(starts), "ids_crc32": crcs}
    return record(found, _DIGEST)


def _documents(spark: SparkSession, path: str, schema: str, made) -> DataFrame:
    ranked = spark.read.parquet(f"{path}/ranks").collect()  # one row per id of the vocabulary
    table = np.empty(len(ranked), np.uint32)
    for row in ranked:
        table[row.rank] = row.id
    shared = spark.sparkContext.broadcast(table)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = shared.value[unpack_ranks(row["control"], row["data"], row["n_ids"])]
                yield made(row["doc_ids"], row["start"] + starts_of(np.array(row["counts"])), ids)

    return read_blocks(spark, path).mapInArrow(decode, schema)


def fresh_token_path(spark: SparkSession) -> str:
    return fresh_path(spark, "tokens")
