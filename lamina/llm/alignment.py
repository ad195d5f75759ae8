"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked id pairs.

Both tokenizers cover a space and the text byte for byte. Where tokens of both end at one
byte, a group ends; two tokens are linked where their byte ranges overlap. The count of an
id pair is the number of documents that hold it linked.

* First pass: documents are aligned, and each task writes the id pairs it met with the number
  of its documents that hold them.
* Hash: a minimal perfect hash is built over all distinct pairs, bucket by bucket in tasks of
  their own: in each level a bit marks a place that exactly one of the keys left falls on, and
  the number of bits before it is the key's index. The keys are kept by index, so every lookup
  is verified.
* Counts: the written pairs are counted in one dense vector per task, by index; the vectors
  are cut into blocks and added up as a tree, first within groups of tasks, then over the groups.
* Second pass: documents are aligned again and look their links' counts up.

A space between two characters that are not white space always ends a token in both
tokenizers, so texts are cut there, and each distinct piece is aligned once a task while a
memory bounded in bytes holds it; it saves time and changes no result.

The tables that tasks share have an entry for each distinct pair of ids that a text can
link. That is bounded by the two vocabularies, whatever the corpus (17 bytes a pair).

Null and empty texts, and texts whose tokens' bytes are not a space and the text, have no
tokens: zeros and an empty ``groups``. Special tokens' own strings are plain text. Each row
counts as a document, also with a null or repeated doc_id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lamina.llm.byte_ids import BYTE_BPE, vocabulary_path
from lamina.llm.common import ragged, record, slices, starts_of, sums
from lamina.session import materialize

PIECE_BPE = "piece_bpe_32k.model"
#: Bytes of pieces that a task remembers, and what a piece takes besides its own bytes.
KEPT_BYTES, PIECE_BYTES = 96_000_000, 300
#: Bytes of text that one task works on at once.
TEXT_BYTES = 6_000_000
#: Pieces that the tokenizers get as one text.
TOGETHER = 64
#: Keys of a bucket of the hash on average, places for each key that is left, and most levels.
BUCKET, PLACES, LEVELS = 4096, 2, 64
#: Counts in a block of a dense vector, and groups of tasks that are summed first.
COUNTS, GROUPS = 1 << 16, 8
#: Pairs that a task holds before it writes them.
HELD = 1 << 21

# White space as either tokenizer or Python sees it, next to more of it or at an end of the text.
_ODD = r"[\s\pZ\x{85}\x1c-\x1f]{2}|\A[\s\pZ\x{85}\x1c-\x1f]|[\s\pZ\x{85}\x1c-\x1f]\z"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for
    themselves, the others follow from 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """A tokenizer's ids, and the bytes of each."""

    def __init__(self, pieces: list[bytes]):
        self.decimal = [str(i) for i in range(len(pieces))]
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = starts_of(self.lengths)
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def __len__(self) -> int:
        return len(self.lengths)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of a space and each of the texts."""
        raise NotImplementedError

    def spelt(self, ids: np.ndarray) -> bytes:
        return ragged(self.flat, self.starts, ids)[0].tobytes()


class ByteTokens(Tokens):
    """The vocabulary file's ids are its merges in their order, so they serve as ranks. Special
    tokens are no part of the encoding: their strings are plain text."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        values = _byte_values()
        special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        pieces = [special[i] if i in special else bytes(values[c] for c in n) for i, n in enumerate(names)]
        super().__init__(pieces)
        ranks = {p: i for i, p in enumerate(pieces) if i not in special}
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokens(Tokens):
    """The model itself puts the space in front."""

    def __init__(self, path: str):
        self.processor = SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        byte = [self.processor.is_byte(i) for i in range(len(names))]
        pieces = [bytes([int(n[3:5], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, byte)]
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


class Aligner:
    """Numbers pieces of texts; knows tokens, groups and links (``a * len(b) + b``) of each."""

    def __init__(self, a: Tokens, b: Tokens, with_groups: bool = False):
        self.a, self.b, self.with_groups = a, b, with_groups
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes = 0
        self.groups: list[str] = []
        self.counts = np.empty((0, 4), np.int32)  # tokens of a, tokens of b, groups, links
        self.wrong = np.empty(0, bool)
        self.links = np.empty(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of all texts one after another, how many each text has, and the number of the first new one."""
        if self.bytes > KEPT_BYTES:
            self.forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        if pc.any(odd).as_py():
            own = [_CUT.split(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            lists = pc.if_else(odd, pa.array(own, lists.type), lists)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        first, new = len(self.known), []
        numbers = np.empty(len(encoded.dictionary), np.int64)
        for i, piece in enumerate(encoded.dictionary.to_pylist()):
            number = self.known.get(piece)
            if number is None:
                number = self.known[piece] = len(self.known)
                new.append(piece)
            numbers[i] = number
        if new:
            self.learn(new)
        return numbers[encoded.indices.to_numpy()], counts, first

    def learn(self, new: list[str]) -> None:
        plain = [i for i, p in enumerate(new) if p and not p[0].isspace() and not p[-1].isspace()]
        units = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        units += [[i] for i in sorted(set(range(len(new))).difference(plain))]
        wrong, order, ids_a, ids_b = np.zeros(len(new), bool), [], [], []
        while units:
            again = []
            for k in range(0, len(units), TOGETHER):
                some = units[k : k + TOGETHER]
                texts = [" ".join([new[i] for i in unit]) for unit in some]
                x, y = self.a.encode(texts), self.b.encode(texts)
                if not self.spell(texts, x, y):
                    good = [self.spell(*own) for own in zip(zip(texts), zip(x), zip(y))]
                    again += [[i] for unit, ok in zip(some, good) if not ok and len(unit) > 1 for i in unit]
                    wrong[[unit[0] for unit, ok in zip(some, good) if not ok and len(unit) == 1]] = True
                    some, x, y = ([v for v, ok in zip(values, good) if ok] for values in (some, x, y))
                order += chain.from_iterable(some)
                ids_a += chain.from_iterable(x)
                ids_b += chain.from_iterable(y)
            units = again
        x, y = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        sizes = np.array([len(p.encode()) + 1 for p in new], np.int64)
        order = np.array(order, np.int64)
        ends, ends_x, ends_y = np.cumsum(sizes[order]), np.cumsum(self.a.lengths[x]), np.cumsum(self.b.lengths[y])
        # Each stretch between two ends of any token lies in one token of a and one of b: a link.
        either = np.sort(np.concatenate([ends_x, ends_y]), kind="stable")
        twice = np.zeros(len(either), bool)
        twice[1:] = either[1:] == either[:-1]
        both, either = either[twice], either[~twice]
        if not (np.diff(np.searchsorted(both, np.stack([ends - 1, ends]), side="right"), axis=0) == 1).all():
            raise ValueError("a token goes beyond a space that should begin a new one")
        links = x[np.searchsorted(ends_x, either)] * len(self.b) + y[np.searchsorted(ends_y, either)]
        counts = np.zeros((len(new), 4), np.int32)
        for column, found in enumerate((ends_x, ends_y, both, either)):
            counts[order, column] = np.diff(np.searchsorted(found, ends, side="right"), prepend=0)
        back = np.zeros(len(new), np.int64)
        back[order] = np.arange(len(order))
        good = np.flatnonzero(~wrong)
        links, _ = ragged(links, starts_of(counts[order, 3]), back[good])
        if self.with_groups:
            self.groups += self._groups(x, y, ends_x, ends_y, both, counts[order, 2], np.where(wrong, -1, back))
        self.counts = np.concatenate([self.counts, counts])
        self.wrong = np.concatenate([self.wrong, wrong])
        self.links = np.concatenate([self.links, links])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts[:, 3])])
        self.bytes += int(sizes.sum()) + PIECE_BYTES * len(new)

    def spell(self, texts, x, y) -> bool:
        """Whether the tokens of both have the bytes of a space and each text."""
        spelt = "".join([" " + t for t in texts]).encode()
        flat = [np.fromiter(chain.from_iterable(ids), np.int64) for ids in (x, y)]
        return self.a.spelt(flat[0]) == spelt == self.b.spelt(flat[1])

    def _groups(self, x, y, ends_x, ends_y, both, counts, places) -> list[str]:
        """``ids of a|ids of b`` of the groups of each piece, joined by ``;``. ``counts`` groups
        belong to the pieces in the order of the tokens, where each piece has its place, or -1."""
        ids_x, ids_y = ([t.decimal[i] for i in ids.tolist()] for t, ids in ((self.a, x), (self.b, y)))
        to_x, to_y = (np.searchsorted(ends, both, side="right").tolist() for ends in (ends_x, ends_y))
        joined, p, q = [], 0, 0
        for p_end, q_end in zip(to_x, to_y):
            joined.append(f"{','.join(ids_x[p:p_end])}|{','.join(ids_y[q:q_end])}")
            p, q = p_end, q_end
        starts = starts_of(counts).tolist()
        return ["" if k < 0 else ";".join(joined[starts[k] : starts[k + 1]]) for k in places.tolist()]


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bucket_levels(keys: np.ndarray) -> list[np.ndarray]:
    """The bits of each level of one bucket of distinct keys."""
    levels = []
    while len(keys):
        if len(levels) == LEVELS:
            raise ValueError("keys of a bucket are not distinct")
        places = -(-PLACES * len(keys) // 8) * 8
        at = (_mixed(keys, len(levels) + 1) % np.uint64(places)).astype(np.int64)
        alone = np.bincount(at, minlength=places) == 1
        levels.append(np.packbits(alone))
        keys = keys[~alone[at]]
    return levels


@dataclass
class PairIndex:
    """A minimal perfect hash of the distinct keys, and the key at each index."""

    n_buckets: int
    bits: np.ndarray  # all levels, each with the bits of all buckets
    before: np.ndarray  # set bits before each byte
    begins: np.ndarray  # by level and bucket, in bytes
    keys: np.ndarray | None = None

    @staticmethod
    def of(levels: list[list[np.ndarray]]) -> PairIndex:
        """From the levels of each bucket."""
        depth = max(map(len, levels), default=0)
        empty = np.empty(0, np.uint8)
        ordered = [own[d] if d < len(own) else empty for d in range(depth) for own in levels]
        bits = np.concatenate([*ordered, empty])
        begins = starts_of(np.array([len(b) for b in ordered], np.int64))
        before = starts_of(np.bitwise_count(bits).astype(np.int64))
        return PairIndex(len(levels), bits, before, begins)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any number, or -1, for one that the hash was not built with."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.bits):
            return found
        bucket = bucket_of(keys, self.n_buckets)
        left = np.arange(len(keys))
        for level in range((len(self.begins) - 1) // self.n_buckets):
            if not len(left):
                break
            begin = self.begins[level * self.n_buckets + bucket[left]]
            size = self.begins[level * self.n_buckets + bucket[left] + 1] - begin
            left, begin, size = left[size > 0], begin[size > 0], size[size > 0]
            at = (_mixed(keys[left], level + 1) % (8 * size).astype(np.uint64)).astype(np.int64)
            byte, bit = begin + (at >> 3), at & 7
            own = self.bits[byte]
            hit = own >> (7 - bit).astype(np.uint8) & 1 > 0
            earlier = np.bitwise_count((own >> (8 - bit).astype(np.uint8)).astype(np.uint8))
            found[left[hit]] = (self.before[byte] + earlier)[hit]
            left = left[~hit]
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; -1 for a key that is not the one kept there."""
        found = self.places(keys)
        known = found >= 0
        known[known] = self.keys[found[known]] == keys[known]
        return np.where(known, found, -1)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (_mixed(keys, 0) % np.uint64(n_buckets)).astype(np.int64)


def _tokens(path_a: str, path_b: str) -> tuple[Tokens, Tokens]:
    return ByteTokens(path_a), PieceTokens(path_b)


def linked_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(key, n): id pairs and how many of a task's documents hold them linked. A task that meets
    more than ``HELD`` different pairs gives some of them in several rows."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*_tokens(path_a, path_b))
        keys, totals = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in slices(batches, limit=TEXT_BYTES):
            document, links = _documents_links(aligner, part.column("text"))
            found, at = np.unique(links, return_inverse=True)
            once = np.sort(document * (len(found) + 1) + at)
            once = once[np.r_[True, once[1:] != once[:-1]]] if len(once) else once
            counts = np.bincount(once % (len(found) + 1), minlength=len(found))
            keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            totals = np.bincount(at, np.concatenate([totals, counts]), len(keys)).astype(np.int64)
            if len(keys) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(totals)], ["key", "n"])
                keys, totals = keys[:0], totals[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(totals)], ["key", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(align, "key long, n long")


def build_index(pairs: DataFrame) -> PairIndex:
    """The hash of all distinct ``pairs`` (key).

    A bucket is built in one task; a row for each comes to the driver, 4 bytes and about
    half a byte a key.
    """
    n_buckets = max(1, -(-pairs.count() // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = bucket_of(batch.column("key").to_numpy(), n_buckets)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(own)], ["key", "bucket"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = pa.table({"key": pa.array([], pa.int64()), "bucket": pa.array([], pa.int64())})
        for batch in chain(batches, [None]):
            if batch is not None:
                rest = pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key, bucket = (rest.column(c).to_numpy() for c in ("key", "bucket"))
            cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            cuts = np.unique(np.r_[0, cuts, len(key)]) if batch is None else np.r_[0, cuts]
            for a, b in zip(cuts, cuts[1:]):
                levels = [level.tobytes() for level in bucket_levels(key[a:b])]
                yield pa.RecordBatch.from_pydict(
                    {"bucket": [int(bucket[a])], "levels": [levels], "keys": [key[a:b].tobytes()]}
                )
            rest = rest.slice(int(cuts[-1]))

    dealt = pairs.mapInArrow(deal, "key long, bucket long").repartition("bucket").sortWithinPartitions("bucket", "key")
    built = dealt.mapInArrow(build, "bucket long, levels array<binary>, keys binary").filter("length(keys) > 0")
    levels: list[list[np.ndarray]] = [[] for _ in range(n_buckets)]
    keys = []
    for row in built.collect():  # bounded by the two vocabularies
        levels[row.bucket] = [np.frombuffer(level, np.uint8) for level in row.levels]
        keys.append(np.frombuffer(row["keys"], np.int64))
    index = PairIndex.of(levels)
    keys = np.concatenate([*keys, np.empty(0, np.int64)])
    index.keys = np.empty_like(keys)
    index.keys[index.places(keys)] = keys
    return index


def _documents_links(aligner: Aligner, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct links of each document with tokens, one document after another."""
    numbers, counts, _ = aligner.pieces(texts)
    wrong = sums(aligner.wrong[numbers].astype(np.int64), counts) > 0
    wrong |= pc.fill_null(pc.equal(texts, ""), True).to_numpy(zero_copy_only=False)
    document = np.repeat(np.arange(len(counts)), counts)
    numbers, document = numbers[~wrong[document]], document[~wrong[document]]
    once = np.unique(document * (len(aligner.wrong) + 1) + numbers)
    document, numbers = once // (len(aligner.wrong) + 1), once % (len(aligner.wrong) + 1)
    links, lengths = ragged(aligner.links, aligner.starts, numbers)
    return np.repeat(document, lengths), links


def _smallest(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest takes, and how many in front."""
    width = next(w for w in (1, 2, 4, 8) if counts.max() < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks, those of one block and group added up."""
    own, total = None, None
    for batch in batches:
        for block, group, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "grp", "counts"))):
            if (block, group) != own:
                if own is not None:
                    yield record(dict(zip(_BLOCK.names, ([own[0]], [own[1]], [_smallest(total)]))), _BLOCK)
                own, total = (block, group), 0
            total = total + np.frombuffer(counts, f"<u{counts[0]}", offset=1).astype(np.int64)
    if own is not None:
        yield record(dict(zip(_BLOCK.names, ([own[0]], [own[1]], [_smallest(total)]))), _BLOCK)


_BLOCK = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("counts", pa.binary())])


def pair_counts(pairs: DataFrame, index: PairIndex) -> np.ndarray:
    """The sum of ``n`` of each key of ``pairs`` (key, n), by index."""
    shared = pairs.sparkSession.sparkContext.broadcast(index)
    n = len(index.keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-n // COUNTS) * COUNTS, np.int64)
        for batch in batches:
            found = shared.value.find(batch.column("key").to_numpy())
            if (found < 0).any():
                raise ValueError("a pair that the hash was not built with")
            np.add.at(total, found, batch.column("n").to_numpy())
        context = TaskContext.get()
        group = (context.partitionId() if context else 0) % GROUPS
        for block, counts in enumerate(total.reshape(-1, COUNTS)):
            if counts.any():
                yield record({"block": [block], "grp": [group], "counts": [_smallest(counts)]}, _BLOCK)

    schema = "block long, grp long, counts binary"
    blocks = pairs.mapInArrow(count, schema)
    by_group = blocks.repartition("block", "grp").sortWithinPartitions("block", "grp").mapInArrow(_added, schema)
    by_block = by_group.withColumn("grp", F.lit(0).cast("long")).repartition("block").sortWithinPartitions("block")
    total = np.zeros(-(-n // COUNTS) * COUNTS, np.int64)
    for row in by_block.mapInArrow(_added, schema).collect():  # one count per pair
        total[row.block * COUNTS : (row.block + 1) * COUNTS] = np.frombuffer(row.counts, f"<u{row.counts[0]}", offset=1)
    return total[:n]


_FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links of the count that is the
    highest of their id of a), count_sum (over links) and groups, or their sha256 with ``digest``."""
    path_a, path_b = path_a or vocabulary_path(BYTE_BPE), path_b or vocabulary_path(PIECE_BPE)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pairs = materialize(linked_pairs(docs, path_a, path_b), "linked-pairs")
    index = build_index(materialize(pairs.select("key").distinct(), "distinct-pairs"))
    counts = pair_counts(pairs, index)
    size_b = len(PieceTokens(path_b))
    highest = np.zeros(int(index.keys.max() // size_b) + 1 if len(index.keys) else 0, np.int64)
    np.maximum.at(highest, index.keys // size_b, counts)
    shared = docs.sparkSession.sparkContext.broadcast((index, counts, counts == highest[index.keys // size_b]))
    names = [c.split()[0] for c in _FOUND.split(", ")]
    schema = pa.schema([(c, pa.string() if c == "groups" else pa.int64()) for c in names])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, counts, best = shared.value
        aligner = Aligner(*_tokens(path_a, path_b), with_groups=True)
        of_piece = np.empty((0, 2), np.int64)  # links of the highest count, and the sum of counts
        for part in slices(batches, limit=TEXT_BYTES):
            numbers, lengths, first = aligner.pieces(part.column("text"))
            if first < len(of_piece):
                of_piece = of_piece[:first]
            distinct, at = np.unique(aligner.links[aligner.starts[first] :], return_inverse=True)
            found = index.find(distinct)
            # A pair that no document with tokens holds linked is not in the hash.
            met, own = found >= 0, aligner.counts[first:, 3]
            new = []
            for values in (best, counts):
                of_pair = np.zeros(len(found), np.int64)
                of_pair[met] = values[found[met]]
                new.append(sums(of_pair[at], own))
            of_piece = np.concatenate([of_piece, np.stack(new, axis=1)])
            none = sums(aligner.wrong[numbers].astype(np.int64), lengths) > 0
            none |= pc.fill_null(pc.equal(part.column("text"), ""), True).to_numpy(zero_copy_only=False)
            values = [aligner.counts[:, i] for i in range(4)] + [of_piece[:, i] for i in range(2)]
            values = [np.where(none, 0, sums(v[numbers], lengths)) for v in values]
            pieces, starts = [aligner.groups[i] for i in numbers.tolist()], starts_of(lengths).tolist()
            joined = ["" if no else ";".join(pieces[i:j]) for no, i, j in zip(none, starts, starts[1:])]
            if digest:
                joined = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in joined]
            yield record(dict(zip(names, [part.column("doc_id"), *values, joined])), schema)

    return docs.mapInArrow(look_up, _FOUND)
