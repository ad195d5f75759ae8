"""Exact set-similarity self-join of documents on word shingles, up to connected classes.

Two documents link when their shingle sets have Jaccard similarity >= ``over / under``.
Equal sets are one set from the start. The others meet in index lists: each set enters
the lists of its rarest shingles (as many as any partner must share one of), in one
global order. The order comes from counts of all shingles in hashed counters, so a
passage that many documents share comes last and is no entry at all for most of them.

Two set relations skip work:

* Blocks by position. A list is sorted by set size and worked off in blocks; a block is
  skipped, without looking at its entries, where the sizes at its ends, or the least
  position of the shingle in its sets, rule out every pair with another block.
* Answers from a similar set. The first round links each set of a list only with the
  head of the list and its neighbour. Sets that are then in one class have the same
  answers: their pairs are never looked at again. Only pairs from different classes that
  the bounds (size, position, and differing bits of two fixed-size signatures) do not
  rule out go on: the nearest pair of each set in two rounds, then all that are left.

Every pair that goes on is verified on the full sets, so the result is exact up to
collisions of 64-bit shingle hashes.

The links themselves lie within classes. ``link_counts`` cuts each class into blocks by set
size and compares all sets of two blocks at once, as a product of incidence matrices; block
pairs that sizes rule out are no rows. Each pair of blocks is a row group of its own, so a
large class is spread over tasks. Its work grows with the square of the sets of a class.

Null and word-less texts have the empty set, link with nothing and are a class of their
own. A text with fewer words than a shingle is one shingle. Rows with a null doc_id get
the class of an equal set that has one, else a null class. Rows that share a doc_id link
like any others; the class of each row follows from its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import apart, coded, record, slices, starts_of, texts_of, words_of
from lamina.session import materialize

SHINGLE = 3
_WORD = r"[^\x20\x09-\x0D]"
#: Linked at 90 / 100 and above.
OVER, UNDER = 90, 100
#: Hashed counters of shingles (fixed size), and 64-bit words of a signature.
COUNTERS, SIGNATURE = 1 << 18, 16
#: Entries of a list, or sets of a class, that are compared, or skipped, at once.
BLOCK = 256
#: Shingles of a pair of blocks in one matrix product.
COLUMNS = 8192

# Odd multipliers of the words of a shingle, and of the finishing mix.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _shingles(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, counts = words_of(texts)
    codes, vocabulary = coded(flat)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))[codes]
    multipliers = np.array([pow(int(_MIX[0]), 2 * i + 1, 1 << 64) for i in range(width)], np.uint64)
    mixed = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        mixed += hashes[i : i + len(mixed)] * multipliers[i]
    mixed = _finish(mixed)
    starts, out = starts_of(counts).tolist(), []
    for a, b in zip(starts, starts[1:]):
        if b - a >= width:
            out.append(np.unique(mixed[a : b - width + 1]))
        elif b > a:  # fewer words than a shingle has: the whole sequence is one, marked by its length
            marked = np.append(hashes[a:b] * multipliers[: b - a], np.array([b - a], np.uint64) * _MIX[1:2])
            out.append(_finish(marked.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _finish(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX[3]
    return (values ^ (values >> np.uint64(29))) * _MIX[2] ^ (values >> np.uint64(32))


def _key(own: bytes) -> bytes:
    return hashlib.blake2b(own, digest_size=16).digest()


def _signature(own: np.ndarray) -> bytes:
    """Parity of the number of shingles at each of a fixed number of bits."""
    bits = np.bincount((own >> np.uint64(20)) % np.uint64(64 * SIGNATURE), minlength=64 * SIGNATURE) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) % COUNTERS


def shingle_counts(docs: DataFrame, width: int = SHINGLE) -> np.ndarray:
    """How many documents hold a shingle of each hashed counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for part in slices(batches):
            sets = _shingles(texts_of(part), width)
            total += np.bincount(_counter_of(np.concatenate(sets)), minlength=COUNTERS)
        filled = np.flatnonzero(total)
        for k in range(0, len(filled), 1 << 16):
            own = filled[k : k + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"counter": own.astype(np.int32), "n": total[own]})

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "counter int, n long")
    summed = counted.groupBy("counter").agg(F.sum("n").alias("n")).mapInArrow(_packed, "counters binary, sums binary")
    totals = np.zeros(COUNTERS, np.int64)
    for row in summed.collect():  # a few rows a task, of at most COUNTERS counters in all
        totals[np.frombuffer(row.counters, np.int32)] = np.frombuffer(row.sums, np.int64)
    return totals


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters and sums of a batch as the bytes of two arrays: the driver gets no row, and no pandas, per counter."""
    for batch in batches:
        if batch.num_rows:
            counter, n = batch.column("counter").to_numpy(), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_pydict({"counters": [counter.tobytes()], "sums": [n.tobytes()]})


_LIGHT = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary())]
    + [("signature", pa.binary()), ("prefix", pa.list_(pa.int64()))]
)


def describe(docs: DataFrame, counts: np.ndarray, width: int, over: int, under: int) -> DataFrame:
    """Size, key, signature and rarest shingles of each document's set."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = _shingles(texts_of(part), width)
            prefixes = []
            for own in sets:
                entries = len(own) - -(-over * len(own) // under) + 1 if len(own) else 0
                rarest = np.lexsort((own, shared.value[_counter_of(own)]))[:entries]
                prefixes.append(own[rarest].view(np.int64))
            yield record(
                {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": [len(own) for own in sets],
                    "set_key": [_key(own.tobytes()) for own in sets],
                    "signature": [_signature(own) for own in sets],
                    "prefix": prefixes,
                },
                _LIGHT,
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary, prefix array<long>")


def _shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted entries, those whose shingle stands in more than one row."""
    last, last_shared = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([batch] if last is None else [last, batch])
        shingle = whole.column("shingle").to_numpy()
        equal = shingle[1:] == shingle[:-1]
        keep = np.zeros(len(shingle), bool)
        keep[1:] |= equal
        keep[:-1] |= equal
        keep[0] |= last_shared
        last, last_shared = whole.slice(len(shingle) - 1).combine_chunks().to_batches()[0], bool(keep[-1])
        yield from whole.slice(0, len(shingle) - 1).filter(pa.array(keep[:-1])).to_batches()
    if last is not None and last_shared:
        yield last


class _Bounds:
    """What rules out a pair without its sets."""

    def __init__(self, over: int, under: int):
        self.over, self.under = over, under

    def may_link(self, n, m, at_n, at_m, bits_n, bits_m) -> np.ndarray:
        """Sizes, positions of the common shingle, and signatures, each as arrays of one shape."""
        least = -(-self.over * (n + m) // (self.over + self.under))
        possible = self.may_fit(n, m, at_n, at_m)
        differ = np.bitwise_count(bits_n ^ bits_m).sum(axis=-1, dtype=np.int64)
        return possible & (differ <= n + m - 2 * least)

    def may_fit(self, n, m, at_n, at_m) -> np.ndarray:
        least = -(-self.over * (n + m) // (self.over + self.under))
        small, large = np.minimum(n, m), np.maximum(n, m)
        return (self.over * large <= self.under * small) & (1 + np.minimum(n - at_n - 1, m - at_m - 1) >= least)


def _columns(table: pa.Table, comp: bool = False) -> dict[str, np.ndarray]:
    table = table.combine_chunks()
    raw = b"".join(table.column("signature").to_pylist())
    out = {c: table.column(c).to_numpy() for c in ("shingle", "n", "set_id", "at")}
    out["bits"] = np.frombuffer(raw, np.uint64).reshape(-1, SIGNATURE)
    if comp:
        out["comp"] = table.column("comp").to_numpy()
    return out


_PAIRS = "a long, b long"
_FIRST = "x long, other long, early boolean"
#: Entries of a list whose pairs all go on in the first round: shorter lists are done with it.
EARLY = 3


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _first_pairs(bounds: _Bounds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each entry x of a list with the list's first entry and with the entry before it."""
    head, seen = None, 0  # first and last entry of the list that the last batch ended in, and its length so far
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        lead = 0 if head is None else head.num_rows
        if head is not None:
            table = pa.concat_tables([head, table])
        c = _columns(table)
        row = np.arange(len(c["n"]))
        new = np.r_[True, c["shingle"][1:] != c["shingle"][:-1]]
        first = np.maximum.accumulate(np.where(new, row, 0))
        place = np.where((first == 0) & (lead > 0), row - lead + seen, row - first)
        for other in (first, np.maximum(row - 1, first)):
            x = row[(row >= lead) & (other < row) & (c["set_id"] != c["set_id"][other])]
            for k in range(0, len(x), 1 << 15):
                i = x[k : k + (1 << 15)]
                j = other[i]
                ok = bounds.may_link(c["n"][i], c["n"][j], c["at"][i], c["at"][j], c["bits"][i], c["bits"][j])
                if ok.any():
                    i, j = i[ok], j[ok]
                    found = {"x": c["set_id"][i], "other": c["set_id"][j], "early": place[i] < EARLY}
                    yield pa.RecordBatch.from_pydict(found)
        seen = int(place[-1]) + 1
        head = table.take(pa.array(sorted({int(first[-1]), len(row) - 1})))


def _chosen(first: DataFrame) -> DataFrame:
    """All early pairs; of the others, for each set the partner met in most lists and the smallest one."""
    met = first.groupBy("x", "other").agg(F.count("*").alias("n"), F.max("early").alias("early"))
    met = materialize(met, "first-pairs")
    ends = met.groupBy("x").agg(
        F.max(F.struct("n", (-F.col("other")).alias("other"))).alias("most"), F.min("other").alias("low")
    )
    found = met.filter("early").select("x", "other")
    found = found.union(ends.select("x", -F.col("most.other"))).union(ends.select("x", "low"))
    return found.select(F.least("x", "other").alias("a"), F.greatest("x", "other").alias("b")).distinct()


def _cross_pairs(bounds: _Bounds, nearest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one list from different classes that no bound rules out.

    With ``nearest`` only the pair of fewest differing bits for each entry and block.
    """
    for entries in _lists(batches):
        c = _columns(entries, comp=True)
        size = len(c["n"])
        for a in range(0, size, BLOCK):
            x = slice(a, min(a + BLOCK, size))
            least_at = c["at"][x].min()
            for b in range(a, size, BLOCK):
                y = slice(b, min(b + BLOCK, size))
                # Sizes rise along the list: beyond this block there is no partner either.
                if bounds.over * c["n"][b] > bounds.under * c["n"][x.stop - 1]:
                    break
                if c["comp"][x].min() == c["comp"][y].max() and c["comp"][x].max() == c["comp"][y].min():
                    continue
                # The block's loosest position still leaves too little to share.
                most = 1 + min(c["n"][x.stop - 1] - least_at - 1, c["n"][y.stop - 1] - c["at"][y].min() - 1)
                if (bounds.over + bounds.under) * most < bounds.over * (c["n"][x.start] + c["n"][y.start]):
                    continue
                i, j = np.nonzero(
                    (c["comp"][x][:, None] != c["comp"][y][None, :])
                    & bounds.may_fit(
                        c["n"][x][:, None], c["n"][y][None, :], c["at"][x][:, None], c["at"][y][None, :]
                    )
                )
                i, j = i + a, j + b
                once = i < j
                i, j = i[once], j[once]
                if not len(i):
                    continue
                differ = np.bitwise_count(c["bits"][i] ^ c["bits"][j]).sum(axis=1, dtype=np.int64)
                total = c["n"][i] + c["n"][j]
                ok = differ <= total - 2 * -(-bounds.over * total // (bounds.over + bounds.under))
                i, j, differ = i[ok], j[ok], differ[ok]
                if nearest and len(i):
                    order = np.lexsort((differ, i))
                    i, j = i[order], j[order]
                    own = np.r_[True, i[1:] != i[:-1]]
                    i, j = i[own], j[own]
                if len(i):
                    yield _pair_batch(c["set_id"][i], c["set_id"][j])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The entries of one shingle at a time."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        shingle = table.column("shingle").to_numpy()
        cuts = [0, *(np.flatnonzero(shingle[1:] != shingle[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest


_INDEX = "shingle long, n long, set_id long, at long, signature binary"


def _verified(
    docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, bounds: _Bounds
) -> DataFrame:
    """The pairs that link, checked on the full sets, which are made anew for the documents concerned."""
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    made = materialize(_full_sets(docs, sets.join(wanted, "set_id", "left_semi"), width), "full-sets")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append((bounds.over + bounds.under) * both >= bounds.over * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = made.select(F.col("set_id").alias("a"), F.col("own").alias("own_a"))
    right = made.select(F.col("set_id").alias("b"), F.col("own").alias("own_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(linked, _PAIRS)


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_id, own): the shingles of each of the ``wanted`` sets, made anew from a document that holds it."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [own.tobytes() for own in _shingles(texts_of(part), width)]
            keep = [_key(own) == key for own, key in zip(found, part.column("set_key").to_pylist())]
            made = pa.RecordBatch.from_arrays([part.column("set_id"), pa.array(found, pa.binary())], ["set_id", "own"])
            yield made.filter(pa.array(keep, pa.bool_()))

    wanted = wanted.withColumnRenamed("label", "doc_id")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = texts.join(wanted, "doc_id").select("set_id", "set_key", "text").mapInArrow(full, "set_id long, own binary")
    return made.dropDuplicates(["set_id"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and the smallest node each is connected to by them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[root]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars: at most one for each node, and chains within the task gone."""
    a, b, held, kept = [], [], 0, 0
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
        held += batch.num_rows
        if held > 2 * kept + (1 << 20):
            node, root = _forest(np.concatenate(a), np.concatenate(b))
            a, b = [root[root != node]], [node[root != node]]
            held = kept = len(a[0])
    if held:
        node, root = _forest(np.concatenate(a), np.concatenate(b))
        a, b = root[root != node], node[root != node]
        for k in range(0, len(a), 1 << 16):
            yield _pair_batch(a[k : k + (1 << 16)], b[k : k + (1 << 16)])


def components(links: DataFrame) -> DataFrame:
    """(node, comp): each node of ``links`` (a, b) with the smallest node it is connected to.

    Each task first replaces its links by stars. Then come rounds of taking the smallest
    neighbour and jumping along it; every round is written out, and the number of rounds
    grows with the logarithm of the longest chain.
    """
    edges = links.mapInArrow(_local_forest, _PAIRS).select(F.col("a").alias("x"), F.col("b").alias("y"))
    edges = materialize(edges.union(edges.select("y", "x")).distinct(), "edges")
    nodes = edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("comp"))
    nodes = materialize(nodes, "components")
    while True:
        near = edges.join(nodes.select(F.col("node").alias("y"), F.col("comp").alias("near")), "y")
        least = near.groupBy(F.col("x").alias("node")).agg(F.min("near").alias("near"))
        hooked = nodes.join(least, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        # A class that borders on a smaller one takes it over as a whole.
        roots = hooked.groupBy("comp").agg(F.min("next").alias("root"))
        moved = hooked.join(roots, "comp").select("node", "comp", F.least("next", "root").alias("step"))
        jump = roots.select(F.col("comp").alias("step"), F.col("root").alias("jump"))
        moved = moved.join(jump, "step", "left").select(
            "node", F.col("comp").alias("before"), F.least("step", F.coalesce("jump", "step")).alias("comp")
        )
        moved = materialize(moved, "components")
        nodes = moved.select("node", "comp")
        if moved.filter("comp != before").isEmpty():
            return nodes


def merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` classes (node, comp) after further ``links``, which are solved between classes alone."""
    for end in ("a", "b"):
        of_end = known.select(F.col("node").alias(end), F.col("comp").alias("class"))
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce("class", end)).drop("class")
    moved = components(links.filter("a != b").select("a", "b"))
    renamed = moved.select(F.col("node").alias("comp"), F.col("comp").alias("after"))
    before = known.join(renamed, "comp", "left").select("node", F.coalesce("after", "comp").alias("comp"))
    return materialize(before.union(moved.join(known, "node", "left_anti").select("node", "comp")), "components")


def _block_links(bounds: _Bounds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set of a pair of blocks, the documents of the sets of the other block that it links with."""
    for part in _groups(batches, ["comp", "low", "high"]):
        n, copies, ids, second = (part.column(c).to_numpy() for c in ("n", "copies", "set_id", "second"))
        flat = np.frombuffer(b"".join(part.column("own").to_pylist()), np.uint64)
        _, codes, held = np.unique(flat, return_inverse=True, return_counts=True)
        shared = held > 1
        row, codes = np.repeat(np.arange(len(n)), n)[shared[codes]], (np.cumsum(shared) - 1)[codes[shared[codes]]]
        order = np.argsort(codes, kind="stable")
        row, codes = row[order], codes[order]
        x = np.flatnonzero(second == 0)
        y = np.flatnonzero(second == 1) if second.any() else x
        both = np.zeros((len(x), len(y)), np.float32)
        for start in range(0, int(shared.sum()), COLUMNS):
            a, b = np.searchsorted(codes, [start, start + COLUMNS])
            held = np.zeros((len(n), min(COLUMNS, int(codes[-1]) + 1 - start)), np.float32)
            held[row[a:b], codes[a:b] - start] = 1
            both += held[x] @ held[y].T
        linked = (bounds.over + bounds.under) * both.astype(np.int64) >= bounds.over * (n[x][:, None] + n[y][None, :])
        if second.any():
            ids, links = np.r_[ids[x], ids[y]], np.r_[linked @ copies[y], copies[x] @ linked]
        else:
            np.fill_diagonal(linked, False)
            links = linked @ copies
        yield pa.RecordBatch.from_pydict({"set_id": ids, "links": links.astype(np.int64)})


def _set_links(docs: DataFrame, sets: DataFrame, classes: DataFrame, width: int, bounds: _Bounds) -> DataFrame:
    """(set_id, links): how many documents hold another set that the set links with. Sets without any are left out."""
    members = sets.select("set_id", "n", "copies").join(classes.withColumnRenamed("node", "set_id"), "set_id")
    place = F.row_number().over(Window.partitionBy("comp").orderBy("n", "set_id")) - 1
    members = materialize(members.withColumn("block", F.floor(place / BLOCK).cast("int")), "members")
    blocks = members.groupBy("comp", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    low = blocks.select("comp", F.col("block").alias("low"), F.col("most").alias("low_most"))
    high = blocks.select("comp", F.col("block").alias("high"), F.col("least").alias("high_least"))
    meet = low.join(high, "comp").filter("low <= high")
    # Sizes rise from block to block.
    meet = meet.filter(F.col("high_least") * bounds.over <= F.col("low_most") * bounds.under).select("comp", "low", "high")
    made = materialize(_full_sets(docs, sets.join(classes, sets["set_id"] == classes["node"], "left_semi"), width), "full-sets")
    light = members.join(meet.withColumn("block", F.col("low")), ["comp", "block"]).withColumn("second", F.lit(0))
    other = members.join(meet.filter("low < high").withColumn("block", F.col("high")), ["comp", "block"])
    light = light.union(other.withColumn("second", F.lit(1)))
    rows = light.join(made, "set_id").select("comp", "low", "high", "second", "set_id", "n", "copies", "own")
    grouped = rows.repartition("comp", "low", "high").sortWithinPartitions("comp", "low", "high", "second", "set_id")
    found = grouped.mapInArrow(partial(_block_links, bounds), "set_id long, links long")
    return found.groupBy("set_id").agg(F.sum("links").alias("links"))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key at a time."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        new = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            own = table.column(key).to_numpy()
            new |= own[1:] != own[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest


def link_classes(
    docs: DataFrame, width: int = SHINGLE, over: int = OVER, under: int = UNDER
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of each document."""
    light, sets, classes = _solved(docs, width, over, under)
    return _of_documents(light, sets, classes).select("doc_id", "n_shingles", "component_id")


def link_counts(
    docs: DataFrame, width: int = SHINGLE, over: int = OVER, under: int = UNDER
) -> DataFrame:
    """``link_classes`` with n_links, the number of other documents that each links with.

    Every row with a doc_id is a document, so a text that stands in several rows counts as
    often. Rows without a doc_id are not counted; where the class is null, so is n_links.
    """
    light, sets, classes = _solved(docs, width, over, under)
    links = _set_links(docs, sets, classes, width, _Bounds(over, under))
    found = _of_documents(light, sets.join(links, "set_id", "left"), classes)
    own = F.col("doc_id").isNotNull().cast("long")
    n_links = F.when(
        F.col("n_shingles") > 0, F.col("copies") - own + F.when(F.col("copies") > 0, F.coalesce("links", F.lit(0)))
    ).when(F.col("doc_id").isNotNull(), 0)
    return found.select("doc_id", "n_shingles", "component_id", n_links.cast("long").alias("n_links"))


def _solved(docs: DataFrame, width: int, over: int, under: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A row per document, a row per distinct set, and the class (node, comp) of each set with links."""
    bounds = _Bounds(over, under)
    light = materialize(describe(docs, shingle_counts(docs, width), width, over, under), "sets")
    # Equal sets are one; its label is the smallest doc_id that has it. Numbers are fixed by writing them.
    sets = light.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("label"), F.first("n_shingles").alias("n"), F.count("doc_id").alias("copies")
    )
    sets = sets.filter("label is not null").withColumn("set_id", F.monotonically_increasing_id())
    sets = materialize(sets, "distinct-sets")
    own = light.select(F.col("doc_id").alias("label"), "set_key", "signature", "prefix")
    own = own.join(sets, ["label", "set_key"]).dropDuplicates(["set_id"])
    own = materialize(own.select("set_id", "n", "signature", "prefix"), "set-entries")

    entries = own.select("set_id", "n", F.posexplode("prefix").alias("at", "shingle"))
    entries = entries.select("shingle", F.col("at").cast("long"), "n", "set_id")
    shared = entries.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_shared_entries, entries.schema)
    shared = materialize(shared, "shared-entries")
    index = materialize(
        shared.join(own.select("set_id", "signature"), "set_id").select(
            "shingle", "n", "set_id", "at", "signature"
        ),
        "index",
    )
    order = ["shingle", "n", "set_id"]
    ranged = index.repartition("shingle").sortWithinPartitions(*order)
    pairs = materialize(_chosen(ranged.mapInArrow(partial(_first_pairs, bounds), _FIRST)), "pairs")
    checked = pairs
    classes = components(materialize(_verified(docs, sets, pairs, width, bounds), "links"))
    for nearest in (True, True, False):
        labelled = index.join(classes.withColumnRenamed("node", "set_id"), "set_id", "left")
        labelled = labelled.withColumn("comp", F.coalesce("comp", "set_id"))
        lists = labelled.groupBy("shingle").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")
        )
        lists = lists.filter((F.col("low") < F.col("high")) & (F.col("size") > EARLY)).select("shingle")
        open_lists = labelled.join(lists, "shingle", "left_semi")
        ordered = open_lists.repartition("shingle").sortWithinPartitions(*order)
        pairs = ordered.mapInArrow(partial(_cross_pairs, bounds, nearest), _PAIRS).distinct()
        pairs = materialize(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        checked = checked.union(pairs)
        found = materialize(_verified(docs, sets, pairs, width, bounds), "links")
        if not found.isEmpty():
            classes = merged(classes, found)

    return light, sets, classes


def _of_documents(light: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Each document with the columns of its set and component_id."""
    of_set = sets.join(classes.withColumnRenamed("node", "set_id"), "set_id", "left")
    of_set = of_set.withColumn("comp", F.coalesce("comp", "set_id"))
    smallest = of_set.groupBy("comp").agg(F.min("label").alias("component_id"))
    of_set = of_set.join(smallest, "comp").drop("comp", "set_id", "n", "label")
    class_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return light.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left").withColumn(
        "component_id", class_id
    )


def one_of_each_class(docs: DataFrame, width: int = SHINGLE, over: int = OVER, under: int = UNDER) -> DataFrame:
    """The first row of each class of links: of smallest doc_id (null last), then of smallest text digest.

    Rows are judged by their own text, so one that shares its doc_id with a copy stays if it is
    none. Rows equal in doc_id and text are one document. Rows without words are linked with
    nothing: those with a doc_id stay once each, those without one all stay.
    """
    text = F.col("text").cast("string")
    own = F.xxhash64("doc_id", text)
    classes = link_classes(docs.select(own.alias("doc_id"), text.alias("text")), width, over, under)
    classes = classes.filter("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id").distinct()
    rows = classes.join(docs.select(own.alias("row"), F.col("doc_id").alias("id")).distinct(), "row")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row").alias("row"))
    first = rows.groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    # Both anti-joins go by row, so a class of any size is spread over all tasks.
    named = apart(docs)
    copies = rows.join(first, "row", "left_anti").select(F.col("row").alias("copy"), F.col("id").alias("copy_id"))
    same = (F.xxhash64("doc_id", text) == F.col("copy")) & F.col("doc_id").eqNullSafe(F.col("copy_id"))
    kept = named.join(copies, same, "left_anti")
    alone = F.col("doc_id").isNull() & ~F.coalesce(text.rlike(_WORD), F.lit(False))
    once = kept.filter(~alone).dropDuplicates(["doc_id", "text"])
    return once.union(kept.filter(alone)).toDF(*docs.columns)
