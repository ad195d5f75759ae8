"""Near duplicates of vectors of one label, by product quantisation.

Vectors are taken at unit length; a cosine of at least ``least`` is then a distance of at
most r = sqrt(2 - 2 * least). Equal unit vectors of one label are one vector from the start,
with a number of copies.

* Coarse lists. Centroids, fitted on a bounded sample, deal all vectors into lists. A vector
  also looks at the lists whose border it is near to: a partner's shift along the line
  between two centroids is at most r, and as a share of r it is some 1 / sqrt(D) of it, so
  all lists within ``SIGMAS`` of that are probed (within r itself for few dimensions).
* Residual codes. What is left after the centroid is cut into subspaces, each coded by its
  nearest codeword. A query's distances to the codewords of a list stand in one table, and
  the distance to a coded vector is a sum of looked-up entries (asymmetric).
* No pair of a probed list is lost: the error of each code is kept, and a pair goes on
  unless its estimate exceeds r by more than that error (triangle inequality).
* Rerank. Cosines of what goes on are taken in double precision.

Lists are worked off in blocks, a pair of blocks a row, so a large list or group of copies
spreads over tasks. Tasks return the number of links of each vector and a forest of the
linked pairs, never the pairs; so classes are exact with regard to all links found.

Null labels and vectors that are null, all zero or hold a null or non-finite component link
with nothing, nor do vectors of another length than most. Each row is a vector, also with a
repeated vec_id; rows with a null vec_id link, and are counted, but name no class (a class
of theirs alone has none: component_id and kept are null). An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import record
from lamina.llm.jaccard_join import _forest, _groups, components
from lamina.session import materialize

LEAST = 0.98
#: Vectors that centroids and codewords are fitted on, vectors of a list on average, most lists.
SAMPLE, LIST, MOST_LISTS = 16_384, 256, 4096
#: Subspaces and codewords of a code, and standard deviations of a partner's shift that are probed.
SUBSPACES, CODEWORDS, SIGMAS = 16, 256, 5.0
#: Vectors of a block, and queries that have their tables at once.
BLOCK, QUERIES = 1024, 64


@dataclass
class Quantiser:
    """Centroids of the lists, and the codewords of each subspace of the residuals."""

    centroids: np.ndarray
    cuts: list[int]
    codewords: list[np.ndarray] = field(default_factory=list)

    def to_centroids(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances, less the squared lengths of the vectors."""
        return (self.centroids**2).sum(axis=1) - 2 * vectors @ self.centroids.T

    def codes(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code of each residual, and how far what it stands for is from it."""
        codes, error = [], np.zeros(len(residuals))
        for a, b, words in zip(self.cuts, self.cuts[1:], self.codewords):
            own = residuals[:, a:b]
            code = ((words**2).sum(axis=1) - 2 * own @ words.T).argmin(axis=1)
            error += ((own - words[code]) ** 2).sum(axis=1)
            codes.append(code.astype(np.uint8))
        return np.stack(codes, axis=1), np.sqrt(error)

    def tables(self, residuals: np.ndarray) -> np.ndarray:
        """The squared distance of each subspace of each residual to each codeword."""
        found = np.full((len(residuals), len(self.codewords), CODEWORDS), np.inf)
        for k, (a, b, words) in enumerate(zip(self.cuts, self.cuts[1:], self.codewords)):
            own = residuals[:, a:b]
            near = (own**2).sum(axis=1)[:, None] + (words**2).sum(axis=1) - 2 * own @ words.T
            found[:, k, : len(words)] = np.maximum(near, 0.0)
        return found


def _nearest_means(rows: np.ndarray, k: int, random: np.random.Generator, rounds: int) -> np.ndarray:
    means = rows[random.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        own = ((means**2).sum(axis=1) - 2 * rows @ means.T).argmin(axis=1)
        counts = np.bincount(own, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, own, rows)
        means = np.where(counts[:, None] > 0, total / np.maximum(counts, 1)[:, None], means)
    return means


def fit(units: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Quantiser | None:
    """From about ``sample`` of the vectors, drawn by a hash of their components."""
    n = units.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit("sample"), "unit"), F.lit(1 << 30)) / float(1 << 30)
    drawn = np.array([r.unit for r in units.filter(draw < min(1.0, sample / n)).select("unit").collect()])
    if not len(drawn):
        drawn = np.array([r.unit for r in units.select("unit").limit(1).collect()])
    drawn = drawn[np.lexsort(drawn.T)]
    width, random = drawn.shape[1], np.random.default_rng(seed)
    lists = max(1, min(MOST_LISTS, n // LIST, len(drawn)))
    quantiser = Quantiser(
        _nearest_means(drawn, lists, random, 8),
        sorted({round(k * width / SUBSPACES) for k in range(SUBSPACES + 1)}),
    )
    residuals = drawn - quantiser.centroids[quantiser.to_centroids(drawn).argmin(axis=1)]
    quantiser.codewords = [
        _nearest_means(residuals[:, a:b], CODEWORDS, random, 6) for a, b in zip(quantiser.cuts, quantiser.cuts[1:])
    ]
    return quantiser


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and unit (null for a row that links with nothing) of each row."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("raw"),
    )
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("raw", lambda x: x != 0)
    # Divided by the largest component first, so that no square overflows or vanishes.
    rows = rows.withColumn("raw", F.when(usable, F.col("raw")))
    largest = F.array_max(F.transform("raw", F.abs))
    rows = rows.withColumn("raw", F.transform("raw", lambda x: x / largest))
    length = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("length", length)
    return rows.select(
        "vec_id", "label", F.transform("raw", lambda x: x / F.col("length") + F.lit(0.0)).alias("unit")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _probes(quantiser: Quantiser, vectors: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each vector's own list, and (vector, list) of the others whose border is within ``reach``.

    The difference of the squared distances to two centroids falls by twice their distance for
    each step across the border.
    """
    near = quantiser.to_centroids(vectors)
    own = near.argmin(axis=1)
    between = quantiser.centroids[own]
    squared = (quantiser.centroids**2).sum(axis=1)
    gaps = np.sqrt(np.maximum(squared[own][:, None] + squared - 2 * between @ quantiser.centroids.T, 0.0))
    beyond = near - near[np.arange(len(near)), own][:, None]
    which, lists = np.nonzero(beyond <= 2 * reach * gaps)
    # A pair is looked for in the list of the larger number of the two.
    later = lists > own[which]
    return own, which[later], lists[later]


def _dealt(sets: DataFrame, quantiser: Quantiser, reach: float) -> DataFrame:
    """label, list, asked (false: stored here, true: only looks here), set_id, copies, unit, code, error."""
    shared = sets.sparkSession.sparkContext.broadcast(quantiser)
    schema = "label string, list int, asked boolean, set_id long, copies long, unit array<double>, code binary, error double"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = shared.value
        for batch in (b.slice(k, BLOCK) for b in batches for k in range(0, b.num_rows, BLOCK)):
            vectors = _matrix(batch.column("unit"))
            own, which, lists = _probes(quantiser, vectors, reach)
            codes, error = quantiser.codes(vectors - quantiser.centroids[own])
            rows = np.r_[np.arange(len(own)), which]
            take = pa.array(rows)
            found = {
                "label": batch.column("label").take(take),
                "list": pa.array(np.r_[own, lists], pa.int32()),
                "asked": pa.array(np.arange(len(rows)) >= len(own)),
                "set_id": batch.column("set_id").take(take),
                "copies": batch.column("copies").take(take),
                "unit": batch.column("unit").take(take),
                "code": pa.array([c.tobytes() for c in codes], pa.binary()).take(take),
                "error": pa.array(error[rows]),
            }
            yield pa.RecordBatch.from_arrays(list(found.values()), list(found))

    return sets.select("label", "set_id", "copies", "unit").mapInArrow(deal, schema)


_BLOCKS = (
    "label string, list int, part int, asked boolean, block int, rows int, "
    "ids binary, copies binary, units binary, codes binary, errors binary"
)
_KINDS = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_BLOCK_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _BLOCKS.split(", ")])


def _blocked(dealt: DataFrame) -> DataFrame:
    """Up to ``BLOCK`` vectors of one list, stored or asked, in one row. ``part`` and ``block`` number them.

    A list is dealt over as many parts as its size asks for, so a large one is many tasks' work.
    """
    sizes = dealt.groupBy("label", "list", "asked").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / (4 * BLOCK)).cast("int")
    dealt = dealt.join(sizes.select("label", "list", "asked", parts.alias("parts")), ["label", "list", "asked"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")).drop("parts")
    keys = ["label", "list", "asked", "part"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "code", "set_id")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, keys):
            part = part.combine_chunks()
            label, own, asked, number = (part.column(c)[0].as_py() for c in keys)
            for place, begin in enumerate(range(0, part.num_rows, BLOCK)):
                rows = part.slice(begin, BLOCK).combine_chunks()
                raw = [rows.column(c).to_numpy().tobytes() for c in ("set_id", "copies", "error")]
                units = np.ascontiguousarray(_matrix(rows.column("unit").combine_chunks())).tobytes()
                codes = b"".join(rows.column("code").to_pylist())
                row = (label, own, number, asked, place, rows.num_rows, raw[0], raw[1], units, codes, raw[2])
                yield record({f.name: [v] for f, v in zip(_BLOCK_SCHEMA, row)}, _BLOCK_SCHEMA)

    return ordered.mapInArrow(block, _BLOCKS)


def linked_rows(
    quantiser: Quantiser, centroid: np.ndarray, asked: np.ndarray, stored: np.ndarray, codes: np.ndarray,
    errors: np.ndarray, least: float, same: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """(asked, stored) rows with a cosine of at least ``least``; with ``same`` both are one block, and asked < stored."""
    radius = math.sqrt(max(0.0, 2 - 2 * least))
    limit = (radius + errors + 1e-9) ** 2
    subspace = np.arange(codes.shape[1])
    found = []
    for a in range(0, len(asked), QUERIES):
        tables = quantiser.tables(asked[a : a + QUERIES] - centroid)
        estimate = tables[:, 0, codes[:, 0]]
        for k in subspace[1:]:
            estimate = estimate + tables[:, k, codes[:, k]]
        q, v = np.nonzero(estimate <= limit)
        if same:
            q, v = q[q + a < v], v[q + a < v]
        exact = np.einsum("ij,ij->i", asked[a + q], stored[v])
        found.append((a + q[exact >= least], v[exact >= least]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _links(sets: DataFrame, quantiser: Quantiser, least: float) -> DataFrame:
    """Links of each set and a forest of them: (a, b, links) with b null for a count, links null for a pair."""
    width = quantiser.centroids.shape[1]
    radius = math.sqrt(max(0.0, 2 - 2 * least))
    reach = radius * min(1.0, SIGMAS / math.sqrt(width))
    blocks = materialize(_blocked(_dealt(sets, quantiser, reach)), "vector-blocks")
    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in ("x", "y"))
    right = right.filter("not y_asked")
    met = left.join(right, (F.col("x_label") == F.col("y_label")) & (F.col("x_list") == F.col("y_list")))
    place = lambda side: F.struct(f"{side}_part", f"{side}_block")
    met = met.filter(F.col("x_asked") | (place("x") <= place("y")))
    own = (place("x") == place("y")) & ~F.col("x_asked")
    shared = sets.sparkSession.sparkContext.broadcast(quantiser)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = (np.frombuffer(row[f"{s}_units"]).reshape(-1, width) for s in "xy")
                x_ids, y_ids = (np.frombuffer(row[f"{s}_ids"], np.int64) for s in "xy")
                codes = np.frombuffer(row["y_codes"], np.uint8).reshape(len(y), -1)
                centroid, errors = shared.value.centroids[row["x_list"]], np.frombuffer(row["y_errors"])
                i, j = linked_rows(shared.value, centroid, x, y, codes, errors, least, row["own"])
                if not len(i):
                    continue
                ids = np.r_[x_ids[i], y_ids[j]]
                x_copies, y_copies = (np.frombuffer(row[f"{s}_copies"], np.int64) for s in "xy")
                found, at = np.unique(ids, return_inverse=True)
                links = np.bincount(at, np.r_[y_copies[j], x_copies[i]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.nulls(len(found), pa.int64()), pa.array(links)], ["a", "b", "links"]
                )
                node, root = _forest(x_ids[i], y_ids[j])
                node, root = node[node != root], root[node != root]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(root), pa.array(node), pa.nulls(len(node), pa.int64())], ["a", "b", "links"]
                )

    columns = [c for c in met.columns if c not in ("x_codes", "x_errors", "y_label", "y_list")]
    # Rows are dealt anew: the pairs of blocks of one list are work for many tasks.
    keys = ["x_label", "x_list", "x_asked", "x_part", "x_block", "y_part", "y_block"]
    spread = met.select(*columns, own.alias("own")).repartition(*keys)
    return spread.mapInArrow(compare, "a long, b long, links long")


def link_classes(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """A row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable by links, itself included) and kept (vec_id is component_id)."""
    units = materialize(unit_vectors(vectors).withColumn("label", F.col("label").cast("string")), "unit-vectors")
    sizes = units.filter("unit is not null").groupBy(F.size("unit").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    usable = F.col("unit").isNotNull() & (F.size("unit") == (most[0]["size"] if most else 0))
    sets = units.filter(usable).groupBy("label", "unit").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest")
    )
    sets = materialize(sets.withColumn("set_id", F.monotonically_increasing_id()), "distinct-vectors")
    quantiser = fit(sets)
    if quantiser is None:
        own, links = F.col("vec_id"), F.lit(0).cast("long").alias("n_links")
        return units.select(own, links, own.alias("component_id"), F.when(own.isNotNull(), True).alias("kept"))
    found = materialize(_links(sets, quantiser, least), "vector-links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    classes = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "set_id")
    of_set = sets.join(counts, "set_id", "left").join(classes, "set_id", "left")
    of_set = materialize(of_set.withColumn("comp", F.coalesce("comp", "set_id")), "vector-classes")
    smallest = of_set.groupBy("comp").agg(F.min("smallest").alias("component_id"))
    of_set = of_set.join(smallest, "comp").select("label", "unit", "copies", "links", "component_id")
    # Rows of a set find it by a digest of label and components next to them, so wide keys are compared once.
    keys = [F.xxhash64("label", "unit").alias("key"), "label", "unit"]
    rows = units.withColumn("usable", usable).select("vec_id", "usable", *keys)
    joined = rows.join(of_set.select(*keys, "copies", "links", "component_id"), ["key", "label", "unit"], "left")
    linked = F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    component = F.when(F.col("copies").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        linked.cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
