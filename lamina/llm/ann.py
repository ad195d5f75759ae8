"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

Every vector gets one more component, so that all have the length of the longest; the
largest inner product is then the smallest distance. All are turned by one random
rotation and cut into column blocks. Centroids, fitted on a bounded sample, deal all
vectors into lists; a query looks at the lists of its nearest centroids. Within a list
the distance grows column block by column block, and a candidate is abandoned as soon as
a hypothesis test on the partial distance says it will not reach the best k: with random
rotation the first d of D components hold about d/D of the squared distance. The distance
to reach is that of the (2k+1)-th of the sample in all lists that the query looks at, and
goes along to each of them.

Survivors are scored on the original vectors in double precision, component after
component, so equal vectors score equally; ties go to the smaller vec_id.

Vectors that are null, all zero, hold a null or a non-finite component, or have another
length than most vectors take no part, nor do rows with a null vec_id. Rows that share a
vec_id are each a candidate, never for a query of their own vec_id. With no more than k
candidates a query gets all that its lists hold; up to ``EXHAUSTIVE`` vectors there is one list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import materialize

#: Vectors that centroids are fitted on, the most lists, and the share of lists a query looks at.
SAMPLE, MOST_LISTS, PROBED = 20_000, 1024, 0.8
EXHAUSTIVE = 256
#: Width of a column block, strictness of the test, vectors and queries compared at once.
COLUMNS, STRICT = 16, 2.1
VECTORS, QUERIES = 4096, 512
#: Pairs that one step of the scan holds.
PAIRS = 1 << 18
#: The scan goes on pair by pair once fewer than one in so many is alive.
SPARSE = 16
#: Scores of queries with the sample that are held at once.
SCORES = 1 << 22


@dataclass
class Index:
    """Longest length, rotation, rotated centroids, and the sample by vec_id with its lists."""

    longest: float
    rotation: np.ndarray
    centroids: np.ndarray
    drawn: np.ndarray
    drawn_ids: np.ndarray
    drawn_lists: np.ndarray

    def turned(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(vectors)) if query else np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0.0)
        return np.column_stack([vectors, np.sqrt(rest)]) @ self.rotation

    def distances(self, turned: np.ndarray) -> np.ndarray:
        """Squared distance to each centroid, less the vector's own squared length."""
        return (self.centroids**2).sum(axis=1) - 2 * turned @ self.centroids.T


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite)
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    most = sizes.limit(1).collect()
    return rows.filter(F.size("vector") == (most[0].size if most else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(rows: DataFrame, sample: int = SAMPLE, rounds: int = 10, seed: int = 11) -> Index | None:
    """Longest length over all rows; centroids by k-means on about ``sample`` of them."""
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, longest = rows.agg(F.count("*"), F.sqrt(F.max(squared))).first()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    found = rows.filter(draw < min(1.0, sample / n)).select("vec_id", "vector").collect()
    found = sorted(found or rows.select("vec_id", "vector").limit(1).collect(), key=lambda r: r.vec_id)
    drawn = np.array([r.vector for r in found])
    random = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(random.normal(size=(drawn.shape[1] + 1,) * 2))
    drawn_ids = np.array([r.vec_id for r in found], np.int64)
    index = Index(float(longest), rotation, np.zeros((1, drawn.shape[1] + 1)), drawn, drawn_ids, drawn_ids)
    drawn = index.turned(drawn[np.lexsort(drawn.T)], query=False)
    lists = 1 if n <= EXHAUSTIVE else min(MOST_LISTS, math.isqrt(n), len(drawn))
    index.centroids = drawn[random.permutation(len(drawn))[:lists]]
    for _ in range(rounds):
        own = index.distances(drawn).argmin(axis=1)
        sums, counts = np.zeros_like(index.centroids), np.bincount(own, minlength=lists)
        np.add.at(sums, own, drawn)
        index.centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], index.centroids)
    # As the rows are dealt: to the first of the nearest centroids.
    index.drawn_lists = index.distances(index.turned(index.drawn, query=False)).argmin(axis=1)
    return index


def _dealt(rows: DataFrame, index: Index, probes: int, query: bool, k: int = 0) -> DataFrame:
    """vec_id, vector and the lists of its ``probes`` nearest centroids, a row for each; beat, of queries."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            near = shared.value.distances(shared.value.turned(vectors, query))
            lists = np.argsort(near, axis=1, kind="stable")[:, :probes]
            again = pa.array(np.repeat(np.arange(batch.num_rows), lists.shape[1]))
            found = {c: batch.column(c).take(again) for c in ("vec_id", "vector")}
            found["list"] = pa.array(lists.ravel().astype(np.int32))
            if query:
                # About twice as many as are asked for: the test may abandon a few of them.
                beat = to_beat(shared.value, vectors, batch.column("vec_id").to_numpy(), lists, 2 * k + 1)
                found["beat"] = pa.array(beat).take(again)
            yield pa.RecordBatch.from_pydict(found)

    schema = "vec_id long, vector array<double>, list int" + (", beat double" if query else "")
    return rows.select("vec_id", "vector").mapInArrow(run, schema)


def _blocks(dealt: DataFrame, lists: int, rows: int, prefix: str) -> DataFrame:
    """list, and ids, vectors and beats of up to ``rows`` rows of it. A long list is dealt over many tasks."""
    sizes = np.zeros(lists, np.int64)
    for row in dealt.groupBy("list").count().collect():  # one row per list
        sizes[row["list"]] = row["count"]
    parts = F.array(*[F.lit(int(-(-n // rows) or 1)) for n in sizes])
    beats = "beat" in dealt.columns
    salted = dealt.withColumn("salt", F.pmod(F.xxhash64("vec_id"), parts[F.col("list")]))
    sorted_ = salted.repartition("list", "salt").sortWithinPartitions("list", "salt", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, salt = (batch.column(c).to_numpy() for c in ("list", "salt"))
            cuts = [0, *(np.flatnonzero((own[1:] != own[:-1]) | (salt[1:] != salt[:-1])) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                for k in range(a, b, rows):
                    part = batch.slice(k, min(rows, b - k))
                    vectors = _matrix(part.column("vector"))
                    found = [[int(own[a])], [part.column("vec_id").to_pylist()], [vectors.tobytes()]]
                    types, names = [pa.int32(), pa.list_(pa.int64()), pa.binary()], ["list", "ids", "vectors"]
                    if beats:
                        found.append([part.column("beat").to_numpy().tobytes()])
                        types, names = [*types, pa.binary()], [*names, "beats"]
                    arrays = [pa.array(v, t) for v, t in zip(found, types)]
                    yield pa.RecordBatch.from_arrays(arrays, [names[0], *[f"{prefix}_{n}" for n in names[1:]]])

    schema = f"list int, {prefix}_ids array<long>, {prefix}_vectors binary"
    return sorted_.mapInArrow(run, schema + (f", {prefix}_beats binary" if beats else ""))


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, the products added one after another."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1]


def scan(
    index: Index,
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    beat: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the queries, vec_ids, scores) of the best k of one block for each query, by the adaptive scan.

    All pairs that are still alive go through a column block together; while most are, that is
    one product of two matrices. ``beat`` is a squared distance that k candidates of the query are
    known to reach, wherever they are.
    """
    turned, asked = index.turned(vectors, query=False), index.turned(queries, query=True)
    width = turned.shape[1]
    slack = 1e-9 * (index.longest**2 + 1e-300)
    # Distances of all pairs while they are dense, then of the pairs (q, v) that are left.
    dense, q, v, partial = np.zeros((len(query_ids), len(ids))), None, None, None
    for a in range(0, width, COLUMNS):
        b = min(a + COLUMNS, width)
        x, y = asked[:, a:b], turned[:, a:b]
        bound = (beat * (1 + STRICT / math.sqrt(b)) ** 2 if b < width else beat) + slack
        if q is None:
            dense += (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * x @ y.T
            keep = dense <= (bound * (b / width))[:, None]
            if b == width or np.count_nonzero(keep) * SPARSE < keep.size:
                q, v = np.nonzero(keep)
                partial = dense[q, v]
        else:
            partial = partial + ((x[q] - y[v]) ** 2).sum(axis=1)
            keep = partial * (width / b) <= bound[q]
            q, v, partial = q[keep], v[keep], partial[keep]
    other = query_ids[q] != ids[v]
    q, v = q[other], v[other]
    scores = exact(vectors[v], queries[q])
    best = np.lexsort((ids[v], -scores, q))
    counts = np.bincount(q, minlength=len(query_ids))
    place = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
    best = best[place < k]
    return q[best], ids[v[best]], scores[best]


def to_beat(index: Index, queries: np.ndarray, query_ids: np.ndarray, lists: np.ndarray, k: int) -> np.ndarray:
    """For each query a squared distance that k of the sample's rows reach in the ``lists`` it looks at.

    These rows are candidates themselves, so the k nearest of all are no farther. It is infinite
    where there are too few that are not rows of the query's own id.
    """
    found = np.full(len(queries), np.inf)
    step = max(1, SCORES // max(1, len(index.drawn)))
    for a in range(0, len(queries) if len(index.drawn) >= k else 0, step):
        some, ids = queries[a : a + step], query_ids[a : a + step]
        probed = np.zeros((len(some), len(index.centroids)), bool)
        np.put_along_axis(probed, lists[a : a + step], True, axis=1)
        scores = np.where(probed[:, index.drawn_lists], some @ index.drawn.T, -np.inf)
        first, last = (np.searchsorted(index.drawn_ids, ids, side) for side in ("left", "right"))
        for i in np.flatnonzero(last > first):
            scores[i, first[i] : last[i]] = -np.inf
        least = np.partition(scores, len(index.drawn) - k, axis=1)[:, len(index.drawn) - k]
        found[a : a + step] = (some**2).sum(axis=1) + index.longest**2 - 2 * least
    return found


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, probed: float = PROBED, sample: int = SAMPLE
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for each row where ``is_query`` holds.

    Rows equal in vec_id and vector ask once; different vectors under one vec_id each get k rows
    of their own. Rows that have the query's vec_id are no candidates of it.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors), "vectors")
    index = fit(rows, sample)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = len(index.centroids)
    probes = lists if lists == 1 else max(2, math.ceil(lists * probed))
    stored = _blocks(materialize(_dealt(rows, index, 1, query=False), "dealt"), lists, VECTORS, "v")
    asked = rows.filter(is_query).dropDuplicates(["vec_id", "vector"])
    # Few as they may be, all tasks compare them with the sample.
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id")
    asked = _blocks(materialize(_dealt(asked, index, probes, query=True, k=k), "asked"), lists, QUERIES, "q")
    shared = spark.sparkContext.broadcast(index)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids = (np.array(row[c], np.int64) for c in ("q_ids", "v_ids"))
                queries = np.frombuffer(row["q_vectors"]).reshape(len(query_ids), -1)
                stored = np.frombuffer(row["v_vectors"]).reshape(len(ids), -1)
                beat = np.frombuffer(row["q_beats"])
                step = max(1, PAIRS // len(ids))
                for a in range(0, len(query_ids), step):
                    some = slice(a, a + step)
                    q, v, scores = scan(shared.value, query_ids[some], queries[some], ids, stored, k, beat[some])
                    digests = [xxhash.xxh3_64_intdigest(own.tobytes()) for own in queries[some]]
                    found = (query_ids[some][q], np.array(digests, np.uint64).view(np.int64)[q], v, scores)
                    yield pa.RecordBatch.from_pydict(dict(zip(("query_id", "query", "vec_id", "score"), found)))

    # Spark sizes both sides by their files, where vectors that come once a list take next to no room: as
    # a broadcast they would fill the driver.
    near = stored.join(asked.hint("merge"), "list").mapInArrow(compare, "query_id long, query long, vec_id long, score double")
    # Two vectors under one id are two queries.
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
