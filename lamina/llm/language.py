"""Language identification by nearest centroid.

A text is a vector of hashed n-grams of two and three bytes over its lower-cased letters
(everything in ASCII that is no letter is one space), weighted by tf-idf and normalised.
Each language has several centroids, clustered by cosine. The nearest centroid names the
language; a text farther from it than nearly all training texts of the cluster is rejected:
its cosine is below ``MARGIN`` of their ``LOW`` quantile. The cosine of a training text is
to the others of its cluster without itself, so few rows do not look closer than they are.

The document frequencies come from all training rows. The centroids are fitted on a
bounded sample of them: about ``SAMPLE`` rows, spread evenly over the languages and
chosen by a hash of the id.

A null text, a text without letters, and every text when there was nothing to learn
from is ``und``, rejected, with score 0. Rows with a null doc_id or a repeated one are
treated like any other row; a null language teaches nothing. The input keeps all its
columns; the new ones begin with ``lid_``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import slices, texts_of

FEATURES = 4096
#: Training rows that the centroids are fitted on, and clusters per language.
SAMPLE, CLUSTERS = 3000, 4
#: A text is rejected below this share of this quantile of the cosines in the training cluster.
MARGIN, LOW = 0.7, 0.01
#: Rows that the quantile is taken from at least: of the cluster, or else of its language, or else of all,
#: and rows of a cluster that counts there. The fewer stand apart, so their cosines tell nothing of others.
ENOUGH, FEW = 100, 20
NO_LANGUAGE = "und"

_BYTES, _ROWS = 1_000_000, 256
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def ngram_counts(texts: list[str]) -> np.ndarray:
    """A row of hashed n-gram counts for each text."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    # Each text stands between spaces, and no n-gram reaches into the next text.
    data = _LETTERS[np.frombuffer(b"".join([b" " + r + b"  " for r in raw]), np.uint8)].astype(np.uint32)
    row = np.repeat(np.arange(len(raw), dtype=np.uint32), [len(r) + 3 for r in raw])
    out = np.zeros(len(raw) * FEATURES)
    pair = data[:-1] * np.uint32(256) + data[1:]
    blank = (data[:-1] == 32) & (data[1:] == 32)
    for key, keep in (
        (pair[:-1], ~blank[:-1]),
        (pair[:-1] * np.uint32(256) + data[2:] + np.uint32(1 << 25), ~(blank[:-1] | blank[1:])),
    ):
        hashed = (key * np.uint32(2654435761)) >> np.uint32(20)
        inside = keep & (row[:-2] == row[2:])
        out += np.bincount(row[:-2][inside] * np.uint32(FEATURES) + hashed[inside], minlength=len(out))
    return out.reshape(len(raw), FEATURES)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.sqrt(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass
class Centroids:
    """Unit vectors, the language of each, and the least cosine at which each accepts a text."""

    idf: np.ndarray
    vectors: np.ndarray
    languages: list[str]
    least: np.ndarray

    def nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each text and the cosine to it; ties go to the first."""
        near = _weighted(ngram_counts(texts), self.idf) @ self.vectors.T
        best = near.argmax(axis=1)
        return best, np.clip(near[np.arange(len(texts)), best], 0.0, 1.0)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by spherical k-means from far-apart starts, and the cluster of each row."""
    mean = vectors.mean(axis=0)
    chosen = [int((vectors @ mean).argmax())]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
    return centroids, (vectors @ centroids.T).argmax(axis=1)


def cosines_to_others(vectors: np.ndarray, member: np.ndarray, k: int) -> list[np.ndarray]:
    """The cosine of each unit vector to its cluster without itself, by cluster; none for a row alone."""
    sums = np.zeros((k, vectors.shape[1]))
    np.add.at(sums, member, vectors)
    along = (vectors @ sums.T)[np.arange(len(vectors)), member]
    rest = np.sqrt(np.maximum((sums**2).sum(axis=1)[member] - 2 * along + 1, 1e-12))
    near, size = np.clip((along - 1) / rest, 0.0, 1.0), np.bincount(member, minlength=k)
    return [near[member == c] if size[c] > 1 else np.empty(0) for c in range(k)]


def limits(near: list[np.ndarray], languages: list[str]) -> np.ndarray:
    """The least cosine at which each cluster accepts a text, from the cosines of its training rows."""
    out = []
    for cosines, language in zip(near, languages):
        same = [n for n, name in zip(near, languages) if name == language and len(n) >= FEW]
        every = [n for n in near if len(n) >= FEW]
        pools = [(cosines, ENOUGH), *((np.concatenate([*p, []]), n) for p, n in ((same, ENOUGH), (every, 1), (near, 1)))]
        out.append(next((np.quantile(p, LOW) for p, n in pools if len(p) >= n), 1.0))
    return MARGIN * np.array(out)


_CLUSTERS = pa.schema(
    [("language", pa.string()), ("cluster", pa.int32()), ("centroid", pa.binary()), ("cosines", pa.binary())]
)


def fit(
    docs: DataFrame, training: Column, language: str = "lang", sample: int = SAMPLE, clusters: int = CLUSTERS
) -> Centroids | None:
    """Centroids of the rows where ``training`` holds and the language is known; None without any."""
    rows = docs.filter(training & F.col(language).isNotNull()).select(
        F.col(language).cast("string").alias("language"), F.col("text").cast("string"), _draw().alias("draw")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, languages = np.zeros(FEATURES, np.int64), {}
        for part in slices(batches, limit=_BYTES, rows=_ROWS):
            held += (ngram_counts(texts_of(part)) > 0).sum(axis=0)
            for name in part.column("language").to_pylist():
                languages[name] = languages.get(name, 0) + 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array([*at.tolist(), *[-1] * len(languages)], pa.int32()),
                "language": pa.array([*[""] * len(at), *languages], pa.string()),
                "n": pa.array([*held[at].tolist(), *languages.values()], pa.int64()),
            }
        )

    counted = rows.select("language", "text").mapInArrow(frequencies, "feature int, language string, n long")
    held, sizes = np.zeros(FEATURES), {}
    for row in counted.groupBy("feature", "language").agg(F.sum("n").alias("n")).collect():  # features + languages
        if row.feature < 0:
            sizes[row.language] = row.n
        else:
            held[row.feature] = row.n
    if not sizes:
        return None
    idf = np.log((1 + sum(sizes.values())) / (1 + held)) + 1

    share = sample / len(sizes)
    taken = F.lit(False)
    for name, n in sizes.items():
        taken = taken | ((F.col("language") == name) & (F.col("draw") < min(1.0, share / n)))
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def clustered(key: tuple, drawn: pa.Table) -> pa.Table:
        """The centroids of one language; the order of the rows does not count."""
        own = np.concatenate(
            [
                _weighted(ngram_counts(texts_of(part)), shared.value).astype(np.float32)
                for part in slices(drawn.to_batches(), limit=_BYTES, rows=_ROWS)
            ]
        )
        own = own[sorted(range(len(own)), key=lambda i: own[i].tobytes())].astype(np.float64)
        own = own[np.linalg.norm(own, axis=1) > 0]
        rows = []
        if len(own):
            found, member = cluster(own, clusters)
            cosines = cosines_to_others(own, member, len(found))
            rows = [(found[c].tobytes(), cosines[c].tobytes()) for c in range(len(found)) if (member == c).any()]
        columns = [[key[0]] * len(rows), list(range(len(rows))), [r[0] for r in rows], [r[1] for r in rows]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CLUSTERS)], schema=_CLUSTERS)

    # A group is a language's share of the bounded sample; only its centroids and cosines reach the driver.
    drawn = rows.filter(taken).select("language", "text").groupBy("language")
    found = drawn.applyInArrow(clustered, "language string, cluster int, centroid binary, cosines binary")
    centroids, names, near = [], [], []
    for row in sorted(found.collect(), key=lambda r: (r.language, r.cluster)):
        centroids.append(np.frombuffer(row.centroid))
        names.append(row.language)
        near.append(np.frombuffer(row.cosines))
    return Centroids(idf, np.array(centroids), names, limits(near, names)) if names else None


def _draw() -> Column:
    """A number from 0 to 1 that the row's id and text fix."""
    return F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def predict(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """``docs`` with lid_language, lid_score (cosine, 0 to 1) and lid_rejected, in place of columns of these names."""
    docs = docs.drop("lid_language", "lid_score", "lid_rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("lid_language", T.StringType()),
            T.StructField("lid_score", T.DoubleType()),
            T.StructField("lid_rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, limit=_BYTES, rows=_ROWS):
            letters = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\pL"), False)
            letters = letters.to_numpy(zero_copy_only=False) & (model is not None)
            names, scores, rejected = [NO_LANGUAGE] * part.num_rows, np.zeros(part.num_rows), ~letters
            if model is not None:
                best, near = model.nearest(texts_of(part))
                names = [model.languages[b] if ok else NO_LANGUAGE for b, ok in zip(best, letters)]
                scores = np.where(letters, near, 0.0)
                rejected = ~letters | (near < model.least[best])
            new = [pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)
