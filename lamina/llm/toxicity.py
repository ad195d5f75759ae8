"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a lexicon (whole words and word beginnings that mark
toxic training texts, with log-odds weights), lexicon words near a second-person pronoun,
pronouns, capitals, punctuation, and words that hide letters behind digits or signs.

Everything that is learned comes from a bounded sample of the labelled training rows:
about ``SAMPLE`` of them, chosen by a hash of the id. Three quarters of the sample make
the lexicon and the trees, the last quarter the calibration. The sample's ids are the
only data that is broadcast.

A null text is empty and gets a score like any other. Labels that are null teach nothing;
several labels of one doc_id count as so many rows. Without labels of both kinds every
score is the share of label 1 in the sample, or 0 without labels. The input keeps its
columns; the new one is ``tox_score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import apart, coded, slices, starts_of, sums, texts_of, words_of
from lamina.session import materialize

#: Labelled rows that the model is fitted on; terms of the lexicon; words a pronoun reaches.
SAMPLE, TERMS, REACH = 20_000, 1000, 6
TREES, DEPTH, STEP = 20, 3, 0.3
PREFIXES = (3, 4, 5, 6)

# Second-person pronouns of the languages at hand, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split()
)
_HIDDEN = str.maketrans("013457@$!", "oieastasi")
_HIDING = re.compile(r"[^\W\d_][\d@$!*.\-_]+[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")

NAMES = [
    "lexicon_hits", "lexicon_density", "lexicon_most", "lexicon_weight", "near_second_person", "second_person",
    "capitals", "exclamations", "questions", "punctuation", "hidden_words", "hidden_hits", "length",
]


def _plain(word: bytes) -> tuple[str, bool]:
    """The letters of a word, and whether other signs stand between or for letters."""
    text = word.decode("utf-8", "replace").lower()
    if text.isalpha():
        return text, False
    hidden = bool(_HIDING.search(text))
    return _NOT_LETTERS.sub("", text.translate(_HIDDEN) if hidden else text), hidden


def _terms(plain: str) -> list[str]:
    return ["=" + plain, *(plain[:n] for n in PREFIXES if len(plain) >= n)] if len(plain) > 2 else []


@dataclass
class Lexicon:
    weights: dict[str, float]

    def weight(self, plain: str) -> float:
        """The largest weight of the terms of a word, 0 if none is in the lexicon."""
        return max((self.weights.get(t, 0.0) for t in _terms(plain)), default=0.0)


def _letter_classes() -> np.ndarray:
    """For each byte: 1 capital, 2 exclamation mark, 3 question mark, 4 other punctuation, else 0."""
    kind = np.zeros(256, np.uint8)
    for b in range(33, 127):
        kind[b] = 0 if chr(b).isalnum() else 4
    kind[65:91], kind[ord("!")], kind[ord("?")] = 1, 2, 3
    return kind


_KINDS = _letter_classes()


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    flat, counts = words_of(texts)
    codes, vocabulary = coded(flat)
    plain = [_plain(w) for w in vocabulary]
    weight = np.array([lexicon.weight(p) for p, _ in plain] or [0.0])[codes]
    hidden = np.array([h for _, h in plain] or [False])[codes]
    second = np.array([p in SECOND_PERSON for p, _ in plain] or [False])[codes]
    hit = weight > 0
    # The distance to the last pronoun before and to the next one behind, within the same text.
    at, text = np.arange(len(codes)), np.repeat(np.arange(len(texts)), counts)
    begins = starts_of(counts)
    last = np.maximum.accumulate(np.where(second, at, -(1 << 40))) if len(at) else at
    after = np.minimum.accumulate(np.where(second, at, 1 << 40)[::-1])[::-1] if len(at) else at
    last = np.where(last >= begins[text], last, -(1 << 40))
    after = np.where(after < begins[text + 1], after, 1 << 40)
    near = hit & (np.minimum(at - last, after - at) <= REACH)

    raw = [t.encode("utf-8", "replace") for t in texts]
    kinds = _KINDS[np.frombuffer(b"".join(raw), np.uint8)]
    sizes = np.array([len(r) for r in raw], np.int64)
    of_kind = [sums((kinds == k).astype(np.int64), sizes) / np.maximum(sizes, 1) for k in (1, 2, 3, 4)]

    n = np.maximum(counts, 1)
    most = np.zeros(len(texts))
    full = counts > 0
    if full.any():
        most[full] = np.maximum.reduceat(weight, begins[:-1][full])
    hits = sums(hit.astype(np.int64), counts)
    return np.column_stack(
        [
            hits, hits / n, most, sums(weight, counts) / np.sqrt(n), sums(near.astype(np.int64), counts),
            sums(second.astype(np.int64), counts) / n, *of_kind, sums(hidden.astype(np.int64), counts) / n,
            sums((hidden & hit).astype(np.int64), counts), np.log1p(counts),
        ]
    )


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``tox_features``, an array of doubles."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([*docs.schema.fields, T.StructField("tox_features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = features(texts_of(part), shared.value)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def learn_lexicon(sample: DataFrame, terms: int = TERMS) -> Lexicon:
    """Terms that stand in far more toxic texts of ``sample`` (text, label) than chance allows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found: dict[str, list[int]] = {}
            for text, label in zip(texts_of(part), part.column("label").to_pylist()):
                own = {t for w in set(words_of([text])[0]) for t in _terms(_plain(w)[0])}
                for t in own:
                    found.setdefault(t, [0, 0])[label] += 1
            rows = {"term": list(found), "n0": [v[0] for v in found.values()], "n1": [v[1] for v in found.values()]}
            yield pa.RecordBatch.from_pydict(rows)

    counted = sample.select("text", "label").mapInArrow(count, "term string, n0 long, n1 long")
    counted = counted.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    toxic, clean = (sample.filter(F.col("label") == label).count() for label in (1, 0))
    rate = toxic / (toxic + clean)
    n = F.col("n0") + F.col("n1")
    score = (F.col("n1") - n * rate) / F.sqrt(n * rate * (1 - rate))
    odds = F.log(((F.col("n1") + 0.5) / (toxic + 1)) / ((F.col("n0") + 0.5) / (clean + 1)))
    best = counted.filter("n1 >= 2").select("term", score.alias("score"), odds.alias("odds"))
    best = best.filter("score > 4 and odds > 1.5").orderBy(F.desc("score"), "term").limit(terms)
    return Lexicon({r.term: r.odds for r in best.collect()})


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    #: Raw tree scores and the calibrated score at each, rising.
    bounds: list[float]
    values: list[float]


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Model:
    """``labels`` has doc_id and toxic; ``training`` chooses its rows."""
    known = labels.filter(training).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter("label in (0, 1) and label_id is not null")
    n = known.count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), "label_id"), F.lit(1 << 30)) / float(1 << 30)
    known = known.filter(draw < min(1.0, sample / max(n, 1)))
    # About ``sample`` pairs of numbers: a bounded broadcast.
    drawn = docs.select("doc_id", F.col("text").cast("string")).join(
        F.broadcast(known), F.col("doc_id") == F.col("label_id")
    )
    drawn = materialize(drawn.select("doc_id", "text", "label"), "labelled")
    counts = {r.label: r["count"] for r in drawn.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = float(next(iter(counts), 0))
        return Model(Lexicon({}), None, [0.0], [share])
    calibrating = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0
    lexicon = learn_lexicon(drawn.filter(~calibrating))
    rows = _assembled(with_features(drawn, lexicon)).withColumn("label", F.col("label").cast("double"))
    rows = materialize(rows.select("doc_id", "label", "tox_vector"), "features")
    fitted, held = rows.filter(~calibrating), rows.filter(calibrating)
    if fitted.select("label").distinct().count() < 2:
        return Model(lexicon, None, [0.0], [counts.get(1, 0) / sum(counts.values())])
    trees = GBTClassifier(
        featuresCol="tox_vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=3,
        predictionCol="tox_prediction",
    )
    trees = trees.fit(fitted.coalesce(4)).setRawPredictionCol("tox_raw").setProbabilityCol("tox_probability")
    raw = held if not held.isEmpty() else fitted
    raw = trees.transform(raw).select("label", vector_to_array("tox_raw")[1].alias("raw"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return Model(lexicon, trees, list(isotonic.boundaries), list(isotonic.predictions))


def _assembled(rows: DataFrame) -> DataFrame:
    columns = [F.col("tox_features")[i].alias(f"tox_f{i}") for i in range(len(NAMES))]
    wide = rows.select("*", *columns)
    assembler = VectorAssembler(inputCols=[f"tox_f{i}" for i in range(len(NAMES))], outputCol="tox_vector")
    return assembler.transform(wide)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``tox_score`` from 0 to 1, in place of a column of this name."""
    docs = docs.drop("tox_score")
    if model.trees is None:
        return docs.withColumn("tox_score", F.lit(model.values[0]))
    named = apart(docs)
    rows = _assembled(with_features(named, model.lexicon))
    rows = model.trees.transform(rows).withColumn("tox_raw", vector_to_array("tox_raw")[1])
    return rows.withColumn("tox_score", _calibrated(F.col("tox_raw"), model.bounds, model.values)).select(
        *named.columns, "tox_score"
    ).toDF(*docs.columns, "tox_score")


def _calibrated(raw: Column, bounds: list[float], values: list[float]) -> Column:
    """Linear between the points of the isotonic regression, constant beyond them."""
    out = F.lit(values[-1])
    for low, high, a, b in reversed(list(zip(bounds, bounds[1:], values, values[1:]))):
        slope = (b - a) / (high - low) if high > low else 0.0
        out = F.when(raw < high, F.lit(a) + (raw - low) * slope).otherwise(out)
    return F.when(raw <= bounds[0], F.lit(values[0])).otherwise(out)
