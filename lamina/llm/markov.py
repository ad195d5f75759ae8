"""A hidden Markov language model over words.

Every word belongs to one of a fixed number of classes, by its first two and last three
bytes. A latent state emits a class, the class emits the word: P(word | state) =
P(class | state) * P(word | class), with P(word | class) from the counts of all training
words (additive smoothing, one slot for unseen words in each class). The parameters of
the states have a fixed size; the word counts stay distributed and are joined.

Training is Baum-Welch. Every task runs the scaled forward and backward recursions over
its documents and gives expected counts by class; Spark adds them up over all tasks.
Every round runs over all training documents. Texts are cut into windows for training only
(a window that begins within a text is no start, and the move into it is not counted);
the score is the forward recursion over the whole text, in double precision.

Null texts are empty: one token, the end. Rows with a null doc_id train or not by the
empty id; repeated rows count once each. Without any training document all counts are 0
and the states stay as they were at first. The input needs doc_id and text; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import coded, record, slices, starts_of, sums, texts_of, words_of
from lamina.session import fresh_path, materialize

STATES = 8
#: Classes of words; class 0 holds the end of a text alone.
CLASSES = 4096
ALPHA = 0.1
#: Rounds over all training documents. In a trial the fifth one changed the fourth digit of the likelihood.
ROUNDS = 5
#: Words of a training window.
WINDOW = 1024


def word_class(word: bytes) -> int:
    return 1 + zlib.crc32(word[:2] + b" " + word[-3:]) % (CLASSES - 1)


@dataclass
class States:
    """Start, transition (from, to) and class probabilities (state, class)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_states(states: int = STATES, seed: int = 7) -> States:
    """States that stay where they are and differ at random."""
    random = np.random.default_rng(seed)
    emit = np.exp(random.normal(0, 0.5, (states, CLASSES)))
    move = np.full((states, states), 0.02 / max(1, states - 1))
    np.fill_diagonal(move, 0.98 if states > 1 else 1.0)
    return States(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))


def _lockstep(classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side: the order (longest first), where each step begins, and the
    place of every symbol when step 0 of all sequences comes first, then step 1, and so on."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    longest = int(counts.max(initial=0))
    active = np.searchsorted(-counts[order], -np.arange(longest), side="left")
    begins = starts_of(active)
    step = np.arange(len(classes)) - np.repeat(starts_of(counts)[:-1], counts)
    return order, begins, begins[step] + np.repeat(rank, counts)


def log_likelihood(model: States, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence of classes, by the scaled forward recursion."""
    total = np.zeros(len(counts))
    if not len(classes):
        return total
    order, begins, place = _lockstep(classes, counts)
    symbols = np.empty(len(classes), np.int64)
    symbols[place] = classes
    emit = np.ascontiguousarray(model.emit.T)
    out = np.zeros(len(counts))
    alpha = np.broadcast_to(model.start, (len(counts), len(model.start)))
    for t in range(len(begins) - 1):
        a, b = begins[t], begins[t + 1]
        alpha = (alpha[: b - a] @ model.move if t else alpha[: b - a]) * emit[symbols[a:b]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[: b - a] += np.log10(scale)
    total[order] = out
    return total


def expected_counts(
    model: States, classes: np.ndarray, counts: np.ndarray, begins_text: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions (class, state) of the sequences, and their log likelihood.

    Only sequences that begin a text (default: all) count as starts.
    """
    k = len(model.start)
    order, begins, place = _lockstep(classes, counts)
    symbols = np.empty(len(classes), np.int64)
    symbols[place] = classes
    start, move = model.start.astype(np.float32), model.move.astype(np.float32)
    seen = np.ascontiguousarray(model.emit.T, np.float32)[symbols]
    alpha = np.empty((len(classes), k), np.float32)
    scale = np.empty(len(classes), np.float32)
    for t in range(len(begins) - 1):
        a, b = begins[t], begins[t + 1]
        now = alpha[begins[t - 1] : begins[t - 1] + b - a] @ move if t else start
        now = now * seen[a:b]
        total = now.sum(axis=1)
        scale[a:b] = total
        np.divide(now, total[:, None], out=alpha[a:b])
    # Backward: ahead[i] becomes emission * beta / scale of symbol i; gamma overwrites alpha.
    moved = np.zeros((k, k))
    beta = np.ones((0, k), np.float32)
    for t in range(len(begins) - 2, -1, -1):
        a, b = begins[t], begins[t + 1]
        here = np.ones((b - a, k), np.float32)
        if len(beta):
            ahead = seen[b : b + len(beta)] * beta / scale[b : b + len(beta), None]
            moved += alpha[a : a + len(beta)].T @ ahead
            here[: len(beta)] = ahead @ move.T
            _set_gamma(alpha, b, beta)
        beta = here
    _set_gamma(alpha, 0, beta)
    emitted = np.stack([np.bincount(symbols, alpha[:, s], CLASSES) for s in range(k)], axis=1)
    firsts = alpha[: len(counts)]
    if begins_text is not None:
        firsts = firsts[begins_text[order]]
    starts = firsts.sum(axis=0, dtype=np.float64)
    return starts, moved * model.move, emitted, float(np.log10(scale, dtype=np.float64).sum())


def _set_gamma(alpha: np.ndarray, begin: int, beta: np.ndarray) -> None:
    own = alpha[begin : begin + len(beta)]
    own *= beta
    own /= own.sum(axis=1, keepdims=True)


def next_states(starts: np.ndarray, moved: np.ndarray, emitted: np.ndarray) -> States:
    """The maximisation step, with small additive counts so that nothing gets probability 0."""
    starts, moved, emit = starts + 1.0, moved + 1.0, emitted.T + 0.01
    return States(
        starts / starts.sum(), moved / moved.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)
    )


# The corpus as chunks: the words of a slice of documents as numbers, with the slice's own vocabulary.

_CHUNKS = (
    "chunk long, doc_ids array<long>, kinds binary, counts binary, codes binary, classes binary, "
    "vocabulary array<binary>, seen array<long>, n_training long"
)
_CHUNK_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("kinds", "counts", "codes", "classes")]
    + [("vocabulary", pa.list_(pa.binary())), ("seen", pa.list_(pa.int64())), ("n_training", pa.int64())]
)
#: Kinds of documents.
_HELD_OUT, _TRAINING = 0, 1


def chunks(docs: DataFrame, training: Column) -> DataFrame:
    """One row per slice of documents; ``seen`` counts each word over its training documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 33
        for part in slices(batches):
            flat, counts = words_of(texts_of(part))
            codes, vocabulary = coded(flat)
            kinds = part.column("kind").to_numpy(zero_copy_only=False).astype(np.uint8)
            seen = np.bincount(codes[np.repeat(kinds >= _TRAINING, counts)], minlength=len(vocabulary))
            row = {
                "chunk": [chunk],
                "doc_ids": [part.column("doc_id").to_pylist()],
                "kinds": [kinds.tobytes()],
                "counts": [counts.astype("<u4").tobytes()],
                "codes": [codes.astype(_code_type(len(vocabulary))).tobytes()],
                "classes": [np.fromiter(map(word_class, vocabulary), "<u2", len(vocabulary)).tobytes()],
                "vocabulary": [vocabulary],
                "seen": [seen],
                "n_training": [int((kinds >= _TRAINING).sum())],
            }
            yield record(row, _CHUNK_SCHEMA)
            chunk += 1

    kind = F.when(F.coalesce(training, F.lit(False)), _TRAINING).otherwise(_HELD_OUT)
    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), kind.alias("kind"))
    return columns.mapInArrow(cut, _CHUNKS)


def _code_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _numbers(batch: pa.RecordBatch, name: str, row: int, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


def _sequences(batch: pa.RecordBatch, row: int, least_kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a chunk's documents of this kind or above, each with its end, and their lengths."""
    counts = _numbers(batch, "counts", row, "<u4").astype(np.int64)
    keep = _numbers(batch, "kinds", row, "u1") >= least_kind
    classes = _numbers(batch, "classes", row, "<u2")
    codes = _numbers(batch, "codes", row, _code_type(len(classes)))
    counts, classes = counts[keep], classes[codes[np.repeat(keep, counts)]]
    return np.insert(classes, np.cumsum(counts), 0).astype(np.int32), counts + 1


def baum_welch(corpus: DataFrame, model: States, window: int = WINDOW) -> States:
    """One round over the training documents; without any the model stays as it is."""
    spark = corpus.sparkSession
    k = len(model.start)
    shared = spark.sparkContext.broadcast(model)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        starts, moved, emitted = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
        for batch in batches:
            for row in range(batch.num_rows):
                classes, counts = _sequences(batch, row, _TRAINING)
                if not len(counts):
                    continue
                pieces = -(-counts // window)
                lengths = np.full(int(pieces.sum()), window)
                lengths[np.cumsum(pieces) - 1] = counts - (pieces - 1) * window
                begins_text = np.zeros(len(lengths), bool)
                begins_text[starts_of(pieces)[:-1]] = True
                found = expected_counts(model, classes, lengths, begins_text)
                starts, moved, emitted = starts + found[0], moved + found[1], emitted + found[2]
        # Key -1 holds the starts, -2 and below the moves from each state.
        keys = [-1, *range(-2, -2 - k, -1), *range(CLASSES)]
        values = np.vstack([starts, moved, emitted])
        filled = values.any(axis=1)
        rows = {f"v{s}": values[filled, s] for s in range(k)}
        yield pa.RecordBatch.from_pydict({"key": np.array(keys)[filled]} | rows)

    schema = "key long, " + ", ".join(f"v{s} double" for s in range(k))
    columns = corpus.select("kinds", "counts", "codes", "classes")
    summed = columns.mapInArrow(expect, schema).groupBy("key").agg(*(F.sum(f"v{s}").alias(f"v{s}") for s in range(k)))
    starts, moved, emitted = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
    for row in summed.collect():  # at most 1 + k + CLASSES rows
        if row[0] >= 0:
            emitted[row[0]] = row[1:]
        elif row[0] == -1:
            starts[:] = row[1:]
        else:
            moved[-2 - row[0]] = row[1:]
    if not emitted.any():
        return model
    return next_states(starts, moved, emitted)


@dataclass
class Totals:
    """Training tokens and distinct ones, over all and by class."""

    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


@dataclass
class LanguageModel:
    states: States
    totals: Totals
    words: DataFrame


def train(corpus: DataFrame, states: int = STATES) -> LanguageModel:
    """Count all training words and fit the states. ``corpus`` holds stored chunks."""
    entries = corpus.select(F.inline(F.arrays_zip("vocabulary", "seen"))).filter("seen > 0")
    counted = entries.groupBy(F.col("vocabulary").alias("word")).agg(F.sum("seen").alias("n"))
    words = materialize(counted, "words")

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            classes = np.fromiter(map(word_class, batch.column("word").to_pylist()), np.int64, batch.num_rows)
            np.add.at(tokens, classes, batch.column("n").to_numpy())
            distinct += np.bincount(classes, minlength=CLASSES)
        at = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_pydict({"class": at.astype(np.int32), "tokens": tokens[at], "words": distinct[at]})

    summed = words.mapInArrow(by_class, "class int, tokens long, words long").groupBy("class")
    class_tokens, class_distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in summed.agg(F.sum("tokens"), F.sum("words")).collect():  # at most CLASSES rows
        class_tokens[row[0]], class_distinct[row[0]] = row[1], row[2]
    ends = corpus.agg(F.sum("n_training")).first()[0] or 0
    class_tokens[0], class_distinct[0] = ends, min(1, ends)
    model = first_states(states)
    for _ in range(ROUNDS):
        model = baum_welch(corpus, model)
    totals = Totals(int(class_tokens.sum()), int(class_distinct.sum()), class_tokens, class_distinct)
    return LanguageModel(model, totals, words)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def score(corpus: DataFrame, model: LanguageModel, alpha: float = ALPHA) -> DataFrame:
    """log10 probability of each document by the states, and by single words alone.

    Each chunk's own vocabulary is joined with the counts; what comes back to a chunk is
    one number per word of it, so no task holds more than its chunk.
    """
    entries = corpus.select("chunk", F.posexplode("vocabulary").alias("at", "word"))
    counted = entries.join(model.words.select("word", "n"), "word").select("chunk", "at", "n")
    known = counted.groupBy("chunk").agg(
        F.collect_list(F.struct(F.col("at"), F.col("n"))).alias("known")
    )
    columns = ["doc_ids", "kinds", "counts", "codes", "classes"]
    joined = corpus.select("chunk", *columns).join(known, "chunk", "left").select(*columns, "known")
    shared = corpus.sparkSession.sparkContext.broadcast((model.states, model.totals))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, totals = shared.value
        unit = math.log10(totals.tokens + alpha * (totals.distinct + 1))
        class_unit = np.log10(totals.class_tokens + alpha * (totals.class_distinct + 1))
        for batch in batches:
            for row in range(batch.num_rows):
                classes = _numbers(batch, "classes", row, "<u2")
                n = np.zeros(len(classes), np.int64)
                known = batch.column("known")[row]
                if known.is_valid:
                    n[known.values.field("at").to_numpy()] = known.values.field("n").to_numpy()
                codes = _numbers(batch, "codes", row, _code_type(len(classes)))
                counts = _numbers(batch, "counts", row, "<u4").astype(np.int64)
                logs = np.log10(n + alpha)
                end = math.log10(totals.class_tokens[0] + alpha)
                base = sums(logs[codes], counts) + end - (counts + 1) * unit
                within = sums((logs - class_unit[classes])[codes], counts) + end - class_unit[0]
                hidden = log_likelihood(states, *_sequences(batch, row, _HELD_OUT))
                found = {
                    "doc_id": batch.column("doc_ids")[row].values,
                    "held_out": _numbers(batch, "kinds", row, "u1") == _HELD_OUT,
                    "n_tokens": counts + 1,
                    "n_known": sums((n > 0).astype(np.int64)[codes], counts) + int(totals.class_tokens[0] > 0),
                    "train_tokens": np.full(len(counts), totals.tokens),
                    "base_score": base,
                    "score": within + hidden,
                }
                yield record(found, _SCORE_SCHEMA)

    return joined.mapInArrow(run, _SCORES)


def stored_chunks(docs: DataFrame, training: Column) -> DataFrame:
    path = fresh_path(docs.sparkSession, "chunks")
    chunks(docs, training).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def score_documents(docs: DataFrame, training: Column) -> DataFrame:
    """Train on the rows where ``training`` holds and score every row."""
    corpus = stored_chunks(docs, training)
    return score(corpus, train(corpus))
