"""The states of the language model against plain enumeration, and on small and empty training sets."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import markov
from lamina.session import materialize


def plain_round(model, texts):
    """Expected counts by going through all paths of states, then the maximisation step."""
    k = len(model.start)
    starts, moved, emitted = np.zeros(k), np.zeros((k, k)), np.zeros((markov.CLASSES, k))
    for symbols in texts:
        paths = list(product(range(k), repeat=len(symbols)))
        chances = []
        for path in paths:
            p = model.start[path[0]] * model.emit[path[0], symbols[0]]
            for a, b, symbol in zip(path, path[1:], symbols[1:]):
                p *= model.move[a, b] * model.emit[b, symbol]
            chances.append(p)
        for path, p in zip(paths, np.array(chances) / sum(chances)):
            starts[path[0]] += p
            for a, b in zip(path, path[1:]):
                moved[a, b] += p
            for state, symbol in zip(path, symbols):
                emitted[symbol, state] += p
    return markov.next_states(starts, moved, emitted)


def table(spark, texts):
    rows = list(enumerate(texts))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_a_round_equals_plain_enumeration(spark):
    """Three partitions, held-out documents, an empty and a null text; every training document counts."""
    texts = ["red fox runs", "red hen", None, "", "fox", "blue hen runs red", "held out words"]
    corpus = materialize(markov.chunks(table(spark, texts), F.col("doc_id") < 6), "chunks")
    model = markov.first_states(3)
    found = markov.baum_welch(corpus, model)
    words = [[markov.word_class(w.encode()) for w in (t or "").split()] + [0] for t in texts[:6]]
    wanted = plain_round(model, words)
    for name in ("start", "move", "emit"):
        assert getattr(found, name) == pytest.approx(getattr(wanted, name), rel=1e-4)


def test_only_the_first_window_of_a_text_is_a_start(spark):
    corpus = materialize(markov.chunks(table(spark, ["a b c d e f g"]), F.lit(True)), "chunks")
    model = markov.first_states(2)
    found = markov.baum_welch(corpus, model, window=3)
    symbols = np.array([markov.word_class(w) for w in (b"a", b"b", b"c")])
    first = markov.expected_counts(model, symbols, np.array([3]))[0]
    assert found.start == pytest.approx((first + 1) / (first + 1).sum(), rel=1e-5)


def test_states_stay_apart_on_few_documents(spark):
    texts = [f"{w} {w} little {w}" for w in ("apple", "river", "stone", "cloud") for _ in range(5)]
    corpus = materialize(markov.chunks(table(spark, texts), F.lit(True)), "chunks")
    states = markov.train(corpus).states
    for a in range(markov.STATES):
        for b in range(a):
            assert np.abs(states.emit[a] - states.emit[b]).max() > 1e-6


def test_without_training_documents_the_states_stay(spark):
    corpus = materialize(markov.chunks(table(spark, ["a b", "c"]), F.lit(False)), "chunks")
    model = markov.first_states()
    found = markov.baum_welch(corpus, model)
    assert all((getattr(found, n) == getattr(model, n)).all() for n in ("start", "move", "emit"))
