"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, words string"


def plain(rows, longest=3, least=10, redundant=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = {
        (lang, words[i:j])
        for (lang, words), a in found.items()
        for i in range(len(words))
        for j in range(i + 2, len(words) + 1)
        if j - i < len(words) and 100 * a >= redundant * f[lang, words[i:j]]
    }
    by_lang = {}
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            cuts = range(1, len(words))
            score, k = min((1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in cuts)
            entry = (-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]])
            by_lang.setdefault(lang, []).append(entry)
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, entries in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(entries)[:top], 1)
    )


def found(docs, **options):
    return sorted(tuple(r) for r in collocations.top_phrases(docs, **options).collect())


@pytest.fixture(scope="module")
def texts():
    """Random texts of few words, so counts tie and phrases nest; odd bytes, long and empty ones."""
    draw = random.Random(5)
    vocabulary = ["the", "The", "of", "x\0y", "é", "ΑΣ", "a\x1cb", "日本", "'s", "b-c", " ", "zz"]
    glue = [" ", "  ", "\t", ". ", ",", "\n", " ; ", "!?", "\x0b"]
    rows = []
    for i in range(400):
        words = [draw.choice(vocabulary[: draw.choice([3, 12])]) for _ in range(draw.choice([0, 1, 3, 40]))]
        text = "".join(w + draw.choice(glue[: draw.choice([1, 2, 9])]) for w in words)
        rows.append((i // 2, text, draw.choice(["en", "de", "", "und", None])))
    rows += [(None, None, None), (1, "", "en"), (2, " .\n", "fr"), (3, "new york city " * 4000, "en")]
    return rows


def test_equals_plain_counting(spark, texts):
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in texts], SCHEMA)
    plainly = plain([(t, lang) for _, t, lang in texts])
    assert {r[0] for r in plainly} >= {"en", "de", "und", ""}
    assert found(docs) == plainly


@pytest.mark.parametrize("options", [{"longest": 2}, {"longest": 4, "least": 3}, {"redundant": 90, "top": 3}])
def test_other_lengths_and_limits(spark, texts, options):
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in texts], SCHEMA)
    assert found(docs, **options) == plain([(t, lang) for _, t, lang in texts], **options)


def test_stream_over_many_tasks(spark, texts, settings):
    """Ranges that begin in the middle of the phrases of one hot first word."""
    settings(spark__sql__shuffle__partitions="61", spark__sql__adaptive__coalescePartitions__enabled="false")
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in texts], SCHEMA).repartition(7)
    options = {"least": 2, "redundant": 100}
    assert found(docs, **options) == plain([(t, lang) for _, t, lang in texts], **options)


def test_full_counters_and_small_holds_change_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_COUNTERS", 16)
    monkeypatch.setattr(collocations, "MOST_COUNTERS", 16)
    monkeypatch.setattr(collocations, "HELD", 500)
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in texts], SCHEMA)
    assert found(docs) == plain([(t, lang) for _, t, lang in texts])


def test_empty_tables(spark):
    for rows in ([], [(1, None, None, None, None, None)]):
        docs = spark.createDataFrame(rows, SCHEMA)
        assert found(docs) == []


def test_scores_pass_64_bits(spark):
    values = [(10**12, 10**12 + 7, 3 * 10**12), (5, 7, 9), (4_294_967_296, 4_294_967_297, 4_294_967_299)]
    frame = spark.createDataFrame(values, "a long, l long, r long")
    scores = frame.select(collocations.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in scores] == [1_000_000 * a * a // (b * c) for a, b, c in values]


def test_counters_rule_out_only_rare_phrases(spark, texts):
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in texts], SCHEMA)
    frequent = np.unpackbits(collocations.frequent_counters(docs, 3, 10, 20))
    assert 0 < frequent.sum() < 2000
