"""Token alignment against both libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lamina.llm import alignment, byte_ids, queries

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(byte_ids.vocabulary_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=byte_ids.vocabulary_path(alignment.PIECE_BPE))


def byte_of():
    """The byte-level alphabet, from the rule of its printable characters."""
    known = {i for i in range(256) if chr(i).isprintable() and chr(i) != " " and i != 0xAD and not 0x7F <= i <= 0xA0}
    out, n = {chr(i): i for i in known}, 0
    for i in range(256):
        if i not in known:
            out[chr(256 + n)] = i
            n += 1
    return out


def plain(rows, libraries):
    a, b = libraries
    values = byte_of()
    aligned = []
    for doc_id, text in rows:
        ids_a, ids_b = [], []
        if text:
            spelt = (" " + text).encode()
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(values[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [
                bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                for i in ids_b
            ]
            if b"".join(bytes_a) != spelt or b"".join(bytes_b) != spelt:
                ids_a, ids_b = [], []
        groups, links = [], []
        i = j = at_a = at_b = 0
        own_a, own_b = [], []
        while i < len(ids_a) or j < len(ids_b):
            links.append((ids_a[i], ids_b[j]))
            end_a, end_b = at_a + len(bytes_a[i]), at_b + len(bytes_b[j])
            if end_a <= end_b:
                own_a.append(ids_a[i])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                own_b.append(ids_b[j])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                own_a, own_b = [], []
        aligned.append((doc_id, len(ids_a), len(ids_b), groups, links))
    counts = Counter(pair for *_, links in aligned for pair in set(links))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return Counter(
        (d, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links),
         sum(counts[p] for p in links), ";".join(groups))
        for d, n_a, n_b, groups, links in aligned
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    parts = ["the", "The", "running", " ", "  ", "\n", " \n", "\n ", "\t", "é", "é", "日本語", "😀", "ΑΣ", "'s",
             "12", "345", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", ".", "...", " ", "　", "\x85",
             "\x1c", "\0", "ﬁ", "ß", "unbelievable", "Straße", "x" * 40, "​", "-", "_"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(12))) for _ in range(700)]
    texts += [None, "", " ", "  ", " a", "a ", "a▁b c", "▁", "a b", "a b", "the running man " * 3000, "x" * 20_000]
    ids = [i // 2 if i % 7 else None for i in range(len(texts))]
    return list(zip(ids, texts))


def found(docs, **options):
    return Counter(tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, **options).collect())


def test_equals_the_libraries(spark, rows, libraries):
    docs = spark.createDataFrame([(*r, "g", 1) for r in rows], "doc_id long, text string, groups string, key long")
    assert found(docs.repartition(5)) == plain(rows, libraries)


def test_forgetting_pieces_changes_nothing(rows, monkeypatch):
    tokens = alignment._tokens(byte_ids.vocabulary_path(), byte_ids.vocabulary_path(alignment.PIECE_BPE))
    texts = [t for _, t in rows if t]
    seen = []
    for kept in (alignment.KEPT_BYTES, 0):
        monkeypatch.setattr(alignment, "KEPT_BYTES", kept)
        aligner, own = alignment.Aligner(*tokens, with_groups=True), []
        for k in range(0, len(texts), 10):
            numbers, counts, _ = aligner.pieces(pa.array(texts[k : k + 10]))
            own.append((counts.tolist(), aligner.counts[numbers].tolist(), [aligner.groups[i] for i in numbers]))
        seen.append(own)
        assert (len(aligner.known) > 100) == (kept > 0)
    assert seen[0] == seen[1]


def test_small_blocks_change_nothing(spark, rows, libraries, monkeypatch):
    for name, value in (("TEXT_BYTES", 500), ("BUCKET", 7), ("COUNTS", 64), ("HELD", 50)):
        monkeypatch.setattr(alignment, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == plain(rows, libraries)


def test_empty_tables(spark):
    schema = "doc_id long, text string"
    assert found(spark.createDataFrame([], schema)) == {}
    docs = spark.createDataFrame([(1, None), (1, ""), (None, None)], schema)
    assert found(docs) == {(1, *[0] * 6, ""): 2, (None, *[0] * 6, ""): 1}


def test_digest(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    groups = alignment.align(docs).select("doc_id", F.sha2("groups", 256).alias("plain"))
    both = queries.op13_alignment(spark, folder).join(groups, "doc_id")
    wrong = both.filter("groups_sha256 != plain and not (groups_sha256 = '' and n_links = 0)")
    assert both.count() == docs.count() and wrong.isEmpty()
    assert hashlib.sha256(b"").hexdigest() not in {r.groups_sha256 for r in both.collect()}


def test_index_is_minimal_perfect_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000))
    for n_buckets in (1, 13):
        bucket = alignment.bucket_of(keys, n_buckets)
        index = alignment.PairIndex.of([alignment.bucket_levels(keys[bucket == i]) for i in range(n_buckets)])
        places = index.places(keys)
        assert sorted(places.tolist()) == list(range(len(keys)))
        index.keys = np.empty_like(keys)
        index.keys[places] = keys
        assert (index.find(keys) == places).all()
        assert (index.find(keys + (1 << 41)) == -1).all()
    nothing = alignment.PairIndex.of([[]])
    nothing.keys = keys[:0]
    assert nothing.find(keys[:5]).tolist() == [-1] * 5
