"""Pieces that texts are cut into, and which of them are remembered."""

from itertools import product

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from lamina.llm import byte_ids, common
from lamina.llm.common import slices, starts_of


def whole(texts):
    tokenizer = Tokenizer.from_file(byte_ids.vocabulary_path())
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def cut(coder, texts):
    flat, counts = coder.encode(texts)
    starts = starts_of(counts)
    return [flat[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_pieces_at_stops_and_line_breaks_have_the_ids_of_the_whole():
    parts = ["a", "É", "ß.", "9", "'s", "'", "_", ".", "!!", "\n", " ", "日", "\t", "…", "İ"]
    texts = ["".join(p) for n in (1, 2, 3, 4) for p in product(parts, repeat=n)]
    texts += ["\n", "\nWord.\nWord!!\nit's. (so)\n", "end.\n\n", "l'eau,l'air;d'où?", "x\0.y", "a<|endoftext|>.b", "a.\r\nb"]
    assert cut(byte_ids.PieceEncoder(byte_ids.vocabulary_path()), texts) == whole(texts)


def test_words_with_other_stops_are_one_piece():
    coder = byte_ids.PieceEncoder(byte_ids.vocabulary_path())
    coder.encode(["word, word. word! word\nword; word", "word"])
    assert {p for p in coder.known if "word" in p} == {"word", "\0word"}


def test_a_full_memory_keeps_what_came_again(monkeypatch):
    monkeypatch.setattr(byte_ids, "KEPT_BYTES", 100_000)
    coder = byte_ids.PieceEncoder(byte_ids.vocabulary_path())
    random = np.random.default_rng(2)
    seen = []
    for call in range(12):
        text = " ".join(["x often again"] + [f"w{n}" for n in random.integers(0, 1 << 40, 150)])
        seen.append("often" in coder.known)
        assert cut(coder, [text, ""]) == whole([text, ""])
        assert coder.bytes < 200_000
    assert "again" in coder.known and all(seen[1:]) and len(coder.known) < 12 * 150


def test_each_batch_of_texts_gives_its_memory_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    class Arrow:
        RecordBatch = pa.RecordBatch
        default_memory_pool = Pool

    monkeypatch.setattr(common, "pa", Arrow)
    batches = [pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 30]})] * 2
    assert [part.num_rows for part in slices(iter(batches), limit=10)] == [2, 1, 2, 1]
    assert len(released) == len(batches)


def test_new_pieces_reach_the_tokenizer_as_few_texts():
    coder, given = byte_ids.PieceEncoder(byte_ids.vocabulary_path()), []
    tokenizer = coder.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **more)

    coder.tokenizer = Counted()
    text = " ".join(f"w{n}" for n in range(1000))
    assert cut(coder, [text]) == whole([text])
    assert len(given) <= 6
