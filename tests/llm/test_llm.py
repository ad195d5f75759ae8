"""Each operator against a plain version, on edge rows and small tables."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lamina.llm import (
    ann,
    byte_ids,
    jaccard_join,
    language,
    markov,
    packing,
    queries,
    segment_bpe,
    simhash,
    token_files,
    toxicity,
    warc_archive,
)
from lamina.session import fresh_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
EDGE = [
    (1, "a b c d"), (2, ""), (3, None), (4, "  \n "), (5, "A B\tC  d"), (6, "a b c d"), (6, "a b c d"),
    (None, "x y z"), (8, "one"), (9, "it's 12 <|endoftext|>  ΑΣ  é \x1c日本"), (10, "q " * 30_000), (11, "$%&"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge rows with a column whose name clashes with results."""
    rows = [(i, t, "en", 0.5) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def words(text):
    return WORD.findall((text or "").encode().lower())


def test_segment_tree_equals_the_library(edge, none):
    reference = Tokenizer.from_file(segment_bpe.vocabulary_path())
    found = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in
                    segment_bpe.encode_documents(edge, segment_bpe.vocabulary_path()).collect())
    expected = Counter()
    for i, t in EDGE:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        expected[i, tuple(ids), reference.decode(ids, skip_special_tokens=False)] += 1
    assert found == expected
    assert segment_bpe.encode_documents(none, segment_bpe.vocabulary_path()).count() == 0


def test_merges_take_the_leftmost_lowest_rank():
    ranked = [(1, 2, 3), (3, 3, 4), (0, 1, 5)]
    merges = segment_bpe.Merges(ranked, 6)
    table = {(a, b): (r, m) for r, (a, b, m) in enumerate(ranked)}

    def plain(piece):
        while True:
            pairs = [(table[p][0], i) for i, p in enumerate(zip(piece, piece[1:])) if p in table]
            if not pairs:
                return piece
            _, i = min(pairs)
            piece = piece[:i] + [table[piece[i], piece[i + 1]][1]] + piece[i + 2 :]

    random = np.random.default_rng(1)
    pieces = [random.integers(0, 3, n).tolist() for n in (*range(1, 40), 600)]
    assert merges.apply(pieces) == [plain(p) for p in pieces]


def test_ranks_round_trip():
    for ranks in ([], [0], [255, 256, 65_535, 65_536, 1 << 24, (1 << 32) - 1], range(1001)):
        ranks = np.array(ranks, np.uint32)
        assert (token_files.unpack_ranks(*token_files.pack_ranks(ranks), len(ranks)) == ranks).all()


def test_ranks_of_two_bytes_are_masked_as_two_bytes():
    for ranks, width in ([], 2), ([1, 65_535], 2), ([1, 65_536], 4):
        control, _ = token_files.pack_ranks(np.array(ranks, np.uint32))
        lengths = token_files.LENGTHS[np.frombuffer(control, np.uint8)]
        assert token_files._width(lengths).itemsize == width


def test_token_files_hold_all_ids_in_order(spark, edge):
    path = fresh_path(spark, "test-tokens")
    token_files.write_token_files(edge, path, byte_ids.vocabulary_path())
    reference = Tokenizer.from_file(byte_ids.vocabulary_path())
    found = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for row, (i, t) in zip(found, sorted(EDGE, key=lambda e: -1 if e[0] is None else e[0]), strict=True):
        ids = reference.encode(t or "", add_special_tokens=False).ids + [0]
        assert (row.doc_id, row.start, list(row.ids)) == (i, at, ids)
        at += len(ids)
    digests = sorted(tuple(r) for r in token_files.read_digests(spark, path).filter("doc_id = 1").collect())
    assert digests[0][3] == zlib.crc32(np.array(found[1].ids, "<u4").tobytes())


def test_no_tokens_of_no_documents(spark, none):
    path = fresh_path(spark, "test-tokens")
    token_files.write_token_files(none, path, byte_ids.vocabulary_path())
    assert token_files.read_digests(spark, path).count() == 0


def test_packing_keeps_each_id_once(edge, none):
    reference = Tokenizer.from_file(byte_ids.vocabulary_path())
    pieces = packing.pack(edge, byte_ids.vocabulary_path(), with_ids=True).collect()
    expected = Counter()
    for _, t in EDGE:
        expected.update(reference.encode(t or "", add_special_tokens=False).ids + [1])
    assert Counter(i for p in pieces for i in p.ids) == expected
    for _, own in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), lambda p: p.sequence_id):
        at = 0
        for p in own:
            assert p.offset == at and p.length == len(p.ids) > 0
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            at += p.length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.pack(none, byte_ids.vocabulary_path()).count() == 0


def test_forward_recursion_is_exact():
    random = np.random.default_rng(2)
    k, c = 3, markov.CLASSES
    model = markov.first_states(k)
    classes, counts = random.integers(0, c, 7), np.array([4, 0, 3])
    found = markov.log_likelihood(model, classes, counts)
    for value, own in zip(found, (classes[:4], [], classes[4:])):
        total = sum(
            math.prod(
                (model.start[s] if not t else model.move[path[t - 1], s]) * model.emit[s, own[t]]
                for t, s in enumerate(path)
            )
            for path in itertools.product(range(k), repeat=len(own))
        )
        assert value == pytest.approx(math.log10(total))
    starts, moved, emitted, likelihood = markov.expected_counts(model, classes, np.array([4, 3]))
    assert starts.sum() == pytest.approx(2, rel=1e-4) and moved.sum() == pytest.approx(5, rel=1e-4)
    assert emitted.sum() == pytest.approx(7, rel=1e-4)
    assert likelihood == pytest.approx(markov.log_likelihood(model, classes, np.array([4, 3])).sum(), rel=1e-4)


def test_language_model_counts(edge, none):
    training = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    found = Counter(tuple(r)[:6] for r in markov.score_documents(edge, training).withColumn(
        "base_score", F.round("base_score", 6)).collect())
    seen = Counter()
    for i, t in EDGE:
        if i is not None and i % 2 == 0:
            seen.update([*words(t), b" "])
    n, v = sum(seen.values()), len(seen)
    expected = Counter()
    for i, t in EDGE:
        own = [*words(t), b" "]
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        held = not (i is not None and i % 2 == 0)
        expected[i, held, len(own), sum(seen[w] > 0 for w in own), n, round(base, 6)] += 1
    assert found == expected
    assert markov.score_documents(none, F.lit(True)).count() == 0


def plain_classes(rows, width, over, under):
    sets = [
        (i, {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if (w := words(t)) else set())
        for i, t in rows
    ]
    label = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for (i, a), (j, b) in itertools.combinations(sets, 2):
            if a and b and under * len(a & b) >= over * len(a | b) and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return Counter((i, len(s), label[i]) for i, s in sets)


@pytest.mark.parametrize("width, over", [(3, 90), (5, 80)])
def test_classes_equal_all_pairs(spark, width, over):
    random = np.random.default_rng(3)
    rows = [(i, t) for i, t in EDGE if i not in (None, 10)]
    for _ in range(4):
        base = random.integers(0, 60, random.choice([15, 40, 90])).tolist()
        for _ in range(25):
            own = list(base)
            for at in random.integers(0, len(own), random.integers(0, 4)):
                own[at] = int(random.integers(0, 60))
            rows.append((100 + len(rows), " ".join(f"w{x}" for x in own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(tuple(r) for r in jaccard_join.link_classes(docs, width, over, 100).collect())
    assert found == plain_classes(rows, width, over, 100)
    kept = [r.doc_id for r in jaccard_join.one_of_each_class(docs, width, over, 100).collect()]
    assert sorted(kept) == sorted({label for _, _, label in plain_classes(rows, width, over, 100)})


def test_copies_go_by_row(spark):
    """Rows are judged by their own text: ids may be shared or null, columns may have any name."""
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join([*base[:-1], "x"]), " ".join(f"v{i}" for i in range(60))
    base = " ".join(base)
    rows = [(3, base), (7, near), (7, other), (None, base), (None, near), (None, "only null"), (None, "only null"),
            (8, other + " y"), (9, ""), (9, ""), (9, None), (None, ""), (None, " ")]
    rows = [(i, t, str(n), True) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copy string, row boolean")
    kept = jaccard_join.one_of_each_class(docs, 5, 80, 100)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found == Counter(
        [(3, base), (7, other), (None, "only null"), (9, ""), (9, None), (None, ""), (None, " ")]
    )
    assert jaccard_join.one_of_each_class(docs.limit(0), 5, 80, 100).count() == 0


def test_link_counts_equal_all_pairs(spark, monkeypatch):
    """All links of classes of several blocks and of equal texts, against each pair of rows."""
    random = np.random.default_rng(8)
    rows = [(i, t) for i, t in EDGE if i != 10]
    for size in (40, 60, 200):
        base = random.integers(0, 400, size).tolist()
        for _ in range(40):
            own = list(base[: size - int(random.integers(0, 4))])
            for at in random.integers(0, len(own), random.integers(0, 2)):
                own[at] = int(random.integers(0, 400))
            rows += [(100 + len(rows), " ".join(f"w{x}" for x in own))] * int(random.integers(1, 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [(i, {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if (w := words(t)) else set()) for i, t in rows]
    expected = Counter()
    for at, (i, a) in enumerate(sets):
        near = [j for other, (j, b) in enumerate(sets) if other != at and a and 100 * len(a & b) >= 90 * len(a | b)]
        expected[i, len(a), None if i is None else sum(j is not None for j in near)] += 1
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    found = jaccard_join.link_counts(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    found = found.collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in found) == expected
    assert max(r.n_links for r in found if r.n_links is not None) > 32
    assert queries.op5_jaccard_join(spark, "/root/testdata/sf0.001").columns[-1] == "n_links"


def test_classes_of_edge_rows(edge, none):
    found = {r.doc_id: r.component_id for r in jaccard_join.link_classes(edge).collect()}
    assert found[5] == found[6] == found[1] == 1 and found[2] == 2 and found[3] == 3 and found[None] is None
    assert jaccard_join.link_classes(none).count() == 0


def test_shingle_counters_reach_the_driver_packed(spark, edge, monkeypatch):
    """No pandas on the driver, and no row per counter; the counts are those of a plain version."""
    kind, rows = type(edge), []
    collect = kind.collect
    monkeypatch.setattr(kind, "toPandas", None)
    monkeypatch.setattr(kind, "collect", lambda self: rows.append(collect(self)) or rows[-1])
    many = spark.range(300).select(F.expr("concat('w', id, ' x y ', id, ' z')").alias("text")).union(edge.select("text"))
    found = jaccard_join.shingle_counts(many.repartition(3))
    sets = jaccard_join._shingles([r.text or "" for r in collect(many)], jaccard_join.SHINGLE)
    plain = np.bincount(jaccard_join._counter_of(np.concatenate(sets)), minlength=jaccard_join.COUNTERS)
    assert (found == plain).all() and len(rows[0]) < 100 < np.count_nonzero(found)
    assert not jaccard_join.shingle_counts(edge.limit(0)).any()


def test_language_centroids(spark, folder, edge, none):
    found = queries.op4_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    share = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.9
    assert language.fit(none, F.lit(True)) is None
    predicted = language.predict(edge, language.fit(edge, F.lit(True)))
    assert predicted.columns[:4] == edge.columns and predicted.count() == len(EDGE)
    by_id = {r.doc_id: r for r in predicted.collect()}
    assert by_id[2].lid_language == by_id[3].lid_language == by_id[11].lid_language == "und"
    assert by_id[1].lid_language == "en" and 0 <= by_id[1].lid_score <= 1
    assert language.predict(edge, None).filter("not lid_rejected").count() == 0


def test_language_rejects_foreign_texts(spark, folder):
    """Random letters and languages that were not learned go; held-out documents of learned ones stay."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.col("doc_id") % 4 == 2
    random = np.random.default_rng(6)
    foreign = ["".join(map(chr, random.integers(97, 123, n))) for n in (6, 60, 600)]
    foreign += [" ".join(foreign[2][i : i + 7] for i in range(0, 600, 7)), hashlib.sha256(b"").hexdigest()]
    foreign += ["Minden ember szabadnak születik és egyenlő méltósága és joga van.", "Все люди рождаются свободными"]
    more = spark.createDataFrame([(4 * i + 2, t, None) for i, t in enumerate(foreign, 10**9)], docs.schema)
    model = language.fit(docs, ~held_out)
    found = language.predict(docs.filter(held_out).union(more), model).collect()
    assert {r.lid_rejected for r in found if r.doc_id >= 10**9} == {True}
    own = [r for r in found if r.doc_id < 10**9]
    assert {r.lang for r in own} == set(model.languages)
    assert not any(r.lid_rejected for r in own if r.text and len(r.text) > 100)
    for name in sorted(set(model.languages)):
        unlearned = language.predict(docs.filter(F.col("lang") == name), language.fit(docs, F.col("lang") != name))
        assert unlearned.agg(F.avg(F.col("lid_rejected").cast("int"))).first()[0] > 0.98


def test_the_driver_gets_centroids_and_no_text_vectors(spark, monkeypatch):
    """Vectors of texts are clustered in tasks, and as a plain version on the driver clusters them."""
    random = np.random.default_rng(8)
    texts = {
        (i, name): " ".join("".join(random.choice(list(letters), 5)) for _ in range(30))
        for name, letters in (("aa", "abcdef"), ("zz", "uvwxyz"), ("", "klmnop"))
        for i in range(40)
    }
    rows = [(i, text, name) for (i, name), text in texts.items()] + [(41, None, "aa"), (42, "1", "01"), (43, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kind, held = type(docs), []
    collect = kind.collect

    def counted(self):
        found = collect(self)
        held.append(sum(len(v) for r in found for v in r if isinstance(v, (bytes, bytearray))))
        return found

    monkeypatch.setattr(kind, "collect", counted)
    model = language.fit(docs, F.lit(True))
    assert max(held) < 3 * language.CLUSTERS * 8 * language.FEATURES + 8 * len(rows)
    assert model.languages == sorted(model.languages) and set(model.languages) == {"aa", "zz", ""}
    for name in ("aa", "zz", ""):
        named = [text for _, text, own_name in rows if own_name == name and text]
        own = language._weighted(language.ngram_counts(named), model.idf).astype(np.float32)
        own = np.array(sorted(own, key=lambda v: v.tobytes()), np.float64)
        plain, member = language.cluster(own, language.CLUSTERS)
        plain = plain[[c for c in range(len(plain)) if (member == c).any()]]
        assert np.allclose(model.vectors[[n == name for n in model.languages]], plain, atol=1e-9)


def test_one_odd_row_does_not_move_the_limit():
    random = np.random.default_rng(7)
    rows = np.abs(random.normal(1, 0.2, (300, 50)))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    odd = np.vstack([rows, np.eye(50)[:1]])
    whole, with_odd = (
        language.limits(language.cosines_to_others(v, np.zeros(len(v), int), 1), ["en"])[0] for v in (rows, odd)
    )
    assert 0.6 < with_odd <= whole < 0.7 and whole - with_odd < 0.02
    apart = language.cosines_to_others(odd, np.r_[np.zeros(300, int), 1], 2)
    assert language.limits(apart, ["en", "en"]) == pytest.approx([whole, whole])


def test_toxicity(spark, edge, none):
    clean, toxic = "the quiet river runs by", "you are a vile idiot"
    rows = [(i, f"{toxic if i % 4 == 0 else clean} number {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    assert "=idiot" in model.lexicon.weights
    scored = toxicity.score(docs, model).collect()
    assert all((r.tox_score >= 0.5) == (r.doc_id % 4 == 0) for r in scored)
    out = toxicity.score(edge, model)
    assert out.columns == [*edge.columns, "tox_score"] and out.filter("tox_score between 0 and 1").count() == len(EDGE)
    unlabelled = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r.tox_score for r in toxicity.score(edge, unlabelled).collect()} == {0.0}
    assert toxicity.score(none, model).count() == 0


def test_archive_rebuilds_every_record(spark):
    pages = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/\r\nX: y", None), (4, "u", ""),
             (4, "u", ""), (None, "n", "<p>x</p>"), (7, "é", "日本" * 5000)]
    path = warc_archive.fresh_archive_path(spark)
    warc_archive.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    index = warc_archive.read_index(spark, path).collect()
    found = Counter(tuple(r)[:5] for r in index)
    digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    x, empty, long = "<p>x</p>", "", "日本" * 5000
    assert found == Counter(
        [(1, 8, digest(x), "revisit", 2), (2, 8, digest(x), "response", None), (None, 8, digest(x), "revisit", 2),
         (3, 0, digest(empty), "revisit", 4), (4, 0, digest(empty), "revisit", 4),
         (4, 0, digest(empty), "response", None), (7, 30_000, digest(long), "response", None)]
    )
    records = warc_archive.read_records(spark, path).collect()
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)$", head)[1])
        assert rest[length:] == b"\r\n\r\n" and b"\nX: y" not in head
        assert (rest[:length].endswith(r.payload) and r.record_type == "response") or r.record_type == "revisit"
    assert warc_archive.read_payloads(spark, path).count() == 3
    rebuilt = Counter((r.page_id, hashlib.sha256(r.record).hexdigest()) for r in records)
    assert Counter((r.page_id, r.record_sha256) for r in index) == rebuilt


def test_archive_of_no_pages(spark):
    path = warc_archive.fresh_archive_path(spark)
    warc_archive.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc_archive.read_index(spark, path).count() == 0


def test_fingerprint_search_equals_all_pairs(spark):
    random = np.random.default_rng(4)
    base = random.integers(-(1 << 63), (1 << 63) - 1, 20)
    stored = [int(b) ^ sum(1 << int(x) for x in random.integers(0, 62, n)) for b in base for n in (0, 1, 2, 3, 5)]
    frame = spark.createDataFrame([(f,) for f in stored] + [(None,)], "fingerprint long")
    found = {(r["query"], r.found) for r in simhash.search(frame, frame, radius=3).collect()}
    assert found == {(a, b) for a in stored for b in stored if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}


def test_edit_likeness(spark, edge, none):
    rows = sorted(((i, t or "") for i, t in EDGE if i not in (None, 6)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.edit_likeness(docs).collect()}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    assert found[2].fingerprint == found[3].fingerprint
    assert simhash.edit_likeness(edge).count() == len(EDGE) and simhash.edit_likeness(none).count() == 0


def test_near_documents_equal_all_pairs(spark, folder):
    found = queries.op3_simhash(spark, folder).select("doc_id", "fingerprint", "n_near").collect()
    own = [int(r.fingerprint, 16) for r in found]
    for r, a in zip(found, own):
        near = sum((a ^ b).bit_count() <= simhash.RADIUS for b in own) - 1
        assert r.n_near == (near if r.doc_id % simhash.EVERY == 0 else None)
    copies = spark.createDataFrame([(i, "a b c d" if i < 50 else f"e {i} f") for i in (*range(60), 20)], "doc_id long, text string")
    assert {r.n_near for r in simhash.edit_likeness(copies).collect() if r.doc_id in (0, 20, 40)} == {50}


def test_nearest_neighbours(spark, folder):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
            (6, [1.0, None]), (7, [-1.0, 0.0]), (8, [1.0]), (None, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.search(vectors, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 7, -1.0)]
    assert ann.search(vectors.limit(0), F.lit(True)).count() == 0
    # Two vectors under one id ask apart, and a repeated row asks once.
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = Counter(tuple(r) for r in ann.search(vectors, F.col("vec_id") == 0).collect())
    assert found == Counter([(0, 1, 1, 3.0), (0, 2, 2, 0.0), (0, 1, 2, 2.0), (0, 2, 1, 0.0)])
    whole = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, all_ = np.array([r.vec_id for r in whole]), np.array([r.embedding for r in whole], float)
    got = Counter((r.query_id, r.vec_id) for r in queries.op7_ann(spark, folder).collect())
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = np.where(ids == q, -np.inf, ann.exact(all_, all_[ids == q][0]))
        hits += sum((q, v) in got for v in ids[np.lexsort((ids, -score))[:20]])
    assert hits >= 0.9 * sum(got.values())


def test_pipeline_keeps_columns_and_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    total = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        docs = after
    assert 0.6 * total < docs.count() < total


def test_pipeline_keeps_clashing_columns(spark, folder):
    """Columns named like those an operator adds pass through with their own values."""
    names = ["lid_rejected", "lid_language", "lid_score", "tox_score", "tox_features", "tox_f0", "tox_vector", "tox_raw"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        assert after.count() > 0
        wrong = [F.col(n) != F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names]
        assert after.filter(reduce(lambda a, b: a | b, wrong)).count() == 0
    pieces = corpus_pipeline.pack_sequences(spark, docs, folder)
    assert pieces.filter("length > 0").select("doc_id").distinct().count() == docs.count()


def test_classes_of_links_in_parts(spark):
    """Chains, stars and later links against plain union-find; no links at all give no classes."""
    random = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    first = chain + [(7, i) for i in range(200, 230)] + [tuple(p) for p in random.integers(300, 360, (30, 2)).tolist()]
    first = [(min(p), max(p)) for p in first if p[0] != p[1]]
    later = [(150, 215), (340, 900), (901, 902)]

    def plain(links):
        root = {n: n for p in links for n in p}
        for _ in root:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return sorted(root.items())

    def frame(links):
        return spark.createDataFrame(links, "a long, b long").repartition(5)

    known = jaccard_join.components(frame(first))
    assert sorted(map(tuple, known.collect())) == plain(first)
    after = jaccard_join.merged(known, frame(later))
    assert sorted(map(tuple, after.collect())) == plain(first + later)
    assert jaccard_join.components(frame([])).isEmpty()
