"""Phrase collocations from count streams in prefix and suffix order.

Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and
tabs, with A-Z in lower case. A phrase of 2 to ``longest`` words that occurs at least
``least`` times in a language is a candidate. Every part of a candidate occurs at least
as often, so all counts that are ever needed belong to phrases of at least ``least``
occurrences: those are the count stream.

* Counting. A first pass throws every occurrence into hashed counters, whose number grows
  with the corpus; a counter below ``least`` rules its phrases out. A second pass counts the
  phrases that are left by their words, so the counts are exact.
* Prefix order. In a stream sorted by words, a phrase comes after all of its prefixes and
  each prefix is the last phrase of its length before it. One pass in lockstep, holding one
  count per length, gives the count of the left part of every cut. The stream is ranged by
  all of its words, so a common first word spreads over tasks; the rows before the first
  prefix of a task get it from a table of at most one row per task.
* Suffix order. The same over the words read backwards gives the count of the right part.
* Extension. A longer candidate knows the counts of itself without its last word (prefix
  order) and without its first (suffix order), and names those it makes redundant. Longer
  extensions need no look of their own: what lies between is a candidate and occurs as often.

Null texts are empty; a null language is ``und``. Rows with a null or repeated doc_id count
like any others, as doc_id takes no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import slices
from lamina.session import materialize

#: Words of the longest phrase, least occurrences, and the share (percent) of a phrase's
#: occurrences inside one longer candidate that makes it redundant.
LONGEST, LEAST, REDUNDANT = 3, 10, 50
#: Phrases returned for each language.
TOP = 2000
#: Counters for each byte of text (in 1/4), and their least and largest number as powers of
#: two. A full set of counters rules out less, and changes no result.
LEAST_COUNTERS, MOST_COUNTERS = 20, 31
#: Counters whose occurrences are shipped and summed together, and occurrences held by a task.
RANGE, HELD = 1 << 16, 1 << 22
#: Bytes of text that one task works on at once.
TEXT_BYTES = 8_000_000

# Fixed by the definition of words and pieces: 1 parts words, 2 parts pieces.
_PARTS = np.zeros(256, np.uint8)
_PARTS[[0x20, 0x09]] = 1
_PARTS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


class _Words:
    """The words of some texts: a code for each, its language and its piece."""

    def __init__(self, batch: pa.RecordBatch):
        texts = pc.fill_null(batch.column("text"), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _PARTS[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        # A text that ends in a word does not go on in the next text.
        borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        begins[borders] = inside[borders]
        ends[borders - 1] = inside[borders - 1]
        starts = np.flatnonzero(begins)
        lengths = np.flatnonzero(ends) + 1 - starts
        text = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(kind == 2, dtype=np.int64)[starts] + text
        packed = np.zeros(len(lengths) + 1, np.int32)
        np.cumsum(lengths, out=packed[1:])
        words = pa.Array.from_buffers(
            pa.string(), len(lengths), [None, pa.py_buffer(packed), pa.py_buffer(_LOWER[data[inside]])]
        ).dictionary_encode()
        self.codes, self.vocabulary = words.indices.to_numpy(), words.dictionary
        langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
        self.lang, self.langs = langs.indices.to_numpy()[text], langs.dictionary

    def phrases(self, length: int) -> np.ndarray:
        """Where a phrase of ``length`` words begins that lies within a piece."""
        n = len(self.piece) - length + 1
        return np.flatnonzero(self.piece[:n] == self.piece[length - 1 :]) if n > 0 else np.empty(0, np.int64)

    def counters(self, at: np.ndarray, length: int, bits: int) -> np.ndarray:
        """The counter of the phrase of ``length`` words at each of ``at``."""
        if not hasattr(self, "hashes"):
            self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary.to_pylist()], np.uint64)
            self.lang_hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.langs.to_pylist()], np.uint64)
        mixed = self.lang_hashes[self.lang[at]] + np.uint64(length)
        for k in range(length):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[0] + self.hashes[self.codes[at + k]] * _MIX[1]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[2]
        return (mixed >> np.uint64(64 - bits)).astype(np.uint32)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))


def counter_bits(docs: DataFrame) -> int:
    """Bits of a counter's number: about one counter for each four bytes of text."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return min(max(int(size // 4).bit_length(), LEAST_COUNTERS), MOST_COUNTERS)


def frequent_counters(docs: DataFrame, longest: int, least: int, bits: int) -> np.ndarray:
    """A bit for each counter: whether it was met ``least`` times.

    A task ships at most ``least`` occurrences of a counter out of every ``HELD`` it meets,
    two bytes each, so a phrase that makes up a third of the corpus is no hot spot. The
    result has a fixed size (``1 << bits`` bits, at most 256 MB).
    """

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> Iterator[pa.RecordBatch]:
            met = np.sort(np.concatenate(held))
            again = np.zeros(len(met), bool)  # the same counter stands ``least`` places before
            again[least:] = met[least:] == met[:-least]
            met = met[~again]
            block = (met >> np.uint32(16)).astype(np.int32)
            cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(met)].astype(np.int32)
            low = pa.py_buffer((met & np.uint32(RANGE - 1)).astype("<u2"))
            low = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts * 2), low])
            whole = pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), low], ["block", "met"])
            for k in range(0, whole.num_rows, 4096):
                yield whole.slice(k, 4096)

        for part in slices(batches, limit=TEXT_BYTES):
            words = _Words(part)
            held += [words.counters(words.phrases(n), n, bits) for n in range(1, longest + 1)]
            if sum(map(len, held)) >= HELD:
                yield from packed()
                held = []
        if sum(map(len, held)):
            yield from packed()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, None

        def found() -> pa.RecordBatch:
            bits_ = np.packbits(total >= least).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([bits_])], ["block", "bits"])

        for batch in batches:
            for block, met in zip(batch.column("block").to_pylist(), batch.column("met").to_pylist()):
                if block != own:
                    if own is not None:
                        yield found()
                    own, total = block, np.zeros(RANGE, np.int64)
                total += np.bincount(np.frombuffer(met, "<u2"), minlength=RANGE)
        if own is not None:
            yield found()

    scattered = _texts(docs).mapInArrow(scatter, "block int, met binary")
    ordered = scattered.repartition("block").sortWithinPartitions("block")
    frequent = np.zeros((1 << bits) // 8, np.uint8)
    for row in ordered.mapInArrow(gather, "block int, bits binary").collect():  # RANGE bits a row, at most 1 << bits in all
        frequent[row.block * RANGE // 8 : (row.block + 1) * RANGE // 8] = np.frombuffer(row.bits, np.uint8)
    return frequent


def count_stream(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): all phrases of up to ``longest`` words that occur ``least`` times, with
    their occurrences. The empty phrase stands for all words of the language, however few."""
    bits = counter_bits(docs)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_counters(docs, longest, least, bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for part in slices(batches, limit=TEXT_BYTES):
            words = _Words(part)
            per_lang = np.bincount(words.lang, minlength=len(words.langs))
            yield _rows(words.langs, pa.array([""] * len(words.langs)), per_lang)
            for n in range(1, longest + 1):
                at = words.phrases(n)
                counter = words.counters(at, n, bits)
                at = at[frequent[counter >> np.uint32(3)] >> (7 - (counter & np.uint32(7))) & 1 > 0]
                key = words.lang[at].astype(np.int64)
                for k in range(n):  # renumbered before each further word, so the key never overflows
                    key = key * len(words.vocabulary) + words.codes[at + k]
                    _, first, key, f = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                if not len(at):
                    continue
                begins = at[first]
                phrase = words.vocabulary.take(pa.array(words.codes[begins]))
                for k in range(1, n):
                    phrase = pc.binary_join_element_wise(
                        phrase, words.vocabulary.take(pa.array(words.codes[begins + k])), " "
                    )
                yield _rows(words.langs.take(pa.array(words.lang[begins])), phrase, f)

    counted = _texts(docs).mapInArrow(count, "lang string, phrase string, f long")
    summed = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return summed.filter((F.col("f") >= least) | ((F.col("phrase") == "") & (F.col("f") > 0)))


def _rows(lang: pa.Array, phrase: pa.Array, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(f, pa.int64())], ["lang", "phrase", "f"])


def _prefix_counts(longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``before``: the counts of the first 1, 2, .. words of each phrase of a sorted stream;
    null where the prefix came before this task's first row."""
    last = np.full(longest, -1, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.list_value_length(batch.column("words")).to_numpy()
        f = batch.column("f").to_numpy()
        rows, columns = np.arange(len(f)), []
        for n in range(1, longest):
            at = np.maximum.accumulate(np.where(length == n, rows, -1))
            count = np.where(at >= 0, f[at], last[n])
            last[n] = count[-1]
            columns.append(np.where(length > n, count, -1))
        flat = np.stack(columns, axis=1)
        wanted = np.arange(1, longest) < length[:, None]
        values = flat[wanted]
        counts = pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(wanted.sum(axis=1))], pa.int32()), pa.array(values, mask=values < 0)
        )
        yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, "before"])


def with_prefix_counts(stream: DataFrame, longest: int, name: str) -> DataFrame:
    """``stream`` (lang, words, f, ..) with ``name``: the counts of the first 1, 2, .. words of each row.

    Every prefix of a row has to be in the stream. A task that begins within the phrases of a
    prefix does not see it; such prefixes are at most one of each length per task, so the
    tables joined here are bounded by the number of tasks.
    """
    order = ["lang", "words"]
    sorted_ = stream.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_.schema)
    scanned = sorted_.mapInArrow(lambda batches: _prefix_counts(longest, batches), f"{fields}, before array<long>")
    found = materialize(scanned, "prefix-counts")
    prefixes = stream.select("lang", "words", F.col("f").alias("prefix_f"))
    for n in range(1, longest):
        unseen = (F.size("words") > n) & F.get("before", F.lit(n - 1)).isNull()
        prefix = F.when(unseen, F.slice("words", 1, n))
        wanted = found.filter(unseen).select("lang", F.slice("words", 1, n).alias("words")).distinct()
        few = prefixes.filter(F.size("words") == n).join(F.broadcast(wanted), ["lang", "words"])
        few = few.withColumnsRenamed({"lang": "prefix_lang", "words": "prefix"})
        same = (F.col("lang") == F.col("prefix_lang")) & (prefix == F.col("prefix"))
        known = F.transform(
            "before", lambda x, i: F.when((i == n - 1) & x.isNull(), F.col("prefix_f")).otherwise(x)  # noqa: B023
        )
        found = found.join(F.broadcast(few), same, "left").withColumn("before", known)
        found = found.drop("prefix_lang", "prefix", "prefix_f")
    return found.withColumnRenamed("before", name)


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact while ``a`` and the score's terms stay below 10**38."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", (a * a) * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def candidates(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, redundant: int = REDUNDANT) -> DataFrame:
    """lang, phrase, a, l, r, n and score of all candidates that no longer one makes redundant."""
    counted = materialize(count_stream(docs, longest, least), "phrase-counts")
    totals = counted.filter("phrase = ''").select("lang", F.col("f").alias("n"))  # one row per language
    stream = counted.filter("phrase != ''").withColumn("words", F.split("phrase", " ", -1))
    left = with_prefix_counts(stream, longest, "left")
    back = left.withColumn("words", F.reverse("words"))
    both = with_prefix_counts(back, longest, "right").withColumn("words", F.reverse("words"))
    phrases = materialize(both.filter(F.size("words") > 1).drop("words"), "phrases")

    longer = F.col("f") * 100
    last = [F.element_at(c, -1) for c in ("left", "right")]
    parts = [
        phrases.filter((F.size("left") > 1) & (longer >= part * redundant)).select("lang", inside.alias("phrase"))
        for part, inside in zip(
            last, (F.expr("regexp_extract(phrase, '(?s)^(.*) ', 1)"), F.expr("regexp_extract(phrase, '(?s)^[^ ]* (.*)$', 1)"))
        )
    ]
    kept = phrases.join(parts[0].union(parts[1]).distinct(), ["lang", "phrase"], "left_anti")
    # A cut after k words: the first k words, and the last size - k.
    cuts = F.transform(
        "left",
        lambda count, k: F.struct(
            cut_score(F.col("f"), count, F.element_at("right", -(k + 1))).alias("score"),
            k.alias("k"),
            count.alias("l"),
            F.element_at("right", -(k + 1)).alias("r"),
        ),
    )
    scored = kept.withColumn("cut", F.array_min(cuts)).join(totals, "lang")
    return scored.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")


def top_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, redundant: int = REDUNDANT, top: int = TOP
) -> DataFrame:
    """The first ``top`` candidates of each language by score, then occurrences, then phrase, with their rank.

    The rank limit goes below the shuffle, so a language ships at most ``top`` rows a task.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(docs, longest, least, redundant).withColumn("rank", F.row_number().over(order))
    columns = ["lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"]
    return ranked.filter(F.col("rank") <= top).select(*columns)
