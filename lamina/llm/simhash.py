"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

Each pair of adjacent words is a term; its 64-bit hash votes on 64 signed bits, once for
every time it occurs. A bit is set when more than half of the votes set it. DataFrame
functions only: terms are exploded and voted on by one aggregation in the JVM.

The search cuts fingerprints into blocks. Two fingerprints that differ in at most ``radius``
bits agree on all but ``radius`` blocks, so for every choice of the other blocks there is a
table keyed by them, and a pair meets in at least one table.

A null text is empty. The empty text and a text of one word have one term, the word
itself. Words are cut at 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import materialize

BITS = 64
#: Documents whose id is divisible by ``EVERY`` are searched for, among all, within ``RADIUS`` bits.
RADIUS, EVERY = 3, 20


def terms(text: Column) -> Column:
    """Hashes of all adjacent pairs of words."""
    words = F.split(F.trim(F.translate(text, "\t\n\x0b\x0c\r", " " * 5)), " +")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    # The last word has no right neighbour; its own term counts only where it is the only word.
    return F.when(F.size(words) > 1, F.slice(pairs, 1, F.size(words) - 1)).otherwise(pairs)


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fingerprint`` (long) of each row. ``keys`` tell the rows apart.

    No shuffle is added where ``rows`` is already partitioned by some of the keys.
    """
    voters = rows.select(*keys, F.explode(terms(F.col(text))).alias("vote"))
    bits = [F.sum(F.shiftrightunsigned("vote", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(BITS)]
    voted = voters.groupBy(*keys).agg(F.count("*").alias("votes"), *bits)
    fingerprint = F.lit(0).cast("long")
    for i in range(BITS):
        bit = (F.col(f"b{i}") * 2 > F.col("votes")).cast("long")
        fingerprint = fingerprint.bitwiseOR(F.shiftleft(bit, i))
    return voted.select(*keys, fingerprint.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of bits that two fingerprints have in common."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def text_form(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def block_tables(fingerprint: str, radius: int, blocks: int) -> Column:
    """An array of (table, key): one key for each choice of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("table"), F.col(fingerprint).bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def search(queries: DataFrame, stored: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """(query, found, distance): every distinct fingerprint of ``stored`` within ``radius`` bits of each of ``queries``.

    Both have a column ``fingerprint``; nulls find nothing. Copies of a fingerprint are one
    row here; join ``found`` back to the documents for all of them. A table key that many
    fingerprints share is a join key that adaptive execution can split.
    """
    if not 0 <= radius < BITS:
        raise ValueError("radius must be from 0 to 63")
    blocks = blocks or min(BITS, radius + 2)
    if not radius < blocks <= BITS or math.comb(blocks, radius) > 10_000:
        raise ValueError("blocks must be more than the radius, at most 64, and give at most 10000 tables")
    a, b = (
        side.select("fingerprint").dropna().distinct()
        .select(F.col("fingerprint").alias(name), F.inline(block_tables("fingerprint", radius, blocks)))
        for side, name in ((queries, "query"), (stored, "found"))
    )
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    near = a.join(b, ["table", "key"]).select("query", "found", distance.alias("distance"))
    return near.filter(F.col("distance") <= radius).distinct()


def _ordered(docs: DataFrame) -> DataFrame:
    """``docs`` with its bucket of the doc_id order and its place in the bucket.

    Buckets are ranges between quantiles of doc_id, at most one per shuffle partition, so a
    window over a bucket holds one partition's rows. Rows without a doc_id come first, spread
    over buckets of their own; rows that share one stand together, in the order of their text hash.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [i / count for i in range(1, count)] or [0.5]
    bounds = docs.select(F.percentile_approx("doc_id", wanted, 10 * count)).first()[0] or []
    bounds = sorted(set(bounds))
    # Coarse steps, then the bounds within a step: a row is compared with few of them.
    step = max(1, math.isqrt(len(bounds)))
    coarse, fine = bounds[::step], [bounds[i : i + step] for i in range(0, len(bounds), step)]
    id_ = F.col("doc_id")
    bucket = F.lit(0)
    if bounds:
        at = F.size(F.filter(F.array(*map(F.lit, coarse)), lambda b: b <= id_))
        within = F.size(F.filter(F.array(*[F.array(*map(F.lit, f)) for f in fine])[at - 1], lambda b: b <= id_))
        bucket = F.when(at == 0, 0).otherwise((at - 1) * step + within)
    spread = F.pmod(F.xxhash64("text", F.lit("spread")), F.lit(count)) - count
    keyed = docs.withColumns(
        {"bucket": F.when(id_.isNull(), spread).otherwise(bucket).cast("int"), "text_hash": F.xxhash64("text")}
    )
    return keyed


def edited_documents(docs: DataFrame) -> DataFrame:
    """bucket, place, doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint of each document.

    The edited text has its last quarter (in code points, rounded down) replaced by as many
    code points from the start of the next document in ascending doc_id; the last is followed
    by the first.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = _ordered(texts)
    order = F.struct(F.col("doc_id"), F.col("text_hash"))
    heads = keyed.groupBy("bucket").agg(F.min_by("text", order).alias("head"))
    after = _following(heads, "head", "head_after")
    row = Window.partitionBy("bucket").orderBy("doc_id", "text_hash")
    placed = keyed.select(
        "bucket",
        F.row_number().over(row).alias("place"),
        "doc_id",
        "text",
        F.lead("text").over(row).alias("within"),
    )
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    following = F.coalesce("within", "head_after")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - quarter),
        F.substring(following, F.lit(1), quarter),
    )
    both = placed.join(after, "bucket").select(
        "bucket",
        "place",
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "text",
        edited.alias("edited"),
    )
    keys = ["bucket", "place", "doc_id", "n_chars", "edited_sha256"]
    split = both.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys, F.posexplode(F.array("text", "edited")).alias("version", "body")
    )
    found = fingerprints(split, [*keys, "version"], "body")
    return found.groupBy(*keys).agg(
        F.max(F.when(F.col("version") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("version") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )


def _following(heads: DataFrame, value: str, name: str) -> DataFrame:
    """The head of the next bucket for each bucket, the first one after the last. One row per bucket."""
    order = Window.orderBy("bucket")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead(value).over(order), F.first(value).over(everything))
    return heads.select("bucket", following.alias(name))


def near_counts(found: DataFrame, wanted: Column, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, near): rows of ``found`` within ``radius`` bits of each fingerprint of the ``wanted`` rows."""
    copies = found.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    pairs = search(found.filter(wanted), found, radius).withColumnRenamed("found", "fingerprint")
    return pairs.join(copies, "fingerprint").groupBy(F.col("query").alias("fingerprint")).agg(F.sum("copies").alias("near"))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and its edited text, with their likeness to it and to the next document's.

    n_near is the number of other documents within ``RADIUS`` bits, for ids divisible by ``EVERY``; else null.
    """
    found = materialize(edited_documents(docs), "fingerprints")
    heads = found.groupBy("bucket").agg(F.min_by("fingerprint", "place").alias("head"))
    row = Window.partitionBy("bucket").orderBy("place")
    following = F.coalesce(F.lead("fingerprint").over(row), F.col("head_after"))
    wanted = F.coalesce(F.col("doc_id") % EVERY == 0, F.lit(False))
    placed = found.join(_following(heads, "head", "head_after"), "bucket").withColumn("next", following)
    return placed.join(near_counts(found, wanted), "fingerprint", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_form(F.col("fingerprint")).alias("fingerprint"),
        text_form(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        F.when(wanted, F.col("near") - 1).alias("n_near"),
    )
