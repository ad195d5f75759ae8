"""Vector near-duplicates against all pairs."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lamina.llm import queries, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, copies long"


def plain(rows, least=0.98):
    """(vec_id, n_links, component_id, kept) of each row."""
    rows = [(i, v, label) for i, v, label, *_ in rows]
    sizes = Counter(len(v) for _, v, label in rows if usable(v, label))
    most = max(sizes, key=lambda n: (sizes[n], n), default=0)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, by_label = [0] * len(rows), defaultdict(list)
    for k, (_, v, label) in enumerate(rows):
        if usable(v, label) and len(v) == most:
            by_label[label].append(k)
    for members in by_label.values():
        units = np.array([rows[k][1] for k in members], np.float64)
        units /= np.sqrt((units**2).sum(axis=1))[:, None]
        for a, b in zip(*np.nonzero(units @ units.T >= least)):
            if a != b:
                links[members[a]] += 1
                root[find(members[a])] = find(members[b])
    smallest = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[find(k)] = min(i, smallest.get(find(k), i))
    return Counter(
        (i, links[k], smallest.get(find(k)), None if i is None else i == smallest[find(k)])
        for k, (i, _, _) in enumerate(rows)
    )


def usable(vector, label):
    if vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
        return False
    return any(x != 0 for x in vector)


def near_copies(random, n, width, noise):
    """Vectors, and for many of them some that are nearly or exactly the same."""
    base = random.normal(size=(n, width))
    again = base[random.integers(0, n, 2 * n)] * random.choice([1.0, 2.0], (2 * n, 1))
    again += random.normal(size=again.shape) * random.choice([0.0, noise / 3, noise], (2 * n, 1))
    return np.concatenate([base, again]).astype(np.float32)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "u", 1) for r in rows], SCHEMA)
    return Counter(tuple(r) for r in vector_dedup.link_classes(frame.repartition(3), **options).collect())


@pytest.mark.parametrize("width", [1, 3, 16, 64])
def test_equals_all_pairs(spark, width, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LIST", 16)
    random = np.random.default_rng(width)
    vectors = near_copies(random, 150, width, 0.15)
    labels = random.choice([0, 0, 0, 1, 2], len(vectors))
    rows = [(int(i), v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels))]
    rows += [(900, rows[0][1], None), (901, None, 0), (902, [0.0] * width, 0), (903, [float("nan")] * width, 0),
             (904, [None] * width, 0), (905, [1.0] * (width + 1), 0), (906, [float("inf")] * width, 0), (907, [], 1),
             (5, rows[7][1], rows[7][2]), (None, rows[8][1], rows[8][2]), (None, None, 1)]
    expected = plain(rows)
    assert found(spark, rows) == expected
    assert sum(n for (_, links, *_), n in expected.items() if links) > 100


def test_one_group_of_near_copies_over_many_blocks(spark, monkeypatch):
    """The same group in one list, cut into many blocks and parts."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    random = np.random.default_rng(0)
    vectors = random.normal(size=32) + random.normal(size=(300, 32)) * 0.12
    rows = [(1000 - i, v.astype(np.float32).tolist(), 3) for i, v in enumerate(vectors)]
    assert found(spark, rows) == plain(rows)


def test_extreme_lengths_and_empty_tables(spark):
    rows = [(1, [1e-40, 2e-40], 0), (2, [1e38, 2e38], 0), (3, [3e38, -3e38], 0), (4, [-0.0, 1.0], 1), (5, [0.0, 2.0], 1)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == {}
    assert found(spark, [(7, None, 1), (None, [1.0], None)]) == plain([(7, None, 1), (None, [1.0], None)])


def test_recall_on_the_test_table(spark, folder):
    table = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    got = Counter(tuple(r) for r in queries.op12_vector_dedup(spark, folder.replace("sf0.001", "sf0.1")).collect())
    assert got == plain(rows)
