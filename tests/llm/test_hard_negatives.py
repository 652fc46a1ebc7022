import math
import random

import numpy as np
import pytest

from ebbtide.llm import hard_negatives as mining
from ebbtide.llm.common import ROW


def plain(rows):
    """All products, in whole numbers."""
    width = max([len(v) for _, v, _ in rows if v is not None], default=0)
    usable = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        whole = [math.floor(256 * x) for x in v]
        if max(map(abs, whole), default=0) <= mining.limit(width):
            usable.append((i, label, whole + [0] * (width - len(whole))))
    order = lambda score, i: (-score, i is None, i)
    out = []
    for a, (i, label, v) in enumerate(usable):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other) for b, (j, other, w) in enumerate(usable) if b != a]
        near = sorted((s for s in scored if s[2] == label), key=lambda s: order(*s[:2]))[:5]
        for p, j, _ in near:
            far = sorted((s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p), key=lambda s: order(*s[:2]))
            out += [(i, j, rank, n, p, s) for rank, (s, n, _) in enumerate(far[:10], 1)]
    return sorted(out, key=repr)


def vectors(seed, n, width, spread=1.0):
    dice = random.Random(seed)
    centres = [[dice.gauss(0, spread) for _ in range(width)] for _ in range(12)]
    return [(i, [c + dice.gauss(0, 0.5) for c in dice.choice(centres)], dice.randrange(10)) for i in range(n)]


@pytest.fixture
def embeddings(spark):
    def make(rows, kind="float"):
        return spark.createDataFrame([(*r, 3, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, tile int, rank string").repartition(3)

    return make


ODD = [(None, [0.5, 0.5], 1), (200, None, 1), (300, [1.0, None], 2), (400, [float("nan"), 1.0], 2), (500, [float("inf"), 1.0], 3),
       (600, [1.0, 1.0], None), (700, [], 4), (800, [0.25], 1), (-100, [1.0, -0.5], 1), (-100, [1.0, -0.5], 1), (900, [1e300, 1.0], 1)]


@pytest.mark.parametrize("n, width, size, block", [(400, 2, 40, 2), (700, 5, 4096, 1024), (300, 16, 4096, 1)])
def test_against_all_products(embeddings, rows, monkeypatch, n, width, size, block):
    monkeypatch.setattr(mining, "BLOCK", block)
    monkeypatch.setattr(mining, "TILE", size)
    # coarse numbers, so that scores tie
    given = [(i, [float(np.float32(round(x, 1))) for x in v], k) for i, v, k in vectors(n, n, width)]
    found = mining.mine(embeddings(given, "double"))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rows(found) == plain(given) != []


def test_odd_rows_repeated_rows_and_none(embeddings, rows):
    given = ODD + [(i, v, k) for i, v, k in vectors(5, 150, 2)] + [(i, v, k) for i, v, k in vectors(5, 150, 2)[:20]]
    assert rows(mining.mine(embeddings(given, "double"))) == plain(given) != []
    assert rows(mining.mine(embeddings([]))) == [] == rows(mining.mine(embeddings(ODD[1:6], "double")))


def test_one_common_vector(embeddings, rows):
    """A third of all rows are equal: their tile is split, and ties go to the smaller vec_id."""
    given = [(i, v if i % 3 else [1.0, 2.0, 0.5], k) for i, v, k in vectors(9, 600, 3)]
    frame = mining.prepared(embeddings(given, "double"))
    tiles, n = mining.tiled(frame, 30, 8)
    counts = [r["count"] for r in tiles.groupBy("tile").count().collect()]
    assert sum(counts) == 600 and len(counts) <= n and max(counts) <= 90
    assert rows(mining.mine(embeddings(given, "double"))) == plain(given)


def test_large_numbers_stay_whole(embeddings, rows):
    given = [(i, [x * 1e6 for x in v], k) for i, v, k in vectors(3, 250, 4)]
    assert rows(mining.mine(embeddings(given, "double"))) == plain(given) != []


def test_the_queue_skips_boxes():
    import pandas as pd

    dice = np.random.default_rng(1)
    points = np.floor(dice.normal(size=(5000, 3)) * 256)
    tile = pd.DataFrame({"v": list(points), "vec_id": range(5000), "label": 1, ROW: range(5000)})
    tree = mining.Tree(tile, np.float64)
    leaves = mining.packed(points)
    assert sorted(np.concatenate(leaves)) == list(range(5000)) and max(map(len, leaves)) <= mining.LEAF
    low, high = tree.bounds(points[:1])
    scores = points @ points[0]
    for node, (_, _, names) in enumerate(tree.leaves):
        own = scores[[row for _, row in names]]
        assert low[0][node] <= own.min() and own.max() <= high[0][node]
    seen = []

    class Watched(list):
        def __getitem__(self, k):
            seen.append(k)
            return super().__getitem__(k)

    tree.leaves = Watched(tree.leaves)
    found = tree.search(points[0], 0, 1, True, [(-math.inf, math.inf, -math.inf)], 5, low[0], high[0])
    assert sorted((-s for s, _, _ in found[0])) == sorted(-np.sort(scores[1:])[::-1][:5])
    assert len(seen) < len(tree.leaves) / 4
