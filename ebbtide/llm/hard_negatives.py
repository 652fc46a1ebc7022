"""Hard negatives by best-first search of a packed R-tree.

Rows are tiled sort-tile-recursive: quantiles of the two widest coordinates deal them into tiles of bounded size,
inside of which the same order makes leaves and, from runs of leaves, the nodes above. A node's bounding box gives
an interval of each coordinate's product with a query and so bounds on every score below it. A search takes nodes
from a queue, highest bound first, and drops those outside of its score windows and those strictly below the worst
score it would still return.

Each anchor first searches the tile it lies in; the scores found there are lower limits for its search of all other
tiles. Anchors are dealt to tiles in blocks, so a task holds one tile and one block; lists of at most a few rows per
anchor, window and tile are merged by rank.

Scores are whole numbers: products are taken in floating point where all of them are exact, else as integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.session import materialise

from .common import ROW, travels

SCALE = 256
#: Rows of a leaf, children of a node above leaves, rows that a tile is planned for, tiles at least.
LEAF = 64
FANOUT = 16
TILE = 4096
TILES = 24
#: Anchors that a task searches for at once.
BLOCK = 1024
FOUND = "anchor long, win int, score long, other long"


def limit(width: int) -> int:
    """The largest component for which inner products of ``width`` components surely fit 64 bits."""
    return math.isqrt(((1 << 63) - 1) // max(width, 1))


def prepared(embeddings: DataFrame, moved: int = 7, labels: int = 10) -> DataFrame:
    """Stored rows that take part: row id, vec_id, label, v.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows with a
    component so large that scores would not fit 64 bits. Shorter vectors are filled up with zeros. Where
    vec_id is divisible by ``moved`` the label becomes (label + 1) % ``labels``.
    """
    x = F.col("embedding")
    whole = ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % moved == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = embeddings.filter(F.col("label").isNotNull() & x.isNotNull()).filter(whole)
    stored = materialise(rows.select(
        F.monotonically_increasing_id().alias(ROW), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), v.alias("v")), "vectors")
    width = stored.agg(F.max(F.size("v"))).first()[0] or 0
    most = limit(width)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    return stored.filter(~F.exists("v", lambda c: (c > most) | (c < -most))).withColumn("v", filled)


def tiled(rows: DataFrame, size: int = TILE, least: int = TILES) -> tuple[DataFrame, int]:
    """``rows`` stored with their ``tile``, and the number of tiles, all of about ``size`` rows or fewer.

    Equal coordinates fall into one tile; a tile with over twice the rows it is planned for is split by hash.
    The driver holds one number per tile.
    """
    first = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = first["n"], first["width"] or 0
    if not n:
        return rows.withColumn("tile", F.lit(0)), 0
    planned = min(max(least, math.ceil(n / size)), n)
    slabs = math.ceil(math.sqrt(planned))
    spread = rows.agg(*[F.coalesce(F.var_pop(F.get("v", F.lit(i))), F.lit(0.0)) for i in range(width)] or [F.lit(0)]).first()
    axes = sorted(range(width), key=lambda i: -spread[i])[:2] or [0]
    x, y = (F.coalesce(F.get("v", F.lit(i)), F.lit(0)) for i in (axes[0], axes[-1]))
    cuts = [k / slabs for k in range(1, slabs)] or [0.5]

    def place(value, limits):
        return F.size(F.filter(limits, lambda c: c < value))

    outer = rows.agg(F.percentile_approx(x, cuts)).first()[0]
    sliced = rows.withColumn("slab", place(x, F.array(*map(F.lit, outer))))
    inner = materialise(sliced.groupBy("slab").agg(F.percentile_approx(y, cuts).alias("cuts")), "cuts")
    sliced = sliced.join(inner, "slab").withColumn("cell", F.col("slab") * slabs + place(y, F.col("cuts"))).drop("slab", "cuts")
    sliced = materialise(sliced, "cells")
    most = 2 * math.ceil(n / planned)
    cells = [(r["cell"], math.ceil(r["count"] / most)) for r in sliced.groupBy("cell").count().collect()]
    starts, total = [], 0
    for cell, parts in sorted(cells):
        starts.append((cell, parts, total))
        total += parts
    layout = rows.sparkSession.createDataFrame(starts, "cell int, parts int, start int")
    tile = F.col("start") + F.pmod(F.xxhash64(ROW), F.col("parts")).cast("int")
    return materialise(sliced.join(layout, "cell").withColumn("tile", tile).drop("cell", "parts", "start"), "tiles"), total


def packed(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of leaves: slices along the widest coordinate, each sliced along the next."""
    axes = list(np.argsort(-points.var(axis=0), kind="stable")[:3]) if points.shape[1] else []

    def cut(rows: np.ndarray, axes: list[int]) -> Iterable[np.ndarray]:
        leaves = math.ceil(len(rows) / leaf)
        if leaves <= 1:
            yield rows
            return
        rows = rows[np.argsort(points[rows, axes[0]], kind="stable")] if axes else rows
        slices = math.ceil(leaves ** (1 / max(len(axes), 1)))
        step = leaf * math.ceil(leaves / slices) if len(axes) > 1 else leaf
        for at in range(0, len(rows), step):
            yield from cut(rows[at : at + step], axes[1:])

    return list(cut(np.arange(len(points)), axes))


class Tree:
    """One tile: leaves of rows, and boxes of all nodes; children of a node are consecutive."""

    def __init__(self, tile: pd.DataFrame, dtype: type, leaf: int = LEAF, fanout: int = FANOUT):
        points = np.array(tile["v"].tolist(), dtype=dtype).reshape(len(tile), -1)
        # a null vec_id comes last
        ids, labels, rows = (tile[c].to_numpy() for c in ("vec_id", "label", ROW))
        ids = [math.inf if i is None or i != i else int(i) for i in ids]
        self.leaves = [(points[own], labels[own], [(ids[k], int(rows[k])) for k in own]) for own in packed(points, leaf)]
        low, high = (np.array([f(p, axis=0) for p, _, _ in self.leaves]) for f in (np.min, np.max))
        self.low, self.high, self.children = [low], [high], [None] * len(low)
        first, n = 0, len(low)
        while n > 1:
            starts = np.arange(0, n, fanout)
            self.children += [range(first + s, first + min(s + fanout, n)) for s in starts]
            self.low.append(np.minimum.reduceat(self.low[-1], starts, axis=0))
            self.high.append(np.maximum.reduceat(self.high[-1], starts, axis=0))
            first, n = first + n, len(starts)
        self.low, self.high = np.concatenate(self.low), np.concatenate(self.high)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score that each node may hold for each query."""
        above, below = np.maximum(queries, 0), np.minimum(queries, 0)
        return above @ self.low.T + below @ self.high.T, above @ self.high.T + below @ self.low.T

    def search(self, query: np.ndarray, own: int, label: int, same: bool, windows: list[tuple], k: int,
               low: np.ndarray, high: np.ndarray) -> list[list[tuple]]:
        """For each window (least, most, floor) its k best rows (-score, vec_id, row), in order.

        Rows are those with the label, ``own`` left out, or those of other labels; their scores lie in the window and
        are not under ``floor``, which others are known to reach.
        """
        found: list[list[tuple]] = [[] for _ in windows]
        # under these scores a window takes nothing any more
        floors = [max(least, floor) for least, _, floor in windows]

        def wanted(node: int) -> bool:
            return any(high[node] >= f and low[node] <= w[1] for f, w in zip(floors, windows))

        queue = [(-high[len(high) - 1], len(high) - 1)]
        while queue:
            node = heapq.heappop(queue)[1]
            if not wanted(node):
                continue
            if self.children[node] is not None:
                for child in self.children[node]:
                    if wanted(child):
                        heapq.heappush(queue, (-high[child], child))
                continue
            points, labels, names = self.leaves[node]
            scores = points @ query
            near = np.flatnonzero((scores >= min(floors)) & ((labels == label) if same else (labels != label)))
            for i in near:
                score, name = int(scores[i]), names[i]
                if name[1] == own:
                    continue
                for w, (_, most, _) in enumerate(windows):
                    if floors[w] <= score <= most:
                        # the heap has the worst of the rows to return at its top
                        item = (score, -name[0], -name[1])
                        if len(found[w]) < k:
                            heapq.heappush(found[w], item)
                        else:
                            heapq.heappushpop(found[w], item)
                        if len(found[w]) == k:
                            floors[w] = max(floors[w], found[w][0][0])
        return found


def _searching(k: int, same: bool, low: int, high: int):
    def run(tile: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(tile) and len(anchors):
            largest = [max((abs(x) for v in part["v"] for x in v), default=0) for part in (tile, anchors)]
            dtype = np.float64 if len(tile["v"].iloc[0]) * math.prod(largest) < 1 << 53 else np.int64
            tree = Tree(tile, dtype)
            queries = np.array(anchors["v"].tolist(), dtype=dtype).reshape(len(anchors), -1)
            lows, highs = tree.bounds(queries)
            for query, own, label, wins, lo, hi in zip(queries, anchors[ROW], anchors["label"], anchors["wins"], lows, highs):
                numbers, windows = [], []
                for w in wins:
                    floor = -math.inf if w["floor"] is None else w["floor"]
                    span = (-math.inf, math.inf) if same else (-(-low * w["score"] // 100), high * w["score"] // 100)
                    if span[0] <= span[1]:
                        numbers.append(w["win"])
                        windows.append((*span, floor))
                if windows:
                    for win, best in zip(numbers, tree.search(query, own, label, same, windows, k, lo, hi)):
                        rows += [(own, win, score, -row) for score, _, row in best]
        return pd.DataFrame(rows, columns=["anchor", "win", "score", "other"]).astype("int64")

    return run


def search(tiles: DataFrame, n_tiles: int, queries: DataFrame, n_queries: int, k: int, same: bool, low: int = 0, high: int = 0) -> DataFrame:
    """anchor, win, score, other and rank of the k best rows of each window of each query, over all tiles."""
    run = _searching(k, same, low, high)
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    names = tiles.select(F.col(ROW).alias("other"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.join(names, "other").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # an anchor's own tile holds at most its rows as anchors
    home = tiles.groupBy("tile").cogroup(queries.groupBy("tile")).applyInPandas(run, FOUND)
    floors = materialise(home.groupBy("anchor", "win").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
                         .filter(F.col("n") == k).drop("n"), "floors")
    limits = materialise(floors.groupBy(F.col("anchor").alias(ROW)).agg(
        F.map_from_entries(F.collect_list(F.struct("win", "floor"))).alias("floors")), "limits")
    blocks = max(1, math.ceil(n_queries / BLOCK))
    known = queries.drop("tile").join(limits, ROW, "left").withColumn("wins", F.transform("wins", lambda w: F.struct(
        w["win"].alias("win"), w["score"].alias("score"), F.element_at("floors", w["win"]).alias("floor"))))
    dealt = known.drop("floors").withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(blocks)).cast("int")).withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    copies = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    every = copies.groupBy("tile", "block").cogroup(dealt.groupBy("tile", "block")).applyInPandas(run, FOUND)
    return ranked(every)


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``; their positives are the ``positives`` best other
    rows of their label. For each, the ``negatives`` best rows of other labels whose score lies between ``low`` and
    ``high`` percent of the positive's. Equal scores are ranked by vec_id, null last. Repeated rows are rows of
    their own, as anchors too; a null vec_id is no anchor. An anchor without positives, and a positive
    without such negatives, gives no rows; no rows give none. ``prepared`` says which rows take part. Columns
    other than vec_id, embedding and label are not read.
    """
    rows = prepared(embeddings)
    tiles, n_tiles = tiled(rows)
    if not n_tiles:
        return embeddings.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # stored, as both sides of a cogroup need columns of their own
    anchors = materialise(tiles.filter(F.col("vec_id") % every == 0), "anchors")
    n = anchors.count()
    first = F.array(F.struct(F.lit(0).alias("win"), F.lit(0).cast("long").alias("score"), F.lit(None).cast("long").alias("floor")))
    near = materialise(search(tiles, n_tiles, anchors.withColumn("wins", first), n, positives, True), "positives")
    wins = near.groupBy(F.col("anchor").alias(ROW)).agg(F.collect_list(F.struct(
        F.col("rank").alias("win"), "score", F.lit(None).cast("long").alias("floor"))).alias("wins"))
    asked = materialise(anchors.join(wins, ROW), "windows")
    far = materialise(search(tiles, n_tiles, asked, n, negatives, False, low, high), "negatives")
    names = anchors.select(F.col(ROW).alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor", F.col("rank").alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.select("anchor", "win", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs, ["anchor", "win"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


travels(__name__)
