"""Hard negatives by exact integer products of anchor and candidate tiles.

Vectors become integers (``floor(scale * x)``). All rows are put in order of
label and id and numbered; consecutive candidates form tiles, consecutive anchors
packs, both of a bounded number of rows. A task holds one pack and reads
the tiles it needs one after the other, so its memory does not grow with the data.
The scores of a pack and a tile are one int64 matrix product by Strassen's
recursion, odd sides padded with zeros: additions and products modulo
2^64, so exact wherever the scores themselves fit 64 bits (checked).

Two passes. The first looks for positives: a pack meets only tiles
that hold a label of its own. Each task keeps a heap of the best positives per anchor;
heaps of other tasks merge by a ranking whose rows are limited before the shuffle.
The second looks for negatives: a pack, now with its positives' scores, meets every tile
but those wholly of its only label, and keeps a heap per anchor and positive of the best
rows inside the score window. The stated set of anchors against all rows, in
blocks: every pair of a pack and a tile is computed once per pass at most.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotask.llm.common import written

# Rows of a candidate tile and of an anchor pack.
TILE, PACK = 2048, 512
# Products with a side no longer than this are made directly.
LEAF = 8
_ROWS_BITS = 33  # of monotonically_increasing_id(), below the partition
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The int64 product of two matrices, modulo 2^64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class _Rows:
    """The rows of a tile or pack as arrays, in order of id (null last) and place."""

    def __init__(self, rows: pa.StructArray, dims: int):
        ids = rows.field("id")
        self.no_id = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0))
        self.places = np.asarray(rows.field("place"))
        self.labels = np.asarray(rows.field("label"))
        self.matrix = np.asarray(rows.field("vec").flatten()).reshape(len(rows), dims)
        order = np.lexsort((self.places, self.ids, self.no_id))
        for name in ("no_id", "ids", "places", "labels", "matrix"):
            setattr(self, name, getattr(self, name)[order])
        self.order = order

    def entry(self, score: int, at: int) -> tuple:
        """What a heap compares: better entries are smaller."""
        return -score, bool(self.no_id[at]), int(self.ids[at]), int(self.places[at])


def best_of(scores: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` largest allowed scores; of equal ones the first positions."""
    at = np.flatnonzero(allowed)
    if len(at) > count:
        found = scores[at]
        least = np.partition(found, len(at) - count)[len(at) - count]
        at = at[found >= least]
    return at[np.argsort(-scores[at], kind="stable")][:count]


def _merged(heap: list, rows: _Rows, scores: np.ndarray, allowed: np.ndarray, count: int) -> list:
    """The best ``count`` entries of a heap and of the allowed rows."""
    if len(heap) == count:
        allowed = allowed & (scores >= -heap[-1][0])
    found = [rows.entry(int(scores[i]), i) for i in best_of(scores, allowed, count)]
    return heapq.nsmallest(count, heap + found) if found else heap


def _search(dims: int, positives: int | None, negatives: int | None, low: int, high: int):
    """The function of a task: per cell a pack (kind 0), then its tiles (kind 1).

    With ``positives`` set it finds positives, else negatives in the windows.
    """

    def new_heaps(pack: _Rows, windows: list) -> list:
        return [[[] for _ in windows[i]] if positives is None else [] for i in range(len(pack.ids))]

    def meet(pack: _Rows, windows: list, heaps: list, tile: _Rows) -> None:
        product = strassen(pack.matrix, np.ascontiguousarray(tile.matrix.T))
        for i in range(len(pack.ids)):
            scores, same = product[i], tile.labels == pack.labels[i]
            if positives is not None:
                heaps[i] = _merged(heaps[i], tile, scores, same & (tile.places != pack.places[i]), positives)
                continue
            for k, (_, score) in enumerate(windows[i]):
                # low * score <= 100 * negative <= high * score, in whole numbers.
                bottom, top = -(-low * score // 100), high * score // 100
                inside = ~same & (scores >= bottom) & (scores <= top)
                if inside.any():
                    heaps[i][k] = _merged(heaps[i][k], tile, scores, inside, negatives)

    def result(pack: _Rows, windows: list, heaps: list) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for i, anchor in enumerate(pack.places.tolist()):
            lists = [(0, heaps[i])] if positives is not None else [(w[0], h) for w, h in zip(windows[i], heaps[i])]
            for window, heap in lists:
                for minus, no_id, id_, place in heap:
                    for column, value in zip(columns, (anchor, window, -minus, None if no_id else id_, place)):
                        column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=pa.int64()) for c in columns], names=["anchor", "window", "score", "id", "place"]
        )

    def run(batches):
        pack = windows = heaps = None
        for batch in batches:
            kinds, lists = batch.column("kind").to_pylist(), batch.column("rows")
            for kind, rows in zip(kinds, lists):
                if kind == 0:
                    if pack is not None:
                        yield result(pack, windows, heaps)
                    pack = _Rows(rows.values, dims)
                    held = rows.values.field("windows").to_pylist()
                    windows = [[(w["place"], w["score"]) for w in held[j] or []] for j in pack.order.tolist()]
                    heaps = new_heaps(pack, windows)
                else:
                    meet(pack, windows, heaps, _Rows(rows.values, dims))
        if pack is not None:
            yield result(pack, windows, heaps)

    return run


def _grouped(rows: DataFrame, by: str, *more: Column) -> DataFrame:
    """Tiles or packs: at most TILE or PACK rows are collected for a number."""
    return rows.groupBy(by).agg(F.collect_list(F.struct("place", "id", "label", "vec", *more)).alias("rows"))


def _cells(packs: DataFrame, tiles: DataFrame, pairs: DataFrame, groups: int) -> DataFrame:
    """The rows of the tasks: every pack once per group of tiles it meets, then the tiles."""
    pairs = pairs.withColumn("group", F.col("tile") % groups)
    heads = packs.join(pairs.select("pack", "group").distinct(), "pack").select(
        "pack", "group", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("tile"), "rows"
    )
    # A tile has no windows; the column makes the two sides alike.
    bare = F.transform(
        "rows",
        lambda r: F.struct(
            *(r[f].alias(f) for f in ("place", "id", "label", "vec")),
            F.lit(None).cast("array<struct<place:bigint,score:bigint>>").alias("windows"),
        ),
    )
    fed = pairs.join(tiles.select("tile", bare.alias("rows")), "tile").select("pack", "group", F.lit(1).alias("kind"), "tile", "rows")
    return heads.unionByName(fed)


_FOUND = "anchor long, window long, score long, id long, place long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tile: int = TILE,
    pack: int = PACK,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label,
    the ``negatives`` best rows of other labels whose score lies between ``low`` and ``high``
    percent of the positive's: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    A score is the integer inner product of ``floor(scale * x)``. Higher scores
    come first, ties by smaller id, null ids last, then in the order in which equal
    rows were numbered. Rows without a label or vector, or with a null or non-finite component, take
    no part; shorter vectors count as padded with zeros. Rows that repeat an id are rows of their
    own: another row of an anchor's id can be its positive. A null in ``is_anchor`` is no anchor.
    Fewer rows than asked for give all there are; a positive with a score below zero has an empty window. Other columns are
    ignored. An empty table gives an empty one.

    Components whose products do not fit 64 bits are refused with a ValueError.
    """
    spark = vectors.sparkSession
    named = {"id": f"`{id_col}`", "label": f"`{label_col}`", "vec": f"`{vector_col}`"}
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (
        vectors.select(
            F.col(named["id"]).cast("long").alias("id"),
            F.col(named["label"]).cast("long").alias("label"),
            F.col(named["vec"]).cast("array<double>").alias("vec"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
        .where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
        .withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))))
        # Equal rows still spread over the tasks of the sort.
        .withColumn("tie", F.monotonically_increasing_id())
    )
    keys = [F.col("label").asc(), F.col("id").asc_nulls_last(), F.col("tie").asc()]
    numbered = written(
        kept.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie").withColumn("at", F.monotonically_increasing_id()),
        "negatives-rows",
    )
    part = F.shiftright("at", _ROWS_BITS)
    sizes = numbered.agg(
        F.count("*").alias("rows"),
        F.count_if("is_anchor").alias("anchors"),
        F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("dims"),
        F.max(F.array_max("vec").cast("double")).alias("top"),
        F.min(F.array_min("vec").cast("double")).alias("bottom"),
    ).first()
    dims, n_tiles = sizes["dims"], -(-sizes["rows"] // tile)
    if dims * int(max(sizes["top"] or 0, -(sizes["bottom"] or 0))) ** 2 >= 1 << 63:
        raise ValueError("the components are too large for scores of 64 bits")

    # Counts of the tasks before: one row per task of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a"))
    offsets = offsets.select(
        "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(o) for c, o in (("n", "rows_before"), ("a", "anchors_before")))
    )
    within = F.col("at").bitwiseAND((1 << _ROWS_BITS) - 1)
    padded = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("vec")))
    placed = numbered.withColumn("part", part).join(offsets, "part").select(
        "part", "at", "id", "label", padded.alias("vec"), "is_anchor", (F.col("rows_before") + within).alias("place"), "anchors_before"
    )
    candidates = placed.withColumn("tile", F.floor(F.col("place") / tile))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("at")) - 1 + F.col("anchors_before")
    anchors = written(
        placed.where("is_anchor").select("place", "id", "label", "vec", F.floor(nth / pack).alias("pack")), "negatives-anchors"
    )
    tiles = written(_grouped(candidates, "tile"), "negatives-tiles")
    n_packs = -(-sizes["anchors"] // pack)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(n_tiles, -(-2 * parallel // max(n_packs, 1))))

    def found(packs: DataFrame, pairs: DataFrame, count: int, **wanted) -> DataFrame:
        cells = _cells(packs, tiles, pairs, groups)
        tasks = max(1, min(n_packs * groups, parallel))
        # One task per cell or more cells in turn; a count keeps small tiles apart.
        dealt = cells.repartition(tasks, "pack", "group").sortWithinPartitions("pack", "group", "kind", "tile")
        rows = dealt.select("kind", "rows").mapInArrow(_search(dims, low=low, high=high, **wanted), _FOUND)
        best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "place")
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)

    labels_of = candidates.select("tile", "label").distinct()
    pack_labels = anchors.select("pack", "label").distinct()
    same = pack_labels.join(labels_of, "label").select("pack", "tile").distinct()
    no_windows = F.lit(None).cast("array<struct<place:bigint,score:bigint>>")
    plain = _grouped(anchors.withColumn("windows", no_windows), "pack", F.col("windows"))
    liked = written(
        found(plain, same, positives, positives=positives, negatives=None).select(
            "anchor", F.col("place").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "negatives-positives",
    )

    windows = liked.groupBy(F.col("anchor").alias("place")).agg(
        F.collect_list(F.struct(F.col("positive").alias("place"), F.col("positive_score").alias("score"))).alias("windows")
    )
    armed = _grouped(anchors.join(windows, "place"), "pack", F.col("windows"))
    # A pack of one label has no negatives in a tile of that label only.
    one = [F.when(F.count_distinct("label") == 1, F.min("label")).alias("only")]
    all_tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_tiles, 1) - 1).cast("long"))).alias("tile")
    pairs = (
        pack_labels.groupBy("pack").agg(*one).withColumnRenamed("only", "own").select("pack", "own", all_tiles)
        .join(labels_of.groupBy("tile").agg(*one), "tile")
        .where(F.col("own").isNull() | F.col("only").isNull() | (F.col("own") != F.col("only")))
        .select("pack", "tile")
    )
    hard = found(armed, pairs, negatives, positives=None, negatives=negatives)
    ids = anchors.select(F.col("place").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        hard.select("anchor", F.col("window").alias("positive"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(liked, ["anchor", "positive"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
