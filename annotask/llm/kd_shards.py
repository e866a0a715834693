"""Sharding by a k-d tree over metadata.

A node is split along the dimension in which its rows are spread widest,
relative to the whole table, at the weighted median of that dimension: the
place that leaves both sides the bytes of the shards they will hold. Rows that
tie go by the checksum of the text, so copies stay together, then by a hash of the
id and by the row's place. Splitting goes on until the leaves have a shard's bytes.

The median is found by histograms: each pass adds up the bytes of the bins
of all open nodes and goes on within the bin that holds the median. Rows never
move for it; the driver holds the tree alone, whose size is that of the shards.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annotask.llm.common import text_or_empty, utf8_bytes, written

BINS = 1024
# A cut may miss its place by so small a part of a shard's bytes.
TOLERANCE = 1e-3
# Rows of one shard that are numbered together, about.
NUMBERED = 65_536
TIES = ("_crc", "_draw", "_place")


def string_place(column: Column) -> Column:
    """A number in the order of the string's first seven bytes; null as empty."""
    head = F.substring(F.encode(F.coalesce(column, F.lit("")), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long")


def log_place(column: Column) -> Column:
    """A number in the order of a size, by its logarithm."""
    return F.floor(F.log2(column + F.lit(1.0)) * F.lit(float(1 << 40))).cast("long")


@dataclass
class Node:
    shards: range
    cut: list[tuple[str, int]] | None = None  # column and value, in order; rows up to it go left
    closed: bool = True  # whether a row equal to the cut goes left
    left: Node | None = None
    right: Node | None = None
    # The search for the cut.
    prefix: list[tuple[str, int]] = field(default_factory=list)
    order: list[str] = field(default_factory=list)
    low: int = 0
    high: int = 0
    before: float = 0.0
    goal: float = 0.0

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def goes_left(self) -> Column:
        """The comparison in order of the cut's columns."""
        column, value = self.cut[-1]
        test = F.col(column) <= value if self.closed else F.col(column) < value
        for column, value in reversed(self.cut[:-1]):
            test = (F.col(column) < value) | ((F.col(column) == value) & test)
        return test

    def pick(self, leaf) -> Column:
        """``leaf(node)`` of the leaf that a row belongs to."""
        if self.left is None:
            return leaf(self)
        return F.when(self.goes_left(), self.left.pick(leaf)).otherwise(self.right.pick(leaf))


def _search(rows: DataFrame, root: Node, searching: list[Node], tolerance: float) -> list[Node]:
    """One pass over all searched nodes; those still without a cut."""
    leaves = root.leaves()
    numbers = {id(n): i for i, n in enumerate(leaves)}

    def place(node: Node) -> Column:
        if all(node is not s for s in searching):
            return F.lit(None).cast("struct<node:int,bin:long,value:long,next:long>")
        column = F.col(node.order[0])
        width = (node.high - node.low) // BINS + 1
        following = F.col(node.order[1]) if len(node.order) > 1 else F.lit(0).cast("long")
        found = F.struct(
            F.lit(numbers[id(node)]).alias("node"),
            F.floor((column - F.lit(node.low)) / F.lit(width)).cast("long").alias("bin"),
            column.alias("value"),
            following.alias("next"),
        )
        inside = reduce(lambda a, p: a & (F.col(p[0]) == p[1]), node.prefix, column.between(node.low, node.high))
        return F.when(inside, found)

    placed = rows.select(root.pick(place).alias("at"), "_size").where("at is not null")
    bins = placed.groupBy("at.node", "at.bin").agg(
        F.sum("_size").alias("bytes"),
        F.min("at.value").alias("low"),
        F.max("at.value").alias("high"),
        F.min("at.next").alias("next_low"),
        F.max("at.next").alias("next_high"),
    )
    bins = bins.withColumn("until", F.sum("bytes").over(W.partitionBy("node").orderBy("bin")))
    goals = F.create_map(*(x for n in searching for x in (F.lit(numbers[id(n)]), F.lit(n.goal - n.before))))
    reached = bins.where(F.col("until") >= F.element_at(goals, F.col("node")) - F.lit(0.5))
    first = reached.groupBy("node").agg(F.min_by(F.struct(*bins.columns), "bin").alias("b")).select("b.*")
    again = []
    for found in first.collect():  # one row per node
        node = leaves[found["node"]]
        start, end = node.before + found["until"] - found["bytes"], node.before + found["until"]
        column, single, last = node.order[0], found["low"] == found["high"], len(node.order) == 1
        if min(node.goal - start, end - node.goal) <= tolerance or (single and last):
            node.closed = end - node.goal < node.goal - start
            node.cut = [*node.prefix, (column, found["high"] if node.closed else found["low"])]
            continue
        if single:
            node.prefix = [*node.prefix, (column, found["low"])]
            node.order = node.order[1:]
            node.low, node.high = found["next_low"], found["next_high"]
        else:
            node.low, node.high = found["low"], found["high"]
        node.before = start
        again.append(node)
    return again


def kd_tree(rows: DataFrame, dimensions: list[str], shards: int, tolerance: float = TOLERANCE) -> tuple[Node, int]:
    """The tree over ``rows`` (dimensions, ties and ``_size``, all non-negative longs) and the number of rows."""
    root, spans, count = Node(range(shards)), None, 0
    while open_nodes := [n for n in root.leaves() if len(n.shards) > 1]:
        leaves = root.leaves()
        number = root.pick(lambda node: F.lit(next(i for i, n in enumerate(leaves) if n is node)))
        ends = rows.groupBy(number.alias("node")).agg(
            F.sum("_size").alias("bytes"),
            F.count("*").alias("rows"),
            *(f(d).alias(f"{k}{d}") for d in dimensions for k, f in (("low", F.min), ("high", F.max))),
        )
        found = {r["node"]: r for r in ends.collect()}  # one row per node
        if not found:
            break
        if spans is None:
            spans = {d: max(found[0][f"high{d}"] - found[0][f"low{d}"], 1) for d in dimensions}
            count, whole = found[0]["rows"], found[0]["bytes"]
        searching = []
        for i, node in enumerate(leaves):
            if len(node.shards) < 2:
                continue
            half, r = len(node.shards) // 2, found.get(i)
            if r is None:  # no rows: any cut will do
                node.cut, node.closed = [(dimensions[0], 0)], False
                continue
            widest = max(dimensions, key=lambda d: (r[f"high{d}"] - r[f"low{d}"]) / spans[d])
            node.order = [widest, *TIES]
            node.low, node.high, node.goal = r[f"low{widest}"], r[f"high{widest}"], r["bytes"] * half / len(node.shards)
            searching.append(node)
        while searching:
            searching = _search(rows, root, searching, tolerance * whole / shards)
        for node in open_nodes:
            half = len(node.shards) // 2
            node.left, node.right = Node(node.shards[:half]), Node(node.shards[half:])
    return root, count


def numbered(rows: DataFrame, count: int, group: str, place: str, out: str, batch: int = NUMBERED) -> DataFrame:
    """``rows`` numbered from 0 without gaps within each group, by parts of a group."""
    parts = max(1, -(-count // batch))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(place), F.lit(parts)))
    sums = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(W.partitionBy(group, "_part").orderBy(place))
    return rows.join(starts, [group, "_part"]).withColumn(out, F.col("_start") + own - 1).drop("_part", "_start")


def kd_shards(
    df: DataFrame,
    shards: int | None = 16,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` (default: all) of ``df`` with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 1. With
    ``target_bytes`` instead of ``shards``, there are as many shards as the
    bytes need. Dimensions are language, source and size; null as
    empty. Rows equal in all of these and in id go by their place in the
    staged table, so one group may be spread over shards when it is larger than one.
    An empty table gives an empty table. Columns of the added names are replaced.
    """
    added = ("size", "text_crc32", "shard", "slot")
    own = [c for c in (carry if carry is not None else df.columns) if c not in added]
    size = utf8_bytes(text_or_empty(text_col)) + 1
    staged = df.select(
        *own,
        size.alias("_size"),
        F.crc32(F.encode(text_or_empty(text_col), "UTF-8")).alias("_crc"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 2).alias("_draw"),
        F.monotonically_increasing_id().alias("_place"),
        string_place(F.col(lang_col)).alias("_lang"),
        string_place(F.col(source_col)).alias("_source"),
        log_place(size).alias("_bytes"),
    )
    rows = written(staged, "shard-rows")
    if target_bytes is not None:
        shards = max(1, -(-(rows.agg(F.sum("_size")).first()[0] or 0) // target_bytes))
    root, count = kd_tree(rows, ["_lang", "_source", "_bytes"], shards)
    placed = rows.withColumn("_shard", root.pick(lambda node: F.lit(node.shards[0])))
    return numbered(placed, count, "_shard", "_place", "_slot").select(
        *own,
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"),
    )
