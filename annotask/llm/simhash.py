"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is set when it is set in over half of the hashes of the
text's shingles. To find every pair of fingerprints within ``radius`` bits,
each bit position gets a non-zero code of ``radius + 1`` bits, and each
non-zero vector of that length gives one mask: the positions whose code has an
odd inner product with it. For any ``radius`` positions in which two
fingerprints differ, some vector is orthogonal to the codes of all of them, so
its mask leaves them out and the two agree under it: no pair is missed.

Equal fingerprints are one class from the start, so a group of copies is one
node however large it is. Classes that agree under a mask meet in a bucket. A
bucket of few classes compares its pairs. In a larger one the classes meet
again under their one-bit neighbours: two fingerprints are within two bits
exactly when they have a neighbour (or themselves) within one bit in common,
and at most 65 fingerprints have a given one, so the rows stay proportional to
the classes. Components of the links come from alternating star contractions,
each written to the shared folder; no link leaves the executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.llm.common import free_name, written

BITS = 64
SEED = 42
# Buckets up to so many classes compare all pairs; larger ones go by neighbours.
PAIRWISE = 16
# Shingles whose hash bits are unpacked at a time.
UNPACKED = 1 << 16


def shingle_hashes(text: str | None, length: int) -> np.ndarray:
    """XXH64 of every shingle of the text, repeats included; none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, width = b" ".join(words), min(length, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, length: int) -> int:
    """The fingerprint as an unsigned integer; zero for a text without words."""
    hashes = shingle_hashes(text, length)
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), UNPACKED):
        octets = hashes[at : at + UNPACKED].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(
    df: DataFrame, length: int = 3, text_col: str = "text", out_col: str = "fingerprint", keep_text: bool = False
) -> DataFrame:
    """``df``, without its text unless ``keep_text``, with a long column: the 64 bits of each text's fingerprint.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text
    of fewer than ``length`` words is one shingle; without words (or null) the
    fingerprint is zero. A column of that name is replaced.
    """
    kept = [f for f in df.schema.fields if f.name != out_col and (keep_text or f.name != text_col)]
    keep = [f.name for f in kept]
    read = [c for c in df.columns if c != out_col]
    schema = T.StructType([*kept, T.StructField(out_col, T.LongType(), False)])

    def run(batches):
        for batch in batches:
            made = (fingerprint(text.as_py(), length) for text in batch.column(batch.schema.get_field_index(text_col)))
            values = np.fromiter(made, dtype=np.uint64, count=batch.num_rows).view(np.int64)
            old = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*old.columns, pa.array(values)], names=[*keep, out_col])

    return df.select(*read).mapInArrow(run, schema)


def covering_masks(radius: int) -> list[int]:
    """The masks, as unsigned integers. Position ``i`` has the code ``1 + i mod (2^(radius+1) - 1)``."""
    vectors = range(1, 1 << (radius + 1))
    codes = [1 + i % (len(vectors)) for i in range(BITS)]
    return [sum(1 << i for i, code in enumerate(codes) if (code & v).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(print_: Column, mask: Column) -> Column:
    """The fingerprint itself and with each single bit outside the mask flipped."""
    single = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    free = F.filter(single, lambda bit: bit.bitwiseAND(mask) == 0)
    return F.concat(F.array(print_), F.transform(free, lambda bit: print_.bitwiseXOR(bit)))


def _stars(df: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Links (a, b), a > b, from each group's smallest node to its others; groups of a bounded size."""
    groups = df.groupBy(*keys).agg(F.collect_set(node).alias("nodes")).where(F.size("nodes") > 1)
    return groups.select(F.explode("nodes").alias("a"), F.array_min("nodes").alias("b")).where("a > b")


def class_links(classes: DataFrame, radius: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (a, b), a > b, between the classes (node, print) within ``radius``
    bits: enough of them to connect what is connected, each a true one.

    Radius 2 is exact for buckets of any size; a smaller radius is checked on
    each pair, a larger one is refused, as larger buckets have no exact way then.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the radius is 0, 1 or 2 bits")
    masks = F.array(*(F.lit(_signed(m)).cast("long") for m in covering_masks(2)))
    placed = (
        classes.select("node", "print", F.posexplode(masks).alias("mask_no", "mask"))
        .withColumn("key", F.col("print").bitwiseAND(F.col("mask")))
    )
    sizes = placed.groupBy("mask_no", "key").agg(F.count("*").alias("members"))
    crowded = written(sizes.where("members > 1"), "simhash-buckets")
    met = placed.join(crowded, ["mask_no", "key"])
    # One table of bucket members serves both ways.
    met = written(met, "simhash-members")
    small = (
        met.where(F.col("members") <= pairwise)
        .groupBy("mask_no", "key")
        .agg(F.collect_list(F.struct("node", "print")).alias("m"))
        .select(F.explode("m").alias("x"), "m")
        .select("x", F.explode("m").alias("y"))
        .where((F.col("x.node") > F.col("y.node")) & (F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) <= radius))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    )
    large = met.where(F.col("members") > pairwise)
    if radius == 2:
        near = large.select("node", F.explode(_flips(F.col("print"), F.col("mask"))).alias("near"))
        linked = _stars(near, ["near"], "node")
    elif radius == 1:
        # Within one bit: one of the two is a flip of the other.
        flipped = large.select("node", "print", F.explode(_flips(F.col("print"), F.col("mask"))).alias("near"))
        other = classes.select(F.col("node").alias("b"), F.col("print").alias("near"))
        linked = flipped.join(other, "near").where("node > b").select(F.col("node").alias("a"), "b")
    else:
        linked = small.where("false")
    return small.union(linked).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links: root is the smallest node reachable.

    Each round links a node's larger neighbours, then its smaller ones, to the
    smallest of them, until every link leads to a root directly.
    """
    edges = written(links.select("a", "b").where("a > b"), "simhash-links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a > b")
        after = written(small.union(least.select("a", F.col("root").alias("b"))).distinct(), "simhash-links")
        # Done when no end of a link has a further link down: all lead to roots.
        if after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and after.groupBy("a").count().where("count > 1").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after


def print_roots(prints: DataFrame, radius: int, pairwise: int) -> DataFrame:
    """(print, root) for the distinct values of ``prints``: root is the same within a component."""
    # A class is named by its fingerprint, so that links need no ids.
    classes = prints.select("print").distinct()
    links = class_links(classes.select(F.col("print").alias("node"), "print"), radius, pairwise)
    roots = components(links)
    return classes.join(roots, classes["print"] == roots["node"], "left").select("print", F.coalesce("root", "print").alias("root"))


def simhash_groups(
    df: DataFrame, length: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", pairwise: int = PAIRWISE
) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows whose fingerprints differ in ``radius`` bits or fewer are linked;
    ``component_id`` is the smallest id reachable over links, the row's own
    included. Null and empty texts have the fingerprint zero and are linked
    like any other. Rows that share an id are rows of their own. Null ids come
    after all others: a component of null ids only has the id null. An
    empty table gives an empty table; other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = written(fingerprints(rows, length, "text", "print"), "simhash-prints")
    least = prints.groupBy("print").agg(F.min("id").alias("least_id"))
    named = written(least.join(print_roots(prints, radius, pairwise), "print"), "simhash-classes")
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = named.select("print", "root").join(ids, "root").select("print", "component_id")
    return prints.join(found, "print").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(
    df: DataFrame, length: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", pairwise: int = PAIRWISE
) -> DataFrame:
    """The rows of ``df`` that stay: of each component of ``simhash_groups`` the
    one of the smallest id, and of rows that share it one. Null ids come last."""
    place, print_ = free_name(df, "locator"), free_name(df, "print")
    staged = df.withColumn(place, F.monotonically_increasing_id())
    rows = written(fingerprints(staged, length, text_col, print_, keep_text=True), "simhash-rows")
    narrow = rows.select(F.col(print_).alias("print"), F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(place).alias("at")).alias("place"))
    least = narrow.groupBy("print").agg(F.min("place").alias("least"))
    named = least.join(print_roots(narrow, radius, pairwise), "print")
    stays = named.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.at").alias(place))
    return rows.join(stays, place, "left_semi").select(*df.columns)
