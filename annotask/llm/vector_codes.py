"""Compression of vectors to codes of exact integer codebooks.

Components become integers (``floor(scale * x)``), vectors are cut into equal parts, and
every part position gets a codebook by rounds of assignment and averaging, all in
whole numbers, so the result does not depend on how the rows are spread.

What keeps a round short: the parts of one position are sorted along a Hilbert curve and
cut into flat blocks of neighbours, written once with the smallest and largest value of
every component (a box), the sums and the count. In a round, an entry whose
distance to the box is above the smallest distance from any entry to the box's
farthest corner cannot be nearest for a row of the block. What is left is the
block's shortlist: one entry takes the whole block by its stored sums, several are
measured against the block's rows by one small integer product. Ties, too, go as by measuring
all entries, as those at the very bound stay on the list.

The driver holds the codebooks (parts x entries x components of a part, whatever the number of rows)
and gets their sums, added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotask.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Rows of a flat block.
BLOCK = 64
# Bits of a Hilbert key; a part of more components is sorted by the first of them.
KEY_BITS = 62


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of grid cells (``bits`` bits a side) along the Hilbert curve, by Skilling's transposition."""
    axes = cells.astype(np.int64).T.copy()
    n = len(axes)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in axes:
            upper = (axis & bit) != 0
            swapped = np.where(upper, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(upper, below, swapped)
            axis ^= swapped
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[n - 1] & (1 << level), (1 << level) - 1, 0)
    axes ^= turn
    keys = np.zeros(axes.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys


def shortlist(entries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Indexes, ascending, of the entries that can be nearest for some point of the box."""
    below, above = low - entries, entries - high
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(high - entries, entries - low)
    bound = np.einsum("ij,ij->i", farthest, farthest).min()
    return np.flatnonzero(np.einsum("ij,ij->i", nearest, nearest) <= bound)


def assign(points: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point its nearest listed entry (the lowest index of equals) and the squared distance."""
    held = entries[listed]
    gap = np.einsum("ij,ij->i", held, held) - 2 * (points @ held.T)
    at = gap.argmin(axis=1)
    least = gap[np.arange(len(points)), at] + np.einsum("ij,ij->i", points, points)
    return listed[at], least


def _ints(buffer) -> np.ndarray:
    return np.frombuffer(buffer.as_buffer(), dtype="<i8")


def _parted(parts: int, width: int, low: float, high: float):
    """Rows (key, vec) → per part (part, hilbert, key, point)."""
    used = min(width, KEY_BITS)
    bits = max(1, KEY_BITS // used) if used else 1
    step = (high - low) / (1 << bits) or 1.0

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keys = np.asarray(batch.column("key"))
            if not len(keys):
                continue
            points = np.asarray(batch.column("vec").flatten()).reshape(len(keys), parts, width)
            for part in range(parts):
                own = np.ascontiguousarray(points[:, part])
                cells = np.clip((own[:, :used] - low) / step, 0, (1 << bits) - 1).astype(np.int64)
                place = hilbert_keys(cells, bits) if used else np.zeros(len(keys), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), part, dtype=np.int32)),
                        pa.array(place),
                        pa.array(keys),
                        pa.array([p.tobytes() for p in own], type=pa.binary()),
                    ],
                    names=["part", "hilbert", "key", "point"],
                )

    return run


_BLOCKS = "part int, keys binary, points binary, low binary, high binary, sums binary, n long"


def _blocked(width: int, size: int):
    """Sorted rows (part, key, point) → blocks of at most ``size`` consecutive rows of one part."""

    def block(part: int, keys: list[int], points: list[bytes]) -> tuple:
        held = np.frombuffer(b"".join(points), dtype="<i8").reshape(len(keys), width)
        whole = [x.astype("<i8").tobytes() for x in (held.min(axis=0), held.max(axis=0), held.sum(axis=0))]
        return part, np.array(keys, dtype="<i8").tobytes(), held.tobytes(), *whole, len(keys)

    def run(batches: Iterator[pa.RecordBatch]):
        part, keys, points = None, [], []
        for batch in batches:
            made = []
            for p, key, point in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "point"))):
                if keys and (p != part or len(keys) == size):
                    made.append(block(part, keys, points))
                    keys, points = [], []
                part = p
                keys.append(key)
                points.append(point)
            if made:
                yield _batch(made)
        if keys:
            yield _batch([block(part, keys, points)])

    types = [pa.int32(), *[pa.binary()] * 5, pa.int64()]
    names = [c.split()[0] for c in _BLOCKS.split(", ")]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def _blocks(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        for part, keys, points, low, high, sums, n in zip(*(batch.column(i) for i in range(7))):
            n = n.as_py()
            yield part.as_py(), _ints(keys), _ints(points).reshape(n, width), _ints(low), _ints(high), _ints(sums), n


def _sums(codebooks: np.ndarray):
    """Blocks → per part and entry the sums of its components and, last, the count: one set of rows per task."""
    parts, entries, width = codebooks.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for part, _, points, low, high, sums, n in _blocks(batches, width):
            listed = shortlist(codebooks[part], low, high)
            if len(listed) == 1:
                total[part, listed[0], :-1] += sums
                total[part, listed[0], -1] += n
            else:
                chosen, _ = assign(points, codebooks[part], listed)
                np.add.at(total[part], (chosen, slice(None, -1)), points)
                total[part, :, -1] += np.bincount(chosen, minlength=entries)
        for part in range(parts):
            used = np.flatnonzero(total[part, :, -1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), part, dtype=np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(total[part, used].tolist(), type=pa.list_(pa.int64())),
                ],
                names=["part", "entry", "sums"],
            )

    return run


def _final(codebooks: np.ndarray):
    """Blocks → per row of a part its entry and squared distance."""
    width = codebooks.shape[2]

    def run(batches):
        for part, keys, points, low, high, _, n in _blocks(batches, width):
            chosen, gap = assign(points, codebooks[part], shortlist(codebooks[part], low, high))
            columns = [pa.array(keys), pa.array(np.full(n, part, dtype=np.int32)), pa.array(chosen), pa.array(gap)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "entry", "gap"])

    return run


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """The rows with a whole vector, without it, with ``code`` (an index of two hex digits per part) and
    ``code_error`` (squared distances to the entries, summed); and the codebooks (parts, entries, components).

    A codebook starts as that part of the rows of the ``entries`` smallest ids (null ids last, equal ids by their
    vectors; fewer rows give fewer entries). A round assigns every part to its nearest entry, ties to the lower
    index, and replaces each used entry by the floor of its parts' averages.

    Rows whose vector is null or holds a null or non-finite component are dropped. Vectors shorter than the longest,
    or of a length that the parts do not divide, count as padded with zeros. Rows that repeat stay rows of
    their own. Columns called ``code`` and ``code_error`` are replaced, all others kept. An empty table gives an
    empty one and empty codebooks. Components too large for 64-bit sums and distances are refused with a ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index of two hex digits takes 1 to 256 entries")
    spark = vectors.sparkSession
    carried = [f for f in vectors.schema.fields if f.name.lower() not in {"code", "code_error"} and f.name != vector_col]
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    row = F.struct(*(F.col(f"`{f.name}`") for f in carried)) if carried else F.struct(F.lit(None).cast("int").alias("none"))
    kept = written(
        vectors.select(
            F.monotonically_increasing_id().alias("key"),
            row.alias("row"),
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
        )
        .where(F.col("vec").isNotNull() & finite)
        .withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))))),
        "codes-rows",
    )
    sizes = kept.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("dims"),
        F.max(F.array_max("vec").cast("double")).alias("top"),
        F.min(F.array_min("vec").cast("double")).alias("bottom"),
    ).first()
    width = -(-sizes["dims"] // parts)
    most = int(max(sizes["top"] or 0, -(sizes["bottom"] or 0)))
    if 4 * most * most * width >= 1 << 62 or most * sizes["rows"] >= 1 << 62:
        raise ValueError("the components are too large for sums and distances of 64 bits")
    padded = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size("vec"))).alias("vec")
    # As many rows as the codebooks have entries.
    first = kept.select("id", padded).orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    codebooks = np.array([r["vec"] for r in first], dtype=np.int64).reshape(len(first), parts, width).swapaxes(0, 1).copy()

    # The grid of the curve: most values lie within three deviations. It orders the blocks, and changes no result.
    value = F.explode("vec").alias("x")
    spread = kept.select(value).agg(F.avg("x").alias("mean"), F.coalesce(F.stddev_pop("x"), F.lit(0.0)).alias("dev")).first()
    middle, reach = spread["mean"] or 0.0, 3 * spread["dev"]
    named = kept.select("key", padded).mapInArrow(
        _parted(parts, width, middle - reach, middle + reach), "part int, hilbert long, key long, point binary"
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["part", "hilbert", "key"]
    blocks = written(
        named.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("part", "key", "point").mapInArrow(
            _blocked(width, block), _BLOCKS
        ),
        "codes-blocks",
    )
    for _ in range(rounds if len(first) else 0):
        partial = blocks.mapInArrow(_sums(codebooks), "part int, entry int, sums array<long>")
        sums = partial.select("part", "entry", F.posexplode("sums")).groupBy("part", "entry", "pos").agg(F.sum("col").alias("sum"))
        total = np.zeros((parts, len(first), width + 1), dtype=np.int64)
        # One number per component of the codebooks.
        for part, entry, pos, value in sums.collect():
            total[part, entry, pos] = value
        used = total[..., -1] > 0
        codebooks[used] = total[used][:, :-1] // total[used][:, -1:]

    ends = blocks.mapInArrow(_final(codebooks), "key long, part int, entry long, gap long")
    digits = F.lower(F.lpad(F.hex("entry"), 2, "0"))
    coded = ends.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("part", digits.alias("digits")))).alias("digits"), F.sum("gap").alias("code_error")
    )
    code = F.array_join(F.transform("digits", lambda d: d["digits"]), "").alias("code")
    out = kept.select("key", "row").join(coded, "key").select(
        *(F.col(f"row.`{f.name}`").alias(f.name) for f in carried), code, "code_error"
    )
    return out, codebooks
