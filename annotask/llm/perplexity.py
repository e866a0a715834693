"""Quality rules with an n-gram language model.

The model is a modified Kneser-Ney model of the characters of each language.
Characters are hashed to 64 classes (small letters and common marks have one of
their own), so a 4-gram is a number below 2^24. Tasks count the 4-grams of
their texts and Spark adds the counts up; counts of lower orders (how many
classes precede a gram), discounts, context sums and probabilities are grouped
aggregations and joins. The result is held in arrays sorted by gram hash.

Over it lies a model of whole words (64-bit hashes), discounted like the lower
orders: what the discounts take goes in equal parts to the word's spelling, that is, to
the character model, and to all words alike, unseen ones as one word. A word is scored by the counts of the other half of the texts,
so a text does not vouch for itself; halves go by the smallest hash of a few
neighbouring words, which near copies mostly share. No entry that a score asks is left out: where a model is
larger than a broadcast, languages and ranges of word hashes take turns.

A text is rejected when its perplexity (per word) lies outside its language's
band. Log perplexities are put in robust standard deviations from the median, wider for
short texts, whose perplexity varies more. Each side of the band starts at the
smallest deviation at which the texts beyond it outnumber those of a normal
distribution so far that at most a share ``FALSE_SHARE`` of them is expected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.llm.common import written

ORDER = 4
CLASS_BITS = 6
CLASSES = 1 << CLASS_BITS
# Classes with a meaning; all other characters share the rest by hash.
START, SPACE, DIGIT, CAPITAL = 0, 1, 2, 3
LETTERS = "abcdefghijklmnopqrstuvwxyz"
MARKS = ".,;:!?'\"-()#*$%&|<>"
OTHER = 4 + len(LETTERS) + len(MARKS)
# Characters of one language that are counted or scored together.
CHUNK = 1 << 21
# Entries of the model that are broadcast at a time, about; one language's
# character model (at most 2^24 4-grams) is not divided.
MAX_ENTRIES = 8_000_000
# Parts of the word hashes' range that a language is divided into at most.
RANGES = 1 << 10
# Word counts that a counting task holds before it hands them on.
HELD_WORDS = 1_600_000
# A side of a band is chosen in steps of robust standard deviations, up to BAND,
# so that of the texts beyond it at most this share is expected by chance.
BAND, NARROWEST, STEP, FALSE_SHARE = 8.0, 1.5, 0.1, 0.3

# Neighbouring words whose hashes choose a text's half.
NEIGHBOURS = 4

MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
# Put before each of several joined texts, and after the last: as many signs as a 4-gram looks back.
_GAP = b" " * (ORDER - 1)
# Words up to so many bytes are told apart eight bytes at a time.
LONG_WORD = 64


def _class_table() -> np.ndarray:
    table = np.array([OTHER + c % (CLASSES - OTHER) for c in range(128)], dtype=np.uint8)
    for c in map(ord, _SPACES):
        table[c] = SPACE
    for c in range(128):
        if chr(c).isdigit():
            table[c] = DIGIT
        elif chr(c).isupper():
            table[c] = CAPITAL
    for first, signs in ((4, LETTERS), (4 + len(LETTERS), MARKS)):
        for k, sign in enumerate(signs):
            table[ord(sign)] = first + k
    return table


_TABLE = _class_table()


_IN_WORD = ~np.isin(np.arange(256), list(_SPACES.encode()))
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class Joined:
    """Texts (as UTF-8) side by side, so that a call of numpy serves many of them.

    Words ``cuts[i]`` to ``cuts[i + 1]`` are those of text ``i``; ``begins``, ``ends``, ``starts`` and ``stops``
    are the places of texts and words in bytes, ``place`` turns them into code points.
    """

    def __init__(self, texts: list[bytes]):
        self.texts, self.data = texts, _GAP.join([b"", *texts, b""])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + len(_GAP))
        self.begins = self.ends - sizes
        self.raw = np.frombuffer(self.data, np.uint8)
        inside = _IN_WORD[self.raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.stops = edges[::2], edges[1::2]
        self.cuts = np.concatenate(([0], np.searchsorted(self.starts, self.ends)))
        self.n_words = np.diff(self.cuts)
        self._places = None if self.data.isascii() else np.cumsum((self.raw & 0xC0) != 0x80) - 1

    def place(self, at: np.ndarray) -> np.ndarray:
        return at if self._places is None else self._places[at]

    def gaps(self) -> np.ndarray:
        """The signs around the texts, by their places in code points."""
        first = self.place(np.append(self.begins - len(_GAP), self.ends[-1:]))
        return (first[:, None] + np.arange(len(_GAP))).ravel()

    def codes(self) -> np.ndarray:
        """The hash of the 4-gram that ends at each character; each text is preceded by start signs."""
        if self._places is None:
            own = _TABLE[self.raw]
        else:
            points = np.frombuffer(self.data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype="<u4")
            own = _TABLE[np.minimum(points, 127)]
            far = np.flatnonzero(points > 127)
            own[far] = OTHER + points[far] % (CLASSES - OTHER)
        own[self.gaps()] = START
        out = own.astype(np.uint32)
        for width in (1, 2):  # of single classes, then of pairs
            out[width:] |= out[:-width] << np.uint32(CLASS_BITS * width)
        return out

    def hashes(self) -> np.ndarray:
        """The 64-bit hash (XXH3) of each word, made once for those that are equal."""
        mixed = self._mixed_words()
        _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
        spans = zip(self.starts[first].tolist(), self.stops[first].tolist())
        return np.fromiter((xxhash.xxh3_64_intdigest(self.data[a:b]) for a, b in spans), np.uint64, len(first))[which]

    def _mixed_words(self) -> np.ndarray:
        """A number of 64 bits that tells words apart: eight bytes at a time are mixed in, long words have their hash."""
        eight = np.ndarray(len(self.data), "<u8", self.data + bytes(8), strides=(1,))
        sizes = self.stops - self.starts
        out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        open_ = np.flatnonzero(sizes <= LONG_WORD)
        for k in range(0, LONG_WORD, 8):
            rest = sizes[open_] - k
            mixed = out[open_] ^ (eight[self.starts[open_] + k] & _FIRST_BYTES[np.minimum(rest, 8)])
            for factor, shift in ((0xBF58476D1CE4E5B9, 32), (0x94D049BB133111EB, 29)):
                mixed *= np.uint64(factor)
                mixed ^= mixed >> np.uint64(shift)
            out[open_] = mixed
            open_ = open_[rest > 8]
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.stops[i]])
        return out

    def halves(self, hashes: np.ndarray) -> np.ndarray:
        """``half`` of each text."""
        out = np.zeros(len(self.texts), np.int64)
        for i in np.flatnonzero((self.n_words > 0) & (self.n_words < NEIGHBOURS)).tolist():
            out[i] = half(hashes[self.cuts[i] : self.cuts[i + 1]])
        long = np.flatnonzero(self.n_words >= NEIGHBOURS)
        if len(long):
            mixed = np.append(_mixed(hashes, NEIGHBOURS), np.uint64(0))  # the last text's end is a place too
            spans = np.stack((self.cuts[long], self.cuts[long + 1] - (NEIGHBOURS - 1)), axis=1).ravel()
            out[long] = np.minimum.reduceat(mixed, spans)[::2] >> np.uint64(7) & np.uint64(1)
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of the characters' values for each word, which goes up to the next one or the text's end."""
        full = np.flatnonzero(self.n_words)
        after = self.cuts[full + 1]
        places = self.place(np.insert(self.starts, after, self.ends[full]))
        return np.delete(np.add.reduceat(values, places), after + np.arange(len(full))) if len(full) else np.zeros(0)

    def rules(self, hashes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
        chars = np.concatenate(([0], np.cumsum(self.place(self.stops) - self.place(self.starts))))[self.cuts]
        symbols = np.searchsorted(np.flatnonzero(_IS_SYMBOL[self.raw]), np.append(0, self.ends))
        repeated = np.zeros(len(self.texts), np.int64)
        windows = hashes
        for width in (1, 2, 4):  # of single words, pairs, fours
            windows = windows[:-width] * np.uint64(0xBF58476D1CE4E5B9) + windows[width:]
            windows ^= windows >> np.uint64(31)
        for i in np.flatnonzero(self.n_words > WINDOW).tolist():
            own = np.sort(windows[self.cuts[i] : self.cuts[i + 1] - (WINDOW - 1)])
            if (own[1:] == own[:-1]).any():
                # Equal hashes are only a hint: the words themselves decide.
                repeated[i] = _repeated(self.texts[i].split())
        doubles = map(_double_lines, self.texts)
        return list(zip(self.n_words.tolist(), np.diff(chars).tolist(), np.diff(symbols).tolist(), doubles, repeated.tolist()))


def grams(text: str) -> np.ndarray:
    """The hash of the 4-gram that ends at each character; the text is preceded by start signs."""
    return Joined([text.encode("utf-8", "surrogatepass")]).codes()[len(_GAP) : -len(_GAP)]


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def gram_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each 4-gram occurs in the texts of each language."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add_up(lang):
            if sizes.get(lang):
                joined = Joined(held.pop(lang))
                keys, counts = np.unique(np.delete(joined.codes(), joined.gaps()), return_counts=True)
                sizes[lang] = 0
                if lang in sums:
                    keys, counts = np.concatenate((sums[lang][0], keys)), np.concatenate((sums[lang][1], counts))
                sums[lang] = _merged(keys, counts)

        def rows(lang):
            keys, counts = sums.pop(lang)
            for at in range(0, len(keys), CHUNK // 8):
                part = keys[at : at + CHUNK // 8].astype(np.int64), counts[at : at + CHUNK // 8].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part[0]), pa.string()), *map(pa.array, part)], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _utf8(batch.column(1))):
                lang = lang or ""
                if text:
                    held.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text)
                    if sizes[lang] >= CHUNK:
                        add_up(lang)
            if len(sizes) > 16:  # many languages: hand on what there is
                for lang in list(sizes):
                    add_up(lang)
                for lang in list(sums):
                    yield from rows(lang)
                sizes.clear()
        for lang in list(sizes):
            add_up(lang)
        for lang in list(sums):
            yield from rows(lang)

    pairs = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, ord, gram, log_p, log_backoff, n) from the counts of the highest order.

    ``log_p`` of a gram is its last class's interpolated log probability
    after the others; ``log_backoff`` is the weight of the next lower
    order after the gram as a context. Null where the gram has no such role.
    """
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        # A lower order counts the classes seen before a gram.
        lower = levels[k + 1].select("lang", (F.col("gram") % (1 << CLASS_BITS * k)).alias("gram"))
        levels[k] = lower.groupBy("lang", "gram").agg(F.count("*").alias("n"))

    def discount(c: Column, times: list[str]) -> Column:
        one, two, three, four = (F.greatest(F.col(t), F.lit(1)) for t in times)
        y = one / (one + 2 * two)
        ds = [F.lit(float(k)) - (k + 1) * y * after / this for k, this, after in ((1, one, two), (2, two, three), (3, three, four))]
        # Small tables can leave the estimate's range.
        ds = [F.greatest(F.lit(0.1), F.least(d, F.lit(k - 0.1))) for k, d in enumerate(ds, 1)]
        return F.when(c == 1, ds[0]).when(c == 2, ds[1]).otherwise(ds[2])

    lower, parts = None, []
    times = [f"t{k}" for k in range(1, 5)]
    for k in range(1, order + 1):
        level = levels[k].withColumn("context", F.shiftright("gram", CLASS_BITS))
        of_counts = level.groupBy("lang").agg(*(F.count(F.when(F.col("n") == c, 1)).alias(t) for c, t in enumerate(times, 1)))
        level = level.join(of_counts, "lang").withColumn("d", discount(F.col("n"), times))
        contexts = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("taken"))
        level = level.join(contexts, ["lang", "context"])
        share, weight = (F.col("n") - F.col("d")) / F.col("total"), F.col("taken") / F.col("total")
        if k == 1:
            found = level.withColumn("p", share + weight / CLASSES)
        else:
            rest = lower.select("lang", F.col("gram").alias("rest"), F.col("p").alias("lower_p"))
            met = level.withColumn("rest", F.col("gram") % (1 << CLASS_BITS * (k - 1))).join(rest, ["lang", "rest"])
            found = met.withColumn("p", share + weight * F.col("lower_p"))
        lower = written(found.select("lang", "gram", "n", "p"), f"grams-{k}")
        nothing = F.lit(None).cast("double")
        parts.append(lower.select("lang", F.lit(k).alias("ord"), "gram", F.log("p").alias("log_p"), nothing.alias("log_backoff"), "n"))
        weights = contexts.select("lang", F.lit(k - 1).alias("ord"), F.col("context").alias("gram"), nothing.alias("log_p"), F.log(F.col("taken") / F.col("total")).alias("log_backoff"), F.lit(None).cast("long").alias("n"))
        parts.append(weights)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


class Model:
    """The arrays of all languages: for each order, gram hashes in order with their values."""

    def __init__(self, table: pa.Table):
        self.arrays: dict[tuple[str, str, int], tuple[np.ndarray, np.ndarray]] = {}
        for lang in table.column("lang").unique().to_pylist():
            own = table.filter(pc.equal(table.column("lang"), lang))
            for role in ("log_p", "log_backoff"):
                ranks, keys, values = (own.column(c).to_numpy() for c in ("ord", "gram", role))
                for k in range(ORDER + 1):
                    at = np.flatnonzero((ranks == k) & ~np.isnan(values.astype(np.float64)))
                    at = at[np.argsort(keys[at], kind="stable")]
                    self.arrays[lang, role, k] = keys[at].astype(np.uint32), values[at].astype(np.float32)

    def _values(self, lang: str, role: str, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the keys, and which keys there are."""
        known, values = self.arrays[lang, role, k]
        if not len(known):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return values[at], known[at] == keys

    def log_p(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Log probability of each 4-gram's last class; an unseen gram goes to the lower order."""
        out, open_ = np.zeros(len(keys), np.float32), np.arange(len(keys))
        for k in range(ORDER, 0, -1):
            grams_ = keys[open_] & np.uint32((1 << CLASS_BITS * k) - 1)
            values, found = self._values(lang, "log_p", k, grams_)
            out[open_[found]] += values[found]
            missing = ~found
            backoff, known = self._values(lang, "log_backoff", k - 1, grams_[missing] >> np.uint32(CLASS_BITS))
            open_ = open_[missing]
            out[open_] += np.where(known, backoff, 0)
        out[open_] -= math.log(CLASSES)
        return out


def word_hashes(words: list[str], cache: dict | None = None) -> np.ndarray:
    """The 64-bit hash of each word; ``cache`` is not used any more."""
    return Joined([" ".join(words).encode("utf-8", "surrogatepass")]).hashes()


def _mixed(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each so many neighbouring words."""
    mixed = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed


def half(hashes: np.ndarray) -> int:
    """0 or 1, by the smallest hash of four neighbouring words (of all, in a shorter text)."""
    return int(_mixed(hashes, min(NEIGHBOURS, len(hashes))).min() >> np.uint64(7)) & 1 if len(hashes) else 0


def _utf8(texts: pa.Array) -> list[bytes]:
    """The texts of a batch; null counts as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _chunks(langs: list[str], texts: list[bytes]):
    """(lang, numbers of its rows, their texts joined), a few megabytes at a time."""
    rows, size, last = [], 0, None
    # By language, so that one table serves a batch's rows of it.
    for i in sorted(range(len(langs)), key=langs.__getitem__):
        if rows and (langs[i] != last or size + len(texts[i]) > CHUNK):
            yield last, rows, Joined([texts[k] for k in rows])
            rows, size = [], 0
        rows.append(i)
        size, last = size + len(texts[i]), langs[i]
    if rows:
        yield last, rows, Joined([texts[k] for k in rows])


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, n0, n1): how often each word (its hash) occurs in either half of each language's texts."""
    schema = T.StructType([T.StructField("lang", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("word", "n0", "n1"))])

    def run(batches):
        held, size = {}, 0

        def merge():
            for lang, pair in held.items():
                keys = np.unique(np.concatenate([k for k, _ in pair]))
                sums = np.zeros((2, len(keys)), np.int64)
                for k, n in pair:
                    sums[:, np.searchsorted(keys, k)] += n
                held[lang] = [(keys, sums)]
            return sum(len(pair[0][0]) for pair in held.values())

        def rows():
            merge()
            for lang, [(keys, sums)] in held.items():
                for at in range(0, len(keys), CHUNK // 8):
                    cut = slice(at, at + CHUNK // 8)
                    own = keys[cut].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(sums[0, cut]), pa.array(sums[1, cut])], names=schema.names)

        for batch in batches:
            langs = [lang or "" for lang in batch.column(0).to_pylist()]
            for lang, _, joined in _chunks(langs, _utf8(batch.column(1))):
                hashes = joined.hashes()
                of_word = np.repeat(joined.halves(hashes), joined.n_words)
                for h in (0, 1):
                    keys, counts = np.unique(hashes[of_word == h], return_counts=True)
                    if len(keys):
                        held.setdefault(lang, []).append((keys, np.stack((counts * (1 - h), counts * h))))
                        size += len(keys)
                if size > HELD_WORDS:
                    size = merge()
                    if size > HELD_WORDS // 2:
                        yield from rows()
                        held, size = {}, 0
        yield from rows()

    pairs = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(run, schema).groupBy("lang", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


class Words:
    """Word counts of one language (or a range of hashes of it) and the discounts of each half."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, totals: dict):
        order = np.argsort(keys)
        # As small a type as holds the largest count.
        self.keys, self.counts = keys[order], counts[:, order].astype(np.min_scalar_type(int(counts.max(initial=0))))
        self.by_half = []
        for h in (0, 1):
            n, types, *t = (totals[f"{c}_{h}"] for c in ("n", "types", "t1", "t2", "t3", "t4"))
            one, two, three, four = (max(1, x) for x in t)
            y = one / (one + 2 * two)
            # Small tables can leave the estimate's range.
            ds = [min(k - 0.1, max(0.1, k - (k + 1) * y * after / this)) for k, this, after in ((1, one, two), (2, two, three), (3, three, four))]
            taken = ds[0] * t[0] + ds[1] * t[1] + ds[2] * (types - t[0] - t[1])
            self.by_half.append((n, np.array([0.0, *ds]), taken, types))

    def log_p(self, hashes: np.ndarray, spelling: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Log probability of words by the counts of each one's half ``other``, given those of their spelling."""
        n, out = np.zeros(len(hashes), np.int64), spelling.copy()
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            n = np.where(self.keys[at] == hashes, self.counts[other, at], 0)
        for h, (total, ds, taken, types) in enumerate(self.by_half):
            if total:
                own = np.flatnonzero(other == h)
                k, base = n[own], (np.exp(spelling[own]) + 1 / (types + 1)) / 2
                out[own] = np.log((k - ds[np.minimum(k, 3)]) / total + taken / total * base)
        return out


def _turns(sizes: list[tuple[str, int, int]], most: int) -> list[list[tuple[str, int, int]]]:
    """(lang, part, parts) in groups that are broadcast together, from (lang, characters' entries, words)."""
    turns, room = [], 0
    for lang, fixed, words in sorted(sizes, key=lambda s: s[1] + s[2]):
        parts = min(RANGES, max(1, math.ceil(words / max(most - fixed, most // 4, 1))))
        need = fixed + words // parts
        for part in range(parts):
            if not turns or need > room or parts > 1:
                turns.append([])
                room = most
            turns[-1].append((lang, part, parts))
            room -= need
    return turns


def _normal_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def band_sides(deviations: DataFrame, band: float = BAND, false_share: float = FALSE_SHARE) -> DataFrame:
    """(lang, below, above): where each side of a band starts, from (lang, z) of all texts."""
    steps = max(0, round((band - NARROWEST) / STEP))
    starts = [min(band, NARROWEST + STEP * k) for k in range(steps)] + [band]
    bins = F.least(F.floor((F.abs("z") - F.lit(NARROWEST)) / F.lit(STEP)), F.lit(len(starts) - 1)).cast("int")
    counted = deviations.withColumn("side", F.col("z") > 0).groupBy("lang", "side", bins.alias("bin")).agg(F.count("*").alias("n"))
    # Small: a row per language, side and step.
    beyond = counted.withColumn("beyond", F.sum("n").over(W.partitionBy("lang", "side").orderBy(F.col("bin").desc())))
    beyond = beyond.withColumn("all", F.sum("n").over(W.partitionBy("lang")))
    tail = F.element_at(F.array(*(F.lit(_normal_tail(s)) for s in starts)), F.greatest(F.col("bin"), F.lit(0)) + 1)
    good = beyond.where((F.col("bin") >= 0) & (F.col("all") * tail <= F.lit(false_share) * F.col("beyond")))
    start = F.element_at(F.array(*map(F.lit, starts)), F.col("bin") + 1)
    return good.groupBy("lang").agg(F.min(F.when(~F.col("side"), start)).alias("below"), F.min(F.when(F.col("side"), start)).alias("above"))


def _double_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier one."""
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    read = [line for line in lines if line.strip()]
    return len(read) - len(set(read))


def _repeated(words: list[bytes]) -> int:
    """Words in windows that are found twice or more."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.uint64)
    windows = [ids[i : i + WINDOW].tobytes() for i in range(len(ids) - WINDOW + 1)]
    met: dict[bytes, int] = {}
    for w in windows:
        met[w] = met.get(w, 0) + 1
    marks = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.flatnonzero([met[w] > 1 for w in windows])
    marks[starts] += 1
    np.subtract.at(marks, starts + WINDOW, 1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def rules(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    joined = Joined([text.encode("utf-8", "surrogatepass")])
    return joined.rules(joined.hashes())[0]


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    band: float = BAND,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """Per row of ``df``: its id, ``lang``, the rules' counts, ``n_chars_scored``,
    ``perplexity`` (per word), the band's ``lower`` and ``upper`` limits,
    ``base_failed`` and ``kept``.

    Texts without words (null and empty ones too) fail the base rules and have a null
    perplexity; a null language is a language of its own, as ''. Rows that
    repeat are judged alike. An empty table gives an empty table; other columns
    are not read. ``band`` is the widest a side of a band may be; ``max_entries``
    bounds what is broadcast at a time and changes no result.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    # Each 4-gram of a scored text was counted, so the lower orders are not asked once its probability is known.
    entries = kneser_ney(written(gram_counts(rows), "grams")).where((F.col("ord") == ORDER) & F.col("log_p").isNotNull())
    entries = written(entries.drop("n"), "grams-model")
    words = written(word_counts(rows), "words")
    per_half = [
        f(F.col(f"n{h}")).alias(f"{name}_{h}")
        for h in (0, 1)
        for name, f in (
            ("n", F.sum), ("types", lambda c: F.count_if(c > 0)), *((f"t{k}", lambda c, k=k: F.count_if(c == k)) for k in (1, 2, 3, 4)))
    ]
    # A text's words occur in its own half, and are judged by the other: one that a half lacks is judged as an unseen one.
    shared_words = (F.col("n0") > 0) & (F.col("n1") > 0)
    # One row per language.
    totals = {r["lang"]: r.asDict() for r in words.groupBy("lang").agg(F.count_if(shared_words).alias("words"), *per_half).collect()}
    sizes = {r["lang"]: r["count"] for r in entries.groupBy("lang").count().collect()}
    turns = _turns([(lang, n, totals[lang]["words"] if lang in totals else 0) for lang, n in sizes.items()], max_entries)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_scored"]
    sums = [T.StructField("log_p", T.DoubleType()), T.StructField("log_p2", T.DoubleType())]
    key = T.StructField("key", T.BinaryType())
    counted = T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField(n, T.LongType()) for n in names] + [key])

    whole = T.StructType([*counted.fields, *sums])
    partial = T.StructType([whole["lang"], key, *sums])

    def score(shared, with_rules):
        def run(batches):
            models = shared.value
            table, table_lang, filled = np.full(1 << CLASS_BITS * ORDER, np.nan, np.float32), None, []

            def look_up(lang, codes, gaps):
                nonlocal table_lang
                model = models[lang][0]
                if table_lang != lang:
                    for keys in filled:
                        table[keys] = np.nan
                    filled.clear()
                    table_lang = lang
                    keys, values = model.arrays[lang, "log_p", ORDER]
                    table[keys] = values
                    filled.append(keys)
                found = table[codes]
                found[gaps] = 0
                missing = np.isnan(found)
                if missing.any():
                    keys = np.unique(codes[missing])
                    table[keys] = model.log_p(lang, keys)
                    filled.append(keys)
                    found[missing] = table[codes[missing]]
                return found.astype(np.float64)

            def sums_of(lang, joined, hashes):
                if lang not in models or not len(hashes):
                    return [0.0] * len(joined.texts), [0.0] * len(joined.texts)
                _, counts, part, parts = models[lang]
                spelling = joined.sums(look_up(lang, joined.codes(), joined.gaps()))
                text = np.repeat(np.arange(len(joined.texts)), joined.n_words)
                other = 1 - joined.halves(hashes)[text]
                if parts > 1:
                    own = hashes % np.uint64(parts) == np.uint64(part)
                    hashes, spelling, text, other = hashes[own], spelling[own], text[own], other[own]
                one = counts.log_p(hashes, spelling, other)
                return tuple(np.bincount(text, weights=w, minlength=len(joined.texts)).tolist() for w in (one, one * one))

            for batch in batches:
                made = [None] * batch.num_rows
                for lang, at, joined in _chunks(batch.column(1).to_pylist(), _utf8(batch.column(2))):
                    hashes = joined.hashes()
                    own = list(zip(map(xxhash.xxh3_128_digest, joined.texts), *sums_of(lang, joined, hashes)))
                    if with_rules:
                        lengths = (joined.place(joined.ends) - joined.place(joined.begins)).tolist()
                        own = [(*r, n, *o) for r, n, o in zip(joined.rules(hashes), lengths, own)]
                    for i, row in zip(at, own):
                        made[i] = row
                fields = whole.fields[2:] if with_rules else partial.fields[1:]
                kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
                columns = [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(zip(*made), fields)]
                if made:
                    given = [batch.column(0), batch.column(1)] if with_rules else [batch.column(1)]
                    yield pa.RecordBatch.from_arrays([*given, *columns], names=whole.names if with_rules else partial.names)

        return run

    def broadcast(turn):
        models = {}
        for lang, part, parts in turn:
            model = Model(entries.where(F.col("lang") == lang).toArrow())
            # The remainder of the hash as an unsigned number, as numpy takes it.
            unsigned = F.pmod(F.pmod(F.shiftrightunsigned("word", 1), F.lit(parts)) * 2 + F.col("word").bitwiseAND(F.lit(1)), F.lit(parts))
            own = words.where((F.col("lang") == lang) & shared_words & (unsigned == part)).toArrow()
            keys, n0, n1 = (own.column(c).to_numpy() for c in ("word", "n0", "n1"))
            if lang in totals:
                models[lang] = model, Words(keys.astype(np.int64).view(np.uint64), np.stack((n0, n1)), totals[lang]), part, parts
        return df.sparkSession.sparkContext.broadcast(models)

    first, *others = turns or [[]]
    shared = broadcast(first)
    scored = written(rows.mapInArrow(score(shared, True), whole), "quality-scores")
    if others:
        shared.destroy()
        each = scored.select("lang", "key", "log_p", "log_p2").groupBy("lang", "key").agg(F.max("log_p").alias("log_p"), F.max("log_p2").alias("log_p2"))
        for turn in others:
            shared = broadcast(turn)
            own = rows.where(F.col("lang").isin([lang for lang, _, _ in turn])).mapInArrow(score(shared, False), partial)
            # Rows of one text have the same sums.
            own = own.groupBy("lang", "key").agg(F.max("log_p").alias("log_p"), F.max("log_p2").alias("log_p2"))
            each = each.unionByName(written(own, "quality-part"))
            shared.destroy()
        each = each.groupBy("lang", "key").agg(F.sum("log_p").alias("log_p"), F.sum("log_p2").alias("log_p2"))
        scored = written(scored.drop("log_p", "log_p2").join(each, ["lang", "key"]), "quality-sums")
    mean = F.col("log_p") / F.col("n_words")
    read = scored.where("n_words > 0")
    # Spread of a single word around its text's mean, for short texts.
    spread = read.groupBy("lang").agg(
        F.percentile_approx(mean, 0.5, 10_000).alias("median"),
        ((F.sum("log_p2") - F.sum(F.col("log_p") * mean)) / F.sum("n_words")).alias("variance"),
    )
    # One row per language: in one file, its measured size lets Spark broadcast it.
    spread = written(spread.coalesce(1), "quality-medians")
    off = F.abs(mean - F.col("median"))
    bands = read.join(spread, "lang").groupBy("lang").agg(
        F.first("median").alias("median"), F.first("variance").alias("variance"), F.percentile_approx(off, 0.5, 10_000).alias("mad")
    )
    bands = written(bands.coalesce(1), "quality-bands")
    unit = F.greatest(
        F.sqrt(F.pow(F.lit(1.4826) * F.col("mad"), 2) + F.greatest(F.col("variance"), F.lit(0.0)) / F.col("n_words")), F.lit(1e-9)
    )
    put = read.join(bands, "lang").select("lang", ((F.col("median") - mean) / unit).alias("z"))
    scale = put.groupBy("lang").agg((F.lit(1.4826) * F.percentile_approx(F.abs("z"), 0.5, 10_000)).alias("scale"))
    scale = written(scale.withColumn("scale", F.greatest("scale", F.lit(1e-9))).coalesce(1), "quality-scales")
    sides = band_sides(put.join(scale, "lang").select("lang", (F.col("z") / F.col("scale")).alias("z")), band)
    bands = bands.join(scale, "lang").join(sides, "lang", "left").fillna({"below": band, "above": band})
    bands = written(bands.coalesce(1), "quality-sides").withColumnRenamed("lang", "of")
    met = scored.join(bands, F.col("lang") == F.col("of"), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    step = unit * F.col("scale")
    met = (
        met.withColumn("perplexity", F.when(F.col("n_words") > 0, F.exp(-mean)))
        .withColumn("lower", F.when(F.col("n_words") > 0, F.exp(-F.col("median") - F.col("below") * step)))
        .withColumn("upper", F.when(F.col("n_words") > 0, F.exp(-F.col("median") + F.col("above") * step)))
        .withColumn("base_failed", failed)
    )
    inside = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return met.select(
        F.col("id").alias(id_col), "lang", *names[:-1], F.col("n_scored").alias("n_chars_scored"),
        "perplexity", "lower", "upper", "base_failed", (~F.col("base_failed") & inside).alias("kept"),
    )
