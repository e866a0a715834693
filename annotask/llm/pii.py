"""Personal data by bootstrapped contextual extraction.

Fixed patterns find the seeds: e-mail and IP addresses, card and telephone
numbers. The words around a seed are its lexical patterns. Every token with a
digit that is not part of a seed is a candidate, with patterns of its own. Spark
scores the graph of patterns and instances in rounds: a pattern is trusted
for a kind when nearly all instances it meets, candidates included, are known
to be of that kind, and an instance is accepted when its trusted
patterns leave little doubt. Accepted instances count as known in the next round.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.llm.common import written

KINDS = ("email", "ip", "card", "phone")
# A pattern needs so many known instances of a kind, and that share of all its
# instances (one more unknown instance assumed); an instance that much certainty.
SUPPORT = 5
TRUST = 0.9
ROUNDS = 4
# Candidates have so many characters at least.
SHORTEST = 5
# Characters on either side in which context words are looked for.
REACH = 120

# A run of address characters, with the rest of an address if it follows: runs
# that are none are passed over at once, so long texts take linear time.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]+((?:\.[0-9]+){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start, then in the order of the kinds."""
    spans = []
    if "@" in text:
        spans += [(*m.span(), "email") for m in _EMAIL.finditer(text) if m[1]]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if m[1] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                spans.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidate_spans(text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Tokens with a digit, without the signs around them, that meet no known span."""
    found, at = [], 0
    begins, reach = [s[0] for s in known], []
    for s in known:  # the furthest end of the spans so far, as spans may overlap
        reach.append(max(s[1], reach[-1] if reach else 0))
    while m := _DIGIT.search(text, at):
        start = m.start()
        while start > at and text[start - 1] not in " \t\n\v\f\r":
            start -= 1
        end = at = _TOKEN.match(text, m.start()).end()
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        before = bisect_left(begins, end)
        if end - start >= SHORTEST and not (before and reach[before - 1] > start):
            found.append((start, end))
    return found


def _plain(word: str) -> str:
    return re.sub(r"[0-9]+", "0", re.sub(r"[^\w]+", "", word.lower()))[:32]


def context_patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: the words before and after it, alone and together."""
    left = [_plain(w) for w in text[max(0, start - REACH) : start].split()[-2:]]
    right = [_plain(w) for w in text[end : end + REACH].split()[:1]]
    left = ["^"] * (2 - len(left)) + left
    right = right or ["$"]
    return [f"{left[0]} {left[1]} _", f"{left[1]} _", f"_ {right[0]}", f"{left[1]} _ {right[0]}"]


_MENTION = T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("instance", T.StringType()),
    T.StructField("patterns", T.ArrayType(T.StringType())),
])
_ARROW_MENTION = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string())),
]))


def mentions(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` without its text, with an array of its seeds and candidates (kind null)."""
    kept = [f for f in df.schema.fields if f.name not in (out_col, text_col)]
    keep = [f.name for f in kept]

    def of(text: str | None) -> list[dict]:
        text = text or ""
        seeds = base_spans(text)
        found = seeds + [(a, b, None) for a, b in candidate_spans(text, seeds)]
        return [
            {"start": a, "end": b, "kind": kind, "instance": text[a:b], "patterns": context_patterns(text, a, b)} for a, b, kind in found
        ]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            made = pa.array([of(t.as_py()) for t in texts], _ARROW_MENTION)
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, made], names=[*keep, out_col])

    schema = T.StructType([*kept, T.StructField(out_col, T.ArrayType(_MENTION))])
    return df.select(*keep, text_col).mapInArrow(run, schema)


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> tuple[DataFrame, DataFrame]:
    """From distinct (pattern, instance, kind; null: candidate): the accepted
    (instance, kind, certainty) and the trusted (pattern, kind, share) of the last round."""
    seeds = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("certainty", F.lit(1.0))
    links = written(edges.select("pattern", "instance").distinct(), "pii-links")
    met = written(links.groupBy("pattern").agg(F.count("*").alias("met")), "pii-patterns")
    candidates = links.join(seeds.select("instance").distinct(), "instance", "left_anti")
    candidates = written(candidates, "pii-candidates")
    seeds = written(seeds, "pii-seeds")
    known, accepted_before = seeds, 0
    for _ in range(rounds):
        sums = links.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("certainty").alias("sum"), F.count("*").alias("n"))
        share = F.col("sum") / (F.col("met") + 1)
        trusted = sums.join(met, "pattern").withColumn("share", share).where((F.col("n") >= support) & (F.col("share") >= trust))
        trusted = written(trusted.select("pattern", "kind", "share"), "pii-trusted")
        doubt = F.exp(F.sum(F.log(1 - F.col("share"))))
        scored = candidates.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("certainty"))
        best = scored.groupBy("instance").agg(F.max(F.struct("certainty", "kind")).alias("best")).select("instance", "best.kind", "best.certainty")
        accepted = written(best.where(F.col("certainty") >= trust), "pii-accepted")
        now = accepted.count()
        if now == accepted_before:
            break
        known, accepted_before = seeds.union(accepted), now
    return accepted, trusted


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    placed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(placed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def extract_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``base`` (array of start, end, kind of the fixed
    patterns) and ``added`` (array of those that the bootstrapping adds).

    Places are code points, end exclusive. Null and empty texts have no spans.
    Rows that share an id are rows of their own. An empty table gives an empty
    table; other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    found = written(mentions(rows, "text", "mentions"), "pii-mentions")
    each = found.select("place", F.explode("mentions").alias("m"))
    edges = each.select(F.explode("m.patterns").alias("pattern"), "m.instance", "m.kind").distinct()
    accepted, _ = bootstrap(written(edges, "pii-edges"))
    open_ = each.where("m.kind is null").select("place", F.col("m.instance").alias("instance"), "m.start", "m.end")
    span = F.struct(F.col("start"), F.col("end"), F.col("kind"))
    added = open_.join(accepted, "instance").groupBy("place").agg(F.sort_array(F.collect_list(span)).alias("added"))
    base = F.transform(
        F.filter("mentions", lambda m: m["kind"].isNotNull()),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind")),
    )
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")
    return found.join(added, "place", "left").select(
        F.col("id").alias(id_col), base.alias("base"), F.coalesce("added", nothing).alias("added")
    )
