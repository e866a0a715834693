"""Quality by hierarchical empirical Bayes.

A classifier gives each document its evidence: the log likelihood ratio of its
features between labelled good and bad documents (naive Bayes over binned
text statistics, counted by Spark). Sites add a prior: the rate of good
documents over all, over a host and over a path of that host, each shrunk towards
the one above with a strength that is estimated from how much the rates really
differ. A sparse site stays near its host, a sparse host near the global rate.
A document's own evidence is taken out of the rates it is judged by, so it does
not count twice.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotask.llm.common import WORD, text_or_empty, written

# Evidence of one feature at most, in log odds; keeps a rare bin from deciding alone.
MAX_EVIDENCE = 4.0
# Pseudo-documents added to each bin of each class.
SMOOTHING = 1.0
# Bounds of the estimated strengths, in documents.
STRENGTH = (1.0, 1000.0)
THRESHOLD = 0.3


def features(text: Column) -> dict[str, Column]:
    """Binned statistics of a text, as small integers."""
    chars = F.char_length(text)
    words = F.regexp_count(text, F.lit(WORD))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / F.greatest(chars, F.lit(1))

    def bins(value: Column, *limits: float) -> Column:
        return sum((F.when(value > limit, 1).otherwise(0) for limit in limits), F.lit(0)).cast("int")

    return {
        "words": bins(words, 0, 5, 20, 50, 200, 1000, 5000),
        "word_length": bins(chars / F.greatest(words, F.lit(1)), 3, 4, 5, 6, 7, 9, 12),
        "symbols": bins(share(r"[#*$%&|<>{}=_~^]"), 0.0, 0.005, 0.02, 0.05, 0.1, 0.2),
        "capitals": bins(share(r"[A-Z]"), 0.0, 0.005, 0.02, 0.05, 0.15, 0.4),
        "digits": bins(share(r"[0-9]"), 0.0, 0.002, 0.01, 0.03, 0.1),
        "exclamations": bins(share(r"[!?]"), 0.0, 0.002, 0.01, 0.03),
        "lines": bins(share(r"\n"), 0.0, 0.002, 0.005, 0.01, 0.03),
        # What is left of a text whose words are counted once each.
        "distinct": bins(F.size(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1))) / F.greatest(words, F.lit(1)),
                         0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    }


def evidence_table(labelled: DataFrame, names: list[str], label: str) -> DataFrame:
    """(feature, bin, evidence) from rows with the features and a 0/1 label."""
    each = labelled.select(label, F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), F.col(n).alias("bin")) for n in names))).alias("f"))
    counts = each.groupBy("f.feature", "f.bin").agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("good"), F.count(F.when(F.col(label) == 0, 1)).alias("bad")
    )
    sums = counts.groupBy("feature").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"), F.count("*").alias("bins"))
    met = counts.join(sums, "feature")

    def rate(part: str) -> Column:
        return (F.col(part) + SMOOTHING) / (F.col(f"all_{part}") + SMOOTHING * F.col("bins"))

    ratio = F.log(rate("good") / rate("bad"))
    return met.select("feature", "bin", F.greatest(F.lit(-MAX_EVIDENCE), F.least(F.lit(MAX_EVIDENCE), ratio)).alias("evidence"))


def _strength(groups: DataFrame, rate: Column, above: Column) -> float:
    """How many documents the rate above counts for: from the spread of the
    groups' rates beyond what their numbers of documents would give by chance."""
    weight = F.greatest(F.col("n") - 1, F.lit(0))
    found = groups.agg(
        F.sum(weight).alias("total"),
        F.sum(above * (1 - above) * weight / F.col("n")).alias("chance"),
        F.sum(weight * F.pow(rate - above, 2)).alias("spread"),
        F.sum(weight * above * (1 - above)).alias("mean"),
    ).first()
    low, high = STRENGTH
    if not found["total"]:
        return high
    beyond = (found["spread"] - found["chance"]) / found["total"]
    return max(low, min(high, found["mean"] / found["total"] / beyond - 1)) if beyond > 0 else high


def site_quality(
    df: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``df``: its id, ``host``, ``path``, ``evidence``, ``site_rate``
    (the shrunk rate of its path without itself), ``score`` and ``kept``.

    ``labels`` has 0/1 labels for some ids; null labels and ids are left out.
    Without labels, every score is 0.5. Null and empty texts are texts without
    words; null hosts and paths are sites of their own. Rows that repeat are
    scored alike. An empty table gives an empty table.
    """
    rows = df.select(F.col(id_col).alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), text_or_empty(text_col).alias("text"))
    measures = features(F.col("text"))
    names = list(measures)
    rows = written(rows.select("id", "host", "path", *(c.alias(n) for n, c in measures.items())), "quality-features")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    labelled = rows.join(known, "id")
    # Some ten bins of each feature: the table is a small constant.
    table = evidence_table(labelled, names, "label").collect()
    counted = labelled.agg(F.sum("label").alias("good"), F.count("*").alias("n")).first()
    prior = ((counted["good"] or 0) + 1) / (counted["n"] + 2)

    def of(name: str) -> Column:
        own = [r for r in table if r["feature"] == name]
        return reduce(lambda a, r: F.when(F.col(name) == r["bin"], r["evidence"]).otherwise(a), own, F.lit(0.0))

    judged = rows.withColumn("evidence", reduce(lambda a, n: a + of(n), names, F.lit(0.0)))
    alone = 1 / (1 + F.exp(-F.col("evidence") - math.log(prior / (1 - prior))))
    judged = written(judged.select("id", "host", "path", "evidence", alone.alias("alone")), "quality-evidence")

    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("alone").alias("good"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = written(hosts, "quality-hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    all_n, all_good = whole["n"] or 0, whole["good"] or 0.0
    everywhere = F.lit(all_good / max(all_n, 1))
    host_strength = _strength(hosts, F.col("good") / F.col("n"), everywhere)
    above = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    sites = written(paths.join(above, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "quality-sites")
    path_strength = _strength(sites, F.col("good") / F.col("n"), F.col("host_good") / F.col("host_n"))
    sites = sites.withColumnRenamed("host", "h").withColumnRenamed("path", "p")

    met = judged.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    own = F.col("alone")
    others = (F.lit(all_good) - own) / (all_n - 1) if all_n > 1 else everywhere
    at_host = (F.col("host_good") - own + host_strength * others) / (F.col("host_n") - 1 + host_strength)
    at_path = (F.col("good") - own + path_strength * at_host) / (F.col("n") - 1 + path_strength)
    rate = F.least(F.greatest(at_path, F.lit(1e-6)), F.lit(1 - 1e-6))
    met = met.withColumn("site_rate", rate)
    score = 1 / (1 + F.exp(-F.col("evidence") - F.log(F.col("site_rate") / (1 - F.col("site_rate")))))
    return met.select(F.col("id").alias(id_col), "host", "path", "evidence", "site_rate", score.alias("score")).withColumn(
        "kept", F.col("score") >= threshold
    )
