"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Labelled rows are dealt to learners. Each learner goes over its rows in
several passes with a learning rate per coordinate and an L1 term that leaves
every coordinate at zero whose gradients do not add up to more than it; the
weights of the learners are averaged. Each learner also learns without each
fifth of its rows in turn; the scores that these models give the rows left out set the
scale and offset of the scores (Platt's method), whatever the number of rows: weights
that are drawn to zero understate how sure a text is. What is left is a short list
of coordinates, which is broadcast to score all rows.

The sample to learn from is bounded and drawn by label, so a rare label is not
thinned out with the other; the offset makes up for the shares drawn.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.llm.common import written

# Labelled rows to learn from, about; beyond it a sample by hash of the id, of
# the rarer label up to half of it.
MAX_TRAINING_ROWS = 16_384
ROWS_PER_LEARNER = 2_048
# Coordinates broadcast at most: those of the largest weights.
MAX_WEIGHTS = 65_536
HASH_BITS = 32  # at most 32
ALPHA, BETA, L2 = 2.0, 1.0, 0.0
L1, PASSES = 12.0, 6
REFIT_L1, REFIT_PASSES = 0.5, 20
# Folds of the scores that set the scale.
CALIBRATION = 5
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W_]+")
# Odd multipliers that tell the kinds of pairs apart.
_NEXT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SKIP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def coordinates(text: str | None) -> np.ndarray:
    """Hashed words, neighbouring pairs and pairs with one word left out; repeats included."""
    digest = xxhash.xxh3_64_intdigest
    words = np.array([digest(w) for w in _WORD.findall((text or "").lower())], dtype=np.uint64)
    pairs = words[:-1] * _NEXT[0] + words[1:] * _NEXT[1]
    skips = words[:-2] * _SKIP[0] + words[2:] * _SKIP[1]
    return (np.concatenate((words, pairs, skips)) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


def ftrl(rows: list[np.ndarray], labels: list[int], passes: int, l1: float, alpha=ALPHA, beta=BETA, l2=L2):
    """(coordinates, weights) that are not zero; coordinate -1 is the bias, which has no L1 term.

    A row's coordinates count once each. Rows are taken in the given order.
    """
    rows = [np.unique(r) for r in rows]
    known, place = np.unique(np.concatenate(rows) if rows else np.empty(0, np.uint32), return_inverse=True)
    ends = np.cumsum([len(r) for r in rows])
    place = (place + 1).astype(np.int32)
    places = [np.append(at, np.int32(0)) for at in np.split(place, ends[:-1])] if rows else []
    z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    shrink = np.full(len(known) + 1, l1)
    shrink[0] = 0.0

    def weights(at):
        over = np.abs(z[at]) - shrink[at]
        return np.where(over > 0, -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(passes):
        for at, label in zip(places, labels):
            w = weights(at)
            gradient = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, w.sum())))) - label
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / alpha
            z[at] += gradient - step * w
            n[at] += gradient**2
    w = weights(np.arange(len(known) + 1))
    kept = np.flatnonzero(w[1:])
    return known[kept], w[1:][kept], float(w[0])


def learn(rows: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL twice: with the strong L1 term that selects coordinates, then on
    those alone with a weak one, as the strong one also draws their weights to zero."""
    selected, _, _ = ftrl(rows, labels, PASSES, L1)
    return ftrl([r[np.isin(r, selected)] for r in rows], labels, REFIT_PASSES, REFIT_L1)


def calibration(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and offset that turn logits into probabilities of the labels, by
    Newton steps on the likelihood of Platt's smoothed targets; (1, 0) where one
    label is missing or the logits do not rise with the label."""
    ones = labels.sum()
    if ones == 0 or ones == len(labels):
        return 1.0, 0.0
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.column_stack((logits, np.ones(len(logits))))
    fit, loss = np.zeros(2), np.inf
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -35, 35)))
        now = -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum()
        if loss - now < 1e-9:
            break
        loss = now
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-9 * np.eye(2), x.T @ (target - p))
        # Shorter steps where a whole one would not improve the fit.
        for _ in range(30):
            q = np.clip(x @ (fit + step), -35, 35)
            if (np.logaddexp(0, q) - target * q).sum() < loss:
                break
            step /= 2
        fit = fit + step
    return (float(fit[0]), float(fit[1])) if fit[0] > 0 else (1.0, 0.0)


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    max_rows: int = MAX_TRAINING_ROWS,
    rows_per_learner: int = ROWS_PER_LEARNER,
    texts: DataFrame | None = None,
) -> DataFrame:
    """(coordinate, weight) learned from ``labelled`` (rows with a null label are left out).

    Of more than about ``max_rows`` rows a share of each label is taken by hash of
    the id: all rows of the rarer label, up to half of ``max_rows``. With ``texts`` (id, text) the labelled
    rows need no text: the sample is drawn from the ids, and only its texts are fetched.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("key"),
        F.xxhash64(F.col(id_col)).alias("draw"),
        F.col(label_col).cast("int").alias("label"),
        *([F.col(text_col).alias("text")] if texts is None else []),
    )
    seen = rows.agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("ones")).first()
    ones, others = seen["ones"], seen["n"] - seen["ones"]
    half = max_rows // 2
    share_one = min(1.0, max(half, max_rows - others) / max(ones, 1))
    share_other = min(1.0, max(half, max_rows - ones) / max(others, 1))
    learners = max(1, math.ceil((ones * share_one + others * share_other) / rows_per_learner))
    # The upper bits draw the sample, the lower ones deal it out.
    limit = F.when(F.col("label") == 1, int(share_one * (1 << 48))).otherwise(int(share_other * (1 << 48)))
    drawn = rows.where(F.shiftrightunsigned("draw", 16) < limit)
    if texts is not None:
        # About max_rows ids: every task gets them, and no text but theirs leaves its task.
        ids = written(drawn, "toxicity-drawn")
        drawn = texts.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(ids), "key")
    drawn = drawn.drop("key")
    drawn = drawn.withColumn("fold", F.pmod(F.shiftrightunsigned("draw", 8), F.lit(CALIBRATION)).cast("int"))
    drawn = written(drawn.withColumn("learner", F.pmod(F.col("draw"), F.lit(learners))), "toxicity-sample")

    def learner(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "text"], kind="stable")
        found, folds, labels = [coordinates(t) for t in group["text"]], group["fold"].tolist(), group["label"].tolist()
        made = []
        for fold in range(CALIBRATION + 1):  # the last one leaves no row out
            own = [i for i, f in enumerate(folds) if f != fold]
            coords, weights, bias = learn([found[i] for i in own], [labels[i] for i in own])
            made.append(pd.DataFrame({"model": fold, "coordinate": np.append(coords.astype(np.int64), -1), "weight": np.append(weights, bias)}))
        return pd.concat(made)

    each = drawn.groupBy("learner").applyInPandas(learner, "model int, coordinate long, weight double")
    mean = each.groupBy("model", "coordinate").agg((F.sum("weight") / F.lit(float(learners))).alias("weight"))
    mean = written(mean, "toxicity-learned")
    # A score and a label for each row of the sample, by the model that left it out.
    checked = [scored(drawn.where(F.col("fold") == k), mean.where(F.col("model") == k).drop("model")).select("score", "label") for k in range(CALIBRATION)]
    checked = pd.concat([c.toPandas() for c in checked])
    score = checked["score"].clip(1e-15, 1 - 1e-15).to_numpy(np.float64)
    scale, offset = calibration(np.log(score / (1 - score)), (checked["label"] == 1).to_numpy(np.int64))
    # The odds of the sample are those of all rows times the ratio of the shares.
    offset += math.log(share_other / share_one)
    moved = F.when(F.col("coordinate") == -1, F.lit(offset)).otherwise(F.lit(0.0))
    return mean.where(F.col("model") == CALIBRATION).select("coordinate", (F.col("weight") * scale + moved).alias("weight"))


def scored(
    df: DataFrame, weights: DataFrame, text_col: str = "text", out_col: str = "score", max_weights: int = MAX_WEIGHTS
) -> DataFrame:
    """``df`` with the probability of label 1 as a double; a column of that name is replaced."""
    bias = F.when(F.col("coordinate") == -1, 0).otherwise(1)
    top = weights.orderBy(bias, F.abs("weight").desc(), "coordinate").limit(max_weights).toPandas()
    top = top.sort_values("coordinate")
    is_bias = top["coordinate"] == -1
    base = float(top.loc[is_bias, "weight"].sum())
    model = df.sparkSession.sparkContext.broadcast((
        top.loc[~is_bias, "coordinate"].to_numpy(np.uint32), top.loc[~is_bias, "weight"].to_numpy(np.float64), base,
    ))
    kept = [f for f in df.schema.fields if f.name != out_col]
    keep = [f.name for f in kept]

    def score(text: str | None, known: np.ndarray, values: np.ndarray, bias: float) -> float:
        total = bias
        if len(known):
            found = coordinates(text)
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            total += values[np.unique(at[known[at] == found])].sum()
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, total))))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = pa.array([score(t.as_py(), *model.value) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, scores], names=[*keep, out_col])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out_col, T.DoubleType(), False)]))


def held_out(id_: Column) -> Column:
    """Whether labels of this id are kept from learning: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(id_.cast("string")) % 3 == 1, F.lit(False))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    reference: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    The texts to learn from are those of ``reference`` (default: ``df``) whose
    id has a label in ``labels`` and is not held out; nothing but the text
    enters a score. Null and empty texts get the score of the bias alone. With
    no labelled rows every score is 0.5. Rows that repeat are scored alike.
    Columns of the added names are replaced, all others pass through.
    """
    known = labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(id_col, F.col(label_col).alias("label"))
    texts = (df if reference is None else reference).select(id_col, F.col(text_col).alias("text"))
    labelled = known.join(texts.select(id_col), id_col, "left_semi")
    weights = written(train(labelled, id_col, "text", texts=texts), "toxicity-weights")
    added = ("held_out", "score", "predicted")
    found = scored(df.drop(*added), weights, text_col)
    return found.withColumn("held_out", held_out(F.col(id_col))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
