"""Quality classifier: naive Bayes support vectors (operator 5).

Hashed n-gram indicators are scaled by their class log-count ratios; a linear hinge-loss model over them is
fitted by dual coordinate descent; its margins become probabilities by a logistic fit on rows set aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.llm import words
from chemlake.llm.workspace import small_batches

#: Features are hashed to 2**BITS columns; a model is three arrays of that many numbers at most.
BITS = 17
#: The hinge-loss model is fitted on about so many labelled rows of each class (all, where there are fewer);
#: the log-count ratios come from every labelled row.
FIT_ROWS = 4_000
#: Labelled ids (12 bytes each) that may be broadcast; beyond that labels are joined by shuffle.
BROADCAST_LABELS = 1_000_000
COST, EPOCHS = 1.0, 10


@dataclass
class Model:
    """score = logistic(slope * margin + offset); margin = bias + weights over the unit-length row."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def features(texts: pa.Array):
    """Sorted hashed n-gram indicators of each text.

    Runs of three bytes, single words, pairs of words, and pairs that repeat the word one or two places
    before (how often, in five steps).
    """
    shift = np.uint64(64 - BITS)
    for first, end, data, offsets in words.text_slices(texts):
        hashes, _, heads = words.word_hashes(data, offsets)
        pairs = words.shingles(hashes, 2)
        wide = data.astype(np.uint64)
        bytes3 = words.mix64(wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) if len(data) > 2 else wide[:0]
        for i in range(end - first):
            own = hashes[heads[i] : heads[i + 1]]
            found = [bytes3[offsets[i] : max(offsets[i], offsets[i + 1] - 2)], own, pairs[heads[i] : max(heads[i], heads[i + 1] - 1)]]
            for back in (1, 2):
                if len(own) > back:
                    share = np.count_nonzero(own[back:] == own[:-back]) / (len(own) - back)
                    steps = np.flatnonzero(share > np.array([0.0, 0.05, 0.15, 0.3, 0.45]))
                    found.append(words.mix64((steps + (8 * back + (1 << 30))).astype(np.uint64)))
            yield np.unique((np.concatenate(found) >> shift).astype(np.int32))


def _counts(batches):
    """Rows of each class that have a feature: one row per feature and task."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for label, found in zip(labels, features(batch.column(0)), strict=True):
            counts[label][found] += 1
            rows[label] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    column = lambda x, last: pa.array(np.append(x, last), pa.int64())
    yield pa.RecordBatch.from_arrays([column(seen, -1), column(counts[0][seen], rows[0]), column(counts[1][seen], rows[1])], ["feature", "n0", "n1"])


def _listed(batches):
    for batch in batches:
        found = [*features(batch.column(0))]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), batch.column(2), lists], ["label", "place", "features"])


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by dual coordinate descent."""
    weights, bias, dual, rng = np.zeros(1 << BITS), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    norms = np.array([v @ v + 1 for v in values])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            moved = min(max(dual[i] - gradient / norms[i], 0.0), COST)
            if moved != dual[i]:
                step = (moved - dual[i]) * signs[i]
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i] = moved
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray, row_weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with targets drawn in from 0 and 1."""
    total = [max(row_weights[labels == c].sum(), 1e-9) for c in (0, 1)]
    target = np.where(labels == 1, (total[1] + 1) / (total[1] + 2), 1 / (total[0] + 2))
    x, at = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (row_weights * (p - target)) + 1e-6 * at
        curve = (x * (row_weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def _unit(ratios: np.ndarray, found: np.ndarray) -> np.ndarray:
    value = ratios[found]
    norm = np.sqrt(value @ value)
    return value / norm if norm else value


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model that labels (doc_id, quality) of docs give.

    Ids whose labels are null, not 0 or 1, or contradict one another are not learnt from.  Without rows of
    both classes the model gives every text the (smoothed) share of label 1.
    """
    clean = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_high"))
    clean = clean.where("_label = _high AND _id IS NOT NULL").select("_id", "_label")
    known = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    labelled = known.join(F.broadcast(clean) if labels.count() <= BROADCAST_LABELS else clean, "_id")
    totals = labelled.select("_text", "_label").mapInArrow(_counts, "feature long, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    whole = totals[totals.feature < 0]
    n = [int(whole.n0.sum()), int(whole.n1.sum())]
    none = np.zeros(1 << BITS, np.float32)
    if not min(n):
        share = (n[1] + 1) / (sum(n) + 2)
        return Model(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = np.ones((2, 1 << BITS))
    seen = totals[totals.feature >= 0]
    counts[:, seen.feature.to_numpy()] += seen[["n0", "n1"]].to_numpy().T
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    place = F.pmod(F.xxhash64(F.lit("fit"), "_id"), F.lit(1 << 30))
    share = F.when(F.col("_label") == 0, F.lit(FIT_ROWS / n[0])).otherwise(F.lit(FIT_ROWS / n[1]))
    sample = labelled.withColumn("place", place).where(F.col("place") < share * float(1 << 30))
    listed = sample.select("_text", "_label", "place").mapInArrow(_listed, "label int, place long, features array<int>")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "label"], kind="stable")
        found, y = [np.asarray(x, np.int64) for x in rows.features], rows.label.to_numpy()
        values = [_unit(shared.value, x) for x in found]
        # every fifth row of each class is for the logistic fit
        aside = np.zeros(len(y), bool)
        for c in (0, 1):
            aside[np.flatnonzero(y == c)[4::5]] = True
        learn = np.flatnonzero(~aside)
        weights, bias = descend([found[i] for i in learn], [values[i] for i in learn], np.where(y[learn] == 1, 1.0, -1.0))
        held = np.flatnonzero(aside) if len(set(y[aside])) == 2 else np.arange(len(y))
        margins = np.array([weights[found[i]] @ values[i] + bias for i in held])
        drawn = [max(1, np.count_nonzero(y[held] == c)) for c in (0, 1)]
        slope, offset = logistic(margins, y[held], np.array([n[c] / drawn[c] * len(held) / sum(n) for c in y[held]]))
        used = np.flatnonzero(weights)
        out = {"feature": [*used, -1, -2, -3], "weight": [*weights[used], bias, slope, offset]}
        return pd.DataFrame(out).astype({"feature": "int64", "weight": "float64"})

    solved = listed.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(solve, "feature long, weight double").toPandas()
    own = {int(k): v for k, v in solved[solved.feature < 0].itertuples(index=False)}
    weights, rest = none.copy(), solved[solved.feature >= 0]
    weights[rest.feature.to_numpy()] = rest.weight.to_numpy()
    return Model(ratios.astype(np.float32), weights, own.get(-1, 0.0), own.get(-2, 1.0), own.get(-3, 0.0))


def scorer(spark, model: Model):
    """An Arrow UDF from a text to its score."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        margins = np.array([m.bias + m.weights[f] @ _unit(m.ratios, f) for f in features(texts)], np.float64)
        return pa.array(1 / (1 + np.exp(-np.clip(m.slope * margins + m.offset, -30, 30))), pa.float64())

    return score


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0. A null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with held_out, score (0 to 1; higher: label 1 likelier) and predicted (1 if score >= threshold).

    Labels are learnt from outside the held-out fold only.  Every row is scored on its whole text alone, so equal texts and
    repeated rows have equal scores, and very long texts are read whole; null and empty texts get the score of no
    features.  A score of just the threshold is predicted 1.  An empty table stays empty, and without usable labels
    every score is 0.5.  Columns of docs with these names are replaced.
    """
    small_batches(docs.sparkSession)
    model = fit(docs.where(~held_out(F.col(doc_id))), labels, doc_id=doc_id, text=text)
    scored = docs.withColumns({"held_out": held_out(F.col(doc_id)), "score": scorer(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit("")))})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
