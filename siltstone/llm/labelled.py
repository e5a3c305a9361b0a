"""Bounded samples of labelled documents, which classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bytes of text of a class that a sample holds at most, besides its first text.
BYTES = 24 << 20


def chosen(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int, seed: int = 42, most_bytes: int = BYTES) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y, text) of at most per_class documents and most_bytes bytes of each class, the first in a seeded order of doc_id, and how many labelled rows each class has.

    Rows of null doc_id, of null label or of another label are left out, and
    so are doc_ids with both labels; repeated labels count once, and of several
    texts of a doc_id the least is read. may_learn is a condition on doc_id.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    open_rows = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & may_learn)
    open_rows = open_rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("doc_id", "y")
    sizes = {r["y"]: r["n"] for r in open_rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = [open_rows.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"]) for rows in first for r in rows.collect()], "doc_id long, y int")
    found = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    before = Window.partitionBy("y").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("before", F.coalesce(F.sum(F.octet_length("text") + F.lit(1)).over(before), F.lit(0))).withColumn("whole", F.col("before") + F.octet_length("text"))
    return found.where((F.col("whole") <= most_bytes) | (F.col("before") == 0)).select("doc_id", "y", "text"), sizes


def arranged(rows: list[tuple[int, int, str]], sizes: dict[int, int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels (0 or 1) and weights of rows (doc_id, y, text), sorted by doc_id, so that a fit is the same each time. Weights restore the shares that the classes have among all labelled rows, and add up to the number of texts."""
    rows = sorted(rows)
    y = np.array([r[1] for r in rows], np.int64)
    counts = np.bincount(y, minlength=2)
    weight = np.array([sizes.get(k, 0) / counts[k] if counts[k] else 0.0 for k in (0, 1)])[y] if len(y) else np.zeros(0)
    return [r[2] for r in rows], y, weight * len(y) / max(weight.sum(), 1e-300)


def sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int, seed: int = 42, most_bytes: int = BYTES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and weights of chosen(), on the driver."""
    rows, sizes = chosen(docs, labels, label, may_learn, per_class, seed, most_bytes)
    return arranged([(r["doc_id"], r["y"], r["text"]) for r in rows.collect()], sizes)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic fit by Newton's method; the slope is never negative."""
    a, b = 0.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * weight * x).sum() + ridge * a, ((p - y) * weight).sum() + 1e-3 * b])
        v = weight * p * (1 - p)
        h = np.array([[(v * x * x).sum() + ridge, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b
