"""Document quality by supervised subword embeddings.

Words and the character n-grams inside them (with a blank at either side) are
hashed to rows of an embedding table; a text is the average of its rows, a
softmax over two classes reads it, and both are trained by stochastic gradient
descent in numpy on a bounded sample of labelled texts. As average and output
are linear up to the softmax, a trained model keeps one number per row, and
scoring a text is one pass of array operations over its code points.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import crc_mod, map_arrow, mix, places, release, table, texts_of, windows, word_sums
from siltstone.llm.labelled import logistic, sample

BUCKET_BITS = 18
GRAMS = (3, 4, 5)
DIM = 12
EPOCHS = 4
PER_CLASS = 1500
#: The token that a word is besides, if it is the same as the one before it.
SAME = np.uint64(0x3D)
#: Code points of a round of features().
ROUND = 1 << 18


def pieces(texts: list[str]) -> Iterator[tuple[int, str]]:
    """Texts and their numbers; long ones in windows of a round. A word longer than a round counts as several."""
    for i, text in enumerate(texts):
        for window in windows(text, ROUND):
            yield i, window


def features(texts: list[str], bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts, or a part of a long one, at a time: rows of all their features, and which text each belongs to.

    One feature for each word [^\\x20\\x09-\\x0D]+, one for each of its
    n-grams of GRAMS code points, a blank before and after it included, and
    the token SAME for each word that is the same as the one before it.
    """
    held: list[tuple[int, str]] = []
    size, last = 0, (-1, 0)
    for piece in pieces(texts):
        if held and size + len(piece[1]) > ROUND:
            rows, owners, last = _features(held, bits, last)
            yield rows, owners
            held, size = [], 0
        held.append(piece)
        size += len(piece[1]) + 2
    if held:
        yield _features(held, bits, last)[:2]


def _features(held: list[tuple[int, str]], bits: int, last: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """last: text and hash of the word before, if it is of the same text; the same for the next is given."""
    shift = np.uint64(64 - bits)
    text = " " + "  ".join(t for _, t in held) + " "
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (cp == 32) | (cp >= 9) & (cp <= 13)
    cp = np.where(blank, 32, cp).astype(np.uint64)
    doc = np.repeat([i for i, _ in held], [len(t) + 2 for _, t in held])
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    words = mix(word_sums(cp, starts, ends) + np.uint64(1))
    of = doc[starts]
    again = np.flatnonzero((words == np.append(np.uint64(last[1]), words[:-1])) & (of == np.append(last[0], of[:-1])))
    same = np.full(len(again), int(mix(np.array([SAME]))[0] >> shift), np.int32)
    rows, owners = [(words >> shift).astype(np.int32), same], [of, of[again]]
    odd = places(max(GRAMS) + 1)
    blanks = np.concatenate(([0], np.cumsum(blank)))
    h = np.zeros(len(cp), np.uint64)
    for k in range(max(GRAMS)):
        n = len(cp) - k
        if n <= 0:
            break
        h = h[:n] + cp[k:] * odd[k]
        if k + 1 in GRAMS:
            inside = blanks[k : k + n] - blanks[1 : n + 1] == 0 if k > 1 else ~blank[1 : n + 1]
            at = np.flatnonzero(inside)
            rows.append(((h[at] + np.uint64(k)) * odd[-1] >> shift).astype(np.int32))
            owners.append(doc[at])
    return np.concatenate(rows), np.concatenate(owners), (int(of[-1]), int(words[-1])) if len(of) else last


@dataclasses.dataclass
class Model:
    """values: what a feature adds to the log-odds of class 1, for a text of that feature alone; slope and intercept calibrate."""

    values: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0
    prior: float = 0.0

    def odds(self, texts: list[str]) -> np.ndarray:
        """Log-odds of class 1; texts without words have the bias alone."""
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        bits = len(self.values).bit_length() - 1
        for rows, owners in features(texts, bits):
            low, high = int(owners.min(initial=0)), int(owners.max(initial=-1)) + 1
            if high > low:
                total[low:high] += np.bincount(owners - low, self.values[rows], high - low)
                n[low:high] += np.bincount(owners - low, minlength=high - low)
        return total / np.maximum(n, 1) + self.bias

    def probability(self, texts: list[str]) -> np.ndarray:
        empty = np.array([not t.strip(" \t\n\v\f\r") for t in texts], bool)
        p = 1 / (1 + np.exp(-np.clip(self.slope * self.odds(texts) + self.intercept, -30, 30)))
        return np.where(empty, self.prior, p)


@dataclasses.dataclass
class Bags:
    """Texts as their distinct rows and how often each has them; held: both for each text, counts in as few bytes as they need. shares: of a text's features, from counts as they are asked for."""

    held: list[tuple[np.ndarray, np.ndarray]]

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        rows, n = self.held[i]
        return rows, n.astype(np.int32) / np.float32(max(1, n.sum(dtype=np.int64)))

    @property
    def rows(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int32), *(rows for rows, _ in self.held)])

    @property
    def shares(self) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self[i][1] for i in range(len(self.held)))])


def bags_of(texts: list[str], bits: int = BUCKET_BITS) -> Bags:
    """A round's rows are counted and dealt to their texts at once, so beside the bags there is one round's features, however many texts there are."""
    held = [(np.zeros(0, np.int32), np.zeros(0, np.uint8))] * len(texts)
    for rows, owners in features(texts, bits):
        low = int(owners.min(initial=0))
        code, n = np.unique((owners - low << bits) + rows, return_counts=True)
        owner = code >> bits
        cut = np.flatnonzero(np.diff(owner)) + 1
        for i, own, many in zip(owner[np.concatenate(([0], cut))] + low if len(owner) else [], np.split(code, cut), np.split(n, cut), strict=False):
            own = own & (1 << bits) - 1
            if len(held[i][0]):  # a long text's parts fall together
                own, at = np.unique(np.concatenate((held[i][0], own)), return_inverse=True)
                many = np.bincount(at, np.concatenate((held[i][1], many)), len(own)).astype(np.int64)
            held[i] = own.astype(np.int32), many.astype(np.min_scalar_type(int(many.max())))
    return Bags(held)


def train(bags: Bags, y: np.ndarray, use: np.ndarray, bits: int = BUCKET_BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = 0.5, seed: int = 42) -> Model:
    """Stochastic gradient descent on the texts in use, one text a step, the rate falling to zero. Classes take turns, so both weigh alike."""
    draw = np.random.default_rng(seed)
    table_ = draw.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    classes = [np.flatnonzero(use & (y == k)) for k in (0, 1)]
    n = max(map(len, classes))
    steps, done = epochs * 2 * n, 0
    for _ in range(epochs):
        turns = np.stack([np.concatenate([draw.permutation(c) for _ in range(-(-n // len(c)))])[:n] for c in classes], axis=1).ravel()
        for i in turns.tolist():
            step = rate * (1 - done / steps)
            done += 1
            rows, share = bags[i]
            if not len(rows):
                continue
            own = table_[rows]
            hidden = share @ own
            z = out @ hidden + bias
            z = np.exp(z - z.max())
            g = z / z.sum()
            g[y[i]] -= 1
            own -= np.outer(np.float32(step * np.sqrt(len(rows))) * share, g @ out)
            table_[rows] = own
            out -= step * np.outer(g, hidden)
            bias -= step * g
    return Model(table_ @ (out[1] - out[0]), float(bias[1] - bias[0]))


def fit(spark: SparkSession, texts: list[str], y: np.ndarray, weight: np.ndarray, folds: int = 3, bits: int = BUCKET_BITS, **options) -> Model:
    """A trained model whose scores are calibrated by a logistic fit to what models of the other folds say. Without texts of both classes every score is nearly the label that there is, or the middle.

    The model and those of the folds learn at the same time, a task each.
    """
    if not len(texts) or y.min() == y.max():
        share = float(y[0]) * 0.998 + 0.001 if len(y) else 0.5
        return Model(np.zeros(2, np.float32), slope=0.0, intercept=float(np.log(share / (1 - share))), prior=share)
    fold = np.empty(len(y), np.int64)
    for k in (0, 1):
        fold[y == k] = np.arange((y == k).sum()) % folds
    # A fold of one class, or whose others are of one class, says nothing of new texts.
    able = [f for f in range(folds) if (fold == f).any() and len(set(y[fold != f].tolist())) == 2]

    def work(batches):
        for b in batches:
            for f in b["fold"].to_pylist():
                bags = bags_of(texts, bits)
                model = train(bags, y, fold != f, bits, **options)
                own = np.flatnonzero(fold == f)
                odds = np.array([share @ model.values[rows] + model.bias for rows, share in map(bags.__getitem__, own.tolist())])
                values = model.values.astype(np.float32).tobytes() if f < 0 else b""
                yield {"fold": pa.array([f], pa.int64()), "values": pa.array([values], pa.binary()), "bias": pa.array([model.bias]), "odds": pa.array([odds.tolist()], pa.list_(pa.field("element", pa.float64())))}

    tasks = [-1, *able]
    jobs = spark.range(0, len(tasks), 1, len(tasks)).select(F.element_at(F.array(*map(F.lit, tasks)), F.col("id").cast("int") + 1).cast("long").alias("fold"))
    got = {r["fold"]: r for r in map_arrow(jobs, work, "fold long, values binary, bias double, odds array<double>").collect()}
    model = Model(np.frombuffer(got[-1]["values"], np.float32), got[-1]["bias"])
    odds = np.zeros(len(y))
    for f in able:
        odds[fold == f] = got[f]["odds"]
    model.slope, model.intercept = logistic(odds, y.astype(float), weight)
    model.prior = float(weight[y == 1].sum() / weight.sum())
    return model


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled rows whose crc32(doc_id) mod 5 is not 0, at most per_class of each class."""
    return fit(docs.sparkSession, *sample(docs, labels, "quality", crc_mod(F.col("doc_id"), 5) != 0, per_class))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (the probability of label 1), predicted.

    Null texts count as empty; texts without words score the share of label 1.
    Repeated rows are scored alike. An empty table gives an empty result.
    Labels, lang, source and doc_id are no inputs of a score; other columns
    are not read.
    """
    model = learn(docs, labels)

    def work(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"].cast("int64"), "score": pa.array(model.probability(texts_of(b["text"])))}

    scored = map_arrow(docs.select("doc_id", "text"), work, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_only(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose text scores at least the threshold. All columns stay.

    Null texts count as empty; texts without words score the share of label 1.
    Repeated rows stay or go together, null ids count as others do. An empty
    table gives an empty result. Without labels of both classes all rows stay,
    unless the one label is 0.
    """
    model = learn(docs, labels)
    release(docs.sparkSession)

    def work(batches):
        for b in batches:
            keep = pa.array(model.probability(texts_of(b["text"])) >= threshold)
            yield {k: v.filter(keep) for k, v in b.items()}

    return map_arrow(docs, work, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
