"""Toxicity by maximum-scoring segments.

Each word has a log-odds of toxic against clean documents under Dirichlet
priors, one drawn to the other: the counts of a word to the rate of its
beginning, those of beginnings of up to LONGEST code points, counted over
distinct words, to the rate of the beginning that is one shorter, and the
shortest to the rate of all. An unknown word has the odds of its longest
beginning known. Less a drift, scores of clean text are negative on the whole,
and the maximal scoring segments (Ruzzo and Tompa, linear time) are a text's
candidate passages. Karlin-Altschul statistics, with lambda and K from clean
text, turn a segment's score into the number of such segments that clean text
of the same length has by chance; passages with few enough count, and a
logistic fit turns their evidence into a score.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import crc_mod, map_arrow, mix, places, release, table, texts_of, word_sums
from siltstone.llm.labelled import arranged, chosen, logistic
from siltstone.llm.quality import ROUND, pieces

#: Code points of the longest beginning of a word that is counted.
LONGEST = 8
SIGNIFICANT = 0.05
PER_CLASS = 4000


def segments(scores: Sequence[float], at: Sequence[int] | None = None) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence of scores, by Ruzzo and Tompa.

    Only positive scores open or extend a segment, so with `at`, their
    positions, the work is linear in their number after a running sum.
    """
    scores = np.asarray(scores, np.float64)
    total = np.concatenate(([0.0], np.cumsum(scores)))
    at = np.flatnonzero(scores > 0) if at is None else at
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum up to the end
    for i in at.tolist() if isinstance(at, np.ndarray) else at:
        new = (i, i + 1, total[i], total[i + 1])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j -= 1
            if j < 0 or kept[j][3] >= new[3]:
                break
            new = (kept[j][0], new[1], kept[j][2], new[3])
            del kept[j:]
        kept.append(new)
    return [(s, e, float(r - left)) for s, e, left, r in kept]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: np.ndarray) -> np.ndarray:
    if not len(keys):
        return default
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def read(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some texts, or a part of a long one, at a time: hashes of the words, lower-cased, which text each is of, the code points, and where words start and end."""
    held: list[tuple[int, str]] = []
    size = 0
    for piece in pieces(texts):
        if held and size + len(piece[1]) > ROUND:
            yield _read(held)
            held, size = [], 0
        held.append(piece)
        size += len(piece[1]) + 1
    if held:
        yield _read(held)


def _read(held: list[tuple[int, str]]) -> tuple[np.ndarray, ...]:
    cp = np.frombuffer((" ".join(t for _, t in held) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    cp = np.where((cp >= 65) & (cp <= 90), cp + 32, cp)
    blank = (cp == 32) | (cp >= 9) & (cp <= 13)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    doc = np.repeat([i for i, _ in held], [len(t) + 1 for _, t in held])
    return mix(word_sums(cp, starts, ends) + np.uint64(1)), doc[starts], cp, starts, ends


def beginnings(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the first 1..LONGEST code points of words, a column each; 0 where the word is not longer."""
    out = np.zeros((len(starts), LONGEST), np.uint64)
    h = np.zeros(len(starts), np.uint64)
    for k, odd in enumerate(places(LONGEST)):
        h = h + cp[np.minimum(starts + k, len(cp) - 1)] * odd
        out[:, k] = np.where(ends - starts > k + 1, mix(h + np.uint64(k + 1)), 0)
    return out


@dataclasses.dataclass
class Model:
    """keys and values: sorted hashes of words and of beginnings with their log-odds less the drift; rest: that of all other words."""

    keys: np.ndarray
    values: np.ndarray
    rest: float
    rate: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 0.0
    intercept: float = 0.0

    def scores(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its words' scores."""
        parts: list[list[np.ndarray]] = [[np.zeros(0)] for _ in texts]
        for h, doc, cp, starts, ends in read(texts):
            names, first, code = np.unique(h, return_index=True, return_inverse=True)
            s = _lookup(self.keys, self.values, names, np.full(len(names), np.nan))
            new = np.flatnonzero(np.isnan(s))
            found = np.full(len(new), self.rest)
            for column in beginnings(cp, starts[first[new]], ends[first[new]]).T:  # the longest known beginning stays
                found = _lookup(self.keys, self.values, column, found)
            s[new] = found
            cut = np.flatnonzero(np.diff(doc)) + 1
            for own, i in zip(np.split(s[code], cut), doc[np.concatenate(([0], cut))] if len(doc) else [], strict=False):
                parts[i].append(own)
        return [np.concatenate(x) for x in parts]

    def chance(self, n: int, score: float) -> float:
        """How many segments of at least that score clean text of n words has by chance, as a natural logarithm."""
        return float(np.log(self.k * max(n, 1)) - self.rate * score)

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float, float]]:
        """Significant passages: start and end word, score, logarithm of the chance."""
        found = [(a, b, s, self.chance(len(scores), s)) for a, b, s in segments(scores)] if (scores > 0).any() else []
        return [x for x in found if x[3] < np.log(SIGNIFICANT)]

    def evidence(self, scores: np.ndarray) -> float:
        """Sum over significant passages of -log10 of chance."""
        return sum(-x[3] for x in self.passages(scores)) / float(np.log(10))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.intercept, -30, 30)))


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray, folds: int = 4, prior: float = 2.0, drift: float = 2.0) -> Model:
    """Learns from labelled texts. Without texts of both classes every score is nearly the label that there is, or 0.

    lambda, K and the logistic fit come from scores of texts under a model that
    learnt from the other folds, as scores of known texts are too good.
    """
    if not len(texts) or y.min() == y.max():
        none = np.zeros(0)
        return Model(none.astype(np.uint64), none, -drift, intercept=30.0 if len(y) and y[0] else -30.0)
    known = Words.of(texts)
    model = log_odds(known, y, np.ones(len(y), bool), prior, drift)
    fold = np.empty(len(y), np.int64)
    for k in (0, 1):  # as many of each class in each fold
        fold[y == k] = np.arange((y == k).sum()) % folds
    scored: list[np.ndarray] = [np.zeros(0)] * len(texts)
    for f in range(folds):
        own = np.flatnonzero(fold == f)
        other = log_odds(known, y, fold != f, prior, drift)
        for i, x in zip(own, other.scores([texts[i] for i in own]), strict=True):
            scored[i] = x

    # Karlin and Altschul: lambda solves E[exp(lambda s)] = 1 over clean words. One word of score 1 is added, so that the root exists.
    clean = [(scored[i], known.weight[i]) for i in np.flatnonzero(y == 0)]
    value, code = np.unique(np.round(np.concatenate([*(x for x, _ in clean), [1.0]]), 2), return_inverse=True)
    n = np.bincount(code, np.concatenate([*(np.full(len(x), w) for x, w in clean), [1.0]]))
    share = n / n.sum()
    low, high = 1e-4, 50.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if (share * np.exp(np.minimum(middle * value, 700))).sum() < 1 else (low, middle)
    model.rate = max(0.05, low)
    # K from the segments that clean text has above the middle of its segments' scores.
    found = [(s, w) for x, w in clean if (x > 0).any() for *_, s in segments(x)] or [(1.0, 1.0)]
    middle = float(np.median([s for s, _ in found]))
    model.k = float(sum(w for s, w in found if s >= middle) / max(1, n.sum()) * np.exp(model.rate * middle))
    evidence = np.array([model.evidence(x) for x in scored])
    model.slope, model.intercept = logistic(evidence, y.astype(float), weight)
    return model


@dataclasses.dataclass
class Words:
    """names: of distinct words, with their beginnings; text and word: which text has which; weight: of each text, one over how many near copies it has."""

    names: np.ndarray
    begin: np.ndarray
    text: np.ndarray
    word: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Words:
        """Texts are near copies if they agree in a band of four of their words' 16 MinHashes; of the four bands the one with the most company counts."""
        known, names, begin, text, word = np.zeros(0, np.uint64), [], [], [], []
        for h, doc, cp, starts, ends in read(texts):
            own, first, code = np.unique(h, return_index=True, return_inverse=True)
            pair = np.unique(doc * len(own) + code)
            text.append((pair // max(1, len(own))).astype(np.int32))
            word.append(own[pair % max(1, len(own))])
            new = np.flatnonzero(~np.isin(own, known))
            names.append(own[new])
            begin.append(beginnings(cp, starts[first[new]], ends[first[new]]))
            known = np.union1d(known, own[new])
        order = np.argsort(np.concatenate([np.zeros(0, np.uint64), *names]))
        begin = np.concatenate([np.zeros((0, LONGEST), np.uint64), *begin])[order]
        every = known
        pair = np.concatenate([np.zeros(0, np.int32), *text]) * np.int64(max(1, len(every)))
        for i, at in zip(np.cumsum([0, *map(len, word)]).tolist(), word, strict=False):
            pair[i : i + len(at)] += np.searchsorted(every, at)
        del text, word
        if len(pair) and (np.diff(pair) <= 0).any():  # a long text's parts fall together
            pair = np.unique(pair)
        text, word = (pair // max(1, len(every))).astype(np.int32), (pair % max(1, len(every))).astype(np.int32)
        weight = np.ones(len(texts))
        some, starts = np.unique(text, return_index=True)
        if len(some):
            least = np.stack([np.minimum.reduceat((every * odd)[word], starts) for odd in places(16)])
            for band in least.reshape(4, 4, -1):
                _, code, n = np.unique(band, axis=1, return_inverse=True, return_counts=True)
                weight[some] = np.minimum(weight[some], 1 / n[code.reshape(-1)])
        return Words(every, begin, text, word, weight)


def _towards(prior: np.ndarray, odds: np.ndarray, a1: np.ndarray, a0: np.ndarray) -> np.ndarray:
    """Log-odds moved by their standard error towards what the prior says, not beyond it."""
    error = np.sqrt(1 / a1 + 1 / a0)
    return prior + np.sign(odds - prior) * np.maximum(0, np.abs(odds - prior) - error)


def log_odds(known: Words, y: np.ndarray, use: np.ndarray, prior: float, drift: float) -> Model:
    """Scores of words and of their beginnings from the texts in use, by how many texts have a word; near copies weigh as one text together."""
    weight = known.weight * use
    c1, c0 = (np.bincount(known.word, (weight * (y == k))[known.text], len(known.names)) for k in (1, 0))
    base = np.zeros(len(known.names))
    keys, values = [], []
    # Beginnings, by distinct words: one that many toxic words share counts, one frequent word's doesn't.
    s1, s0 = (c1 > 0).astype(float), (c0 > 0).astype(float)
    m1, m0 = max(1.0, s1.sum()), max(1.0, s0.sum())
    for column in known.begin.T:
        some = np.flatnonzero((column != 0) & (c1 + c0 > 0))
        names, first, code = np.unique(column[some], return_index=True, return_inverse=True)
        t1, t0 = (np.bincount(code, x[some], len(names)) for x in (s1, s0))
        below = base[some[first]]
        odds = _drawn(t1, t0, m1, m0, below, prior)
        base[some] = odds[code]
        keep = np.abs(odds - below) > 0.05
        keys.append(names[keep])
        values.append(odds[keep] - drift)
    n1, n0 = max(1.0, c1.sum()), max(1.0, c0.sum())
    odds = _drawn(c1, c0, n1, n0, base, prior)
    keep = np.abs(odds - base) > 0.05
    keys, values = np.concatenate([*keys, known.names[keep]]), np.concatenate([*values, odds[keep] - drift])
    order = np.argsort(keys)
    return Model(keys[order], values[order], -drift)


def _drawn(c1: np.ndarray, c0: np.ndarray, n1: float, n0: float, base: np.ndarray, prior: float) -> np.ndarray:
    """Log-odds of counts of n1 toxic and n0 clean, under a Dirichlet prior of log-odds base."""
    up = n1 * np.exp(base)
    a1, a0 = c1 + prior * up / (up + n0), c0 + prior * n0 / (up + n0)
    return _towards(base, np.log(a1 / n1) - np.log(a0 / n0), a1, a0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages): the probability that a text is toxic, and how many significant passages it has. Null texts count as empty; repeated rows are scored alike."""

    def work(batches):
        for b in batches:
            own = model.scores(texts_of(b["text"]))
            found = np.array([model.evidence(x) for x in own])
            yield {"doc_id": b["doc_id"].cast("int64"), "score": pa.array(model.probability(found)), "passages": pa.array([len(model.passages(x)) for x in own], pa.int32())}

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, score double, passages int")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, end, segment_score, chance): every significant passage of each text, in words; chance is a natural logarithm."""

    def work(batches):
        for b in batches:
            rows = [(k, *x) for k, s in enumerate(model.scores(texts_of(b["text"]))) for x in model.passages(s)]
            yield {
                "doc_id": b["doc_id"].cast("int64").take(pa.array([r[0] for r in rows], pa.int64())),
                "start": pa.array([r[1] for r in rows], pa.int32()),
                "end": pa.array([r[2] for r in rows], pa.int32()),
                "segment_score": pa.array([r[3] for r in rows], pa.float64()),
                "chance": pa.array([r[4] for r in rows], pa.float64()),
            }

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, start int, end int, segment_score double, chance double")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled rows whose crc32(doc_id) mod 3 is not 1, at most per_class of each class. One task reads the sample; the driver gets the model."""
    rows, sizes = chosen(docs, labels, "toxic", crc_mod(F.col("doc_id"), 3) != 1, per_class)

    def work(batches):
        held = [r for b in batches for r in zip(b["doc_id"].to_pylist(), b["y"].to_pylist(), b["text"].to_pylist(), strict=True)]
        model = fit(*arranged(held, sizes))
        numbers = [model.rest, model.rate, model.k, model.slope, model.intercept]
        yield {"keys": pa.array([model.keys.tobytes()], pa.binary()), "odds": pa.array([model.values.tobytes()], pa.binary()), "numbers": pa.array([numbers], pa.list_(pa.field("element", pa.float64())))}

    got = map_arrow(rows.repartition(1), work, "keys binary, odds binary, numbers array<double>").first()
    return Model(np.frombuffer(got["keys"], np.uint64), np.frombuffer(got["odds"], np.float64), *got["numbers"]) if got else fit([], np.zeros(0, np.int64), np.zeros(0))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, passages.

    Null texts count as empty; texts without a significant passage score
    alike. Repeated rows are scored alike. An empty table gives an empty result. Labels,
    lang, source and doc_id are no inputs of a score; other columns are not
    read.
    """
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def clean_only(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose text scores below the threshold. All columns stay.

    Null texts count as empty, and texts without a significant passage score
    alike. Repeated rows stay or go together, null ids count as others do. An
    empty table gives an empty result. Without labels of both classes all rows
    stay, unless the one label is toxic.
    """
    model = learn(docs, labels)
    release(docs.sparkSession)

    def work(batches):
        for b in batches:
            found = np.array([model.evidence(x) for x in model.scores(texts_of(b["text"]))])
            yield {k: v.filter(pa.array(model.probability(found) < threshold)) for k, v in b.items()}

    return map_arrow(docs, work, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
