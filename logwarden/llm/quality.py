"""Quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import held_out, mix, pieces, sampled_texts, utf8

#: At most about this many labelled rows are learnt from.
LABEL_BOUND = 20_000

#: Shrinkage of a class covariance towards the pooled one, then towards a multiple of identity.
TO_POOLED, TO_IDENTITY = 0.05, 0.01

THRESHOLD = 0.3

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _flags(chars: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Byte classes whose share of the text is a statistic.
CLASSES = {
    "upper": _flags(range(65, 91)), "lower": _flags(range(97, 123)), "digit": _flags(range(48, 58)),
    "stop": _flags(b".,;:?"), "mark": _flags(b"!#$%&*|^~<>{}[]\\=+@_`"), "quote": _flags(b"\"'()-/"),
    "line": _flags(b"\n"), "wide": _flags(range(192, 256)),
}
WORD_CLASSES = ("words", "mean_length", "spread_length", "same_as_last", "distinct", "distinct_pairs",
                "distinct_triples", "ends_sentence", "starts_upper", "ends_mark")
N_FEATURES = 1 + len(CLASSES) + len(WORD_CLASSES)


def _distinct(keys: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """How many different keys each document has."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=docs)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share, pulled in so that 0 and 1 stay finite and small wholes stay moderate."""
    share = (part + 0.02) / (whole + 0.04 + 1e-9)
    share = np.clip(share, 1e-3, 1 - 1e-3)
    return np.log(share / (1 - share))


def statistics(texts: pa.Array) -> np.ndarray:
    """Transformed statistics of whole texts, one row each. An empty or null text has a row too."""
    raw, at = utf8(texts)
    docs = len(texts)
    out = np.zeros((docs, N_FEATURES))
    size = np.diff(at).astype(float)
    out[:, 0] = np.log1p(size)
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])
    for i, flags in enumerate(CLASSES.values()):
        out[:, 1 + i] = _share(total(flags[raw]), size)
    filled = ~_SPACE[raw]
    first = filled.copy()
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first[1:] &= ~filled[:-1] | edge[1:-1]
    last = filled.copy()
    last[:-1] &= ~filled[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(at, begin, "right") - 1
    words = np.bincount(owner, minlength=docs).astype(float)
    length = (end - begin).astype(float)
    mean = np.bincount(owner, length, docs) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(np.bincount(owner, length ** 2, docs) / np.maximum(words, 1) - mean ** 2, 0))
    key = word_keys(raw, begin, end)
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    columns = [np.log1p(words), np.log1p(mean), np.log1p(spread), _share(np.bincount(owner[same], minlength=docs), words)]
    for n in (1, 2, 3):
        grams, of = key, owner
        if n > 1:
            grams = key[n - 1:].copy() if len(key) >= n else key[:0]
            for k in range(n - 1):
                grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + key[k:len(key) - n + 1 + k])
            inside = owner[n - 1:] == owner[:len(owner) - n + 1] if len(key) >= n else np.zeros(0, bool)
            grams, of = grams[inside], owner[n - 1:][inside]
        count = np.bincount(of, minlength=docs)
        columns.append(_share(_distinct(grams, of, docs), count.astype(float)))
    for flags, where in ((_flags(b".?!"), end - 1), (CLASSES["upper"], begin), (CLASSES["mark"], end - 1)):
        columns.append(_share(np.bincount(owner[flags[raw[where]]], minlength=docs), words))
    out[:, 1 + len(CLASSES):] = np.array(columns).T
    return out


_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def word_keys(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of byte ranges, equal for equal words, from one running polynomial."""
    if len(begin) == 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        forth = np.concatenate(([np.uint64(1)], np.full(len(raw), _STEP))).cumprod()
        back = np.concatenate(([np.uint64(1)], np.full(len(raw), _BACK))).cumprod()
        running = np.concatenate(([np.uint64(0)], ((mix(raw.astype(np.uint64) + np.uint64(1))) * forth[:-1]).cumsum()))
        return mix((running[end] - running[begin]) * back[begin] + (end - begin).astype(np.uint64))


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of both classes, and the scale of the final score."""

    centre: np.ndarray
    spread: np.ndarray
    means: list[np.ndarray]
    whiten: list[np.ndarray]
    log_scale: list[float]
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 minus that of class 0, from Mahalanobis distances."""
        z = (x - self.centre) / self.spread
        log = [-0.5 * (((z - m) @ w.T) ** 2).sum(1) - s for m, w, s in zip(self.means, self.whiten, self.log_scale)]
        return log[1] - log[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant | None:
    """None where a class has no row: then every document gets the share of label 1."""
    if len(label) == 0 or label.min() == label.max():
        return None
    centre, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-6, spread, 1.0)
    z = (x - centre) / spread
    groups = [z[label == c] for c in (0, 1)]
    own = [np.cov(g.T, bias=True) if len(g) > 1 else np.zeros((z.shape[1],) * 2) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(z)
    means, whiten, scale = [], [], []
    for g, covariance in zip(groups, own):
        # a class with few rows leans more on the pooled covariance
        weight = max(to_pooled, min(1.0, z.shape[1] / len(g)))
        mixed = (1 - weight) * covariance + weight * pooled
        level = np.trace(mixed) / len(mixed)
        factor = np.linalg.cholesky((1 - to_identity) * mixed + (to_identity * level + 1e-6) * np.eye(len(mixed)))
        means.append(g.mean(0))
        whiten.append(np.linalg.inv(factor))
        scale.append(float(np.log(np.diag(factor)).sum()))
    model = Discriminant(centre, spread, means, whiten, scale)
    model.slope, model.offset = _calibrate(model.difference(x), label)
    return model


def _calibrate(difference: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn the density difference into a probability (Newton steps)."""
    scale = max(float(np.abs(difference).mean()), 1e-9)
    a = np.column_stack((np.clip(difference / scale, -20, 20), np.ones(len(label))))
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (label - p) - 0.1 * w
        w = w + np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2), gradient)
    return float(w[0] / scale), float(w[1])


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> tuple[Discriminant | None, float]:
    """The model of ``labels.quality`` and the share of label 1, from a bounded sample of labelled rows."""
    def rows(batches):
        for batch in batches:
            for part in pieces(batch):
                x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float64())), part.column("label")], ["x", "label"])

    sample = sampled_texts(docs, labels, "quality", bound).select("text", "label")
    found = sample.mapInArrow(rows, "x array<double>, label int").toPandas()
    label = found["label"].to_numpy(float)
    x = np.array(found["x"].tolist()) if len(found) else np.zeros((0, N_FEATURES))
    return fit(x, label), float((label.sum() + 0.5) / (len(label) + 1))


def score_quality(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is an input of a score. Null and empty texts are scored from their (empty)
    statistics; repeated rows get equal scores; a missing id is not held out. Without labels of
    both classes every score is the share of label 1. An empty table gives no rows; other columns
    are ignored. Whole texts are read, in pieces of about 4 MB of rows.
    """
    model, share = fit_quality(docs, labels, bound)

    def scored(batches):
        for batch in batches:
            for part in pieces(batch):
                n = part.num_rows
                score = model.score(statistics(part.column("text"))) if model else np.full(n, share)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score),
                     pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text",
    ).mapInArrow(scored, SCHEMA)
