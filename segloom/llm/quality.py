"""Quality classifier by pairwise ranking.

Method: Bradley-Terry. Each preference pair is a good and a bad labelled document; the logistic loss on the
difference of their features learns one weight a feature. A document's score is the weighted sum; the cut is
the quantile of scores that the share of bad labels names, and a logistic curve through it maps to 0..1.

Only the learning rows (at most ``max_learning_rows``, the smallest hashes of their ids: a bounded sample of
labelled rows) reach the driver, as feature vectors. Features of all rows are made in one narrow stage.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, text_bytes

#: Function words of four languages (fixed values), for the share of each language in a text.
_FUNCTION_WORDS = {
    "en": "the of and to in is it that was for on with as are be this by from or an at not have which his her had they you were",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei",
    "fr": "le la les de des et un une du en est que qui dans pour pas sur au par plus ce il elle ne se sont avec son on mais ou",
    "es": "el la los las de y que en un una por con no para su al lo como del se es más o pero sus le ya este sí porque",
}
_WORDS: dict[bytes, int] = {}
for _k, _words in enumerate(_FUNCTION_WORDS.values()):
    for _w in _words.split():
        _WORDS[_w.encode()] = _WORDS.get(_w.encode(), 0) | 1 << _k

_CLASSES = np.zeros(256, np.uint8)  # 0 other
_CLASSES[97:123], _CLASSES[65:91], _CLASSES[48:58] = 1, 2, 3
_CLASSES[[9, 10, 11, 12, 13, 32]] = 4
_CLASSES[[46, 44]] = 5
_CLASSES[33:44], _CLASSES[45], _CLASSES[58:65], _CLASSES[91:97], _CLASSES[123:127] = 6, 6, 6, 6, 6
_CLASSES[128:] = 7

FEATURES = (
    "lower", "upper", "digit", "space", "stop", "sign", "high", "log_bytes", "word_length", "distinct_words", "repeated_lines", "repeated_next",
    "repeated_pairs", "sign_ends", "most_common", "top_language", "second_language", "upper_words", "lone_signs", "squeezed", "one",
)


def features(text: bytes) -> list[float]:
    """Shares of character classes, repetition of words, pairs and lines, and function words of a whole text."""
    n = len(text)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    shares = np.bincount(_CLASSES[np.frombuffer(text, np.uint8)], minlength=8) / n
    words = text.split()
    count = max(1, len(words))
    distinct = set(words)
    lines = [x for x in text.split(b"\n") if x]
    pairs = list(zip(words, words[1:], strict=False))
    bare = [w.strip(b".,").lower() for w in words]
    tally: dict[bytes, int] = {}
    for w in bare:
        tally[w] = tally.get(w, 0) + 1
    languages = [0, 0, 0, 0]
    for w, c in tally.items():
        if mask := _WORDS.get(w):
            for k in range(4):
                if mask >> k & 1:
                    languages[k] += c
    first, second = sorted(languages, reverse=True)[:2]
    ends = sum(_CLASSES[w[-1]] == 6 for w in words)
    return [
        *(float(shares[k]) for k in (1, 2, 3, 4, 5, 6, 7)),
        float(np.log1p(n)) / 10,
        sum(map(len, words)) / count / 10,
        len(distinct) / count,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(a == b for a, b in pairs) / count,
        1 - len(set(pairs)) / max(1, len(pairs)),
        ends / count,
        max(tally.values(), default=0) / count,
        first / count,
        second / count,
        sum(w.isupper() for w in words) / count,
        sum(len(w) == 1 and _CLASSES[w[0]] == 6 for w in words) / count,
        len(zlib.compress(text, 1)) / n,
        1.0,
    ]


def with_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features array<float>); a null text counts as empty."""

    def run(batches):
        for b in batches:
            rows = [features(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["id", "features"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, features array<float>").withColumnRenamed("id", id_col)


@dataclass
class Ranking:
    """A fitted model: score = logistic(slope * (weights . standardised features - cut))."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.cut), -30, 30)))


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs: int = 60_000, epochs: int = 12, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> Ranking:
    """Bradley-Terry weights from random (good, bad) pairs by stochastic gradient descent.

    With labels of one kind only there is no pair: every document then gets that label.
    """
    x = np.asarray(x, np.float64).reshape(len(good), len(FEATURES))
    mean, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    scale = np.where(scale < 1e-6, 1.0, scale)
    z = np.clip((x - mean) / scale, -8, 8)
    ups, downs = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    w = np.zeros(x.shape[1])
    if not len(ups) or not len(downs):
        return Ranking(mean, scale, w, -1.0 if len(ups) or not len(downs) else 1.0, 1.0)
    rng = np.random.default_rng(seed)
    differences = z[rng.choice(ups, pairs)] - z[rng.choice(downs, pairs)]
    square = np.full(x.shape[1], 1e-8)
    for _ in range(epochs):
        for d in np.array_split(differences[rng.permutation(pairs)], max(1, pairs // 256)):
            g = -(d / (1 + np.exp(np.clip(d @ w, -30, 30)))[:, None]).mean(0) + decay * w
            square += g * g
            w -= rate * g / np.sqrt(square)
    raw = z @ w
    cut = float(np.quantile(raw, len(downs) / len(good)))
    near = np.sort(raw)[max(0, int(0.98 * len(downs)) - 1) : int(1.02 * len(downs)) + 1]
    if len(near) > 1:  # the middle of the widest gap near the quantile
        k = int(np.argmax(np.diff(near)))
        cut = float((near[k] + near[k + 1]) / 2)
    return Ranking(mean, scale, w, cut, fit_slope(raw - cut, good))


def fit_slope(margins: np.ndarray, good: np.ndarray, least: float = 0.05, most: float = 20.0) -> float:
    """The slope of the logistic curve through the cut under which the labels are likeliest, by halving.

    Labels that the cut separates would have an infinite one, so it is bounded.
    """
    signed = np.where(good == 1, margins, -margins)

    def rise(slope: float) -> float:  # of the log-likelihood, which is concave in the slope
        return float((signed / (1 + np.exp(np.clip(slope * signed, -60, 60)))).sum())

    for _ in range(40):
        middle = math.sqrt(least * most)
        least, most = (middle, most) if rise(middle) > 0 else (least, middle)
    return math.sqrt(least * most)


def fit_quality(documents: DataFrame, labels: DataFrame, max_learning_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Learn from labelled rows whose crc32(id as text) mod 3 is not 1; no more than ``max_learning_rows`` of them.

    Rows with a null label or id are not learnt from. Of labels that repeat an id the smallest counts, of documents
    that do the text of smallest hash, so no more rows than that reach the driver. Labels, language, source and id
    are no inputs of a score.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1) & (id_remainder(id_col, 3) != 1))
    chosen = usable.groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("id"), "id").limit(max_learning_rows)
    texts = documents.select(F.col(id_col).alias("id"), text_col).join(F.broadcast(chosen), "id")  # bounded by the parameter
    hashed = texts.select("id", F.xxhash64(text_bytes(text_col)).alias("h"), text_col)
    once = with_features(hashed.select(F.struct("id", "h").alias("key"), text_col), "key", text_col).groupBy("key.id").agg(F.min_by("features", "key.h").alias("features"))
    learning = once.join(F.broadcast(chosen), "id").orderBy("id").collect()
    x = np.array([r["features"] for r in learning], np.float64).reshape(len(learning), len(FEATURES))
    return fit_ranking(x, np.array([r["quality"] for r in learning], np.int64))


def score_quality(df: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of each row's whole text; a null text scores as the empty one.

    Equal texts score alike, whatever their row; rows and ids may repeat or be null. A score at the cut (0.5) counts
    as label 1. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        for b in batches:
            x = np.array([features(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], names=["id", "score", "predicted"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, score double, predicted int").withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """df without the rows whose predicted label is 0; its columns stay as they are."""

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text_col)
            x = np.array([features((t or "").encode()) for t in b.column(at).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= 0.5))

    return df.mapInArrow(run, df.schema)
