"""Quality scores learned from preferences (Bradley-Terry).

A document is a vector of features of its whole text. Every labelled good document is preferred to every labelled bad one; the
weights minimise the logistic loss on feature differences of such pairs. A quantile of the training margins, the share of bad
documents, is the threshold, and scores are shifted so that it lies at `CUT`. Labels and ids are never features.

All labelled rows and all pairs of a good and a bad one are used. The loss of a pair depends on its two margins only, so each
Newton step sums the rows of either label by cells of their margin (counts, features, products; one pass over the written
features) and pairs the cells: `CELLS` of equal width over six deviations to both sides, each at the mean margin of its rows. The threshold is found by counting
margins in ever narrower ranges. The driver receives such sums only. Null texts count as empty. Where labels hold one class or none, all weights are 0 and every document passes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import held, shingle_hashes, sum_arrays, word_hashes, word_spans
from ringsight.session import materialize

CUT = 0.3
CELLS, STEPS = 256, 30
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _OTHER, _HIGH = range(7)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[ord(c) for c in ".,;:'\"()-"]] = _STOP
N_FEATURES = 22


def features(text: str | None) -> np.ndarray:
    """Shares of character kinds, lengths, and how much of the text repeats."""
    out = np.zeros(N_FEATURES)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        out[0] = 1
        return out
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=7) / len(data)
    words, lengths = len(starts), ends - starts
    hashes = word_hashes(text)
    _, repeats = np.unique(hashes, return_counts=True)
    grams = shingle_hashes(hashes, 5)
    last, first = _KIND[data[ends - 1]], _KIND[data[starts]]
    symbols = np.concatenate((counts[33:48], counts[58:65], counts[91:97], counts[123:127])) / len(data)
    lines = (text or "").split("\n")
    out[1:8] = np.sqrt(kinds)
    out[8] = np.log1p(words)
    out[9] = np.log1p(lengths.mean())
    out[10] = np.log1p(lengths.std())
    out[11] = len(repeats) / words
    out[12] = repeats.max() / words
    out[13] = len(np.unique(grams)) / len(grams)
    out[14] = (last == _OTHER).mean()
    out[15] = (last == _STOP).mean()
    out[16] = (first == _UPPER).mean()
    out[17] = (first == _OTHER).mean()
    out[18] = (lengths == 1).mean()
    out[19] = np.sqrt(symbols.max())
    out[20] = 1 - len(set(lines)) / len(lines)
    out[21] = np.log1p(words / len(lines))
    return out


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(self.margin(x) - self.threshold + shift, -60, 60)))


def _moments(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Rows, good rows, and the sums of the features."""
    return np.concatenate(([len(x), good.sum()], x.sum(axis=0)))


def _spread(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return ((x - mean) ** 2).sum(axis=0)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _cells(z: np.ndarray, good: np.ndarray, weights: np.ndarray, low: float, width: float) -> np.ndarray:
    """Per label and cell of the margin: rows, sum of margins, sums of the features and of their products."""
    n = z.shape[1]
    upper = np.triu_indices(n)
    margin = z @ weights
    cell = np.clip((margin - low) / width, 0, CELLS - 1).astype(np.int64) + CELLS * good
    out = np.zeros((2 * CELLS, 2 + n + len(upper[0])))
    order = np.argsort(cell, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(z) else ():
        products = z[part].T @ z[part]
        out[cell[part[0]]] = np.concatenate(([len(part), margin[part].sum()], z[part].sum(axis=0), products[upper]))
    return out.ravel()


def _along(cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per cell the sum of the features times the distance of the row's margin from the cell's mean."""
    n = len(weights)
    rows, columns = np.triu_indices(n)
    products = np.zeros((len(cells), n, n))
    products[:, rows, columns] = products[:, columns, rows] = cells[:, 2 + n :]
    return products @ weights - cells[:, 2 : 2 + n] * (cells[:, 1] / cells[:, 0])[:, None]


def _newton(cells: np.ndarray, weights: np.ndarray, penalty: float) -> np.ndarray:
    """The step on the mean logistic loss over all pairs of a good and a bad row."""
    n = len(weights)
    upper = np.triu_indices(n)
    bad, good = cells.reshape(2, CELLS, -1)
    bad, good = bad[bad[:, 0] > 0], good[good[:, 0] > 0]
    pairs = bad[:, 0].sum() * good[:, 0].sum()
    p = 1 / (1 + np.exp(np.clip((good[:, 1] / good[:, 0])[:, None] - bad[:, 1] / bad[:, 0], -60, 60)))
    q = p * (1 - p)
    slope = (p @ bad[:, 0]) @ good[:, 2 : 2 + n] - (good[:, 0] @ p) @ bad[:, 2 : 2 + n]
    # within a cell, features go along with margins
    slope -= (q @ bad[:, 0]) @ _along(good, weights) + (good[:, 0] @ q) @ _along(bad, weights)
    slope = slope / pairs - penalty * weights
    own = np.zeros((n, n))
    own[upper] = (q @ bad[:, 0]) @ good[:, 2 + n :] + (good[:, 0] @ q) @ bad[:, 2 + n :]
    own = own + own.T - np.diag(own.diagonal())
    cross = good[:, 2 : 2 + n].T @ q @ bad[:, 2 : 2 + n]
    return np.linalg.solve((own - cross - cross.T) / pairs + penalty * np.eye(n), slope)


def _range(cells: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """The first margin and the width of cells that hold the rows' margins by these weights."""
    n = len(weights)
    sums = cells.reshape(2 * CELLS, -1).sum(axis=0)
    products = np.zeros((n, n))
    products[np.triu_indices(n)] = sums[2 + n :]
    products = products + products.T - np.diag(products.diagonal())
    middle = sums[2 : 2 + n] @ weights / sums[0]
    spread = np.sqrt(max(weights @ products @ weights / sums[0] - middle * middle, 0.0)) + 1e-9
    return middle - 6 * spread, 12 * spread / CELLS


def _quantile(count: Callable[[float, float], np.ndarray], rows: int, share: float, reach: float) -> float:
    """The margin at a share of all rows, between neighbours: two order statistics, by counts in ever narrower ranges."""
    seen: dict[tuple[float, float], np.ndarray] = {}

    def at(rank: int) -> float:
        low, high = -reach, reach
        while high - low > 1e-12:
            if (low, high) not in seen:
                seen[low, high] = np.cumsum(count(low, high))  # rows below the range, then those of its cells
            cell = min(max(int(np.searchsorted(seen[low, high], rank, "right")) - 1, 0), CELLS - 1)
            low, high = low + cell * (high - low) / CELLS, low + (cell + 1) * (high - low) / CELLS
        return (low + high) / 2

    place = share * (rows - 1)
    first = at(int(place))
    if place == int(place):
        return first
    return first + (place - int(place)) * (at(int(place) + 1) - first)


def _counts(margin: np.ndarray, low: float, high: float) -> np.ndarray:
    """Rows below `low`, then per cell of [low, high); margins never reach the last `high`."""
    cell = np.floor((margin - low) / (high - low) * CELLS).astype(np.int64)
    return np.bincount(np.clip(cell, -1, CELLS) + 1, minlength=CELLS + 2)[: CELLS + 1].astype(float)


Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray | None]


def _fit(total: Total, penalty: float = 1e-3) -> Ranker:
    """Fit on rows that are only seen as sums: `total` adds a function of (features, good) up over all of them."""
    sums = total(_moments)
    if sums is None or not 0 < sums[1] < sums[0]:
        return Ranker(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    rows, share = int(sums[0]), sums[1] / sums[0]
    mean = sums[2:] / rows
    scale = np.sqrt(total(lambda x, good: _spread(x, mean)) / rows)
    scale[scale < 1e-9] = 1
    weights, low, width = np.zeros(N_FEATURES), -1.0, 2 / CELLS
    for _ in range(STEPS):
        cells = total(lambda x, good: _cells(_standard(x, mean, scale), good, weights, low, width))
        step = _newton(cells, weights, penalty)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
        low, width = _range(cells, weights)
    reach = 8 * np.abs(weights).sum() + 1
    count = lambda low, high: total(lambda x, good: _counts(_standard(x, mean, scale) @ weights, low, high))
    return Ranker(mean, scale, weights, _quantile(count, rows, 1 - share, reach))


def fit_ranker(x: np.ndarray, good: np.ndarray, penalty: float = 1e-3) -> Ranker:
    """The same fit on arrays."""
    return _fit(lambda part: part(x, good), penalty)


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `x`: the features as bytes, so that texts are read once and never shuffled."""

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    return docs.withColumn("x", vector(F.col(text)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Ranker:
    """Fit on all labelled documents whose crc32(id as text) mod 5 is not 0. An id with labels of both classes teaches nothing."""
    return fit(with_features(docs.select(key, text).where(~held(key, 5, 0)), text).select(key, "x"), labels, key)


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> Ranker:
    """`train` on documents given as (key, x)."""
    known = labels.where(~held(key, 5, 0) & F.col("quality").isin(0, 1) & F.col(key).isNotNull()).select(key, "quality")
    one = known.groupBy(key).agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    written = materialize(rows.select(key, "x").join(one, key).select(F.col("quality").cast("long").alias("quality"), "x"), "quality-features")

    def total(part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
        def add(batches):
            out = None
            for batch in batches:
                if len(batch):
                    x = np.frombuffer(b"".join(batch["x"])).reshape(-1, N_FEATURES)
                    found = part(x, (batch["quality"] == 1).to_numpy(bool))
                    out = found if out is None else out + found
            if out is not None:
                yield pd.DataFrame({"data": [np.asarray(out, float).tobytes()]})

        return sum_arrays(written.mapInPandas(add, "data binary"), fan=8)

    return _fit(total)


def scored_features(rows: DataFrame, ranker: Ranker, name: str = "score") -> DataFrame:
    """`with_scores` of documents given by their features `x`."""

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(ranker.score(np.frombuffer(b"".join(x)).reshape(-1, N_FEATURES)))

    return rows.withColumn(name, score("x"))


def with_scores(docs: DataFrame, ranker: Ranker, text: str = "text", name: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(ranker.score(np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)))

    return docs.withColumn(name, score(F.col(text)))
