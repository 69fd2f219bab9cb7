"""Document quality by Bradley-Terry ranking of preference pairs.

Every pair of a good and a bad labelled document is a preference, and all of them count.  The
model learns document scores ``w . x`` by the logistic loss on feature differences, -log sigmoid(w . (x_good -
x_bad)), with a small ridge.  A score quantile of the training documents is the cut between
kept and rejected documents.

Features are independent of the language: shares of pairs of adjacent character classes, and
how much of a text repeats (words, lines).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, StructField, StructType

from bikelake.llm.common import small_batches, written

RIDGE = 1e-3
CELLS = 1 << 13           # of the grid of scores, in whose resolution pairs are told apart
BLOCK = 2048              # documents of a stored block of features
MEMORY, MOST_STEPS, TOLERANCE = 20, 300, 1e-6   # of L-BFGS; the tolerance is of the gradient's norm
CUT_QUANTILE = 0.995
CUT_SHARE = 0.3
SHOWN_AT = 0.7            # the score that the cut is mapped to

_CLASSES: list[np.ndarray] = []
_KNOWN = "\n \t.,;:!?'\"-()[]{}<>|#$%&*@/\\=+_~^"
N_CLASSES = 4 + len(_KNOWN)
N_FEATURES = N_CLASSES * N_CLASSES + 8


def _classes() -> np.ndarray:
    """Class of a code point: other, lower, upper, digit, or one of the known marks."""
    if not _CLASSES:
        t = np.zeros(0x3000, np.int64)
        for i in range(0x3000):
            c = chr(i)
            t[i] = 3 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() else 0
        for k, c in enumerate(_KNOWN):
            t[ord(c)] = 4 + k
        _CLASSES.append(t)
    return _CLASSES[0]


def features(text: str | None) -> np.ndarray:
    """Feature vector of a whole text; null and empty texts have the zero vector."""
    x = np.zeros(N_FEATURES, np.float32)
    if not text:
        return x
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    c = _classes()[np.minimum(codes, 0x2FFF)]
    c[(codes >= 0x3000) & (codes < 0xE000)] = 1  # scripts without case
    if len(c) > 1:
        x[:N_CLASSES * N_CLASSES] = np.sqrt(
            np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_CLASSES * N_CLASSES) / (len(c) - 1))
    words, lines = text.split(), [s for s in text.split("\n") if s]
    n = max(1, len(words))
    distinct = len(set(words))
    x[-8:] = (np.log1p(len(words)) / 10, distinct / n, len(set(lines)) / max(1, len(lines)),
              sum(map(len, set(lines))) / max(1, sum(map(len, lines))), min(len(codes) / n, 40) / 20,
              np.log1p(len(codes) / max(1, len(lines))) / 10, float(n < 5), float(distinct < 0.3 * n and n > 20))
    return x


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).astype(np.float64) @ self.weight

    def score(self, texts, block: int = 512) -> np.ndarray:
        """Scores in 0..1; the cut is mapped to ``SHOWN_AT``."""
        out = []
        for k in range(0, len(texts), block):
            raw = self.raw(np.stack([features(t) for t in texts[k:k + block]]))
            z = np.clip(raw - self.cut, -30, 30) + np.log(SHOWN_AT / (1 - SHOWN_AT))
            out.append(1 / (1 + np.exp(-z)))
        return np.concatenate(out) if out else np.zeros(0)


def _scores(row: np.ndarray, j: np.ndarray, v: np.ndarray, n: int, u: np.ndarray, shift: float) -> np.ndarray:
    return np.bincount(row, v * u[j], minlength=n) - shift


def _moments(y, row, j, v):
    """Documents per label, and every feature's sum and sum of squares."""
    return np.concatenate([[(y == 0).sum(), (y == 1).sum()], np.bincount(j, v, N_FEATURES), np.bincount(j, v * v, N_FEATURES)])


def _spread_scores(y, row, j, v, u, shift, half):
    """Scores of each label, dealt linearly to the two grid points beside them, and how many
    lie outside of the grid."""
    at = (_scores(row, j, v, len(y), u, shift) + half) / (2 * half) * CELLS
    inside = np.clip(at, 0, CELLS)
    k = np.minimum(inside.astype(np.int64), CELLS - 1)
    part = inside - k
    sides = [np.bincount(k[y == c], 1 - part[y == c], CELLS + 1) + np.bincount(k[y == c] + 1, part[y == c], CELLS + 1) for c in (0, 1)]
    return np.concatenate([[(at != inside).sum()], *sides])


def _pull(y, row, j, v, u, shift, half, pulls):
    """Sum of the documents' features, each by the derivative of the loss by its score."""
    s, grid = _scores(row, j, v, len(y), u, shift), np.linspace(-half, half, CELLS + 1)
    c = np.where(y == 1, np.interp(s, grid, pulls[1]), np.interp(s, grid, pulls[0]))
    return np.concatenate([[c.sum()], np.bincount(j, v * c[row], N_FEATURES)])


def _ranks(y, row, j, v, u, shift, wanted):
    """For each (label, low, high): scores below low, in each of its cells, and from high on."""
    s = _scores(row, j, v, len(y), u, shift)
    return np.concatenate([np.bincount(np.clip(np.floor((s[y == c] - low) / (high - low) * CELLS), -1, CELLS).astype(np.int64) + 1,
                                       minlength=CELLS + 2) for c, low, high in wanted])


def _against(held: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """At each grid point k the sum over grid points l of held[l] * kernel(l - k)."""
    n = len(held)
    size = 1 << (3 * n).bit_length()
    return np.fft.irfft(np.fft.rfft(held, size) * np.fft.rfft(kernel[::-1], size), size)[n - 1:2 * n - 1]


def fit(total, ridge: float = RIDGE) -> Model:
    """Minimise the Bradley-Terry loss over all pairs of a good and a bad document.

    ``total(fn, **more)`` sums ``fn(y, row, j, v, **more)`` over all labelled documents: their
    labels, and their features other than zero as (document, feature, value).  The mean loss of a
    score against all documents of the other label is a convolution of these documents' scores on
    a grid, so every pair counts and none is formed.  The loss has one minimum, found by L-BFGS.
    The cut lies between the ``CUT_QUANTILE`` score quantile of the bad documents and the
    opposite one of the good.  Without both labels every document passes.
    """
    sums = total(_moments)
    n_bad, n_good = (int(k) for k in sums[:2]) if sums is not None else (0, 0)
    if not n_bad or not n_good:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), -1.0)
    mean, square = sums[2:].reshape(2, -1) / (n_bad + n_good)
    scale = np.maximum(np.sqrt(np.maximum(square - mean * mean, 0)), 0.02)
    half = 16.0

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        nonlocal half
        u = w / scale
        at, half = {"u": u, "shift": float(mean @ u)}, max(16.0, half / 2)
        while (found := total(_spread_scores, half=half, **at))[0] > 0:
            half *= 2                                  # a score beyond the grid: a wider one
        bad, good = found[1:].reshape(2, -1) / [[n_bad], [n_good]]
        d = np.arange(-CELLS, CELLS + 1) * (2 * half / CELLS)
        wrong = 1 / (1 + np.exp(-np.clip(d, -500, 500)))   # of a bad document that lies d higher
        value = good @ _against(bad, np.logaddexp(0, d)) + ridge / 2 * (w @ w)
        pulls = (_against(good, wrong[::-1]) / n_bad, -_against(bad, wrong) / n_good)
        g = total(_pull, half=half, pulls=pulls, **at)
        return float(value), (g[1:] - g[0] * mean) / scale + ridge * w

    w = np.zeros(N_FEATURES)
    value, grad = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(MOST_STEPS):
        if np.linalg.norm(grad) < TOLERANCE:
            break
        way, taken = grad.copy(), []
        for s, t in reversed(steps):
            taken.append(s @ way / (s @ t))
            way -= taken[-1] * t
        way *= steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.linalg.norm(grad))
        for (s, t), a in zip(steps, reversed(taken)):
            way += s * (a - t @ way / (s @ t))
        size = 1.0
        while True:
            new, (new_value, new_grad) = w - size * way, loss(w - size * way)
            if new_value <= value - 1e-4 * size * (grad @ way) or size < 1e-3:
                break
            size /= 2
        if new_value > value:                          # as low as the grid tells
            break
        s, t = new - w, new_grad - grad
        if s @ t > 1e-12 * np.linalg.norm(s) * np.linalg.norm(t):
            steps = [*steps[1 - MEMORY:], (s, t)]
        w, value, grad = new, new_value, new_grad
    at = {"u": w / scale, "shift": float(mean @ (w / scale))}
    # Cut by score quantiles: between those of the best bad and the worst good documents, nearer
    # to the bad ones, since a good document lost cannot be made up for.
    places = [(0, CUT_QUANTILE * (n_bad - 1)), (1, (1 - CUT_QUANTILE) * (n_good - 1))]
    ranks = [(c, int(r) + k) for c, r in places for k in (0, 1)]
    wanted = [(c, -half, half) for c, _ in ranks]
    for _ in range(3):                                 # the cell that holds the rank, cut into cells again
        counts = total(_ranks, wanted=wanted, **at).reshape(len(ranks), -1).cumsum(axis=1)
        for i, ((c, rank), (_, low, high)) in enumerate(zip(ranks, wanted)):
            k = min(max(int(np.searchsorted(counts[i], min(rank, counts[i][-1] - 1), side="right")) - 1, 0), CELLS - 1)
            width = (high - low) / CELLS
            if width > 1e-9:
                wanted[i] = (c, low + k * width, low + (k + 1) * width)
    value_at = [(low + high) / 2 for _, low, high in wanted]
    high, low = (value_at[2 * i] + (r - int(r)) * (value_at[2 * i + 1] - value_at[2 * i]) for i, (_, r) in enumerate(places))
    return Model(mean, scale, w, float(min(high, low) + CUT_SHARE * abs(low - high)))


@pandas_udf(StructType([StructField("j", BinaryType()), StructField("v", BinaryType())]))
def _sparse(texts: pd.Series) -> pd.DataFrame:
    """Features other than zero: their numbers (16 bits) and values (32 bits)."""
    found = []
    for text in texts:
        x = features(text)
        j = np.flatnonzero(x)
        found.append((j.astype("<i2").tobytes(), x[j].astype("<f4").tobytes()))
    return pd.DataFrame(found, columns=["j", "v"])


def _blocks(batches):
    """Blocks of documents: labels, features a document, their numbers and values."""
    for b in batches:
        for k in range(0, len(b), BLOCK):
            part = b.iloc[k:k + BLOCK]
            yield pd.DataFrame({"y": [part["y"].to_numpy(np.int8).tobytes()],
                                "n": [np.array([len(j) // 2 for j in part["j"]], "<i4").tobytes()],
                                "j": [b"".join(part["j"])], "v": [b"".join(part["v"])]})


def _totals(blocks: DataFrame):
    """Sums over blocks: one array a task, and two tasks a core, come to the driver."""
    few = blocks.coalesce(2 * blocks.sparkSession.sparkContext.defaultParallelism)

    def total(fn, **more):
        def run(batches):
            held = None
            for b in batches:
                for y, n, j, v in zip(b["y"], b["n"], b["j"], b["v"]):
                    n = np.frombuffer(n, "<i4")
                    got = fn(np.frombuffer(y, np.int8), np.repeat(np.arange(len(n)), n), np.frombuffer(j, "<i2").astype(np.int64),
                             np.frombuffer(v, "<f4").astype(np.float64), **more)
                    held = got.astype(np.float64) if held is None else held + got
            if held is not None:
                yield pd.DataFrame({"held": [held.tobytes()]})

        out = None
        for r in few.mapInPandas(run, "held binary").collect():
            out = np.frombuffer(r.held) + (0 if out is None else out)
        return out
    return total


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit on every document with a label.  Rows without a label, id or text are not learned
    from.  Of a document with several labels the largest counts.  Features are made beside the
    texts; the join and the passes over the labelled documents carry only these.  They are
    written before the join: where it is broadcast, features and blocks would else be made in
    one task by two Python workers, and an executor keeps all workers that it ever needed at once."""
    spark = docs.sparkSession
    small_batches(spark)
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y"))
             .filter("__id IS NOT NULL AND y IS NOT NULL").groupBy("__id").agg(F.max("y").alias("y")).filter("y IN (0, 1)"))
    found = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
             .filter("__id IS NOT NULL AND __text IS NOT NULL").select("__id", _sparse("__text").alias("x")))
    rows = written(spark, found, "quality-features").join(known, "__id").select("y", "x.j", "x.v")
    return fit(_totals(written(spark, rows.mapInPandas(_blocks, "y binary, n binary, j binary, v binary"), "quality")))


def scorer(model: Model):
    """Column function ``text -> score``; null and empty texts get the score of the zero vector."""
    @pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))
    return run
