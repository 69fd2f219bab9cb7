"""Language identification by nearest centroids of TF-IDF character trigrams.

A text becomes the normalised TF-IDF vector of its hashed trigrams (letters lower-cased,
anything else a gap).  Every language has several centroids, found by clustering its
training vectors by cosine.  A text gets the language of the nearest centroid; one that is
farther from it than the centroid's radius allows is rejected.  Short texts lie farther from
their centroid than long ones, so a centroid has a radius for each class of length (distinct
trigrams), from a low quantile of its members' cosines and of those of excerpts of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from bikelake.llm.common import small_batches

BITS = 14
FEATURES = 1 << BITS
PER_LANGUAGE = 600       # bound of the training sample, in documents of each language
CENTROIDS = 3
QUANTILE = 0.02          # share of members and excerpts that may lie beyond the radius before its slack
SLACK = 0.75             # a text is rejected below this share of that quantile
EXCERPTS = (3, 6, 20, 80, 330, 1500)  # characters of the excerpts that set the radii of the classes of length
FEW = 20                 # with fewer members in a class a centroid takes its language's radius
SMALL = 0.05             # clusters below this share of a language's members are given up
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> lower-cased code point of letters, 0 for all others (built once)."""
    if not _LETTERS:
        t = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _LETTERS.append(t)
    return _LETTERS[0]


def counts_of(text: str) -> np.ndarray | None:
    """Hashed trigram counts of a text; None if it has no letter."""
    codes = _letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")]
    if not codes.any():
        return None
    h = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    gap = (codes[:-2] == 0) & (codes[1:-1] == 0) & (codes[2:] == 0)
    return np.bincount((h >> np.uint32(32 - BITS))[~gap], minlength=FEATURES).astype(np.float32)


def length_class(counts: np.ndarray) -> np.ndarray:
    """Class of length of count rows: distinct trigrams below 4, 16, 64, 256, 1024 and above."""
    return np.searchsorted([4, 16, 64, 256, 1024], np.count_nonzero(counts, axis=-1), "right")


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]      # of each centroid
    least: np.ndarray         # cosine below which the centroid rejects, by class of length

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts)
        v *= self.idf
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        return v

    def predict(self, texts: list[str | None], block: int = 64):
        """``(language, score, rejected)`` per text."""
        out = []
        for k in range(0, len(texts), block):
            counts = [counts_of(t) if t else None for t in texts[k:k + block]]
            known = [c for c in counts if c is not None]
            best, score = [], []
            if known and len(self.languages):
                rows = np.stack(known)
                cos = self.vectors(rows) @ self.centroids.T
                best, length = cos.argmax(axis=1), length_class(rows)
                score = np.clip(cos.max(axis=1), 0, 1)
            j = 0
            for c in counts:
                if c is None or not len(self.languages):
                    out.append((UNKNOWN, 0.0, True))
                else:
                    b = int(best[j])
                    out.append((self.languages[b], float(score[j]), bool(score[j] < self.least[b, length[j]])))
                    j += 1
        return out


def _clusters(x: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """Unit centroids of the rows.  A start is a row that lies far from the others, but nearer
    than a tenth of the rows, so outliers start nothing; small clusters go to their neighbours."""
    start = [int((x @ x.mean(axis=0)).argmax())]
    while len(start) < min(centroids, len(x)):
        start.append(int(np.argsort((x @ x[start].T).max(axis=1), kind="stable")[len(x) // 10]))
    c = x[start]
    while True:
        for _ in range(rounds):
            near = (x @ c.T).argmax(axis=1)
            c = np.stack([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        size = np.bincount((x @ c.T).argmax(axis=1), minlength=len(c))
        if len(c) == 1 or size.min() >= max(2, SMALL * len(x)):
            return c
        c = np.delete(c, size.argmin(), axis=0)


def _radii(model: Model, texts: list[str], c: np.ndarray) -> np.ndarray:
    """Least cosine by (centroid, class of length) from the texts and excerpts of their middles."""
    near, cos, length = [], [], []
    for size in (None, *EXCERPTS):
        cut = texts if size is None else [t[(len(t) - size) // 2:][:size] for t in texts if len(t) > size]
        for k in range(0, len(cut), 256):
            counts = [x for x in map(counts_of, cut[k:k + 256]) if x is not None]
            if counts:
                counts = np.stack(counts)
                score = model.vectors(counts) @ c.T
                near.append(score.argmax(axis=1))
                cos.append(score.max(axis=1))
                length.append(length_class(counts))
    near, cos, length = map(np.concatenate, (near, cos, length))
    out = np.zeros((len(c), len(EXCERPTS)))
    for k in range(len(c)):
        for j in range(len(EXCERPTS)):
            own, every = cos[(near == k) & (length == j)], cos[length == j]
            if len(every):
                out[k, j] = SLACK * max(0.0, float(np.quantile(own if len(own) >= FEW else every, QUANTILE)))
            elif j:
                out[k, j] = out[k, j - 1]  # no member so long: as the next shorter ones
    return out


def fit(rows: list[tuple[str, str]], centroids: int = CENTROIDS, rounds: int = 8) -> Model:
    """Fit from (language, text); clusters start from spread-out members, without chance."""
    by_lang: dict[str, list[str]] = {}
    df, n = np.zeros(FEATURES, np.int64), 0
    for lang, text in sorted(rows):
        c = counts_of(text) if text else None
        if c is not None:
            by_lang.setdefault(lang, []).append(text)
            df += c > 0
            n += 1
    if not by_lang:
        return Model(np.ones(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32), [],
                     np.zeros((0, len(EXCERPTS))))
    model = Model(np.log((1 + n) / (1 + df)).astype(np.float32) + 1, np.zeros((0, FEATURES)), [], np.zeros((0, 0)))
    found, langs, least = [], [], []
    for lang, texts in sorted(by_lang.items()):
        c = _clusters(model.vectors(np.stack([counts_of(t) for t in texts])), centroids, rounds)
        found.append(c)
        langs += [lang] * len(c)
        least.append(_radii(model, texts, c))
    return Model(model.idf, np.concatenate(found).astype(np.float32), langs, np.concatenate(least))


def bounded_rows(docs: DataFrame, label: str, id_col: str, text_col: str, per_label: int) -> list[tuple[str, str]]:
    """About ``per_label`` rows (label, text) of every label, chosen by a hash of the id and
    therefore the same in every run; at most twice that many are read to the driver."""
    known = docs.filter(F.col(label).isNotNull() & F.col(text_col).isNotNull())
    sizes = known.groupBy(label).count().orderBy(label).collect()    # one row per label
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r[0], min(1.0, per_label / r[1]))])
    dice = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    rows = (known.filter(dice < F.coalesce(share[F.col(label)], F.lit(0.0)))
            .select(F.col(label).alias("label"), F.col(text_col).alias("text"))
            .limit(2 * per_label * len(sizes)).collect())
    return [(r[0], r[1]) for r in rows]


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Fit on a bounded sample of the labelled rows of every language of ``docs``; the model
    grows with the number of languages, by some 200 kB each."""
    return fit(bounded_rows(docs, lang_col, id_col, text_col, per_language), centroids)


def classifier(model: Model):
    """Column function ``text -> struct(lang_pred, score, rejected)``.  Null texts and texts
    without a letter give ``und``, score 0, rejected."""
    @pandas_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(texts.tolist()), columns=["lang_pred", "score", "rejected"])
    return run


def folds(id_col: str, modulus: int, held: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == held


def identify(docs: DataFrame, train_on: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """``(id, lang_pred, score, rejected)`` for every row of ``docs``; repeated rows and null
    ids give one row each, an empty table none.  Whole texts are read, and handed to Python, a
    few MB at a time."""
    small_batches(docs.sparkSession)
    model = model or train(train_on, id_col=id_col, text_col=text_col, lang_col=lang_col)
    p = classifier(model)(F.col(text_col))
    return docs.select(F.col(id_col), p.alias("__p")).select(id_col, "__p.*")
