"""Bradley-Terry quality ranking.

Every text gets a row of layout features. A pair of labelled texts, one of label 1 and one of label
0, is a preference; the probability that the first wins is the logistic function of the difference
of their scores, a linear function of the feature difference. Weights minimise the logistic loss
over the pairs. The decision threshold is a quantile of the labelled texts' scores: the share of
label 0 among them; scores are then mapped to 0..1 so that the threshold falls on ``THRESHOLD``.

The weights come from a bounded sample of labelled rows (``max_rows``) and a bounded number of pairs.
The threshold and the spread of the scores come from all labelled rows outside the held-out fold: one
pass over the texts makes a number per row, and only numbers are shuffled. Scoring reads every text
whole, in one more pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from fractions import Fraction
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.profile import percentiles
from ..session import checkpoint_dir
from .common import _q, byte_table, map_texts
from .labels import fold, held_out, labelled_sample, labels_outside, largest
from .toxicity import score_column

THRESHOLD = 0.3
_CLASSES = np.stack([byte_table(f) for f in (
    lambda b: 65 <= b <= 90,                                    # upper case
    lambda b: 97 <= b <= 122,                                   # lower case
    lambda b: 48 <= b <= 57,                                    # digits
    lambda b: b >= 128,                                         # beyond ASCII
    lambda b: b == 32 or 9 <= b <= 13,                          # blanks
    lambda b: b == 10,                                          # line ends
    lambda b: chr(b) in ".,;:",                                 # sentence marks
    lambda b: chr(b) in "!?",
    lambda b: chr(b) in "'\"()-",
    lambda b: chr(b) in "#$%&*+/<=>@[\\]^_`{|}~",               # other signs
    lambda b: b < 9 or 14 <= b < 32 or b == 127)], 1).astype(float)  # control characters
N_SHARES = _CLASSES.shape[1]
N_FEATURES = 2 * N_SHARES + 10


def features(text: str | None) -> np.ndarray:
    """Layout features of one whole text; those of an empty text are zeros but for the first."""
    out = np.zeros(N_FEATURES)
    data = (text or "").encode()
    if not data:
        out[0] = 1
        return out
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / len(data)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    lengths = len(data) * (1 - share[4]) / n
    out[1:10] = (np.log1p(len(words)), lengths, lengths ** 0.5, len(set(words)) / n, (len(set(words)) / n) ** 2,
                 sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
                 np.log1p(len(words) / max(1, len(lines))), np.log1p(n) * len(set(words)) / n)
    out[10:10 + N_SHARES] = share
    out[10 + N_SHARES:] = np.sqrt(share)
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cutoff: float   # the score quantile
    slope: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        """Bradley-Terry scores of feature rows."""
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def ranks(self, texts: list) -> np.ndarray:
        return self.rank(np.array([features(t) for t in texts]).reshape(len(texts), N_FEATURES))

    def scores(self, texts: list) -> np.ndarray:
        z = self.slope * (self.ranks(texts) - self.cutoff) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_pairs(x: np.ndarray, y: np.ndarray, max_pairs: int = 40_000, l2: float = 1e-4, steps: int = 400,
              seed: int = 1) -> QualityModel:
    """Weights from preference pairs: each row meets rows of the other label, in a seeded order, until
    ``max_pairs`` pairs. With one label only, all weights are zero."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    w = np.zeros(N_FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return QualityModel(mean, scale, w, 0.0 if len(bad) else -1.0, 1.0)
    rng = np.random.Generator(np.random.PCG64(seed))
    turns = min(max_pairs, max(len(good), len(bad)) * 8)
    first, second = np.resize(rng.permutation(good), turns), rng.permutation(np.resize(bad, turns))
    z = np.clip((x - mean) / scale, -8, 8)
    d = z[first] - z[second]

    def loss(v):
        s = d @ v
        return np.mean(np.logaddexp(0, -s)) + l2 * v @ v, d.T @ (-1 / (1 + np.exp(s))) / len(d) + 2 * l2 * v

    look, t, step = w.copy(), 1.0, 1.0
    for _ in range(steps):
        value, g = loss(look)
        while True:
            new = look - step * g
            if loss(new)[0] <= value - 0.5 * step * (g @ g) or step < 1e-8:
                break
            step /= 2
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t, step = new, t_new, step * 1.2
    s = z @ w
    cutoff = float(np.quantile(s, len(bad) / (len(good) + len(bad))))
    return QualityModel(mean, scale, w, cutoff, float(3 / (s.std() + 1e-9)))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, fold_out: int = 0,
                id_col: str = "doc_id", text_col: str = "text", max_rows: int = 10_000) -> QualityModel:
    """A model with the weights of at most ``max_rows`` labelled texts outside the held-out fold, whose
    feature rows (a few hundred bytes each) are gathered on the driver, and the cutoff and slope of all."""
    sample = labelled_sample(docs, labels, label_col, folds, fold_out, max_rows, id_col, text_col)

    def start():
        return lambda texts: {"x": [features(t).tolist() for t in texts]}
    rows = map_texts(sample, "text", ["id", "label"], T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), start)
    got = rows.toArrow().sort_by("id")
    x = np.array(got.column("x").to_pylist()).reshape(got.num_rows, N_FEATURES)
    order = np.lexsort(x.T[::-1]) if len(x) else np.zeros(0, int)  # the same whatever the order of rows
    model = fit_pairs(x[order], got.column("label").to_numpy()[order])
    return calibrated(model, docs, labels, label_col, folds, fold_out, id_col, text_col) if model.weights.any() else model


def calibrated(model: QualityModel, docs: DataFrame, labels: DataFrame, label_col: str, folds: int, fold_out: int,
               id_col: str, text_col: str) -> QualityModel:
    """The model with cutoff and slope from the scores of all labelled texts outside the held-out fold."""
    checkpoint_dir(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        return lambda texts: {"rank": m.ranks(texts).tolist()}
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text")).where("id is not null and text is not null")
    ranks = map_texts(src.where(fold("id", folds) != fold_out), "text", ["id"],
                      T.StructType([T.StructField("rank", T.DoubleType())]), start)
    rows = ranks.join(largest(labels_outside(labels, label_col, folds, fold_out, id_col)), "id").select("label", "rank").checkpoint()
    exact = lambda c: F.sum(c.cast("decimal(38,12)"))  # noqa: E731  (the same whatever the order of rows)
    n, bad, total, squares = rows.agg(F.count("*"), F.count_if(F.col("label") == 0), exact(F.col("rank")),
                                      exact(F.col("rank") * F.col("rank"))).first()
    spread = float(max(Fraction(0), Fraction(squares) / n - (Fraction(total) / n) ** 2)) ** 0.5
    cutoff = percentiles(rows.select("rank"), ["rank"], [bad / n]).first()["value"]
    return replace(model, cutoff=float(cutoff), slope=3 / (spread + 1e-9))


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, fold_out: int = 0,
                  id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Null and empty texts get the score of a text without content; null ids are not held out;
    repeated rows are scored each; without labels every score is equal; an empty table gives no
    rows; other columns are ignored.
    """
    model = fit_quality(docs, labels, label_col, folds, fold_out, id_col, text_col, **fit)
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    out = score_column(src, model, "text", ["id"])
    return out.select(F.col("id").alias(id_col), held_out("id", folds, fold_out).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
