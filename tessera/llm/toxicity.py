"""Counterfactual-regularised toxicity classifier.

A linear model on how often a text's words begin with a certain stem: features are the hashed first
3 to 12 bytes of each word and the whole word, valued by the root of their share of all words, so
that inflected stems count in any language and long texts compare with short ones. Next to the logistic loss it is fitted with a penalty on score changes between a
labelled text and its counterfactuals, in which each identity term is swapped for another term of
its group: a mention of a group as such can then carry no weight either way.

The fit uses a bounded sample of labelled rows (``max_rows``): stems are summed by class on the
executors, the ``max_features`` most telling ones are kept, and only these of each sampled text
reach the driver. Scoring reads every text whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import ByteHasher, _q, byte_table, map_texts, rows_out, word_spans
from .labels import held_out, labelled_sample

PREFIXES = (3, 4, 5, 6, 7, 8, 10, 12, 1 << 20)  # bytes; the last takes the whole word
BUCKET_BITS = 22
THRESHOLD = 0.3
#: Identity terms by group; a term is swapped for the next one of its group.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("immigrants", "citizens", "refugees"),
    ("deaf", "blind", "disabled"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"))
_IN_WORD = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_HASHER = ByteHasher(6)


def stems(texts: list[str], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value) of the distinct stems of each text, in order; of the ``chosen``
    buckets only (a boolean table). A prefix as long as its word stands for the word alone."""
    raw = [t.lower().encode() for t in texts]
    buf = np.frombuffer(b"\n".join(raw), np.uint8)
    start, end = word_spans(buf, _IN_WORD)
    doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, side="right")
    words = np.bincount(doc, minlength=len(texts))
    bucket = (_HASHER.ranges(buf, start, end, lengths=PREFIXES) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    if chosen is None:
        use = np.array(PREFIXES) < (end - start)[:, None]
        use[:, -1] = True
        row, bucket = np.nonzero(use)[0], bucket[use]
    else:
        use = chosen[bucket]
        row, col = np.nonzero(use)
        real = (np.array(PREFIXES)[col] < (end - start)[row]) | (col == len(PREFIXES) - 1)
        bucket, row = bucket[use][real], row[real]
    key, count = np.unique((doc[row] << BUCKET_BITS) | bucket, return_counts=True)
    of = key >> BUCKET_BITS
    return of, key & ((1 << BUCKET_BITS) - 1), np.sqrt(count / words[of])


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of about a megabyte of text, so that the arrays of a batch stay small."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size < 1 << 20):
            size += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def swap_terms(groups=IDENTITY_TERMS) -> Callable[[str], str]:
    """The function that replaces every identity term of a text by the next one of its group."""
    to = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    find = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(to, key=len, reverse=True))) + r")\b", re.I) if to else None

    def swap(text: str) -> str:
        return find.sub(lambda m: to.get(m[0].lower(), m[0]), text) if find else text
    return swap


@dataclass
class ToxicityModel:
    buckets: np.ndarray  # ascending
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text; null counts as empty."""
        chosen = np.zeros(1 << BUCKET_BITS, bool)
        chosen[self.buckets] = True
        return self._scores(texts, chosen)

    def _scores(self, texts, chosen) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for at, to in _slices(texts):
            doc, bucket, value = stems([t or "" for t in texts[at:to]], chosen)
            total[at:to] += np.bincount(doc, self.weights[np.searchsorted(self.buckets, bucket)] * value, to - at)
        return 1 / (1 + np.exp(-total))


def fit_linear(rows: list[tuple], y: np.ndarray, twins: list[tuple], n: int, l2: float = 2e-5,
               twin_weight: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias for sparse rows ``(features, values)``: mean logistic loss, ``l2`` times the
    squared weights and ``twin_weight`` times the mean squared change of the linear score between
    row ``i`` and its twin ``(i, features, values)``. Accelerated gradient steps, halved as needed."""
    def csr(parts):
        size = np.array([len(f) for f, _ in parts], np.int64)
        flat, value = ([np.concatenate(x) for x in zip(*parts)] if parts else (np.zeros(0, np.int64), np.zeros(0)))
        return flat, value, np.repeat(np.arange(len(size)), size), len(size)

    def times(part, w):
        flat, value, own, m = part
        return np.bincount(own, w[flat] * value, m)

    def back(part, r):
        flat, value, own, _ = part
        return np.bincount(flat, r[own] * value, n)

    main, twin = csr(rows), csr([t[1:] for t in twins])
    of = np.array([t[0] for t in twins], np.int64)
    m, k = max(1, len(y)), max(1, len(twins))

    def loss(v):
        w, b = v[:n], v[n]
        linear = times(main, w)
        z = linear + b
        d = linear[of] - times(twin, w)
        value = np.mean(np.logaddexp(0, z) - y * z) + l2 * w @ w + twin_weight * (d @ d) / k
        r = (1 / (1 + np.exp(-z)) - y) / m
        change = 2 * twin_weight * d / k
        pull = r.copy()
        np.add.at(pull, of, change)
        return value, np.append(back(main, pull) + 2 * l2 * w - back(twin, change), r.sum())

    v = np.zeros(n + 1)
    v[n] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    look, t, step = v.copy(), 1.0, 4.0
    for _ in range(steps):
        value, g = loss(look)
        while True:
            new = look - step * g
            if loss(new)[0] <= value - 0.5 * step * (g @ g) or step < 1e-6:
                break
            step /= 2
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - v)
        v, t, step = new, t_new, step * 1.2
    return v[:n], float(v[n])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, fold_out: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", max_rows: int = 10_000, max_features: int = 2_000,
                 groups=IDENTITY_TERMS, twin_weight: float = 1.0) -> ToxicityModel:
    """A model from at most ``max_rows`` labelled texts outside the held-out fold. Without any
    label of one class, the model has no features and its bias alone."""
    checkpoint_dir(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, folds, fold_out, max_rows, id_col, text_col).checkpoint()
    n = dict(sample.groupBy("label").count().collect())
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log((n1 + 0.5) / (n0 + 0.5))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, labels = b.column(0).to_pylist(), b.column(1).to_numpy()
            for at, to in _slices(texts):
                doc, bucket, value = stems(texts[at:to])
                ids, where = np.unique(bucket, return_inverse=True)
                one = labels[at:to][doc] == 1
                sums = [np.bincount(where, x, len(ids)) for x in (one * value, ~one * value, one * value ** 2, ~one * value ** 2)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, np.bincount(where, minlength=len(ids)), *sums)],
                                                 names=["bucket", "n", "a", "b", "aa", "bb"])

    by_class = (sample.select("text", "label")
                .mapInArrow(count, "bucket long, n long, a double, b double, aa double, bb double")
                .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb")]))
    a, b = F.col("a") / n1, F.col("b") / n0
    spread = F.sqrt((F.col("aa") / n1 - a * a) / n1 + (F.col("bb") / n0 - b * b) / n0 + 1e-9)
    best = (by_class.where("n >= 4").select("bucket", F.round(F.abs(a - b) / spread, 6).alias("z")).where("z >= 2.5")
            .orderBy(F.desc("z"), "bucket").limit(max_features))
    buckets = np.array(sorted(r.bucket for r in best.collect()), np.int64)

    def chosen_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, swap = np.zeros(1 << BUCKET_BITS, bool), swap_terms(groups)
        table[buckets] = True

        def features(texts):
            doc, bucket, value = stems(texts, table)
            cut = np.searchsorted(doc, np.arange(1, len(texts)))
            return [(f.tolist(), v.tolist()) for f, v in zip(np.split(np.searchsorted(buckets, bucket), cut), np.split(value, cut))]

        def rows():
            for texts, y in ((t[at:to], y[at:to]) for b in batches for t, y in [[c.to_pylist() for c in b.columns[:2]]]
                             for at, to in _slices(t)):
                twins = [swap(t) for t in texts]
                changed = [i for i, t in enumerate(twins) if t != texts[i]]
                twin = dict(zip(changed, features([twins[i] for i in changed]))) if changed else {}
                for i, f in enumerate(features(texts)):
                    yield (y[i], *f, *twin.get(i, (None, None)))
        yield from rows_out(out, rows(), 1000)

    out = T.StructType([T.StructField("label", T.IntegerType())] + [
        T.StructField(c, T.ArrayType(t)) for c, t in (("f", T.IntegerType()), ("v", T.DoubleType()),
                                                      ("tf", T.IntegerType()), ("tv", T.DoubleType()))])
    got = sample.select("text", "label").mapInArrow(chosen_only, out).toArrow()
    col = {c: got.column(c).to_pylist() for c in ("f", "v", "tf", "tv")}
    own = [(np.array(f, np.int64), np.array(v, float)) for f, v in zip(col["f"], col["v"])]
    twins = [(i, np.array(f, np.int64), np.array(v, float)) for i, (f, v) in enumerate(zip(col["tf"], col["tv"])) if f is not None]
    w, bias = fit_linear(own, got.column("label").to_numpy().astype(float), twins, len(buckets), twin_weight=twin_weight)
    return ToxicityModel(buckets, w, bias)


def score_column(docs: DataFrame, model, text_col: str, keep: list[str], name: str = "score") -> DataFrame:
    """The ``keep`` columns and the model's score of every row; the model is broadcast (bounded)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        return lambda texts: {name: m.scores(texts).tolist()}
    return map_texts(docs, text_col, keep, T.StructType([T.StructField(name, T.DoubleType())]), start)


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, fold_out: int = 2,
                   threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts score as a text without features; null ids are not held out; repeated
    rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    model = fit_toxicity(docs, labels, label_col, folds, fold_out, id_col, text_col, **fit)
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    out = score_column(src, model, "text", ["id"])
    return out.select(F.col("id").alias(id_col), held_out("id", folds, fold_out).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text", **fit) -> DataFrame:
    """The documents that score below the threshold, with all their columns. Labels from which no feature
    can be learnt (none at all, or of one class) tell no document from another: then all stay."""
    model = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, **fit)
    if not len(model.buckets):
        return docs
    name = "__score"
    while name in docs.columns:
        name += "_"
    out = score_column(docs, model, text_col, docs.columns, name)
    return out.where(_q(name) < threshold).select(*[_q(c) for c in docs.columns])
