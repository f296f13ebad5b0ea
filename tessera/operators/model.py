"""Weighted logistic regression with ``pyspark.ml`` (ML1-ML10).

The fitted pipeline is a ``PipelineModel`` of native stages: a ``SQLTransformer`` carrying
the fitted imputation/scaling constants (exact training medians, mean and population std),
``StringIndexer`` + ``OneHotEncoder`` (unknown and NULL levels -> all-zero vector),
``VectorAssembler`` and a ``LogisticRegressionModel``. The balanced class weights ``n / (k * n_c)``
come from the per-class counts (one row per class), taken once.

The coefficients minimise ``C * sum(weights * logistic loss) + (|coefficients|^2 + intercept^2) / 2``, the
intercept penalised like any coefficient, by Newton's method (iteratively reweighted least squares): a
pass over the cached rows sums loss, gradient and weighted Gram matrix, a number for each pair of
features, and about seven passes reach the minimum. Category columns stay index columns until a
batch is multiplied, so a pass reads a few numbers per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import binary_target, parse_emp_length, percent_lenient, percent_strict
from .quantiles import exact_percentiles

# Feature lists and label statuses of the loan model.
NUMERIC_BASE = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
                "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc"]
NUMERIC = NUMERIC_BASE + ["emp_length_numeric"]
CATEGORICAL = ["term", "grade", "sub_grade", "home_ownership", "verification_status", "purpose",
               "addr_state"]
TRAINING_STATUSES = ["Fully Paid", "Charged Off"]
MISSING_LEVEL = "Missing"


def prepare(df: DataFrame, scope: str = "binary", numeric: Sequence[str] = NUMERIC,
            categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Target and parsed features. ``scope='binary'`` keeps the two training statuses, drops
    rows with a NULL numeric feature and fills NULL categoricals with 'Missing' (training);
    ``scope='all'`` keeps every row and status (label 0 for all but 'Charged Off') as the A/B
    evaluation does; NULLs are then handled by the pipeline's imputation."""
    d = df.filter(F.col("loan_status").isin(TRAINING_STATUSES)) if scope == "binary" else df
    have = set(d.columns)
    extra = [binary_target("loan_status").alias("target")]
    if "emp_length" in have:
        extra.append(parse_emp_length("emp_length").alias("emp_length_numeric"))
    repl = {}
    if "int_rate" in have:
        repl["int_rate"] = percent_strict("int_rate")
    if "revol_util" in have:
        repl["revol_util"] = percent_lenient("revol_util")
    d = d.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in d.columns], *extra)
    if scope == "binary":
        needed = [c for c in numeric if c in d.columns]
        parsed = [c for c in needed if c in repl or c not in have]
        d = _drop_missing(d, [*parsed, "target"], [c for c in needed if c not in parsed])
        d = d.fillna(MISSING_LEVEL, subset=[c for c in categorical if c in d.columns])
    return d


def _drop_missing(d: DataFrame, parsed: Sequence[str], plain: Sequence[str]) -> DataFrame:
    """``dropna`` over ``parsed`` and ``plain`` columns, a condition for each plain one (no NULL, and no NaN, which is
    above infinity). One condition over all of them is too much generated code for the JVM to compile and
    can only run after the last join; as they are, Spark moves each down to the table it reads. The parsed columns
    stay together and come first: text is parsed on one side of the joins, and bad text raises in any row."""
    kinds, out = dict(d.dtypes), F.lit(True)
    for c in plain:
        out = out & (F.col(c) <= F.lit(float("inf")) if kinds[c] in ("double", "float") else F.col(c).isNotNull())
    return d.dropna(how="any", subset=list(parsed)).filter(out)


def class_weights(df: DataFrame, label: str = "target", name: str = "class_weight") -> DataFrame:
    """ML7: balanced weights ``n / (k * n_c)`` (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w = Window.partitionBy()
    return counts.select(label, (F.sum("_nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("_nc"))).alias(name))


def with_class_weights(df: DataFrame, label: str = "target", name: str = "class_weight") -> DataFrame:
    """ML7: the weights joined by class (broadcast)."""
    return df.join(F.broadcast(class_weights(df, label, name)), label)


def fitted_constants(train: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """ML1 + ML2: exact median per numeric feature, then mean and population std of the imputed
    values (a few scalars)."""
    found, _ = exact_percentiles(train, {c: F.col(c) for c in numeric}, [0.5]) if numeric else ({}, None)
    med = {c: found.get((c, 0.5), 0.0) for c in numeric}
    aggs = []
    for c in numeric:
        x = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(med[c]))
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    row = train.agg(*aggs).first() if aggs else {}
    out = {}
    for c in numeric:
        mean = row[f"{c}__m"] if row[f"{c}__m"] is not None else 0.0
        std = row[f"{c}__s"]
        out[c] = (med[c], float(mean), float(std) if std is not None and std > 0 else 1.0)
    return out


def _prep_statement(consts: dict[str, tuple[float, float, float]], categorical: Sequence[str]) -> str:
    num = [f"(COALESCE(CAST(`{c}` AS DOUBLE), {m!r}D) - {mu!r}D) / {s!r}D AS `{c}__z`"
           for c, (m, mu, s) in consts.items()]
    cat = [f"COALESCE(CAST(`{c}` AS STRING), '{MISSING_LEVEL}') AS `{c}__f`" for c in categorical]
    return "SELECT *, " + ", ".join(num + cat) + " FROM __THIS__"


def build_pipeline(consts: dict[str, tuple[float, float, float]], categorical: Sequence[str]) -> Pipeline:
    """The stages up to the ``features`` vector."""
    cats = list(categorical)
    stages = [SQLTransformer(statement=_prep_statement(consts, cats))]
    if cats:
        stages.append(StringIndexer(inputCols=[f"{x}__f" for x in cats], outputCols=[f"{x}__i" for x in cats],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{x}__i" for x in cats], outputCols=[f"{x}__v" for x in cats],
                                    dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"{x}__z" for x in consts] + [f"{x}__v" for x in cats],
                                  outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def loss_sums(rows: DataFrame, beta: np.ndarray, numbers: int, levels: Sequence[int]) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted logistic loss, gradient and Hessian at ``beta`` over ``rows``: ``numbers`` feature columns, an
    index column for each category (``levels``: its known levels; any other index is all zeros), label
    and weight. The last entry of ``beta`` is the intercept. A task sends one number for each pair of
    features; the sums over tasks are taken by Spark."""
    start = np.concatenate(([0], np.cumsum(levels))).astype(int) + numbers
    d = len(beta)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad, gram = 0.0, np.zeros(d), np.zeros((d, d))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                cols = [c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns]
                x = np.zeros((part.num_rows, d))
                x[:, -1] = 1.0
                for j, c in enumerate(cols[:numbers]):
                    x[:, j] = c
                for j, n in enumerate(levels):
                    level = cols[numbers + j].astype(int)
                    known = np.flatnonzero(level < n)
                    x[known, start[j] + level[known]] = 1.0
                y, w = cols[-2], cols[-1]
                f = x @ beta
                p = 0.5 * (1 + np.tanh(f / 2))
                loss += float(w @ np.logaddexp(0, np.where(y > 0.5, -f, f)))
                grad += x.T @ (w * (p - y))
                gram += x.T @ (x * (w * p * (1 - p))[:, None])
        out = np.concatenate(([loss], grad, gram[upper])).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], names=["s"])

    sums = (rows.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "x"))
            .groupBy("i").agg(F.sum("x").alias("x")).toArrow())  # a row for each pair of features
    total = np.zeros(1 + d + len(upper[0]))
    total[sums.column("i").to_numpy()] = sums.column("x").to_numpy()
    gram = np.zeros((d, d))
    gram[upper] = total[1 + d:]
    return float(total[0]), total[1:1 + d], gram + np.triu(gram, 1).T


def newton(rows: DataFrame, c: float, numbers: int, levels: Sequence[int], start: np.ndarray | None = None,
           max_iter: int = 100, tol: float = 1e-6) -> np.ndarray:
    """The minimum of ``c * loss + |beta|^2 / 2``. A step that does not lower the objective is halved. Ends when
    a step is below ``tol``; the error left is of the order of its square."""
    d = numbers + int(sum(levels)) + 1
    beta, step, best = np.zeros(d) if start is None else start, None, np.inf
    for _ in range(max_iter):
        loss, grad, gram = loss_sums(rows, beta, numbers, levels)
        value = c * loss + beta @ beta / 2
        if step is not None and value > best + 1e-9 * abs(best):
            step = step / 2
            beta = held + step
            continue
        held, best = beta, value
        step = -np.linalg.solve(c * gram + np.eye(d), c * grad + beta)
        beta = held + step
        if np.abs(step).max() < tol:
            break
    return beta


def _logistic_stage(spark, beta: np.ndarray, c: float, sum_weights: float, label: str):
    """A ``LogisticRegressionModel`` with these coefficients: fitted to two rows under bounds that leave no
    other choice."""
    d = len(beta) - 1
    rows = spark.createDataFrame([(Vectors.dense([float(y)] * d), float(y), 1.0) for y in (0, 1)], ["features", label, "class_weight"])
    bound, icpt = Matrices.dense(1, d, beta[:-1].tolist()), Vectors.dense([float(beta[-1])])
    return LogisticRegression(featuresCol="features", labelCol=label, weightCol="class_weight", standardization=False,
                              regParam=1.0 / (c * sum_weights), elasticNetParam=0.0, fitIntercept=True, maxIter=1,
                              family="binomial", lowerBoundsOnCoefficients=bound, upperBoundsOnCoefficients=bound,
                              lowerBoundsOnIntercepts=icpt, upperBoundsOnIntercepts=icpt).fit(rows)


ROW_BYTES_PER_COLUMN = 16
TARGET_PARTITION_BYTES = 64 * 1024 * 1024


def fit_partitions(spark, rows: int, columns: int) -> int:
    """Partitions of the cached training frame: about 64 MB each and at least one per core. Every
    optimizer iteration is one ``treeAggregate`` over them."""
    size = rows * columns * ROW_BYTES_PER_COLUMN
    return max(spark.sparkContext.defaultParallelism, -(-size // TARGET_PARTITION_BYTES))


@contextmanager
def _training(train: DataFrame, numeric, categorical, label: str, rows: int | None, cached: bool):
    """(frame, weight by class, constants, categorical features, row count) of one training set. The frame is
    persisted here unless the caller says that ``train`` is cached (MEMORY_AND_DISK; lost blocks
    are recomputed from the deterministic lineage). The classes are counted once, so that the passes
    over the frame do not count them again."""
    numeric = [x for x in numeric if x in train.columns]
    categorical = [x for x in categorical if x in train.columns]
    cols = list(dict.fromkeys([label, *numeric, *categorical]))
    n = rows if rows is not None else train.count()
    frame = train.select(*cols)
    if not cached:
        frame = frame.repartition(fit_partitions(train.sparkSession, n, len(cols))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = {r[label]: r["class_weight"] for r in class_weights(frame, label).collect() if r[label] is not None}
        known = frame.filter(F.col(label).isNotNull())
        yield known, weights, fitted_constants(known, numeric), categorical, n
    finally:
        if not cached:
            frame.unpersist()


@contextmanager
def _ready(frame: DataFrame, weights: dict, consts, cats: Sequence[str], label: str):
    """(fitted stages, rows of persisted number and index columns, number of number columns, levels of each
    category). Indices are cached as integers, which the cache compresses, and a weight follows from its label."""
    head = build_pipeline(consts, cats).fit(frame)
    levels = [len(x) for x in head.stages[1].labelsArray] if cats else []
    flat = frame
    for stage in head.stages[:2 if cats else 1]:
        flat = stage.transform(flat)
    features = [*[f"{x}__z" for x in consts], *[f"{x}__i" for x in cats]]
    kept = flat.select(*[F.col(f"{x}__z") for x in consts], *[F.col(f"{x}__i").cast("int").alias(f"{x}__i") for x in cats],
                       F.col(label)).persist(StorageLevel.MEMORY_AND_DISK)
    weight = F.coalesce(F.lit(None).cast("double"), *[F.when(F.col(label) == F.lit(v), F.lit(float(w))) for v, w in weights.items()])
    try:
        yield head.stages, kept.select(*features, F.col(label).cast("double").alias(label), weight.alias("class_weight")), len(consts), levels
    finally:
        kept.unpersist()


def fit(train: DataFrame, c: float = 1.0, numeric: Sequence[str] = NUMERIC,
        categorical: Sequence[str] = CATEGORICAL, label: str = "target", max_iter: int = 100,
        rows: int | None = None, cached: bool = False) -> PipelineModel:
    """ML1-ML8: fit the pipeline on ``train``. ``rows`` (the training row count) saves a pass when
    the caller knows it; ``cached`` says that ``train`` comes from a persisted frame."""
    return sweep(train, [c], numeric, categorical, label, max_iter, rows, cached)[c]


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("id", "target")) -> DataFrame:
    """ML9: predicted label (0.5 cut) and probability of class 1 as ``score``."""
    out = model.transform(df)
    return out.select(*[k for k in keep if k in df.columns], F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("score"))


def sweep(train: DataFrame, cs: Sequence[float], numeric: Sequence[str] = NUMERIC,
          categorical: Sequence[str] = CATEGORICAL, label: str = "target", max_iter: int = 100,
          rows: int | None = None, cached: bool = False) -> dict[float, PipelineModel]:
    """ML10: one model per regularisation strength; the persisted training frame, its constants, the
    indexers and the encoders are made once, only Newton's method runs per strength, from the last minimum."""
    out, beta = {}, None
    with _training(train, numeric, categorical, label, rows, cached) as (frame, weights, consts, cats, n):
        with _ready(frame, weights, consts, cats, label) as (stages, ready, numbers, levels):
            for c in cs:
                beta = newton(ready, c, numbers, levels, beta, max_iter)
                out[c] = PipelineModel([*stages, _logistic_stage(train.sparkSession, beta, c, float(n), label)])
    return out


def coefficients(model: PipelineModel) -> tuple[list[float], float]:
    lr = model.stages[-1]
    return list(lr.coefficients.toArray()), float(lr.intercept)
