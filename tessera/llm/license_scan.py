"""Licence scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Built-in functions only, row by row, without a shuffle. A text's words become five-word shingle
hashes. For each template, windows of the template's length, an eighth of it apart, get a MinHash
signature of ``BANDS`` bands of ``ROWS`` minima; a template is retrieved when a window shares a
band with it, and reported when the document holds at least ``CONTAINMENT`` of its shingles.

Band settings: a copy in one place that holds 0.8 of a template lies in some window that is off by at most
a sixteenth; its Jaccard similarity with the template is then 0.6 or more, and 20 bands of 2 minima
collide with probability 1 - (1 - 0.6**2)**20, which is over 0.9998. A notice in distant parts fills no
window. A text without a colliding window is therefore counted as a whole, and the template retrieved from
the least number of its shingles on that a report needs: retrieval loses nothing.

Two exact shortcuts keep the work small. A text that is reported holds at least ``k`` of a template's
shingles, counted in whole numbers; each template has a few long words (needles) that touch all but
fewer than ``k`` of them. Texts without any needle, or without any shingle of the template, are not windowed.
The templates are a parameter of bounded size (``MAX_TEMPLATES``), so their signatures are constants of the plan.

Sister notices (two versions of one licence) share most of their shingles, so one of them alone would
report both. A template is left out where a sister has the higher containment and the text holds no
shingle that the template has and the sister lacks; the template of highest containment always stays.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _q
from .license_templates import TEMPLATES

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 20, 2
MAX_TEMPLATES = 500

_WORDS = "filter(split(lower({0}), '[^a-z0-9]+'), w -> w <> '')"
_HASHES = (f"if(size({{0}}) >= {SHINGLE}, transform(sequence(0, size({{0}}) - {SHINGLE}), i -> xxhash64("
           + ", ".join(f"{{0}}[i + {j}]" for j in range(SHINGLE)) + ")), array())")


def _seeds() -> list[int]:
    return np.random.Generator(np.random.PCG64(7)).integers(-2**62, 2**62, BANDS * ROWS).tolist()


def _bands(window: str) -> str:
    """Band keys of an array of shingle hashes: minima of the hashes under fixed exclusive ors."""
    s = [f"array_min(transform({window}, h -> h ^ {x}L))" for x in _seeds()]
    return "array(" + ", ".join(f"xxhash64({b}, {', '.join(s[b * ROWS:(b + 1) * ROWS])})" for b in range(BANDS)) + ")"


def _windows(hashes: str, m: int) -> str:
    """Band keys of all windows of ``m`` shingles."""
    step = max(1, m // 8)
    starts = (f"array_distinct(concat(sequence(0, greatest(size({hashes}) - {m}, 0), {step}), "
              f"array(greatest(size({hashes}) - {m}, 0))))")
    return f"flatten(transform(transform({starts}, i -> slice({hashes}, i + 1, {m})), x -> {_bands('x')}))"


def least_count(n: int) -> int:
    """The least number of a template's ``n`` shingles that makes a report."""
    return next((k for k in range(n + 1) if n and k / n >= CONTAINMENT), 0)


def needles(text: str) -> list[str]:
    """Words, longest first, that leave fewer of the template's distinct shingles untouched than a reported
    document holds: every reported document has one of them."""
    words = re.findall("[a-z0-9]+", text.lower())
    grams = {tuple(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
    least = least_count(len(grams))
    out, left = [], set(grams)
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        if len(left) < least or not left:
            break
        out.append(w)
        left = {g for g in left if w not in g}
    return out


def _signatures(spark: SparkSession, templates) -> list[tuple]:
    """(id, needles, distinct shingle hashes, band keys) of the templates, by the same expressions."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates at once; scan in several passes")
    rows = [(str(i), t) for i, t in templates]
    df = spark.createDataFrame(rows, "id string, text string").withColumn("w", F.expr(_WORDS.format("text")))
    df = df.withColumn("sh", F.expr(f"array_distinct({_HASHES.format('w')})")).where("size(sh) > 0")
    got = {r.id: r for r in df.select("id", "sh", F.expr(_bands("sh")).alias("bands")).collect()}
    return [(i, needles(t), got[i].sh, got[i].bands) for i, t in rows if i in got]


def _longs(values: list[int]) -> str:
    return "array(" + ", ".join(f"{v}L" if v > -2**63 else "(-9223372036854775807L - 1L)" for v in values) + ")"


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``licenses``, an array of (id, containment) of the templates
    found, by id; of sister notices those that the text tells apart (see above), on ties all.

    Words are runs of a-z and 0-9 after lower-casing. Null, empty and short texts have no shingles and
    no licences; templates of fewer than five words are left out; null ids and repeated rows stay rows
    of their own; texts are read whole; an empty table gives no rows; other columns are ignored.
    """
    found = sorted(_signatures(docs.sparkSession, templates))
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    if not found:
        return src.select(F.col("id").alias(id_col), F.expr("cast(array() as array<struct<id:string,containment:double>>)").alias("licenses"))
    every = sorted({n for _, ns, _, _ in found for n in ns})
    held = src.withColumn("low", F.lower("text"))
    held = held.select("id", "low", F.array(*[F.when(F.col("low").contains(n), F.lit(n)) for n in every]).alias("has"))
    words = F.when(F.exists("has", lambda x: x.isNotNull()), F.expr(_WORDS.format("low")))
    shingled = (held.select("id", "has", F.coalesce(words, F.expr("cast(array() as array<string>)")).alias("w"))
                .select("id", "has", F.expr(_HASHES.format("w")).alias("sh")))
    cases = []
    for i, ns, shingles, bands in found:
        has = " or ".join(f"has[{every.index(n)}] is not null" for n in ns)
        own = _longs(shingles)
        hits = f"size(array_intersect(sh, {own}))"
        retrieved = f"arrays_overlap({_windows('sh', len(shingles))}, {_longs(bands)}) or {hits} >= {least_count(len(shingles))}"
        lone = [f"case when not arrays_overlap(sh, {_longs(sorted(set(shingles) - set(other)))}) then '{j}' end"
                for j, _, other, _ in found if _sister(shingles, other)]
        lone = f"array({', '.join(lone)})" if lone else "cast(array() as array<string>)"
        cases.append(f"case when size(sh) > 0 and ({has}) and arrays_overlap(sh, {own}) then case when {retrieved} then "
                     f"named_struct('id', '{i}', 'containment', {hits} / {len(shingles)}D, 'lone', {lone}) end end".replace("\\", "\\\\"))
    scanned = shingled.select("id", F.expr(
        f"filter(array({', '.join(cases)}), x -> x is not null and x.containment >= {CONTAINMENT}D)").alias("held"))
    return scanned.select(F.col("id").alias(id_col), F.expr(
        "transform(filter(held, x -> not exists(held, y -> y.containment > x.containment and coalesce(array_contains(x.lone, y.id), false))),"
        " x -> named_struct('id', x.id, 'containment', x.containment))").alias("licenses"))


def _sister(shingles: list[int], other: list[int]) -> bool:
    """Whether a text of the other template alone would report this one, without holding all of it."""
    shared = len(set(shingles) & set(other))
    return least_count(len(shingles)) <= shared < len(shingles)


def oracle_sql(templates=TEMPLATES) -> str:
    """The same answer in DuckDB SQL: containment of every template's shingles in every document, less sisters."""
    quote = lambda s: s.replace("'", "''")
    values = ", ".join(f"('{quote(i)}', '{quote(t)}')" for i, t in templates)
    split = "list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda x: x <> '')"
    grams = ("list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), "
             "lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))")
    return f"""
WITH t AS (SELECT id, unnest(g) AS gram, len(g) AS n FROM (SELECT id, {grams} AS g FROM (
       SELECT id, {split.format('text')} AS w FROM (VALUES {values}) AS v(id, text)))),
d AS (SELECT doc_id, unnest({grams}) AS gram FROM (SELECT doc_id, {split.format('text')} AS w FROM documents)),
hits AS (SELECT doc_id, id, count(*) / any_value(n) AS containment FROM d JOIN t USING (gram) GROUP BY doc_id, id),
held AS (SELECT * FROM hits WHERE containment >= {CONTAINMENT}),
sisters AS (SELECT a.id, b.id AS other FROM t a JOIN t b USING (gram) WHERE a.id <> b.id GROUP BY a.id, b.id
       HAVING count(*) / any_value(a.n) >= {CONTAINMENT} AND count(*) < any_value(a.n)),
apart AS (SELECT s.id, s.other, t.gram FROM sisters s JOIN t ON t.id = s.id
       WHERE NOT EXISTS (FROM t o WHERE o.id = s.other AND o.gram = t.gram)),
told AS (SELECT DISTINCT doc_id, id, other FROM d JOIN apart USING (gram)),
gone AS (SELECT x.doc_id, x.id FROM held x JOIN sisters s ON s.id = x.id
       JOIN held y ON y.doc_id = x.doc_id AND y.id = s.other AND y.containment > x.containment
       WHERE NOT EXISTS (FROM told WHERE told.doc_id = x.doc_id AND told.id = x.id AND told.other = s.other)),
good AS (SELECT doc_id, count(*) AS n_licenses, string_agg(id, ',' ORDER BY id) AS licenses FROM held
       WHERE NOT EXISTS (FROM gone WHERE gone.doc_id = held.doc_id AND gone.id = held.id) GROUP BY doc_id)
SELECT doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN good USING (doc_id)"""
