"""Corpus pipeline: from raw documents to packed sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's ``docs``. All stages but the last
return the columns of ``docs``.

1. toxicity: documents that score 0.3 or more go.
2. SimHash near-dedup: of each group linked at 2 or fewer bits (3-word shingles) one document stays.
3. benchmark decontamination: words inside occurrences of 10-word benchmark windows are cut out;
   a document that has no other words goes.
4. secret scan: secrets are replaced by a mark.
5. packing: sequences of 2048 tokens, one row per piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, table
from tessera.llm.decontaminate import cut_spans
from tessera.llm.packing import pack_documents
from tessera.llm.secret_scan import redact_secrets
from tessera.llm.simhash import keep_one_per_group
from tessera.llm.toxicity import drop_toxic
from tessera.session import checkpoint_dir


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3. Null and empty texts have a score like any other (the model's
    intercept), null ids are scored but never learnt from, repeated rows go or stay together, an empty
    table stays empty, and labels that teach nothing reject nothing; all columns stay."""
    ship_package(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id (null ids last), on ties the least row hash, of equal rows
    one. Null, empty and blank texts share one fingerprint and so are one group; all columns stay."""
    ship_package(spark)
    return keep_one_per_group(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows. Texts without a hit, nulls and empty ones among them, stay
    as they are; a document of hit words only goes; repeated rows stay rows; all columns stay, and
    ``n_chars``, where there is one, follows the text."""
    ship_package(spark)
    return _sized(cut_spans(docs, table(spark, sf_dir, "benchmark"), n=10))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with ``[SECRET]`` for each run of secret spans. Null and empty texts, null ids and repeated rows
    stay; all columns stay, and ``n_chars``, where there is one, follows the text."""
    ship_package(spark)
    return _sized(redact_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece. A null or empty text is its closing id alone, each repeated row is packed, null ids
    too; an empty table gives no rows; columns other than id and text are not carried along."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("secret scans", secrets), ("packing", packing)]

#: The stages learn, hash and tokenise in ways SQL cannot express.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. Stage results are written below the shared checkpoint folder; each is
    deleted once the next one is written, so only the last remains, which the result reads."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            _delete(spark, f"{folder}/{i - 1}")
    return docs
