"""The corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the last return the
columns of ``docs``. A row with a null key is judged and redacted by its own text; it is no near duplicate of anything.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sendero.llm.decontaminate import contaminated
from sendero.llm.near_dups import near_duplicates
from sendero.llm.pii import find_personal_data, redact
from sendero.llm.queries import BYTE_BPE, REJECTED
from sendero.llm.toxicity import score_toxicity, train
from sendero.llm.transducer import round_trip
from sendero.plans.registry import query, table
from sendero.session import table_path


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that is never null, ``_unit``: for a null key a hash of the text."""
    return docs.withColumn("_unit", F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce("text", F.lit("")))))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents whose score reaches ``REJECTED``; the model is fitted on the labelled rows of ``docs``."""
    rows = keyed(docs)
    scores = score_toxicity(rows, train(docs, table(spark, sf_dir, "labels")), "_unit")
    rejected = scores.where(F.col("score") >= REJECTED).select("_unit").distinct()
    return rows.join(rejected, "_unit", "left_anti").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest key, of each group of five-word, 80 per cent near duplicates."""
    groups = near_duplicates(docs, size=5, percent=80)
    dropped = groups.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents that hold a passage of the benchmark, re-parameterised ones too."""
    rows = keyed(docs)
    found = contaminated(rows, table(spark, sf_dir, "benchmark"), "_unit").select(F.col("doc_id").alias("_unit")).distinct()
    return rows.join(found, "_unit", "left_anti").select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets. A changed text's ``n_chars`` is counted anew."""
    found = (find_personal_data(keyed(docs), "_unit").where(F.size("spans") > 0).dropDuplicates(["doc_id", "row"])
             .select(F.col("doc_id").alias("_unit"), F.col("row").alias("_row"), F.col("spans").alias("_spans")))
    rows = keyed(docs).withColumn("_row", F.xxhash64(F.coalesce("text", F.lit("")))).join(found, ["_unit", "_row"], "left")
    changed = rows.withColumn("text", F.when(F.col("_spans").isNotNull(), redact(F.col("text"), F.col("_spans")))
                              .otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length("text").cast("bigint"))
                                     .otherwise(F.col("n_chars")))
    return changed.select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)``: token ids, and a digest of what they decode to."""
    coded = round_trip(docs, public_tokenizers.path(BYTE_BPE))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("toxicity", drop_toxic), ("near duplicates", keep_one_of_each), ("decontamination", drop_contaminated),
          ("personal data", redact_personal_data), ("token ids", encode_tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = table_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark, sf_dir):
    return run(spark, sf_dir)
