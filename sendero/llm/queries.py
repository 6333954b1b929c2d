"""The registered queries of the corpus operators: production parameters, whole tables, digests of real outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sendero.llm.chat import format_conversations, loss_spans, texts_under, turns_in
from sendero.llm.decontaminate import contaminated
from sendero.llm.manifest import manifest
from sendero.llm.near_dups import near_duplicates
from sendero.llm.passages import remove_repeats
from sendero.llm.pii import KINDS, find_personal_data, written
from sendero.llm.rans import store_and_read
from sendero.llm import secrets
from sendero.llm.sql import MANIFEST, SECRETS
from sendero.llm.token_counts import count_tokens
from sendero.llm.toxicity import fold, score_toxicity, train
from sendero.llm.transducer import round_trip
from sendero.llm.vectors import nearest
from sendero.llm.whitening import whiten
from sendero.plans.registry import query, table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID = 2
MAX_TOKENS = 512
REJECTED = 0.7
# The conversation that the result holds besides the table's.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query()
def op1_contextual_pii(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
                        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query()
def op2_bpe_round_trip(spark, sf_dir):
    coded = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op3_rans_ids(spark, sf_dir):
    read = store_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), END_ID)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query()
def op4_phrase_automata(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_template_windows(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_one_bit_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query()
def op7_clause_grammar(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= REJECTED).cast("int").alias("predicted"))


@query()
def op8_bbit_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85)


@query()
def op9_token_counts(spark, sf_dir):
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query()
def op10_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    masked = loss_spans(format_conversations(turns.unionByName(planted)))
    read = masked.select("conv_id", "formatted", turns_in(F.col("formatted")).alias("turns"),
                         F.array_join(texts_under(F.col("formatted"), F.col("spans")), "").alias("loss"))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


@query(SECRETS)
def op11_secret_owners(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    some = lambda holds: secrets.written(F.filter("spans", holds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS)],
        F.sha2(some(lambda s: s["kind"] < secrets.FOUND), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"),
        some(lambda s: s["state"] == "live").alias("live"), some(lambda s: s["state"] == "copied").alias("copied"))


@query(MANIFEST)
def op12_bitmap_manifest(spark, sf_dir):
    altered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest(table(spark, sf_dir, "documents"), altered_keys=altered)


@query()
def op13_jacobi_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=4).drop("deviation_exact")
