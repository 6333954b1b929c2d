"""Word counts and line search over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.functions.text import lines_of
from sendero.functions.wordcount import (merged_sketches, search_counts, top_words as top_words_of,
                                         top_words_first_seen as top_words_by_place, vocabulary_sketches, vocabulary_size, word_counts)
from sendero.plans.registry import query, table

WORDS = r"""WITH k AS (SELECT source, w AS word FROM (
    SELECT source, unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS w FROM documents) WHERE w <> '') """
LINES = "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) "


@query(WORDS + "SELECT word, count(*) AS n FROM k GROUP BY 1")
def word_count(spark, sf_dir):
    return word_counts(table(spark, sf_dir, "documents"), "text")


@query(WORDS + "SELECT source, word, count(*) AS n FROM k GROUP BY 1, 2")
def word_count_by_source(spark, sf_dir):
    return word_counts(table(spark, sf_dir, "documents"), "text", "source")


@query(WORDS + "SELECT count(DISTINCT word) AS n FROM k")
def vocab_size(spark, sf_dir):
    return vocabulary_size(table(spark, sf_dir, "documents"), "text")


@query(WORDS + "SELECT word, count(*) AS n FROM k GROUP BY 1 ORDER BY n DESC, word LIMIT 10")
def top_words(spark, sf_dir):
    return top_words_of(table(spark, sf_dir, "documents"), "text", 10)


@query(r"""SELECT CAST(row_number() OVER (ORDER BY n DESC, spot) AS INTEGER) AS rank, word, n FROM (
          SELECT w AS word, count(*) AS n, min(r * 1000000 + i) AS spot FROM (
              SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
                  SELECT row_number() OVER () AS r, regexp_split_to_array(text, '[ \t\n\x0B\f\r]+') AS ws FROM documents))
          WHERE w <> '' GROUP BY 1) ORDER BY rank LIMIT 500""")
def top_words_first_seen(spark, sf_dir):
    return top_words_by_place(table(spark, sf_dir, "documents"), "text", 500)


@query(WORDS + """SELECT source, count(DISTINCT word) AS n, true AS near FROM k GROUP BY 1
                  UNION ALL SELECT NULL, count(DISTINCT word), true FROM k""")
def vocab_sketch(spark, sf_dir):
    """Exact vocabulary sizes of each source and of all, and whether the sketches are within two per cent of them."""
    documents = table(spark, sf_dir, "documents")
    sketches = vocabulary_sketches(documents, "text", "source")
    whole = merged_sketches(sketches).select(F.lit(None).cast("string").alias("source"), "sketch")
    exact = word_counts(documents, "text", "source")
    sizes = exact.groupBy("source").agg(F.count("*").alias("n")).unionByName(
        exact.agg(F.count_distinct("word").alias("n")).select(F.lit(None).cast("string").alias("source"), "n"))
    told = sketches.unionByName(whole).select(F.col("source").alias("s"), F.hll_sketch_estimate("sketch").alias("about"))
    return (sizes.join(told, F.col("source").eqNullSafe(F.col("s")))
            .select("source", "n", (F.abs(F.col("about") - F.col("n")) <= F.col("n") * 0.02).alias("near")))


@query(LINES + """SELECT count(*) FILTER (WHERE contains(lower(line), 'the')) AS n1,
                  count(*) FILTER (WHERE contains(lower(line), 'und')) AS n2 FROM l""")
def line_search_counts(spark, sf_dir):
    return search_counts(lines_of(table(spark, sf_dir, "documents"), "text"), "line", {"n1": "the", "n2": "und"})
