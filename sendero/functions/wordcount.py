"""Word counts and term search over text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sendero.functions.text import words_by_whitespace


def words(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(words_by_whitespace(text)).alias("word"))


def word_counts(df: DataFrame, text: str, *by: str) -> DataFrame:
    """``(*by, word, n)``; each task sums its own words before they move."""
    return words(df, text, *by).groupBy(*by, "word").agg(F.count("*").alias("n"))


def vocabulary_size(df: DataFrame, text: str) -> DataFrame:
    return words(df, text).agg(F.count_distinct("word").alias("n"))


def first_seen(scan: DataFrame, text: str) -> DataFrame:
    """``(word, n, file, row, place)``: each word's count and where it stands first, by file path, row of the file, place in the text.

    ``scan`` is a table as read from its files. Counts and first places are combined per word and file before they move,
    rows and places as one number, so the combining stays within a hash table.
    """
    place = F.col("row").cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("place").cast("decimal(10,0)")
    located = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
                          F.posexplode(words_by_whitespace(text)).alias("place", "word"))
    by_file = located.groupBy("word", "file").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    first = by_file.groupBy("word").agg(F.sum("n").alias("n"), F.min(F.struct("file", "at")).alias("f"))
    row = F.floor(F.col("f.at") / F.lit(2**31)).cast("bigint")
    return first.select("word", "n", "f.file", row.alias("row"),
                        (F.col("f.at") - row.cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)")).cast("int").alias("place"))


def top_words_first_seen(scan: DataFrame, text: str, k: int = 10) -> DataFrame:
    """``(rank, word, n)``: the ``k`` most frequent words; of equally frequent ones that seen first comes first."""
    top = first_seen(scan, text).orderBy(F.desc("n"), "file", "row", "place").limit(k)
    order = Window.orderBy(F.desc("n"), "file", "row", "place")  # of k rows
    return top.select(F.row_number().over(order).alias("rank"), "word", "n")


def vocabulary_sketches(df: DataFrame, text: str, *by: str, size: int = 16) -> DataFrame:
    """``(*by, sketch)``: mergeable sketches of the distinct words, of ``2 ** size`` bytes at most, each off by about ``1 / 2 ** (size / 2)``.

    Every task sketches its own words; only sketches move.
    """
    return words(df, text, *by).groupBy(*by).agg(F.hll_sketch_agg("word", F.lit(size)).alias("sketch"))


def merged_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups, without another look at the words."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def top_words(df: DataFrame, text: str, k: int = 10) -> DataFrame:
    return word_counts(df, text).orderBy(F.desc("n"), "word").limit(k)


def search_counts(lines: DataFrame, column: str, terms: dict[str, str]) -> DataFrame:
    """Number of lines containing each term, case ignored, all in one pass; ``terms`` maps output names to terms."""
    lowered = lines.select(F.lower(column).alias("_line"))
    return lowered.agg(*[F.count_if(F.contains("_line", F.lit(t.lower()))).alias(n) for n, t in terms.items()])
