"""Trigram sets, their Jaccard similarity, and 64-bit SimHash, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.text import unify_newlines
from corpuskit.session import spread


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trigram_text(c: Column | str) -> Column:
    """Lower case; letters, digits and white space only."""
    return F.regexp_replace(F.lower(_c(c)), r"[^\p{L}\p{N}\s]", "")


def with_trigrams(df: DataFrame, text_col: str, out: str = "trigrams") -> DataFrame:
    """Adds the set of substrings of three characters; empty for shorter texts, null for null.

    The text is normalised in a projection of its own: inside the function over the places it would be done anew for
    every place.
    """
    t = F.col("_normal")
    some = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substring(t, i, F.lit(3))))
    empty = F.array().cast("array<string>")
    return df.withColumn("_normal", trigram_text(text_col)).withColumn(out, F.when(F.length(t) >= 3, some).when(t.isNotNull(), empty)).drop("_normal")


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two sets; 0 if either is empty."""
    a, b = _c(a), _c(b)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def simhash_words(c: Column | str) -> Column:
    """Words of code for SimHash: comment lines, comment marks and docstrings dropped, lower case."""
    x = F.regexp_replace(unify_newlines(c), r'"""(?s:.*?)"""', "")
    x = F.regexp_replace(x, r"(?m)^[ \t]*#.*$", "")
    return F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def word_hash(w: Column) -> Column:
    """64 bits of a word, from the head of its MD5."""
    return F.conv(F.substring(F.md5(w), 1, 16), 16, -10).cast("long")


def simhash(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and simhash: for each bit the majority of the words' hashes (a tie gives 0). Texts without words have no row.

    Words are exploded and the 64 bit counts summed within a task, so one row of counts a text is shuffled, no words.
    """
    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))).select("id", F.explode(simhash_words("t")).alias("w"))
    hashed = rows.select("id", word_hash(F.col("w")).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    counted = hashed.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *sums)
    out = F.lit(0).cast("long")
    for b in range(64):
        value = (1 << b) if b < 63 else -(1 << 63)
        out = out.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("n"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return counted.select(F.col("id").alias(id_col), out.alias("simhash"))


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(_c(a).bitwiseXOR(_c(b)))


def simhash_similarity(a: Column | str, b: Column | str) -> Column:
    return F.lit(1.0) - hamming(a, b) / 64
