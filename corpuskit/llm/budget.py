"""Token budget per source, language and domain (problem 4).

Method: a count table keyed by content and tokenizer hash, kept in a folder (``TokenBudget``) beside the membership and the
cube of the last update. An update encodes only contents that the table lacks (each at most once in a partition of the
input, however often it repeats), and brings the cube up to date through signed deltas: rows that came add, rows that went
or changed subtract, so removed documents leave no trace. Texts travel only where unseen contents are too many to
broadcast their hashes.

Names are counted as one without case and outer white space; a language loses its region suffix. Defined results:
null and empty texts have 0 tokens; null names form a group of their own; of the rows of one item the one retrieved last
counts (ties by content hash and names), and rows without an item id count once for each content; empty tables give empty
cubes; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.arrow import small_batches
from corpuskit.llm.bpe import BYTE_BPE_50K, TOKENIZER_DIR, load_bpe, tokenizer_hash
from corpuskit.llm.mixing import source_name
from corpuskit.operators.joins import anti_join, semi_join
from corpuskit.session import cut_lineage, spread

DIMENSIONS = ["item_table", "source", "lang", "domain"]
_KEY = ["item_table", "item_id", "content_hash"]
_NAMES = ["source", "lang", "domain"]


def language_name(c: Column | str) -> Column:
    """A language in lower case, without outer white space and region suffix."""
    return F.regexp_replace(source_name(c), "[-_].*$", "")


def items(df: DataFrame, item_table: str, id_col: str, text_col: str, source_col: str | None = None, lang_col: str | None = None, domain_col: str | None = None, time_col: str | None = None) -> DataFrame:
    """item_table, item_id, content_hash, source, lang, domain, at, text; a null text counts as an empty one."""
    none = F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.lit(item_table).alias("item_table"),
        F.col(id_col).cast("long").alias("item_id"),
        F.unhex(F.sha2(text, 256)).alias("content_hash"),
        (source_name(source_col) if source_col else none).alias("source"),
        (language_name(lang_col) if lang_col else none).alias("lang"),
        (source_name(domain_col) if domain_col else none).alias("domain"),
        (F.col(time_col) if time_col else none).cast("timestamp").alias("at"),
        text.alias("text"),
    )


def membership(rows: DataFrame) -> DataFrame:
    """The items without their texts, each once, as they were retrieved last. Combined before the shuffle."""
    last = F.max(F.struct("at", "content_hash", *_NAMES)).alias("r")
    unnamed = F.when(F.col("item_id").isNull(), F.col("content_hash")).alias("k")
    return rows.groupBy("item_table", "item_id", unnamed).agg(last).select("item_table", "item_id", "r.content_hash", *[f"r.{n}" for n in _NAMES])


def count_tokens(rows: DataFrame, known: DataFrame | None = None, directory: str = TOKENIZER_DIR, name: str = BYTE_BPE_50K) -> DataFrame:
    """content_hash, tokenizer_hash, n_tokens of all contents of ``rows`` that ``known`` (such a table) lacks."""
    of = tokenizer_hash(directory, name)
    todo = rows.select("content_hash", "text")
    if known is not None:
        have = known.filter(F.col("tokenizer_hash") == of)
        fresh = cut_lineage(anti_join(todo.select("content_hash").distinct(), have, ["content_hash"]))
        todo = semi_join(todo, fresh, ["content_hash"])

    def run(batches):
        bpe = load_bpe(directory, name)
        seen: set[bytes] = set()
        for batch in small_batches(batches, "text"):
            hashes, fresh = batch.column("content_hash").to_pylist(), []
            for i, h in enumerate(hashes):
                if h not in seen:
                    seen.add(h)
                    fresh.append(i)
            take = pa.array(fresh, pa.int64())
            n = [bpe.count(t) for t in batch.column("text").take(take).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("content_hash").take(take), pa.array(n, pa.int64())], ["content_hash", "n_tokens"])

    counted = spread(todo).mapInArrow(run, "content_hash binary, n_tokens long").groupBy("content_hash").agg(F.max("n_tokens").alias("n_tokens"))
    return counted.select("content_hash", F.lit(of).alias("tokenizer_hash"), "n_tokens")


def item_tokens(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Every item with its number of tokens."""
    return membership(rows).join(counts.select("content_hash", "n_tokens"), "content_hash")


def cube(members: DataFrame, counts: DataFrame) -> DataFrame:
    """n_items and n_tokens by DIMENSIONS of a membership table."""
    signed = members.withColumn("sign", F.lit(1))
    return _totals(signed.join(counts.select("content_hash", "n_tokens"), "content_hash"))


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("sign").alias("n_items"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))


def cube_delta(old: DataFrame, new: DataFrame, counts: DataFrame) -> DataFrame:
    """Signed changes of the cube between two membership tables; rows in both cancel and are not joined at all."""
    cols = [*_KEY, *_NAMES]
    both = old.select(*cols, F.lit(-1).alias("sign")).unionByName(new.select(*cols, F.lit(1).alias("sign")))
    changed = both.groupBy(*cols).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    return _totals(changed.join(counts.select("content_hash", "n_tokens"), "content_hash"))


def apply_delta(totals: DataFrame, delta: DataFrame) -> DataFrame:
    """The cube after a delta; groups without items vanish."""
    both = totals.unionByName(delta).groupBy(*DIMENSIONS).agg(F.sum("n_items").alias("n_items"), F.sum("n_tokens").alias("n_tokens"))
    return both.filter("n_items <> 0")


class TokenBudget:
    """The count table, the membership and the cube of a corpus in a folder, brought up to date by each ``update``.

    A version of membership and cube is one folder; it counts once both are written. An update that is done again, after
    a failure, writes the same version again; what it had counted before stays counted.
    """

    def __init__(self, spark: SparkSession, path: str, directory: str = TOKENIZER_DIR, name: str = BYTE_BPE_50K):
        self.spark, self.path, self.directory, self.name, self.version = spark, path.rstrip("/"), directory, name, 0

    @property
    def counts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/counts")

    @property
    def cube(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cube/{self.version}")

    def update(self, rows: DataFrame) -> DataFrame:
        """Make ``rows`` (of ``items``) the corpus; returns its cube."""
        known = self.counts if self.version else None
        count_tokens(rows, known, self.directory, self.name).write.mode("append" if self.version else "overwrite").parquet(f"{self.path}/counts")
        membership(rows).write.mode("overwrite").parquet(f"{self.path}/members/{self.version + 1}")
        new = self.spark.read.parquet(f"{self.path}/members/{self.version + 1}")
        of = tokenizer_hash(self.directory, self.name)
        # A content counted twice, by an update done again, has one count.
        counts = self.counts.filter(F.col("tokenizer_hash") == of).groupBy("content_hash").agg(F.max("n_tokens").alias("n_tokens"))
        if self.version:
            totals = apply_delta(self.cube, cube_delta(self.spark.read.parquet(f"{self.path}/members/{self.version}"), new, counts))
        else:
            totals = cube(new, counts)
        totals.write.mode("overwrite").parquet(f"{self.path}/cube/{self.version + 1}")
        self.version += 1
        return self.cube


def roll_up(totals: DataFrame) -> DataFrame:
    """Totals by each of source, language and domain, from the (small) cube: dimension, name, n_items, n_tokens."""
    parts = [
        totals.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("name")).agg(F.sum("n_items").alias("n_items"), F.sum("n_tokens").alias("n_tokens"))
        for d in ("source", "lang", "domain")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
