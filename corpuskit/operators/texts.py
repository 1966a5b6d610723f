"""Text sources: header blocks, chapters, and the status of acquired records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import metrics
from corpuskit.functions.text import header_fields, split_chapters, strip
from corpuskit.operators.dedup import duplicate_of

#: Header keys of proposals and the fields they fill.
PROPOSAL_FIELDS = {
    "pep": "pep", "title": "title", "author": "authors", "status": "status", "type": "type", "topic": "topic",
    "requires": "requires", "replaces": "replaces", "superseded-by": "superseded_by", "created": "created",
    "python-version": "python_version", "post-history": "post_history", "resolution": "resolution",
    "discussions-to": "discussions_to", "content-type": "content_type", "bdc": "bdc", "bdde": "bdde", "sphere": "sphere",
}


def proposal_headers(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("header", header_fields(text, PROPOSAL_FIELDS))


def chapters(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, index (from 1), title, text of the chapters of LaTeX sources."""
    rows = df.select(key, F.posexplode(split_chapters(text)).alias("pos", "c"))
    return rows.select(key, (F.col("pos") + 1).cast("long").alias("index"), "c.title", "c.text")


def acquisition_status(df: DataFrame, text: str, id_col: str, hash_col: str, order: list[str], section: Column | None = None) -> DataFrame:
    """Adds duplicate_of and status: INVALID_EMPTY, INVALID_MALFORMED (a NUL), INVALID_MISSING_SECTION, DUPLICATE or ACQUIRED."""
    rows = duplicate_of(df, hash_col, id_col, order)
    t = F.col(text)
    status = F.when(t.isNull() | (strip(t) == ""), "INVALID_EMPTY").when(metrics.is_binary(t, 1 << 30), "INVALID_MALFORMED")
    if section is not None:
        status = status.when(~section, "INVALID_MISSING_SECTION")
    return rows.withColumn("status", status.when(F.col("duplicate_of").isNotNull(), "DUPLICATE").otherwise("ACQUIRED"))
