"""Quality gate with reasons, filter funnel, and the summaries over both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import metrics
from corpuskit.functions.text import exact_hash, strip
from corpuskit.operators.dedup import first_seen

#: Thresholds of the gate.
MIN_TOKENS, MAX_TOKENS, MIN_COMMENT_RATIO, MAX_STYLE = 50, 2048, 0.1, 5


def _two_places(c: Column) -> Column:
    return F.format_string("%.2f", c.cast("double"))


def quality_gate(
    df: DataFrame,
    code_col: str = "code",
    ast_valid: Column | None = None,
    style: Column | None = None,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    min_ratio: float = MIN_COMMENT_RATIO,
    max_style: int = MAX_STYLE,
) -> DataFrame:
    """Adds the measures, all reasons against a record, and its status.

    ast_valid and pep8_violations are columns of an earlier pass; without them a record counts as valid, without
    violations. A null or empty text is rejected for that alone.
    """
    code = F.col(code_col)
    empty = code.isNull() | (code == "")
    tokens, ratio = metrics.tokens_by_chars(code), metrics.comment_line_ratio(code)
    style = F.coalesce(style, F.lit(0)) if style is not None else F.lit(0)
    valid = F.coalesce(ast_valid, F.lit(False)) if ast_valid is not None else F.lit(True)
    rows = df.withColumns(
        {
            "token_count": F.when(empty, 0).otherwise(tokens).cast("long"),
            "comment_ratio": F.when(empty, 0.0).otherwise(ratio),
            "docstring_ratio": F.when(empty, 0.0).otherwise(metrics.docstring_line_ratio(code)),
            "generated_or_vendor": F.when(empty, False).otherwise(metrics.has_generated_mark(code)),
            "pep8_violations": style.cast("long"),
            "ast_valid": F.when(empty, False).otherwise(valid),
        }
    )
    n, r = F.col("token_count"), F.col("comment_ratio")
    checks = [
        (n < min_tokens, "token_min", F.format_string(f"token_count %d < MIN_TOKEN_LENGTH {min_tokens}", n)),
        (n > max_tokens, "token_max", F.format_string(f"token_count %d > MAX_TOKEN_LENGTH {max_tokens}", n)),
        (F.lit(min_ratio > 0) & (r < min_ratio), "comment_ratio", F.concat(F.lit("comment_ratio "), _two_places(r), F.lit(f" < MIN_COMMENT_RATIO {min_ratio}"))),
        (F.col("pep8_violations") > max_style, "pep8", F.format_string(f"pep8_violations %d > PEP8_MAX_VIOLATIONS {max_style}", F.col("pep8_violations"))),
        (~F.col("ast_valid"), "ast", F.lit("ast_valid=False (syntax structure issue)")),
    ]
    reasons = F.array_compact(F.array(*[F.when(c, text) for c, _, text in checks]))
    codes = F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name, _ in checks]))
    return rows.withColumns(
        {
            "rejection_reasons": F.when(empty, F.array(F.lit("empty code field"))).otherwise(reasons),
            "reason_codes": F.when(empty, F.array(F.lit("empty"))).otherwise(codes),
        }
    ).withColumn("quality_gate_status", F.when(F.size("rejection_reasons") > 0, "REJECTED").otherwise("ACCEPTED"))


def _ten_thousandths(ratio: str) -> Column:
    """The sum of ratios of four places as a whole number: exact, whatever the order in which rows are added."""
    return F.sum(F.round(F.col(ratio) * 10000).cast("long"))


def _totals() -> list[Column]:
    """Averages are not rounded; a reader can round as it likes."""
    n = F.count(F.lit(1))
    return [
        n.alias("records_examined"),
        F.count_if(F.col("quality_gate_status") == "ACCEPTED").alias("records_accepted"),
        F.count_if(F.col("quality_gate_status") != "ACCEPTED").alias("records_rejected"),
        (F.count_if(F.col("quality_gate_status") == "ACCEPTED") / n).alias("acceptance_rate"),
        F.count_if("ast_valid").alias("ast_valid_count"),
        F.count_if(~F.col("ast_valid")).alias("ast_invalid_count"),
        F.sum("pep8_violations").alias("pep8_total"),
        (_ten_thousandths("comment_ratio") / n / 10000).alias("comment_ratio_avg"),
        (_ten_thousandths("docstring_ratio") / n / 10000).alias("docstring_ratio_avg"),
        F.sum("token_count").alias("token_total"),
        (F.sum("token_count") / n).alias("token_avg"),
        F.count_if("generated_or_vendor").alias("generated_or_vendor_count"),
    ]


def summary_by(evaluated: DataFrame, source_col: str = "source") -> DataFrame:
    """One summary per source."""
    return evaluated.groupBy(F.col(source_col).alias("source")).agg(*_totals())


def summary_rollup(evaluated: DataFrame, source_col: str = "source") -> DataFrame:
    """The summaries per source and over all; is_total marks the latter, as a source may be null."""
    return evaluated.withColumn("source", F.col(source_col)).rollup("source").agg(F.grouping("source").cast("int").alias("is_total"), *_totals())


def counters(evaluated: DataFrame, key_col: str, source_col: str = "source") -> DataFrame:
    """source and a map from the values of a column to their counts (nulls are not counted)."""
    n = evaluated.filter(F.col(key_col).isNotNull()).groupBy(F.col(source_col).alias("source"), F.col(key_col).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("counts"))


def reason_histogram(evaluated: DataFrame, col: str = "reason_codes") -> DataFrame:
    return evaluated.select(F.explode(col).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


#: Fields that a record must have, and those that make its provenance complete.
REQUIRED = ["source", "source_type", "source_url", "record_id", "content_hash", "acquisition_date", "license"]
PROVENANCE = ["source", "record_id", "content_hash", "acquisition_date"]


def missing_fields(df: DataFrame, required: list[str] = REQUIRED) -> Column:
    """array of the required fields that are absent or null in a row."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) if f in df.columns else F.lit(f) for f in required]))


def validate_contract(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    return df.withColumn("missing_fields", missing_fields(df, required)).withColumn("is_complete", F.size("missing_fields") == 0)


def funnel(
    df: DataFrame,
    code_col: str,
    order: list[str],
    ast_valid: Column,
    tokens: Column,
    ratio: Column,
    style: Column,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    min_ratio: float = MIN_COMMENT_RATIO,
    max_style: int = MAX_STYLE,
) -> DataFrame:
    """Each record in the bucket of its first failed check, or 'retained'; ``order`` is the total order of arrival.

    Empty records are out before their hash is looked at; invalid ones still take their hash. Where the measures are
    costly, use ``arrivals`` first, measure the first arrivals only, and name the buckets with ``bucket``.
    """
    named = bucket(ast_valid, tokens, ratio, style, min_tokens, max_tokens, min_ratio, max_style)
    return arrivals(df, code_col, order).withColumn("bucket", named).drop("is_blank", "is_first")


def arrivals(df: DataFrame, code_col: str, order: list[str]) -> DataFrame:
    """Adds is_blank, and is_first: the record is the first of its content (blank ones are not compared)."""
    code = F.col(code_col)
    rows = df.withColumns({"is_blank": code.isNull() | (strip(code) == ""), "_hash": exact_hash(F.coalesce(code, F.lit("")))})
    full = first_seen(rows.filter("not is_blank"), ["_hash"], order, flag="is_first")
    return full.unionByName(rows.filter("is_blank").withColumn("is_first", F.lit(True))).drop("_hash")


def bucket(
    ast_valid: Column,
    tokens: Column,
    ratio: Column,
    style: Column,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    min_ratio: float = MIN_COMMENT_RATIO,
    max_style: int = MAX_STYLE,
) -> Column:
    measured = measured_bucket(ast_valid, tokens, ratio, style, min_tokens, max_tokens, min_ratio, max_style)
    return F.when(F.col("is_blank"), "syntax_invalid").when(~F.col("is_first"), "exact_duplicates").otherwise(measured)


def measured_bucket(
    ast_valid: Column,
    tokens: Column,
    ratio: Column,
    style: Column,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    min_ratio: float = MIN_COMMENT_RATIO,
    max_style: int = MAX_STYLE,
) -> Column:
    """The bucket of a first record that is not blank, by its measures."""
    return (
        F.when(~F.coalesce(ast_valid, F.lit(False)), "syntax_invalid")
        .when(tokens < min_tokens, "too_short")
        .when(tokens > max_tokens, "too_long")
        .when(ratio < min_ratio, "low_documentation")
        .when(style > max_style, "pep8_rejected")
        .otherwise("retained")
    )


def funnel_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def funnel_statistics(rows: DataFrame, code_col: str, ratio: str, style: str) -> DataFrame:
    """Averages and the exact median over the records that got past the syntax check; 0.0 without any."""
    kept = rows.filter(~F.col("bucket").isin("syntax_invalid", "exact_duplicates"))
    length = F.length(code_col)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return kept.agg(
        F.count(F.lit(1)).alias("n"), zero(F.avg(length)).alias("average_length"), zero(F.median(length)).alias("median_length"),
        zero(F.avg(ratio)).alias("average_comment_ratio"), zero(F.avg(style)).alias("average_style"),
    )


def policy_comparison(df: DataFrame, policies: dict[str, Column]) -> DataFrame:
    """Accepted and rejected records under several filter policies, in one pass."""
    wide = df.agg(*[F.count_if(c).alias(name) for name, c in policies.items()], F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(name).alias("policy"), F.col(name).alias("accepted"), (F.col("_n") - F.col(name)).alias("rejected")) for name in policies])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def source_infos(evaluated: DataFrame, source: str, status: str, license_: str, acquired: str, hash_: str, order: list[str]) -> DataFrame:
    """Per source: records, accepted, rejected, majority verdict (a tie rejects), most common license (a tie goes to
    the first seen), last acquisition, hash of the first record."""
    by = evaluated.groupBy(F.col(source).alias("source"))
    place = F.struct(*order)
    base = by.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col(status) == "ACCEPTED").alias("n_accepted"),
        F.max(acquired).alias("last_acquired"),
        F.min_by(hash_, place).alias("first_hash"),
    )
    seen = evaluated.filter(F.col(license_).isNotNull()).groupBy(F.col(source).alias("source"), F.col(license_).alias("l")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
    top = seen.groupBy("source").agg(F.max("n").alias("n")).join(seen, ["source", "n"]).groupBy("source").agg(F.min_by("l", "at").alias("license_status"))
    out = base.join(top, base["source"].eqNullSafe(top["source"]), "left").drop(top["source"])
    return out.withColumn("n_rejected", F.col("n_records") - F.col("n_accepted")).withColumn("verdict", F.when(F.col("n_accepted") > F.col("n_rejected"), "ACCEPTED").otherwise("REJECTED"))
