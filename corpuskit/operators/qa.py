"""Question and answer records: filters, tiers, pairing, profiles, and selection under a token budget."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import metrics
from corpuskit.functions.text import clean_tags, parse_tags, strip

#: Thresholds and tags of the Q&A sources.
MIN_SCORE, MIN_BODY = 10, 200
CORE_TAGS = ["python"]
ECOSYSTEM_TAGS = ["numpy", "pandas", "scipy", "matplotlib", "tensorflow", "pytorch", "django", "flask", "fastapi"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def long_scored_code(body: Column | str, score: Column | str) -> Column:
    """An answer worth keeping: long enough, with code, scored high enough."""
    return (F.length(_c(body)) >= MIN_BODY) & metrics.has_code(body) & (F.coalesce(_c(score), F.lit(0)) >= MIN_SCORE) & (strip(body) != "")


def tagged_python(tags: Column) -> Column:
    return F.exists(tags, lambda t: F.contains(F.lower(t), F.lit("python")))


def function_pair(code: Column | str, comment: Column | str | None = None, least: int = 20) -> Column:
    """Code (and comment) with a function and of some length."""
    out = metrics.has_function(code, comment) & (F.length(_c(code)) >= least)
    return out if comment is None else out & (F.length(_c(comment)) >= least)


def of_community(community: Column | str, url: Column | str, name: str) -> Column:
    """By the community field, or else by the URL unless that is a meta site."""
    return (_c(community) == name) | (F.contains(_c(url), F.lit(name)) & ~F.contains(_c(url), F.lit("meta.stackexchange")))


def relevant(tags: Column, core_only: bool = False) -> Column:
    wanted = CORE_TAGS if core_only else CORE_TAGS + ECOSYSTEM_TAGS
    return F.arrays_overlap(tags, F.array(*map(F.lit, wanted)))


def tier(score: Column | str, accepted: Column | str) -> Column:
    """A: accepted, 10 or more; B: not accepted, 20 or more; C: accepted, 5 or more; else null. An unknown acceptance is neither."""
    s, a = _c(score), _c(accepted)
    return F.when(s.isNull() | a.isNull(), None).when(a & (s >= 10), "A").when(~a & (s >= 20), "B").when(a & (s >= 5), "C")


def tags_of(c: str, df: DataFrame) -> Column:
    """Tags that come as a bar-separated string or as an array."""
    return clean_tags(c) if df.schema[c].dataType.typeName() == "array" else parse_tags(c)


def qa_pairs(questions: DataFrame, answers: DataFrame, first_only: bool = False) -> DataFrame:
    """Questions (question_id, ...) with their answers (parent_id, ordinal, ...); ``first_only``: the first answer of each
    question by ordinal, before any filter on its score."""
    if first_only:
        firsts = answers.groupBy("parent_id").agg(F.min("ordinal").alias("ordinal"))
        answers = answers.join(firsts, ["parent_id", "ordinal"], "left_semi")
    return questions.join(answers, questions.question_id == answers.parent_id).drop("parent_id")


def accepted_answers(questions: DataFrame, answers: DataFrame) -> DataFrame:
    return questions.join(answers, questions.accepted_answer_id == answers.answer_id)


def profile(df: DataFrame, scores: list[str], tokens: str, accepted: str) -> DataFrame:
    """One row: rows, least and greatest of the pooled scores and of the tokens, accepted and not accepted."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.least(*[F.min(s) for s in scores]).alias("min_score") if len(scores) > 1 else F.min(scores[0]).alias("min_score"),
        F.greatest(*[F.max(s) for s in scores]).alias("max_score") if len(scores) > 1 else F.max(scores[0]).alias("max_score"),
        F.min(tokens).alias("min_tokens"),
        F.max(tokens).alias("max_tokens"),
        F.count_if(accepted).alias("n_accepted"),
        F.count_if(~F.col(accepted)).alias("n_not_accepted"),
    )


def top_values(df: DataFrame, col: str | Column, k: int, name: str = "value") -> DataFrame:
    """The k most frequent values; ties by the value."""
    n = df.groupBy(_c(col).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), name).limit(k)


def top_tags(df: DataFrame, tags: Column, k: int) -> DataFrame:
    return top_values(df.select(F.explode(tags).alias("tag")), "tag", k, "tag")




def select_budget(df: DataFrame, tokens: str, order: list[tuple[str, bool]], minimum: int, tier_col: str = "tier", key: str = "id") -> DataFrame:
    """Rows in the order of tier and ``order`` (column, descending) until their tokens reach ``minimum``.

    The running total is not one window over all rows: totals per leading order value come first (few rows, as scores
    repeat), and only the group in which the budget is reached is ordered row by row.
    """
    rows = df.filter(F.col(tier_col).isNotNull())
    lead, down = order[0]
    group = [F.col(tier_col), F.col(lead)]
    totals = rows.groupBy(*group).agg(F.sum(tokens).alias("_sum"))
    by = [F.col(tier_col), F.col(lead).desc() if down else F.col(lead).asc()]
    totals = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = totals.filter(F.col("_before") < minimum)
    joined = rows.join(totals, [tier_col, lead])
    whole = joined.filter(F.col("_before") + F.col("_sum") <= minimum)
    rest = joined.filter(F.col("_before") + F.col("_sum") > minimum)
    inner = Window.partitionBy(tier_col, lead).orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order[1:]], key)
    rest = rest.withColumn("_run", F.col("_before") + F.coalesce(F.sum(tokens).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return whole.drop("_sum", "_before").unionByName(rest.filter(F.col("_run") < minimum).drop("_sum", "_before", "_run"))


def one_per(df: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """Diversity by chained selection: for each column in turn the first row of each of its values."""
    for c in columns:
        df = df.withColumn("_n", F.row_number().over(Window.partitionBy(c).orderBy(*order))).filter("_n = 1").drop("_n")
    return df


def diverse_exact(df: DataFrame, columns: list[str], order: list[str], group: str) -> DataFrame:
    """The sequential rule, group by group: a row is taken if none of its values was taken before. A group goes to one
    task (ids and keys only); use ``one_per`` for groups that may be large."""

    def pick(part: pd.DataFrame) -> pd.DataFrame:
        taken: list[set] = [set() for _ in columns]
        keep = []
        for i, r in zip(part.index, part.sort_values(order)[columns].itertuples(index=True)):
            values = r[1:]
            if not any(v in t for v, t in zip(values, taken)):
                keep.append(r[0])
                for v, t in zip(values, taken):
                    t.add(v)
        return part.loc[sorted(keep)]

    return df.groupBy(group).applyInPandas(pick, df.schema)


def chunk_numbers(df: DataFrame, order: list[str], size: int, by: list[str] | None = None) -> DataFrame:
    """Adds chunk, numbered from 0 in a total order (within ``by``). Without ``by`` the order is global, so places come from
    the counts of range partitions instead of one window over all rows."""
    if by:
        return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size))
    return with_global_place(df, order).withColumn("chunk", F.floor(F.col("place") / size)).drop("place")


def with_global_place(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """Adds the place (from 0) of each row in a total order, by range partitioning: each partition is sorted by itself and
    offset by the number of rows before it; only those few counts come together.

    The partitioned rows are checkpointed, as they are read twice and their partitioning must not change in between.
    """
    from corpuskit.session import cut_lineage

    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return ranged.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_before") + within).cast("long")).drop("_p", "_c", "_before")
