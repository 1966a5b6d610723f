"""The pN_ queries and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import budget, encode, leaks, licenses, mixing, neardup, split
from corpuskit.llm.syntax import operator as syntax
from corpuskit.session import shared_path, table


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    return syntax.corpus_verdicts(table(spark, d, "python_tutorial_code"), table(spark, d, "repo_files"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _verdicts(spark, d).filter("not parses").select("item_table", "item_id")


def p1_rates(spark: SparkSession, d: str) -> DataFrame:
    return syntax.rates(_verdicts(spark, d))


def p1_against_recorded(spark: SparkSession, d: str) -> DataFrame:
    return syntax.against_recorded(_verdicts(spark, d), table(spark, d, "validation_result"))


def _near(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(table(spark, d, "python_tutorial_code"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).pairs().select(F.col("id_a").alias("record_id_a"), F.col("id_b").alias("record_id_b"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).classes().withColumnRenamed("id", "record_id")


def _licenses(spark: SparkSession, d: str) -> licenses.Licenses:
    return licenses.Licenses(table(spark, d, "repo_files"), table(spark, d, "repo_candidates"), table(spark, d, "manifest"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _licenses(spark, d).found()


def p3_files(spark: SparkSession, d: str) -> DataFrame:
    return _licenses(spark, d).files


def _items(spark: SparkSession, d: str) -> DataFrame:
    docs = budget.items(table(spark, d, "documents"), "documents", "doc_id", "text", "source", "lang", "domain", "retrieved_at")
    return docs.unionByName(budget.items(table(spark, d, "python_tutorial_code"), "python_tutorial_code", "record_id", "code", "source", time_col="retrieved_at"))


def _share_of_time(rows: DataFrame, share: float):
    """The moment at a share of the time over which rows were retrieved; null where none was."""
    ends = rows.agg(F.min("at").cast("double").alias("a"), F.max("at").cast("double").alias("b")).first()
    return F.lit(None).cast("timestamp") if ends.a is None else F.timestamp_seconds(F.lit(ends.a + share * (ends.b - ends.a)))


def p4_token_cube(spark: SparkSession, d: str) -> DataFrame:
    """The corpus as it was when nine tenths of the time had passed, brought up to date with what came since."""
    rows = _items(spark, d)
    kept = budget.TokenBudget(spark, shared_path(spark, "budget"))
    kept.update(rows.filter(F.coalesce(F.col("at") <= _share_of_time(rows, 0.9), F.lit(True))))
    return kept.update(rows)


def p4_cube_deltas(spark: SparkSession, d: str) -> DataFrame:
    """The cube after rows came, went and came again, beside the cube from scratch; ``same`` in every row."""
    rows = _items(spark, d)
    kept = budget.TokenBudget(spark, shared_path(spark, "budget"))
    late = F.coalesce(F.col("at") > _share_of_time(rows, 0.5), F.lit(False))
    kept.update(rows.filter(~late))
    kept.update(rows.filter(late))
    after = kept.update(rows)
    whole = budget.cube(budget.membership(rows), budget.count_tokens(rows)).withColumnsRenamed({"n_items": "n_items_anew", "n_tokens": "n_tokens_anew"})
    both = after.alias("a").join(whole.alias("w"), [F.col(f"a.{c}").eqNullSafe(F.col(f"w.{c}")) for c in budget.DIMENSIONS], "full_outer")
    same = F.col("n_items").eqNullSafe(F.col("n_items_anew")) & F.col("n_tokens").eqNullSafe(F.col("n_tokens_anew"))
    return both.select(*[F.coalesce(f"a.{c}", f"w.{c}").alias(c) for c in budget.DIMENSIONS], "n_items", "n_tokens", "n_items_anew", "n_tokens_anew", same.alias("same"))


def p4_item_tokens(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d)
    return budget.item_tokens(rows, budget.count_tokens(rows)).select("item_table", "item_id", "n_tokens")


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    return budget.roll_up(p4_token_cube(spark, d))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    sizes = mixing.source_sizes(table(spark, d, "python_tutorial_code"))
    return mixing.plan_mix(sizes, table(spark, d, "mix_requests"), table(spark, d, "mix_targets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The sources that water-filling clamps by their own share, and those that it has to repeat."""
    return _plan(spark, d).filter("status <> 'fits'").select("mix_id", "source", "status")


def p5_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).select("mix_id", "source", F.round("share", 9).alias("share"), "size", "status", "clamped", F.round("chars", 3).alias("chars"))


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return mixing.sample_mix(table(spark, d, "python_tutorial_code"), _plan(spark, d))


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    rows = mixing.actual_shares(mixing.sample_mix(table(spark, d, "python_tutorial_code"), plan), plan)
    return rows.withColumns({"planned_chars": F.round("planned_chars", 3)} | {c: F.round(c, 9) for c in ("target_share", "actual_share", "epochs")})


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p7_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold an item in one piece, or in pieces of five words and more that cover four fifths of it."""
    docs, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    return leaks.find_leaks(docs, items, seed_words=leaks.COVERAGE_SEED, min_coverage=leaks.MIN_COVERAGE)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return split.split_oversized(table(spark, d, "documents"), with_text=False).select("doc_id").distinct()


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_oversized(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_rates, p1_against_recorded, p2_found, p2_groups, p3_found, p3_files, p4_token_cube, p4_cube_deltas, p4_item_tokens, p4_totals, p5_found, p5_plan, p5_sample, p5_shares,
        p6_ids, p7_found, p7_coverage, p8_found, p8_pieces,
    )
}

_EDGE = r"[\t-\r\x1c-\x1f \x{85}\x{a0}]+"
_NAME = f"lower(regexp_replace(source, '^{_EDGE}|{_EDGE}$', '', 'g'))"

_SIZES = f"""
recs AS (SELECT DISTINCT record_id, {_NAME} AS source, length(code)::BIGINT AS chars
         FROM python_tutorial_code WHERE retained AND code IS NOT NULL AND length(code) > 0 AND source IS NOT NULL),
sizes AS (SELECT source, sum(chars) AS size FROM recs GROUP BY 1),
t AS (SELECT mix_id, {_NAME} AS source, sum(target_weight) AS w FROM mix_targets GROUP BY 1, 2),
n AS (SELECT t.mix_id, t.source, w / sum(w) OVER (PARTITION BY t.mix_id) * total_chars AS need, max_repeats, coalesce(size, 0) AS size
      FROM t JOIN mix_requests USING (mix_id) LEFT JOIN sizes USING (source))
"""

# The level of the water: source i is clamped if all of them, filled as far as i when it is full, hold less than the total.
_FILLED = f"""{_SIZES}, m AS (SELECT *, size * max_repeats AS cap FROM (SELECT n.*, t.w, total_chars FROM n JOIN t USING (mix_id, source) JOIN mix_requests USING (mix_id, max_repeats))),
c AS (SELECT a.mix_id, a.source, a.w > 0 AND sum(least(b.cap, CASE WHEN a.w > 0 THEN a.cap / a.w * b.w END)) < any_value(a.total_chars) AS clamped
      FROM m a JOIN m b ON a.mix_id = b.mix_id GROUP BY a.mix_id, a.source, a.w),
l AS (SELECT mix_id, any_value(total_chars) - coalesce(sum(cap) FILTER (clamped), 0) AS rest, sum(w) FILTER (NOT clamped) AS free FROM m JOIN c USING (mix_id, source) GROUP BY 1),
f AS (SELECT mix_id, source, need / total_chars AS share, size, clamped, CASE WHEN need > max_repeats * size OR size = 0 AND need > 0 THEN 'short' WHEN need > size THEN 'repeat' ELSE 'fits' END AS status,
      round(CASE WHEN clamped THEN cap WHEN free > 0 THEN least(cap, rest * w / free) ELSE 0 END, 6) AS chars FROM m JOIN c USING (mix_id, source) JOIN l USING (mix_id))"""
_DRAWN = f"""{_FILLED}, o AS (SELECT mix_id, source, chars, size, CASE WHEN size > 0 THEN floor(chars / size)::BIGINT ELSE 0 END AS whole FROM f WHERE chars > 0),
u AS (SELECT mix_id, o.source, record_id, recs.chars, whole, o.chars - whole * size AS rest, ('0x' || substr(md5('7|' || mix_id || '|' || record_id), 1, 15))::BIGINT AS u FROM o JOIN recs USING (source)),
s AS (SELECT *, whole + CASE WHEN sum(chars) OVER (PARTITION BY mix_id, source ORDER BY u % 4096, u, record_id) <= rest THEN 1 ELSE 0 END AS repeats FROM u)"""

_SIMILAR = r"""r AS (SELECT DISTINCT record_id, code, regexp_replace(lower(code), '[^\p{L}\p{N}\s]', '', 'g') AS x
           FROM python_tutorial_code WHERE length(code) >= 200),
g AS (SELECT record_id, unnest(list_distinct(list_transform(range(1, length(x) - 1), lambda k: x[k:k + 2]))) AS t FROM r WHERE length(x) > 2),
n AS (SELECT record_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.record_id AS ra, b.record_id AS rb, count(*) AS c FROM g a JOIN g b ON a.t = b.t AND a.record_id < b.record_id GROUP BY 1, 2),
q AS MATERIALIZED (SELECT ra, rb FROM p JOIN n x ON x.record_id = ra JOIN n y ON y.record_id = rb WHERE c::DOUBLE / (x.n + y.n - c) > 0.85)"""

ORACLE_SQL = {
    "p5_plan": f"WITH {_FILLED} SELECT mix_id, source, round(share, 9) AS share, size, status, clamped, round(chars, 3) AS chars FROM f",
    "p5_sample": f"WITH {_DRAWN} SELECT mix_id, source, record_id, chars, repeats::INTEGER AS repeats FROM s WHERE repeats > 0",
    "p5_shares": f"""WITH {_DRAWN}, g AS (SELECT mix_id, source, sum(chars * repeats)::BIGINT AS actual, max(repeats)::INTEGER AS most FROM s WHERE repeats > 0 GROUP BY 1, 2),
j AS (SELECT f.*, coalesce(actual, 0)::BIGINT AS actual_chars, coalesce(most, 0)::INTEGER AS most_repeats FROM f LEFT JOIN g USING (mix_id, source))
SELECT mix_id, source, status, round(share, 9) AS target_share, round(chars, 3) AS planned_chars, actual_chars,
 round(CASE WHEN sum(actual_chars) OVER w > 0 THEN actual_chars / sum(actual_chars) OVER w ELSE 0 END, 9) AS actual_share, most_repeats, round(CASE WHEN size > 0 THEN chars / size ELSE 0 END, 9) AS epochs
FROM j WINDOW w AS (PARTITION BY mix_id)""",
    "p5_found": f"""WITH {_SIZES}
SELECT mix_id, source, CASE WHEN need > max_repeats * size OR size = 0 THEN 'short' ELSE 'repeat' END AS status
FROM n WHERE need > size""",
    "p7_found": r"""WITH w AS (SELECT doc_id AS id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS l FROM documents)),
v AS (SELECT item_id AS id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS l FROM eval_items)),
a AS (SELECT DISTINCT id, g FROM (SELECT id, list(x) OVER s AS g, count(*) OVER s AS n FROM w WINDOW s AS (PARTITION BY id ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) WHERE n = 13),
b AS (SELECT DISTINCT id, g FROM (SELECT id, list(x) OVER s AS g, count(*) OVER s AS n FROM v WINDOW s AS (PARTITION BY id ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) WHERE n = 13)
SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM a JOIN b USING (g)""",
    "p2_found": f"""WITH {_SIMILAR} SELECT ra AS record_id_a, rb AS record_id_b FROM q""",
    "p2_groups": f"""WITH RECURSIVE {_SIMILAR}, l AS (SELECT ra, rb FROM q UNION ALL SELECT rb, ra FROM q),
c AS (SELECT record_id, count(*) OVER (PARTITION BY code) AS copies FROM r),
reach AS (SELECT record_id AS a, record_id AS b FROM r UNION SELECT reach.a, l.rb FROM reach JOIN l ON reach.b = l.ra)
SELECT c.record_id, (SELECT min(b) FROM reach WHERE a = c.record_id) AS class_id, copies, (SELECT count(*) FROM l WHERE ra = c.record_id) AS links FROM c""",
}
