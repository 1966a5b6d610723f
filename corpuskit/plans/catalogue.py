"""The registered queries of the core, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import metrics, python_source, similarity, text
from corpuskit.operators import dedup, governance, packages, qa, quality, repos, texts
from corpuskit.sources import readers
from corpuskit.streaming import jobs
from corpuskit.session import cut_lineage, shared_path, spread, table

QUERIES: dict = {}
ORACLE_SQL: dict = {}

# White space of Python's strip() as a character class of DuckDB's expressions.
_W = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WL = r"[\t\x0b-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{_W}+|{_W}+\z', '', 'g')"


def _sql_source_name() -> str:
    return f"lower({_strip('source')})"


# ---- quality ----

_GATE = rf"""g0 AS (SELECT *, text IS NULL OR text = '' AS empty, string_split(text, chr(10)) AS ls FROM documents),
g AS (SELECT * EXCLUDE (ls, empty), empty,
  CASE WHEN empty THEN 0 ELSE greatest(1, length(text) // 4) END::BIGINT AS token_count,
  CASE WHEN empty THEN 0.0 ELSE round(len(list_filter(ls, lambda s: regexp_matches(s, '\A{_W}*#')))::DOUBLE / len(ls), 4) END::DOUBLE AS comment_ratio,
  CASE WHEN empty THEN 0.0 ELSE round(len(list_filter(ls, lambda s: contains(s, repeat(chr(34), 3))))::DOUBLE / len(ls), 4) END::DOUBLE AS docstring_ratio,
  CASE WHEN empty THEN false ELSE contains(lower(text), 'do not edit') OR contains(lower(text), 'generated') OR contains(lower(text), 'third_party') END AS generated_or_vendor,
  0::BIGINT AS pep8_violations, NOT empty AS ast_valid FROM g0),
e AS (SELECT *, CASE WHEN empty THEN ['empty'] ELSE list_filter([CASE WHEN token_count < 50 THEN 'token_min' END, CASE WHEN token_count > 2048 THEN 'token_max' END,
  CASE WHEN comment_ratio < 0.1 THEN 'comment_ratio' END], lambda r: r IS NOT NULL) END AS reason_codes FROM g),
q AS (SELECT *, CASE WHEN len(reason_codes) > 0 THEN 'REJECTED' ELSE 'ACCEPTED' END AS quality_gate_status FROM e)"""
_SUMS = """count(*) AS records_examined, count(*) FILTER (quality_gate_status = 'ACCEPTED') AS records_accepted,
  count(*) FILTER (quality_gate_status <> 'ACCEPTED') AS records_rejected, count(*) FILTER (quality_gate_status = 'ACCEPTED')::DOUBLE / count(*) AS acceptance_rate,
  count(*) FILTER (ast_valid) AS ast_valid_count, count(*) FILTER (NOT ast_valid) AS ast_invalid_count, sum(pep8_violations)::BIGINT AS pep8_total,
  sum(round(comment_ratio * 10000)::BIGINT)::DOUBLE / count(*) / 10000 AS comment_ratio_avg, sum(round(docstring_ratio * 10000)::BIGINT)::DOUBLE / count(*) / 10000 AS docstring_ratio_avg, sum(token_count)::BIGINT AS token_total,
  sum(token_count)::DOUBLE / count(*) AS token_avg, count(*) FILTER (generated_or_vendor) AS generated_or_vendor_count"""


def _gated(spark, d):
    return quality.quality_gate(table(spark, d, "documents"), "text")


@query(f"WITH {_GATE} SELECT source, {_SUMS} FROM q GROUP BY source")
def q_quality_summary_by_source(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary_by(_gated(spark, d))


@query(f"WITH {_GATE} SELECT source, grouping(source)::INT AS is_total, {_SUMS} FROM q GROUP BY ROLLUP (source)")
def q_quality_rollup(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary_rollup(_gated(spark, d))


@query(f"WITH {_GATE} SELECT doc_id, token_count, comment_ratio, docstring_ratio, generated_or_vendor, quality_gate_status, array_to_string(reason_codes, ',') AS reasons FROM q")
def q_quality_eval(spark: SparkSession, d: str) -> DataFrame:
    cols = ["doc_id", "token_count", "comment_ratio", "docstring_ratio", "generated_or_vendor", "quality_gate_status"]
    return _gated(spark, d).select(*cols, F.array_join("reason_codes", ",").alias("reasons"))


@query(f"WITH {_GATE} SELECT reason, count(*) AS n FROM (SELECT unnest(reason_codes) AS reason FROM q) GROUP BY reason")
def q_rejection_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_histogram(_gated(spark, d))


@query(f"""WITH {_GATE} SELECT 'strict' AS policy, count(*) FILTER (token_count BETWEEN 50 AND 2048 AND comment_ratio >= 0.1) AS accepted, count(*) - count(*) FILTER (token_count BETWEEN 50 AND 2048 AND comment_ratio >= 0.1) AS rejected FROM q
UNION ALL SELECT 'length', count(*) FILTER (token_count BETWEEN 50 AND 2048), count(*) - count(*) FILTER (token_count BETWEEN 50 AND 2048) FROM q
UNION ALL SELECT 'context', count(*) FILTER (token_count >= 50 OR domain IS NOT NULL), count(*) - count(*) FILTER (token_count >= 50 OR domain IS NOT NULL) FROM q""")
def q_policy_comparison(spark: SparkSession, d: str) -> DataFrame:
    n, r = F.col("token_count"), F.col("comment_ratio")
    return quality.policy_comparison(_gated(spark, d), {"strict": n.between(50, 2048) & (r >= 0.1), "length": n.between(50, 2048), "context": (n >= 50) | F.col("domain").isNotNull()})


@query("SELECT (source IS NULL)::INT + (url IS NULL)::INT + (license IS NULL)::INT + (retrieved_at IS NULL)::INT + (text IS NULL)::INT AS n_missing, count(*) AS n FROM documents GROUP BY 1")
def q_contract(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.validate_contract(table(spark, d, "documents"), ["doc_id", "source", "url", "license", "retrieved_at", "text"])
    return rows.groupBy(F.size("missing_fields").alias("n_missing")).agg(F.count(F.lit(1)).alias("n"))


_FUNNEL = rf"""r AS (SELECT doc_id, text, text IS NULL OR {_strip('text')} = '' AS blank, sha256({_strip("regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g')")}) AS h,
  len(list_filter(regexp_split_to_array(text, '{_W}+'), lambda x: x <> '')) AS n, string_split(text, chr(10)) AS ls FROM documents),
f AS (SELECT *, NOT blank AND doc_id = min(doc_id) OVER (PARTITION BY blank, h) AS first,
  round(len(list_filter(ls, lambda s: regexp_matches(s, '\A{_W}*#')))::DOUBLE / len(ls), 4) AS ratio FROM r),
b AS (SELECT *, CASE WHEN blank THEN 'syntax_invalid' WHEN NOT first THEN 'exact_duplicates' WHEN n < 50 THEN 'too_short' WHEN n > 2048 THEN 'too_long'
  WHEN ratio < 0.1 THEN 'low_documentation' ELSE 'retained' END AS bucket FROM f)"""


def _funnel(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).withColumn("ratio", metrics.comment_line_ratio("text"))
    return quality.funnel(docs, "text", ["doc_id"], F.lit(True), metrics.words("text"), F.col("ratio"), F.lit(0))


@query(f"WITH {_FUNNEL} SELECT bucket, count(*) AS n FROM b GROUP BY bucket")
def q_funnel_buckets(spark: SparkSession, d: str) -> DataFrame:
    return quality.funnel_counts(_funnel(spark, d))


@query(f"""WITH {_FUNNEL} SELECT count(*) AS n, round(avg(length(text)), 6) AS average_length, median(length(text))::DOUBLE AS median_length,
 round(avg(ratio), 9) AS average_comment_ratio FROM b WHERE bucket NOT IN ('syntax_invalid', 'exact_duplicates')""")
def q_funnel_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.funnel_statistics(_funnel(spark, d).withColumn("style", F.lit(0)), "text", "ratio", "style")
    return rows.select("n", F.round("average_length", 6).alias("average_length"), "median_length", F.round("average_comment_ratio", 9).alias("average_comment_ratio"))


def _code(spark, d):
    """Code records, each once (a record delivered twice has one content)."""
    return table(spark, d, "python_tutorial_code").groupBy("record_id").agg(F.max_by(F.struct("code", "source", "section", "url", "retained", "retrieved_at"), "retrieved_at").alias("r")).select("record_id", "r.*")


@query()
def q_code_validation(spark: SparkSession, d: str) -> DataFrame:
    """Every code record with its validation record and measures."""
    rows = table(spark, d, "python_tutorial_code").select("record_id", "code")
    return python_source.with_validation(rows, "code").select("record_id", "validation.*", "token_count", "pep8_violations").distinct()


@query()
def q_code_funnel(spark: SparkSession, d: str) -> DataFrame:
    """The funnel over code records, with real syntax checks and measures.

    A code is measured once in a task; only its hashes, the record and its bucket are shuffled. The first record of a
    content has the bucket of its own code, the others are duplicates.
    """
    code = F.col("code")
    rows = spread(table(spark, d, "python_tutorial_code").select("record_id", "code")).select("record_id", (code.isNull() | (text.strip(code) == "")).alias("is_blank"), text.exact_hash("code").alias("h"), F.unhex(F.md5("code")).alias("k"), "code")
    v = F.col("validation")
    measured = python_source.with_validation(rows, "code", once_by="k", keep_code=False, is_spread=True)
    named = quality.measured_bucket(v["is_valid"], F.col("token_count"), v["comment_ratio"], F.col("pep8_violations"))
    every = cut_lineage(measured.select("record_id", "is_blank", "h", "k", F.when(v.isNotNull(), named).alias("bucket")))
    blank, seen = every.filter("is_blank").agg(F.countDistinct("record_id").alias("n")).select(F.lit("syntax_invalid").alias("bucket"), "n"), every.filter("not is_blank")
    firsts = seen.groupBy("h", "record_id").agg(F.min("k").alias("k")).groupBy("h").agg(F.min_by("k", "record_id").alias("k"), F.count(F.lit(1)).alias("n"))
    buckets = seen.filter("bucket is not null").groupBy("k").agg(F.max("bucket").alias("bucket"))
    one = firsts.join(buckets, "k").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    more = firsts.agg(F.sum(F.col("n") - 1).alias("n")).select(F.lit("exact_duplicates").alias("bucket"), "n")
    both = one.unionByName(more).unionByName(blank).filter("n > 0")
    return both.groupBy("bucket").agg(F.sum("n").alias("n"))


@query()
def q_code_gate(spark: SparkSession, d: str) -> DataFrame:
    """Quality summary of the code records by source, with real syntax checks."""
    rows = python_source.with_validation(_code(spark, d).select("record_id", "source", "code"), "code").withColumnRenamed("pep8_violations", "style").drop("token_count")
    return quality.summary_by(quality.quality_gate(rows, "code", F.col("validation.is_valid"), F.col("style")))


@query(f"""WITH {_GATE}, s AS (SELECT source, quality_gate_status AS st, license, doc_id, retrieved_at FROM q),
m AS (SELECT source, license, count(*) AS n, min(doc_id) AS place FROM s WHERE license IS NOT NULL GROUP BY 1, 2),
t AS (SELECT source, license AS license_status FROM m QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, place) = 1),
b AS (SELECT source, count(*) AS n_records, count(*) FILTER (st = 'ACCEPTED') AS n_accepted, max(retrieved_at) AS last_acquired, min(doc_id) AS first_hash FROM s GROUP BY 1)
SELECT b.source, n_records, n_accepted, n_records - n_accepted AS n_rejected, last_acquired, first_hash, license_status,
 CASE WHEN n_accepted > n_records - n_accepted THEN 'ACCEPTED' ELSE 'REJECTED' END AS verdict FROM b LEFT JOIN t ON b.source IS NOT DISTINCT FROM t.source""")
def q_source_infos(spark: SparkSession, d: str) -> DataFrame:
    return quality.source_infos(_gated(spark, d), "source", "quality_gate_status", "license", "retrieved_at", "doc_id", ["doc_id"])


# ---- hashes and duplicates ----



def _lf(x: str) -> str:
    return f"regexp_replace({x}, chr(13) || chr(10) || '?', chr(10), 'g')"


def _no_tails(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '{_WL}+\n', chr(10), 'g'), '{_WL}+\z', '', 'g')"


@query(rf"""WITH c AS (SELECT DISTINCT record_id, code, regexp_replace({_no_tails(_lf('code'))}, '\n{{3,}}', chr(10) || chr(10), 'g') AS n0, {_no_tails("regexp_replace(code, chr(13) || chr(10), chr(10), 'g')")} AS l FROM python_tutorial_code WHERE code IS NOT NULL)
SELECT record_id, sha256({_strip(_lf('code'))}) AS exact_hash,
 sha256(regexp_replace(regexp_replace(CASE WHEN regexp_full_match(n0, '\n+') THEN '' ELSE n0 END, '\A\n{{2,}}', chr(10)), '\n{{2,}}\z', chr(10))) AS normalized_hash,
 sha256(l) AS line_hash, sha256(array_to_string(list_filter(string_split(l, repeat(chr(34), 3)), lambda v, i: i % 2 = 1), '')) AS content_hash, sha256(lower({_strip('code')})) AS answer_hash FROM c""")
def q_hash_variants(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(table(spark, d, "python_tutorial_code").select("record_id", "code").filter("code is not null"))
    hashes = {"exact_hash": text.exact_hash, "normalized_hash": text.normalized_hash, "line_hash": text.line_hash, "content_hash": text.content_hash, "answer_hash": text.answer_hash}
    return rows.select("record_id", *[f("code").alias(n) for n, f in hashes.items()]).distinct()


_HASHED = f"d AS (SELECT *, sha256(lower({_strip('text')})) AS h FROM documents WHERE text IS NOT NULL)"


def _hashed(spark, d):
    return table(spark, d, "documents").filter("text is not null").withColumn("h", text.answer_hash("text"))


@query(f"WITH {_HASHED} SELECT min(doc_id) AS doc_id, h FROM d GROUP BY h")
def q_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_seen(_hashed(spark, d).select("doc_id", "h"), ["h"], ["doc_id"])


@query(f"WITH {_HASHED} SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS first_id, min(doc_id) OVER (PARTITION BY h) <> doc_id AS is_duplicate FROM d")
def q_duplicate_of(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_of(_hashed(spark, d).select("doc_id", "h"), "h", "doc_id", ["doc_id"]).select("doc_id", F.coalesce("duplicate_of", "doc_id").alias("first_id"), F.col("duplicate_of").isNotNull().alias("is_duplicate"))


@query(f"""WITH {_HASHED}, p AS (SELECT h, source, min(retrieved_at) AS a, count(*) AS n, min(doc_id) AS place FROM d GROUP BY 1, 2)
SELECT h AS content_hash, arg_min_null(source, place) AS kept_source, sum(n)::BIGINT AS n_records, min(a) AS first_acquired FROM p GROUP BY h""")
def q_provenance(spark: SparkSession, d: str) -> DataFrame:
    out = dedup.provenance(_hashed(spark, d).withColumn("source", F.coalesce("source", F.lit("none"))), "h", "source", "retrieved_at", ["doc_id"])
    return out.select("content_hash", F.nullif("kept_source", F.lit("none")).alias("kept_source"), "n_records", F.array_min(F.map_values("acquisition_timestamps")).alias("first_acquired"))


_SIM = r"""w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'),
 '(?s)"{3}.*?"{3}', '', 'g'), '(?m)^[ \t]*#.*$', '', 'g')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS w FROM documents),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM w),
b AS (SELECT doc_id, b, sum((h >> b) & 1)::BIGINT * 2 > count(*) AS one FROM h, range(64) t(b) GROUP BY 1, 2),
s AS (SELECT doc_id, bit_or(CASE WHEN one THEN 1::UBIGINT << b::UBIGINT ELSE 0::UBIGINT END) AS u FROM b GROUP BY 1)"""


@query(f"WITH {_SIM} SELECT doc_id, CASE WHEN u > 9223372036854775807 THEN (u::HUGEINT - 18446744073709551616)::BIGINT ELSE u::BIGINT END AS simhash FROM s")
def q_simhash(spark: SparkSession, d: str) -> DataFrame:
    return similarity.simhash(table(spark, d, "documents"), "doc_id", "text")


@query(f"""WITH {_SIM}, l AS (SELECT x.doc_id, count(*) AS n FROM s x JOIN s y ON x.doc_id <> y.doc_id AND bit_count(xor(x.u, y.u)) <= 9 GROUP BY 1)
SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY u) AS class_id, coalesce(n, 0) AS n_links FROM s LEFT JOIN l USING (doc_id)""")
def q_simhash_links(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the number of those of a similarity of 0.85 or more (9 differing bits)."""
    prints = cut_lineage(similarity.simhash(table(spark, d, "documents"), "doc_id", "text"))
    return dedup.simhash_links(prints, "doc_id", "simhash")


_TRI = r"""t AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, length(x) - 1), lambda k: x[k:k + 2]))) AS g
 FROM (SELECT doc_id, regexp_replace(lower(url), '[^\p{L}\p{N}\s]', '', 'g') AS x FROM documents WHERE url IS NOT NULL) WHERE length(x) > 2),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
p AS (SELECT a.doc_id AS id_a, b.doc_id AS id_b, count(*) AS c FROM t a JOIN t b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
j AS (SELECT id_a, id_b, c::DOUBLE / (x.n + y.n - c) AS similarity FROM p JOIN n x ON x.doc_id = id_a JOIN n y ON y.doc_id = id_b)"""


@query(f"WITH {_TRI} SELECT * FROM j WHERE similarity > 0.85")
def q_trigram_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.trigram_pairs(table(spark, d, "documents"), "doc_id", "url", 0.85)


def _text_pairs(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes of whole texts, and the classes."""
    classes = dedup.text_classes(items, "doc_id", "text")
    return dedup.class_pairs(items, classes, "doc_id", "text"), classes


@query()
def q_text_trigram_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of the near-duplicate operator over whole texts (q_trigram_pairs is over the short column url)."""
    pairs, classes = _text_pairs(table(spark, d, "documents"))
    return dedup.with_copies(pairs, classes)


@query()
def q_near_clusters(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents")
    pairs, classes = _text_pairs(items)
    clusters = dedup.near_clusters(items, dedup.class_edges(cut_lineage(pairs), classes), "doc_id")
    return dedup.near_duplicate_status(clusters, items, "doc_id", "source")


@query()
def q_greedy_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").withColumn("score", F.col("n_chars"))
    pairs, classes = _text_pairs(items)
    return dedup.greedy_survivors(items, cut_lineage(pairs), "doc_id", "score", "doc_id", classes)


@query(r"""WITH w AS (SELECT doc_id AS id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS l FROM documents)),
v AS (SELECT item_id AS id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS l FROM eval_items)),
a AS (SELECT DISTINCT id, g FROM (SELECT id, list(x) OVER s AS g, count(*) OVER s AS n FROM w WINDOW s AS (PARTITION BY id ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) WHERE n = 13),
b AS (SELECT DISTINCT id, g FROM (SELECT id, list(x) OVER s AS g, count(*) OVER s AS n FROM v WINDOW s AS (PARTITION BY id ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) WHERE n = 13)
SELECT a.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM a JOIN b USING (g) GROUP BY 1, 2""")
def q_contamination(spark: SparkSession, d: str) -> DataFrame:
    return governance.ngram_overlap(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "item_id", "text")


@query("""WITH h AS (SELECT DISTINCT record_id, sha256(code) AS h FROM python_tutorial_code WHERE code IS NOT NULL)
SELECT match, count(*) AS n FROM (SELECT record_id, CASE WHEN count(*) OVER (PARTITION BY h) = 1 THEN 'one' ELSE 'many' END AS match FROM h) GROUP BY 1""")
def q_hash_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "python_tutorial_code").filter("code is not null").select("record_id", text.raw_hash("code").alias("sha256")).distinct()
    files = rows.withColumn("path", F.col("record_id").cast("string"))
    return packages.hash_lookup(rows, files).groupBy("match").agg(F.count(F.lit(1)).alias("n"))


# ---- text measures ----


@query(rf"""SELECT source, sum(greatest(1, length(text) // 4))::BIGINT AS by_chars, sum(len(list_filter(regexp_split_to_array(text, '{_W}+'), lambda x: x <> '')))::BIGINT AS by_words,
 floor(sum(length(text)) / 4.5::DOUBLE)::BIGINT AS by_total, floor(sum(strlen(text)) / 1.8::DOUBLE)::BIGINT AS by_bytes FROM documents WHERE text IS NOT NULL GROUP BY source""")
def q_token_estimates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").groupBy("source").agg(
        F.sum(metrics.tokens_by_chars("text")).alias("by_chars"),
        F.sum(metrics.words("text")).alias("by_words"),
        metrics.tokens_of_chars(F.sum(F.length("text"))).alias("by_total"),
        metrics.tokens_of_bytes(F.sum(F.octet_length("text"))).alias("by_bytes"),
    )


@query(r"""SELECT domain, count(*) FILTER (contains(lower(text), 'def ') OR contains(lower(text), 'import ') OR contains(lower(text), 'class ') OR contains(lower(text), 'print(')
  OR contains(lower(text), 'range(') OR contains(lower(text), 'if ') OR contains(lower(text), 'for ') OR contains(lower(text), 'while ') OR contains(lower(text), 'return ')) AS like_python,
 count(*) FILTER (contains(text, '```') OR contains(lower(text), '<code>')) AS with_code, count(*) FILTER (contains(lower(text), 'def ')) AS with_function, count(*) AS n FROM documents GROUP BY domain""")
def q_code_signs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("domain").agg(
        F.count_if(metrics.looks_like_python("text")).alias("like_python"), F.count_if(metrics.has_code("text")).alias("with_code"),
        F.count_if(metrics.has_function("text")).alias("with_function"), F.count(F.lit(1)).alias("n"),
    )


@query(r"SELECT doc_id, sha256(regexp_replace(text, '<[^>]+>', chr(10), 'g')) AS stripped FROM documents WHERE text IS NOT NULL")
def q_html_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.sha2(text.strip_html_tags("text"), 256).alias("stripped"))


@query(rf"""SELECT DISTINCT record_id, sha256(array_to_string(list_transform(list_filter(list_transform(string_split({_lf('code')}, chr(10)), lambda s: regexp_replace(s, '\A{_W}+', '')),
 lambda s: starts_with(s, '>>> ') OR starts_with(s, '... ') OR s IN ('>>>', '...')), lambda s: CASE WHEN s IN ('>>>', '...') THEN '' ELSE substr(s, 5) END), chr(10))) AS code FROM python_tutorial_code WHERE code IS NOT NULL""")
def q_doctest_strip(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "python_tutorial_code").filter("code is not null")
    return rows.select("record_id", F.sha2(text.strip_doctest_prompts("code"), 256).alias("code")).distinct()


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '\\chapter\{')) AS n_chapters FROM documents WHERE contains(text, '\chapter{')""")
def q_chapters(spark: SparkSession, d: str) -> DataFrame:
    return texts.chapters(table(spark, d, "documents"), "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chapters"))


@query(rf"""WITH {_HASHED.replace('WHERE text IS NOT NULL', '')}, x AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS one FROM d)
SELECT CASE WHEN text IS NULL OR {_strip('text')} = '' THEN 'INVALID_EMPTY' WHEN contains(text, chr(0)) THEN 'INVALID_MALFORMED' WHEN h IS NOT NULL AND one <> doc_id THEN 'DUPLICATE' ELSE 'ACQUIRED' END AS status, count(*) AS n FROM x GROUP BY 1""")
def q_acquisition_status(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("h", text.answer_hash("text"))
    return texts.acquisition_status(rows, "text", "doc_id", "h", ["doc_id"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT (('0x' || substr(sha256(text), 1, 8))::BIGINT % 100) AS b FROM documents WHERE text IS NOT NULL)
SELECT CASE WHEN b < 90 THEN 'train' WHEN b < 94 THEN 'validation' WHEN b < 97 THEN 'holdout' ELSE 'test' END AS split, count(*) AS n FROM s GROUP BY 1""")
def q_dataset_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text is not null")
    return rows.groupBy(governance.split_of(F.sha2("text", 256)).alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH h AS (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h, length(text) AS n FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, text, n, least(h % (n + 1), (h >> 20) % (n + 1)) AS lo, greatest(h % (n + 1), (h >> 20) % (n + 1)) AS hi FROM h WHERE (h >> 40) % 1000 < 500)
SELECT doc_id, sha256(substr(text, 1, lo::BIGINT)) AS prefix, sha256(substr(text, lo::BIGINT + 1, (hi - lo)::BIGINT)) AS middle, sha256(substr(text, hi::BIGINT + 1, (n - hi)::BIGINT)) AS suffix FROM c""")
def q_middle_out(spark: SparkSession, d: str) -> DataFrame:
    rows = governance.middle_out(table(spark, d, "documents"), "text", F.col("doc_id")).filter("fim is not null")
    return rows.select("doc_id", *[F.sha2(f"fim.{c}", 256).alias(c) for c in ("prefix", "middle", "suffix")])


@query("""SELECT source_type, record_id, content_hash, license FROM (
 SELECT 'document' AS source_type, doc_id::VARCHAR AS record_id, sha256(text) AS content_hash, license FROM documents
 UNION ALL SELECT DISTINCT 'code', record_id::VARCHAR, sha256(code), NULL FROM python_tutorial_code)""")
def q_canonical_union(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source", "license", F.sha2("text", 256).alias("h"), F.lit("document").alias("t"))
    code = table(spark, d, "python_tutorial_code").select("record_id", "code", F.sha2("code", 256).alias("h"), F.lit("code").alias("t")).distinct()
    one = governance.canonical(docs, {"source": "source", "source_type": "t", "record_id": "doc_id", "content_hash": "h", "license": "license", "text": "text"})
    two = governance.canonical(code, {"source_type": "t", "record_id": "record_id", "content_hash": "h", "text": "code"})
    return one.unionByName(two).select("source_type", "record_id", "content_hash", "license")


# ---- packages and repositories ----

_CLASS = """CASE WHEN contains(t, 'mit') OR contains(t, 'apache-2.0') OR contains(t, 'bsd-2-clause') OR contains(t, 'bsd-3-clause') OR contains(t, 'isc') OR contains(t, 'psf-2.0') OR contains(t, 'unlicense') OR contains(t, 'wtfpl') THEN 'permissive'
 WHEN contains(t, 'gpl-2.0') OR contains(t, 'gpl-3.0') OR contains(t, 'lgpl-2.1') OR contains(t, 'mpl-2.0') OR contains(t, 'eupl-1.2') OR contains(t, 'cc-by-sa') THEN 'share-alike'
 WHEN trim(t) = '' THEN 'no licence metadata' ELSE 'unclear' END"""


@query(f"SELECT {_CLASS} AS reason, count(*) AS n FROM (SELECT DISTINCT manifest_id, lower(coalesce(license, '')) AS t FROM manifest) GROUP BY 1")
def q_license_class(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "manifest").select("manifest_id", "license").distinct()
    return rows.groupBy(packages.license_class("license")["reason"].alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT batch_no, CASE WHEN license_key IS NULL THEN 'UNKNOWN' WHEN license_key IN ('MIT', 'Apache-2.0', 'BSD-2-Clause', 'BSD-3-Clause', 'ISC', 'Unlicense') THEN 'CLEAR' ELSE 'RESTRICTED_OR_REVIEW' END AS status,
 count(*) AS n FROM repo_candidates GROUP BY 1, 2""")
def q_repo_license_class(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "repo_candidates")
    return rows.groupBy("batch_no", packages.repository_license_class("license_key").alias("status")).agg(F.count(F.lit(1)).alias("n"))


_FILES = "fl AS (SELECT DISTINCT file_id, repo_id, path, content, length FROM repo_files)"


def _files(spark, d):
    """Files, each once; a file delivered twice has one content."""
    return table(spark, d, "repo_files").select("file_id", "repo_id", "path", "content", "length").dropDuplicates(["file_id"])


@query(f"""WITH {_FILES}, c AS (SELECT string_split(lower(path), '/') AS p FROM fl)
SELECT CASE WHEN list_has_any(p, ['vendor', 'third_party', 'third-party', '_vendor', 'bundled', 'vendored']) THEN 'vendor' WHEN list_has_any(p, ['tests', 'test', 'testing', 'unittests']) THEN 'test'
 WHEN list_has_any(p, ['examples', 'example', 'demos', 'demo']) THEN 'example' WHEN list_has_any(p, ['docs', 'doc', 'documentation']) THEN 'docs'
 WHEN list_has_any(p, ['generated', '.generated', 'build', 'dist', '__pycache__']) THEN 'generated' ELSE 'source' END AS category, count(*) AS n FROM c GROUP BY 1""")
def q_file_category(spark: SparkSession, d: str) -> DataFrame:
    return packages.files_by_category(_files(spark, d))


@query(rf"""WITH {_FILES}, l AS (SELECT *, ends_with(lower(path), '.py') AS py, string_split(content, chr(10)) AS ls FROM fl)
SELECT repo_id, count(*) AS files, count(*) FILTER (py) AS python_files,
 coalesce(sum(CASE WHEN py THEN len(list_filter(ls, lambda s: NOT regexp_matches(s, '\A{_W}*(?:#.*)?\z'))) ELSE 0 END), 0)::BIGINT AS python_lines,
 coalesce(sum(CASE WHEN py THEN len(ls) - CASE WHEN ends_with(content, chr(10)) OR content = '' THEN 1 ELSE 0 END ELSE 0 END), 0)::BIGINT AS total_lines,
 count(*) FILTER (contains(array_to_string(ls[1:5], chr(10)), 'DO NOT EDIT') OR contains(array_to_string(ls[1:5], chr(10)), 'GENERATED')) AS flagged,
 bool_or(path = 'README.md') AS has_readme, bool_or(starts_with(path, 'docs/')) AS has_docs, coalesce(sum(length), 0)::BIGINT AS bytes FROM l GROUP BY repo_id""")
def q_tree_measures(spark: SparkSession, d: str) -> DataFrame:
    return repos.tree_measures(_files(spark, d))


@query(f"""WITH {_FILES} SELECT repo_id, count(*) AS file_count, sum(strlen(content))::BIGINT AS total_bytes, sha256(string_agg(path || ' ' || sha256(content), chr(10) ORDER BY path, sha256(content))) AS listing
 FROM fl WHERE content IS NOT NULL AND NOT regexp_matches(path, '(^|/)\\.git') GROUP BY repo_id""")
def q_snapshot_manifest(spark: SparkSession, d: str) -> DataFrame:
    out = repos.snapshot_manifest(_files(spark, d).filter("content is not null"), ["repo_id"])
    listing = F.array_join(F.transform("files", lambda f: F.concat_ws(" ", f["path"], f["sha256"])), "\n")
    return out.select("repo_id", "file_count", "total_bytes", F.sha2(listing, 256).alias("listing"))


@query("""WITH e AS (SELECT DISTINCT record_id, length(code)::BIGINT AS size, sha256(code) AS h FROM python_tutorial_code WHERE code IS NOT NULL),
a AS (SELECT DISTINCT record_id FROM validation_result WHERE is_valid)
SELECT record_id, CASE WHEN a.record_id IS NULL THEN 'missing' ELSE 'unexpected' END AS discrepancy FROM e FULL JOIN a USING (record_id) WHERE a.record_id IS NULL OR e.record_id IS NULL""")
def q_tree_comparison(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "python_tutorial_code").filter("code is not null").select("record_id", F.length("code").cast("long").alias("size"), F.sha2("code", 256).alias("sha256")).distinct()
    valid = table(spark, d, "validation_result").filter("is_valid").select("record_id").distinct()
    actual = valid.join(rows, "record_id", "left")
    return repos.compare_trees(rows, actual, ["record_id"])


@query("""SELECT record_id, is_valid, error_type FROM validation_result QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY validated_at DESC, is_valid DESC, coalesce(error_type, '') DESC) = 1""")
def q_latest_verdict(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "validation_result").select("record_id", "is_valid", "error_type", "validated_at", F.coalesce("is_valid", F.lit(False)).alias("v"), F.coalesce("error_type", F.lit("")).alias("e"))
    return repos.latest(rows, "record_id", ["validated_at", "v", "e"]).select("record_id", "is_valid", "error_type")


@query("SELECT DISTINCT record_id FROM python_tutorial_code WHERE record_id NOT IN (SELECT record_id FROM validation_result WHERE record_id IS NOT NULL)")
def q_unprocessed(spark: SparkSession, d: str) -> DataFrame:
    return repos.unprocessed(table(spark, d, "python_tutorial_code").select("record_id").distinct(), table(spark, d, "validation_result"), "record_id")


@query("SELECT count(DISTINCT record_id) AS n FROM python_tutorial_code WHERE record_id IN (SELECT record_id FROM validation_result WHERE is_valid)")
def q_processed(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "validation_result").filter("is_valid").select("record_id")
    return table(spark, d, "python_tutorial_code").join(done, "record_id", "left_semi").agg(F.countDistinct("record_id").alias("n"))


@query("SELECT user_id, event_type AS state, count(*) AS n FROM events GROUP BY 1, 2")
def q_state_counts(spark: SparkSession, d: str) -> DataFrame:
    return repos.state_counts(table(spark, d, "events").withColumnRenamed("event_type", "state"), "state", "user_id")


@query("""SELECT user_id, event_id, event_type, p AS previous_state FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
WHERE p IS NOT NULL AND NOT (p = 'view' AND event_type IN ('click', 'view')) AND NOT (p = 'click' AND event_type IN ('purchase', 'view', 'click'))""")
def q_transitions(spark: SparkSession, d: str) -> DataFrame:
    rows = repos.check_transitions(table(spark, d, "events"), "user_id", "event_type", ["ts", "event_id"], {"view": ["click", "view"], "click": ["purchase", "view", "click"]})
    return rows.select("user_id", "event_id", "event_type", "previous_state")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_event_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("""SELECT repo_id, CASE WHEN size_kb IS NULL THEN 'ERROR' WHEN size_kb <= 51200 THEN 'SMALL' WHEN size_kb <= 204800 THEN 'MEDIUM' ELSE 'LARGE' END AS size_class FROM repo_candidates
ORDER BY CASE WHEN size_kb IS NULL THEN 2 WHEN size_kb <= 51200 THEN 0 WHEN size_kb <= 204800 THEN 1 ELSE 3 END, size_kb, repo_id LIMIT 150""")
def q_next_work(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "repo_candidates").withColumn("size_class", repos.size_class("size_kb"))
    order = F.array_position(F.array(*map(F.lit, ["SMALL", "MEDIUM", "ERROR", "LARGE"])), F.col("size_class"))
    return repos.next_work(rows, order, ["size_kb", "repo_id"], 150).select("repo_id", "size_class")


@query("""SELECT p_partkey, p_name, n, row_number() OVER (ORDER BY n DESC, lower(p_name), p_name, p_partkey) AS rank FROM (
 SELECT p_partkey, p_name, count(l_orderkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2)""")
def q_popularity_rank(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, d, "part").select("p_partkey", "p_name").join(used, "p_partkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = [F.desc("n"), F.lower("p_name"), F.col("p_name"), F.col("p_partkey")]
    return qa.with_global_place(rows, order, "rank").withColumn("rank", F.col("rank") + 1)


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 10000 AS chunk FROM orders")
def q_chunk_numbers(spark: SparkSession, d: str) -> DataFrame:
    return qa.chunk_numbers(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 10000)


@query("""SELECT tag, count(*) AS n FROM (SELECT unnest(topics) AS tag FROM repo_candidates) WHERE tag IS NOT NULL AND tag <> '' GROUP BY 1 ORDER BY n DESC, tag LIMIT 20""")
def q_top_tags(spark: SparkSession, d: str) -> DataFrame:
    return qa.top_tags(table(spark, d, "repo_candidates"), text.clean_tags("topics"), 20)


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source NULLS FIRST LIMIT 10")
def q_top_sources(spark: SparkSession, d: str) -> DataFrame:
    return qa.top_values(table(spark, d, "documents"), "source", 10, "source")


@query("""SELECT count(*) AS n, least(min(stars), min(forks)) AS min_score, greatest(max(stars), max(forks)) AS max_score, min(size_kb) AS min_tokens, max(size_kb) AS max_tokens,
 count(*) FILTER (archived) AS n_accepted, count(*) FILTER (NOT archived) AS n_not_accepted FROM repo_candidates""")
def q_profile(spark: SparkSession, d: str) -> DataFrame:
    return qa.profile(table(spark, d, "repo_candidates"), ["stars", "forks"], "size_kb", "archived")


_TIER = """t AS (SELECT *, CASE WHEN stars IS NULL OR archived IS NULL THEN NULL WHEN NOT archived AND stars >= 10 THEN 'A' WHEN archived AND stars >= 20 THEN 'B' WHEN NOT archived AND stars >= 5 THEN 'C' END AS tier FROM repo_candidates)"""


def _tiered(spark, d):
    return table(spark, d, "repo_candidates").withColumn("tier", qa.tier("stars", ~F.col("archived")))


@query(f"WITH {_TIER} SELECT tier, count(*) AS n, sum(size_kb)::BIGINT AS kb FROM t GROUP BY tier")
def q_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _tiered(spark, d).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("size_kb").alias("kb"))


@query(f"""WITH {_TIER}, c AS (SELECT repo_id, tier, sum(size_kb) OVER (ORDER BY tier, stars DESC, created_at, repo_id ROWS UNBOUNDED PRECEDING) - size_kb AS before FROM t WHERE tier IS NOT NULL AND size_kb IS NOT NULL)
SELECT repo_id, tier FROM c WHERE before < 1000000""")
def q_token_budget(spark: SparkSession, d: str) -> DataFrame:
    rows = _tiered(spark, d).filter("size_kb is not null")
    return qa.select_budget(rows, "size_kb", [("stars", True), ("created_at", False)], 1_000_000, key="repo_id").select("repo_id", "tier")


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY stars DESC, repo_id) AS n FROM repo_candidates)
SELECT repo_id FROM a WHERE n = 1 QUALIFY row_number() OVER (PARTITION BY language, created_at::DATE ORDER BY stars DESC, repo_id) = 1""")
def q_one_per(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "repo_candidates").withColumn("k", F.struct("language", F.to_date("created_at")))
    return qa.one_per(rows, ["owner", "k"], [F.desc("stars"), F.col("repo_id")]).select("repo_id")


@query("SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey QUALIFY l_linenumber = min(l_linenumber) OVER (PARTITION BY l_orderkey)")
def q_qa_pairs(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "orders").select(F.col("o_orderkey").alias("question_id"))
    said = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("parent_id"), F.col("l_linenumber").alias("ordinal"), "l_quantity")
    return qa.qa_pairs(asked, said, first_only=True).select(F.col("question_id").alias("o_orderkey"), F.col("ordinal").alias("l_linenumber"), "l_quantity")


_FACTS = """f AS (SELECT p_partkey, '1.' || (p_size % 3) AS requested_version, '1.' || (p_size % 4 % 3) AS resolved_version,
 CASE WHEN p_size % 5 = 0 THEN NULL ELSE replace(lower(p_brand), '#', '') || '-1.' || (p_size % 6 % 3) || '.tar.gz' END AS fn,
 CASE WHEN p_size % 7 = 0 THEN NULL ELSE '1.' || (p_size % 9 % 3) END AS mv, CASE WHEN p_partkey % 2 = 0 THEN 'a' END AS es, CASE WHEN p_partkey % 10 = 0 THEN 'b' ELSE 'a' END AS os FROM part)"""


@query(f"""WITH {_FACTS}, v AS (SELECT *, CASE WHEN regexp_matches(split_part(regexp_replace(fn, '\\.tar\\.gz', ''), '-', -1), '^[0-9]') THEN split_part(regexp_replace(fn, '\\.tar\\.gz', ''), '-', -1) END AS fv FROM f),
r AS (SELECT *, CASE WHEN es IS NOT NULL AND es <> os THEN 'sha_mismatch' WHEN requested_version <> resolved_version THEN 'resolved_version_mismatch' WHEN fv <> requested_version THEN 'filename_version_mismatch'
 WHEN mv <> requested_version THEN 'metadata_version_mismatch' WHEN fv IS NULL AND mv IS NULL THEN 'identity_unprovable_no_sha' ELSE 'identity_verified' END AS reason FROM v)
SELECT p_partkey, reason, CASE reason WHEN 'identity_verified' THEN 'ACCEPT' WHEN 'identity_unprovable_no_sha' THEN 'QUARANTINE' ELSE 'REJECT' END AS status FROM r""")
def q_identity_gate(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size")
    label = lambda x: F.concat(F.lit("1."), x.cast("string"))
    facts = table(spark, d, "part").select(
        "p_partkey",
        label(n % 3).alias("requested_version"),
        label(n % 4 % 3).alias("resolved_version"),
        F.when(n % 5 != 0, F.concat(F.regexp_replace(F.lower("p_brand"), "#", ""), F.lit("-"), label(n % 6 % 3), F.lit(".tar.gz"))).alias("archive_filename"),
        F.when(n % 7 != 0, label(n % 9 % 3)).alias("metadata_version"),
        F.when(F.col("p_partkey") % 2 == 0, "a").alias("archive_sha256_expected"),
        F.when(F.col("p_partkey") % 10 == 0, "b").otherwise("a").alias("archive_sha256_observed"),
    )
    return packages.identity_gate(facts).select("p_partkey", "reason", "status")


@query("""SELECT count(*) AS total, count(*) FILTER (s = 'ACQUIRED') AS acquired, count(*) FILTER (s = 'FAILED') AS failed, count(*) FILTER (s = 'TIMEOUT') AS timeout, count(*) FILTER (s = 'SKIPPED') AS skipped, count(*) FILTER (s IS NULL) AS remaining
 FROM (SELECT DISTINCT record_id FROM python_tutorial_code) LEFT JOIN (SELECT record_id, CASE WHEN bool_or(is_valid) THEN 'ACQUIRED' ELSE 'FAILED' END AS s FROM validation_result GROUP BY 1) USING (record_id)""")
def q_reconcile(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "python_tutorial_code").select(F.col("record_id").cast("string").alias("package"))
    states = table(spark, d, "validation_result").groupBy(F.col("record_id").cast("string").alias("package")).agg(F.when(F.bool_or("is_valid"), "ACQUIRED").otherwise("FAILED").alias("state"))
    return packages.reconcile(names, states).drop("coverage")


@query(rf"""WITH {_FILES}, s AS (SELECT path, length, lower(path) AS p FROM fl)
SELECT CASE WHEN contains(p, 'python_docs') OR contains(p, 'python-docs') THEN 'python_docs' WHEN contains(p, 'thinkpython') OR contains(p, 'atbs') OR contains(p, 'textbook') THEN 'textbooks'
 WHEN contains(p, 'stackoverflow') THEN 'stackoverflow' WHEN contains(p, 'pypi') THEN 'pypi' WHEN contains(p, 'github') THEN 'github' WHEN contains(p, 'the_stack') THEN 'the_stack'
 WHEN contains(p, 'codesearchnet') THEN 'codesearchnet' WHEN contains(p, 'jupyter') THEN 'jupyter' WHEN contains(p, 'reasoning') THEN 'reasoning' WHEN contains(p, 'reddit') THEN 'reddit' ELSE 'unknown' END AS source_type,
 count(*) AS files, sum(length)::BIGINT AS bytes, max({{'l': length, 'p': path}}).p AS largest FROM s GROUP BY 1""")
def q_inventory(spark: SparkSession, d: str) -> DataFrame:
    return readers.inventory(_files(spark, d))


@query()
def q_package_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Each repository as a package: files, lines, syntax, docstrings, distinct contents."""
    rows = _files(spark, d).filter(F.lower("path").endswith(".py")).select("repo_id", "path", F.col("content").alias("code"))
    return packages.package_analysis(python_source.with_validation(rows, "code", measures=False), "repo_id")


@query()
def q_syntax_by_repo(spark: SparkSession, d: str) -> DataFrame:
    rows = _files(spark, d).filter(F.lower("path").endswith(".py")).select("repo_id", "content")
    return repos.syntax_by_repo(python_source.with_validation(rows, "content", measures=False))


@query("""SELECT event_type, count(*) AS n, max(ts) AS last_first FROM (SELECT event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1) GROUP BY 1""")
def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream: the first of each user and type, whatever comes late, counted by type."""
    at = shared_path(spark, "stream")
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    stream = jobs.stream_files(spark, f"{d}/events.parquet*", events.schema)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    jobs.run_batches(stream, jobs.first_rows_table(f"{at}/rows", keys, order), f"{at}/checkpoint")
    return jobs.read_firsts(spark, f"{at}/rows", keys, order).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_first"))
