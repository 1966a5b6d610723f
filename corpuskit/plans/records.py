"""Registered queries over names, filters, states and governance, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import code_graph, metrics, text
from corpuskit.operators import dedup, governance, packages, qa, repos, texts
from corpuskit.plans.catalogue import _FILES, _files, query
from corpuskit.session import table

# ---- names ----

_NAMED = "replace(upper(p_name[1:1]) || p_name[2:], ' ', CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '-_.' END)"


def _named() -> F.Column:
    mark = F.element_at(F.array(*map(F.lit, ["-", "_", ".", "-_."])), (F.col("p_partkey") % 4 + 1).cast("int"))
    return F.replace(F.concat(F.upper(F.substr("p_name", F.lit(1), F.lit(1))), F.substr("p_name", F.lit(2))), F.lit(" "), mark)


@query(f"""SELECT p_partkey, lower(regexp_replace(n, '[-_.]+', '-', 'g')) AS package, 'pypi:' || regexp_replace(lower(n), '[-.]', '_', 'g') || ':1.' || p_size AS record_id,
 'docs:' || p_partkey || ':' || p_size AS other_id FROM (SELECT p_partkey, p_size, {_NAMED} AS n FROM part)""")
def q_package_names(spark: SparkSession, d: str) -> DataFrame:
    n = _named()
    return table(spark, d, "part").select(
        "p_partkey", text.package_name(n).alias("package"), text.package_record_id(n, F.concat(F.lit("1."), "p_size")).alias("record_id"), text.record_id("docs", "p_partkey", "p_size").alias("other_id")
    )


@query(f"""WITH f AS (SELECT p_partkey, p_size, {_NAMED} AS n, '1.' || p_size || CASE WHEN p_size % 3 = 0 THEN '.dev1' ELSE '' END AS v FROM part)
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE replace(lower(replace(n, '-', '_')), '_', '-') END AS wheel_package, CASE WHEN p_size % 5 = 0 THEN NULL ELSE v END AS wheel_version,
 CASE WHEN p_size % 4 = 0 THEN NULL ELSE v END AS sdist_version, CASE WHEN p_size % 4 = 0 THEN NULL ELSE v END AS archive_version FROM f""")
def q_archive_names(spark: SparkSession, d: str) -> DataFrame:
    """Packages and versions from the names of wheels and source archives."""
    size = F.col("p_size")
    version = F.concat(F.lit("1."), size.cast("string"), F.when(size % 3 == 0, ".dev1").otherwise(""))
    wheel = F.concat(F.replace(_named(), F.lit("-"), F.lit("_")), F.lit("-"), version, F.when(size % 2 == 0, "-1").otherwise(""), F.when(size % 5 == 0, ".whl").otherwise("-py3-none-any.whl"))
    sdist = F.concat(F.replace(_named(), F.lit("-"), F.lit("_")), F.lit("-"), F.when(size % 4 == 0, F.lit("latest")).otherwise(version), F.lit(".tar.gz"))
    w = text.wheel_parts(wheel)
    return table(spark, d, "part").select(
        "p_partkey", w["package"].alias("wheel_package"), w["version"].alias("wheel_version"), text.sdist_version(sdist).alias("sdist_version"), text.archive_version(sdist).alias("archive_version")
    )


@query("""SELECT manifest_id, source AS name, CASE WHEN trim(license) = '' THEN NULL ELSE trim(license) END AS license, source AS title, CASE WHEN manifest_id % 2 = 0 THEN 'second' ELSE 'first' END AS status, 2 + (manifest_id % 3 = 0)::INT AS n_fields
 FROM (SELECT DISTINCT manifest_id, source, coalesce(license, '') AS license FROM manifest WHERE NOT contains(coalesce(license, ''), chr(10)))""")
def q_header_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of a metadata file and of a proposal's header, each made of a manifest row."""
    rows = table(spark, d, "manifest").select("manifest_id", "source", F.coalesce("license", F.lit("")).alias("license")).filter(~F.contains("license", F.lit("\n"))).distinct()
    i = F.col("manifest_id")
    info = F.concat(F.lit("Metadata-Version: 2.1\nName:  "), "source", F.lit(" \nLicense: "), "license", F.lit("\nLicense: other\n\nLicense: body"))
    proposal = F.concat(
        F.lit("Title: "), "source", F.lit("\nStatus: first\nUnknown: x\n"), F.when(i % 2 == 0, "Status: second\n").otherwise(""), F.when(i % 3 == 0, "Created: 2020\n").otherwise(""), F.lit("\nTitle: body\n")
    )
    h = F.col("header")
    found = texts.proposal_headers(rows.withColumn("text", proposal))
    return found.select("manifest_id", text.metadata_field(info, "Name").alias("name"), text.metadata_field(info, "License").alias("license"), h["title"].alias("title"), h["status"].alias("status"), F.size(h).alias("n_fields"))


@query(r"""SELECT repo_id, owner, repo, 'https://docs.example/3/x/' || repo || '.html' AS url, '/remote/' || owner AS moved, repo_id % 2 = 0 AS is_commit,
 CASE WHEN size_kb IS NULL THEN NULL ELSE round(size_kb / 1048576.0, 9) END AS gb, '3.' || repo_id % 20 AS version, 'https://x/python-3.' || repo_id % 20 || '-docs-html.zip' AS link FROM repo_candidates""")
def q_paths_and_links(spark: SparkSession, d: str) -> DataFrame:
    """owner__repo names, relative URLs, paths of another root, commits, sizes with units, versions and links of archives."""
    rows = table(spark, d, "repo_candidates")
    both = text.owner_and_repo(F.concat("owner", F.lit("__"), "repo"))
    commit = F.substring(F.sha1(F.col("full_name")), 1, 40)
    label = F.concat(F.lit("python-3."), (F.col("repo_id") % 20).cast("string"), F.lit("-docs-html.zip"))
    page = F.concat(F.lit('<a href="https://x/other.zip">o</a> <a href="https://x/'), label, F.lit('">docs</a> <a href="python-2.7-docs-html.zip">old</a>'))
    return rows.select(
        "repo_id", both["owner"].alias("owner"), both["repo"].alias("repo"), text.join_url("https://docs.example/3/x/index.html", F.concat("repo", F.lit(".html"))).alias("url"),
        text.map_path(F.concat(F.when(F.col("repo_id") % 3 == 0, "/old/").otherwise("/local/"), "owner"), "/local/", "/remote/", "/old/").alias("moved"),
        text.is_commit(F.when(F.col("repo_id") % 2 == 0, commit).otherwise(F.concat(F.lit("g"), commit))).alias("is_commit"),
        F.round(text.size_to_gb(F.concat(F.col("size_kb").cast("string"), F.lit(" KiB"))), 9).alias("gb"), text.docs_version(label).alias("version"), text.docs_archive_link(page).alias("link"),
    )


@query("""SELECT repo_id, len(list_filter(topics, lambda t: t IS NOT NULL AND trim(t) <> '')) AS n_tags, list_contains(topics, 'python') AS core, list_has_any(coalesce(topics, []), ['python', 'numpy', 'pandas', 'scipy', 'matplotlib', 'tensorflow', 'pytorch', 'django', 'flask', 'fastapi']) AS relevant
 FROM repo_candidates WHERE topics IS NOT NULL""")
def q_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags of bar-separated strings, and their relevance."""
    rows = table(spark, d, "repo_candidates").filter("topics is not null").withColumn("tags", text.parse_tags(F.concat(F.lit(" | "), F.array_join("topics", "| "), F.lit("||"))))
    return rows.select("repo_id", F.size("tags").cast("long").alias("n_tags"), qa.relevant(F.col("tags"), core_only=True).alias("core"), qa.relevant(F.col("tags")).alias("relevant"))


# ---- filters ----


@query(rf"""WITH {_FILES}, x AS (SELECT file_id, repo_id, content, string_split(lower(path), '/') AS p, string_split(path, '/')[-1] AS name FROM fl)
SELECT repo_id, count(*) FILTER (list_has_any(p, ['vendor', 'third_party', 'third-party', '_vendor', 'bundled', 'vendored']) OR name IN ('_pb2.py', '_pb2_grpc.py', '_version.py')
 OR coalesce(contains(lower(content), 'autogenerated') OR contains(lower(content), 'generated by') OR contains(lower(content), 'do not edit') OR contains(lower(content), 'machine-generated'), false)) AS n_generated,
 count(*) FILTER (list_bool_or(list_transform(p, lambda s: starts_with(s, '.git')))) AS n_forbidden, count(*) > 0 AND sum(strlen(content)) > 1000 AS usable FROM x GROUP BY 1""")
def q_foreign_files(spark: SparkSession, d: str) -> DataFrame:
    """Generated, foreign and forbidden files of each repository, and whether it can be used at all."""
    rows = _files(spark, d)
    measured = rows.groupBy("repo_id").agg(F.count_if(metrics.is_generated_or_vendor("path", "content")).alias("n_generated"), F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("content")).alias("bytes"))
    forbidden = repos.forbidden_entries(rows).groupBy("repo_id").agg(F.count(F.lit(1)).alias("n_forbidden"))
    good = repos.usable(measured).select("repo_id", F.lit(True).alias("usable"))
    out = measured.join(forbidden, "repo_id", "left").join(good, "repo_id", "left")
    return out.select("repo_id", "n_generated", F.coalesce("n_forbidden", F.lit(0)).alias("n_forbidden"), F.when(F.col("bytes").isNotNull(), F.coalesce("usable", F.lit(False))).alias("usable"))


@query(r"""SELECT doc_id, coalesce(length(text) >= 200 AND (contains(text, '```') OR contains(lower(text), '<code>')) AND coalesce(n_chars % 40, 0) >= 10, false) AS long_scored,
 coalesce(contains(lower(text), 'def ') AND length(text) >= 20, false) AS function_pair, coalesce(domain = 'web', false) OR coalesce(contains(url, 'docs') AND NOT contains(url, 'meta.stackexchange'), false) AS of_docs,
 CASE WHEN url IS NULL THEN NULL ELSE split_part(url, '/', 3) END AS host FROM documents""")
def q_answer_filters(spark: SparkSession, d: str) -> DataFrame:
    """Documents as answers: long with code and score, with a function, of a community."""
    rows = table(spark, d, "documents")
    no = lambda c: F.coalesce(c, F.lit(False))
    community = no(F.col("domain") == "web") | no(qa.of_community(F.lit(None).cast("string"), "url", "docs"))
    return rows.select(
        "doc_id", no(qa.long_scored_code("text", F.col("n_chars") % 40)).alias("long_scored"), no(qa.function_pair("text")).alias("function_pair"),
        community.alias("of_docs"), F.get(F.split("url", "/"), F.lit(2)).alias("host"),
    )


@query("SELECT o_orderkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 2")
def q_accepted_answers(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 10 + 2).alias("accepted_answer_id"))
    said = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("answer_id"), "l_quantity")
    return qa.accepted_answers(asked, said).select("o_orderkey", "l_quantity")


@query("""SELECT record_id, coalesce(contains(lower(error_type), 'timeout') OR contains(lower(error_type), 'network') OR contains(lower(error_type), 'connection') OR contains(lower(error_type), 'temporary') OR contains(lower(error_type), 'io error'), false) AS again,
 coalesce(line_number, 0) AS line, coalesce(TRY_CAST(validator_version AS DOUBLE), 0.0) AS version FROM validation_result""")
def q_casts_and_retries(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "validation_result")
    return rows.select("record_id", repos.is_retryable("error_type").alias("again"), metrics.to_int(F.col("line_number").cast("string")).alias("line"), metrics.to_float("validator_version").alias("version"))


# ---- states and trees ----


@query("""SELECT event_id FROM (SELECT *, event_id % 5 AS res, 'o' || user_id % 3 AS own, epoch(ts)::BIGINT AS s, epoch(ts)::BIGINT + 60 + event_id % 300 AS e FROM events) a
WHERE EXISTS (SELECT 1 FROM (SELECT *, event_id % 5 AS res, 'o' || user_id % 3 AS own, epoch(ts)::BIGINT AS s, epoch(ts)::BIGINT + 60 + event_id % 300 AS e FROM events) b
 WHERE b.res = a.res AND b.own <> a.own AND b.e > a.s AND (b.s, b.e, b.own) < (a.s, a.e, a.own))""")
def q_lease_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Events as leases of five resources by three owners."""
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("event_id", (F.col("event_id") % 5).alias("res"), F.concat(F.lit("o"), (F.col("user_id") % 3).cast("string")).alias("own"), start.alias("s"), (start + 60 + F.col("event_id") % 300).alias("e"))
    return repos.lease_overlaps(rows, "res", "own", "s", "e").select("event_id")


_STATE = "['QUEUED', 'FETCHING', 'CHECKOUT', 'TIMEOUT_RETRYABLE', 'TIMEOUT_PERMANENT', 'FAILED', 'ACQUIRED', 'PROMOTING']"


def _states(spark, d):
    names = F.array(*map(F.lit, ["QUEUED", "FETCHING", "CHECKOUT", "TIMEOUT_RETRYABLE", "TIMEOUT_PERMANENT", "FAILED", "ACQUIRED", "PROMOTING"]))
    error = F.when(F.col("repo_id") % 3 == 0, "Connection reset").when(F.col("repo_id") % 3 == 1, "bad tree")
    return table(spark, d, "repo_candidates").select("repo_id", "size_kb", F.element_at(names, (F.col("repo_id") % 8 + 1).cast("int")).alias("state"), (F.col("stars") % 25).cast("int").alias("attempts"), error.alias("error"))


_STATES = f"s AS (SELECT repo_id, size_kb, {_STATE}[repo_id % 8 + 1] AS state, (stars % 25)::INT AS attempts, CASE repo_id % 3 WHEN 0 THEN 'Connection reset' WHEN 1 THEN 'bad tree' END AS error FROM repo_candidates)"


@query(f"""WITH {_STATES}, r AS (SELECT repo_id, CASE WHEN state IN ('FETCHING', 'CHECKOUT', 'PROMOTING') THEN 'QUEUED' ELSE state END AS state, CASE WHEN state IN ('FETCHING', 'CHECKOUT', 'PROMOTING') THEN 0 ELSE attempts END AS attempts,
 CASE WHEN state IN ('FETCHING', 'CHECKOUT', 'PROMOTING') THEN NULL ELSE error END AS error FROM s)
SELECT repo_id, CASE WHEN state = 'TIMEOUT_PERMANENT' THEN 'TIMEOUT_RETRYABLE' WHEN state = 'FAILED' AND error = 'Connection reset' THEN 'QUEUED' ELSE state END AS state, attempts, error FROM r""")
def q_state_resets(spark: SparkSession, d: str) -> DataFrame:
    """States after a crash, and then before another try."""
    return repos.reset_for_retry(repos.reset_interrupted(_states(spark, d))).select("repo_id", "state", "attempts", "error")


@query(f"""WITH {_STATES} SELECT repo_id FROM s WHERE state = 'TIMEOUT_RETRYABLE' AND coalesce(attempts, 0) < 20 OR state = 'QUEUED'
ORDER BY CASE state WHEN 'TIMEOUT_RETRYABLE' THEN 0 ELSE 1 END, size_kb NULLS FIRST, repo_id LIMIT 40""")
def q_next_attempts(spark: SparkSession, d: str) -> DataFrame:
    """The next repositories to do: timeouts with tries left before queued ones."""
    rows = _states(spark, d).withColumn("p", repos.work_priority("state", "attempts")).filter("p is not null")
    return repos.next_work(rows, F.col("p"), ["size_kb", "repo_id"], 40).select("repo_id")


@query(rf"""WITH {_FILES}, t AS (SELECT repo_id, count(*) AS files, sum(strlen(content)) AS bytes, min(CASE WHEN regexp_matches(path, '(^|/)\.git') THEN path END) AS forbidden FROM fl GROUP BY 1),
f AS (SELECT c.repo_id, CASE WHEN c.repo_id % 13 = 0 THEN '' ELSE '/x/' || repo END AS path, repo AS dir, CASE WHEN c.repo_id % 11 = 0 THEN 'other' ELSE repo END AS commit, t.repo_id IS NOT NULL OR c.repo_id % 2 = 0 AS there, c.repo_id % 17 <> 0 AS isdir,
 coalesce(files, 0) AS files, coalesce(bytes, 0) AS bytes, forbidden, c.repo_id % 19 <> 0 AS ok FROM repo_candidates c LEFT JOIN t USING (repo_id))
SELECT repo_id, CASE WHEN path = '' THEN 'no_path' WHEN NOT there THEN 'missing' WHEN NOT isdir THEN 'not_a_directory' WHEN commit <> dir THEN 'other_commit' WHEN files = 0 THEN 'empty' WHEN bytes <= 1000 THEN 'too_small'
 WHEN forbidden IS NOT NULL THEN 'forbidden_metadata' WHEN NOT ok THEN 'manifest_differs' END AS finding FROM f""")
def q_snapshot_audit(spark: SparkSession, d: str) -> DataFrame:
    """The first discrepancy of each repository's snapshot, by its files and the facts of its checkout."""
    rows = _files(spark, d)
    trees = rows.groupBy("repo_id").agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("content")).alias("bytes"), F.min(F.when(repos.is_excluded("path"), F.col("path"))).alias("forbidden"), F.lit(True).alias("found"))
    i = F.col("repo_id")
    facts = table(spark, d, "repo_candidates").select("repo_id", "repo").join(trees, "repo_id", "left").select(
        "repo_id", F.when(i % 13 == 0, "").otherwise(F.concat(F.lit("/x/"), "repo")).alias("path"), F.when(i % 11 == 0, "other").otherwise(F.col("repo")).alias("commit"),
        (F.col("found").isNotNull() | (i % 2 == 0)).alias("is_there"), (i % 17 != 0).alias("is_directory"), "files", "bytes", "forbidden", (i % 19 != 0).alias("manifest_ok"),
    )
    return repos.audit(facts).select("repo_id", "finding")


@query("""WITH m AS (SELECT repo_id, min(license) AS license FROM manifest GROUP BY 1) SELECT repo_id, coalesce(license_key, license) AS license_key, repo IN (SELECT owner FROM repo_candidates) AS in_packages FROM repo_candidates LEFT JOIN m USING (repo_id)""")
def q_filled_and_overlapping(spark: SparkSession, d: str) -> DataFrame:
    """License keys filled from the manifest, and repositories that have the name of a package (here: of an owner)."""
    rows = table(spark, d, "repo_candidates").select("repo_id", "license_key", "repo")
    other = table(spark, d, "manifest").groupBy("repo_id").agg(F.min("license").alias("license_key"))
    filled = packages.fill_missing(rows, other, "repo_id", "license_key")
    return repos.overlap(filled, table(spark, d, "repo_candidates"), F.col("repo"), F.col("owner")).select("repo_id", "license_key", "in_packages")


@query("SELECT repo_id FROM repo_candidates WHERE repo_id NOT IN (SELECT repo_id FROM manifest WHERE repo_id IS NOT NULL) ORDER BY updated_at, repo_id LIMIT 100")
def q_prunable(spark: SparkSession, d: str) -> DataFrame:
    """The hundred repositories longest unchanged that no manifest names."""
    return repos.prunable(table(spark, d, "repo_candidates"), table(spark, d, "manifest").filter("repo_id is not null"), "repo_id", "updated_at", 100).select("repo_id")


@query("""SELECT count(*) AS n_packages, sum(function_count)::BIGINT AS python_files, sum(line_number)::BIGINT AS python_loc, count(*) FILTER (is_valid) AS ast_valid, count(*) FILTER (NOT is_valid) AS ast_invalid, round(avg(comment_count), 6) AS docstring_ratio FROM validation_result""")
def q_package_totals(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "validation_result")
    rows = v.select(F.col("function_count").alias("python_files"), F.col("line_number").alias("python_loc"), F.when(F.col("is_valid"), 1).otherwise(0).alias("ast_valid"), F.when(~F.col("is_valid"), 1).otherwise(0).alias("ast_invalid"), F.col("comment_count").cast("double").alias("docstring_ratio"))
    return packages.totals(rows).withColumn("docstring_ratio", F.round("docstring_ratio", 6))


# ---- governance ----


@query("""SELECT doc_id, CASE lower(trim(source)) WHEN 'code' THEN 1 WHEN 'docs' THEN 2 ELSE 3 END AS stage, CASE WHEN license IS NULL THEN 'PROVISIONAL' ELSE 'FINAL' END AS status, coalesce(license, 'UNKNOWN (not recorded)') AS known_license,
 coalesce(url, 'UNKNOWN (not recorded)') AS known_url, CASE WHEN license IS NULL AND domain IS NULL THEN 4 ELSE (license IS NOT NULL)::INT + (domain IS NOT NULL)::INT END AS n_quality, coalesce(domain, 'none') AS merged_domain
 FROM documents WHERE domain IS DISTINCT FROM 'report' OR url IS NOT NULL""")
def q_governed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Curriculum stage, token status, provenance and quality metadata of documents; those of one kind only with a known URL."""
    rows = governance.exclude_reasoning(table(spark, d, "documents").withColumn("kind", F.when(F.col("domain") == "report", "reasoning").otherwise(F.col("domain"))), "kind", "url")
    known = governance.provenance_chain({"license": F.col("license"), "url": F.col("url")})
    quality = governance.quality_metadata({"license_status": F.col("license"), "token_count_status": F.col("domain")})
    base = F.create_map(F.lit("domain"), F.lit("none"))
    over = F.when(F.col("domain").isNotNull(), F.create_map(F.lit("domain"), F.col("domain")))
    return rows.select(
        "doc_id", governance.stage(F.lower(F.trim("source")), {"code": 1, "docs": 2}).alias("stage"), governance.token_status("license").alias("status"), known["license"].alias("known_license"),
        known["url"].alias("known_url"), F.size(quality).alias("n_quality"), governance.merged(base, over)["domain"].alias("merged_domain"),
    )


@query("SELECT record_id, record_id % 2 = 0 AS is_id, is_valid IS TRUE AND error_type IS NULL AND line_number IS NULL AS recovered FROM validation_result")
def q_rules(spark: SparkSession, d: str) -> DataFrame:
    """The form of experiment ids, and a rule of several conditions that must all hold."""
    name = F.concat(F.when(F.col("record_id") % 2 == 0, "DATA-run-").otherwise("DATA-"), F.format_string("%03d", "record_id"), F.when(F.col("record_id") % 2 == 0, "").otherwise("x"))
    holds = governance.all_hold({"valid": F.col("is_valid"), "error": F.col("error_type").isNull(), "line": F.col("line_number").isNull()})
    return table(spark, d, "validation_result").select("record_id", governance.is_experiment_id(name, "DATA").alias("is_id"), holds.alias("recovered"))


@query("SELECT 'd-v0.' || (max(stars) + 1) AS next, 'd-v0.' || least(max(stars) + 1, 5) AS capped, count(*) AS n FROM repo_candidates")
def q_versions(spark: SparkSession, d: str) -> DataFrame:
    """The version after the last one, with and without a cap, and the immutable table with one more."""
    rows = table(spark, d, "repo_candidates").select(F.concat(F.lit("d-v0."), F.coalesce("stars", F.lit(0))).alias("version"))
    new, capped = governance.next_version(rows, "d-v"), governance.next_version(rows, "d-v", cap=5)
    more = governance.append_version(rows, {"version": new})
    try:
        governance.append_version(more, {"version": new})
        raise AssertionError("a version was written twice")
    except ValueError:
        return more.agg(F.lit(new).alias("next"), F.lit(capped).alias("capped"), (F.count(F.lit(1)) - 1).alias("n"))


@query("SELECT 'count' AS name, true AS ok, NULL::VARCHAR AS error UNION ALL SELECT 'missing', false, 'AnalysisException' UNION ALL SELECT 'last', true, NULL")
def q_steps(spark: SparkSession, d: str) -> DataFrame:
    """Steps that are run in order; one fails, the others go on."""
    steps = [("count", lambda: table(spark, d, "region").count()), ("missing", lambda: table(spark, f"{d}/none", "region").count()), ("last", lambda: table(spark, d, "nation").count())]
    return governance.run_steps(spark, steps).drop("seconds")


@query("""WITH r AS (SELECT doc_id, sha256(text) AS h, CASE lower(trim(source)) WHEN 'code' THEN 0 ELSE 1 END AS source_rank, (license IS NULL)::INT AS license_rank, retrieved_at AS acquired FROM documents WHERE text IS NOT NULL)
SELECT h, arg_min(doc_id, (coalesce(acquired, TIMESTAMP '9999-01-01'), source_rank, doc_id)) AS fifo, arg_min(doc_id, (source_rank, coalesce(acquired, TIMESTAMP '9999-01-01'), doc_id)) AS priority,
 arg_min(doc_id, (license_rank, source_rank, coalesce(acquired, TIMESTAMP '9999-01-01'), doc_id)) AS license FROM r GROUP BY h""")
def q_keep_policies(spark: SparkSession, d: str) -> DataFrame:
    """The record that is kept of each content under three policies."""
    rows = table(spark, d, "documents").filter("text is not null").select(
        "doc_id", F.sha2("text", 256).alias("h"), F.when(F.lower(F.trim("source")) == "code", 0).otherwise(1).alias("source_rank"), F.col("license").isNull().cast("int").alias("license_rank"), F.col("retrieved_at").alias("acquired")
    )
    return rows.groupBy("h").agg(*[dedup.kept_by(p, "doc_id").alias(p) for p in dedup.POLICIES])


@query()
def q_code_relations(spark: SparkSession, d: str) -> DataFrame:
    """What Python files define, inherit and import."""
    return code_graph.code_relations(_files(spark, d).filter(F.lower("path").endswith(".py")), "file_id", "content")
