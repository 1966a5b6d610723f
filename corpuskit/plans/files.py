"""Registered queries over sources and sinks: whole test tables are written as files in the session and read back."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import html, text
from corpuskit.operators import packages
from corpuskit.plans.catalogue import query
from corpuskit.session import shared_path, table
from corpuskit.sources import readers, writers

_DOC = "doc_id long, lang string, source string, n_chars long, domain string"


@query("SELECT doc_id, lang, source, n_chars, domain FROM documents")
def q_jsonl_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """Documents as JSON lines among blank and broken ones, in two appended parts."""
    at = shared_path(spark, "jsonl")
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", "domain")
    writers.write_jsonl(rows.filter("doc_id % 2 = 0"), at, rows_per_file=1000)
    writers.append_records(rows.filter("doc_id % 2 <> 0"), at)
    broken = rows.select(F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, '{"doc_id": ').otherwise("no json").alias("value"))
    broken.write.mode("append").text(at)
    return readers.read_jsonl(spark, at, _DOC).dropna("all")


@query("SELECT DISTINCT manifest_id, repo_id, source, license, retained_count FROM manifest")
def q_jsonl_strict(spark: SparkSession, d: str) -> DataFrame:
    at = shared_path(spark, "manifest")
    writers.write_jsonl(table(spark, d, "manifest").select("manifest_id", "repo_id", "source", "license", "retained_count"), at)
    return readers.read_manifest(spark, at, "manifest_id long, repo_id long, source string, license string, retained_count long").distinct()


@query("SELECT repo_id, full_name, stars FROM repo_candidates")
def q_jsonl_commented(spark: SparkSession, d: str) -> DataFrame:
    at = shared_path(spark, "commented")
    rows = table(spark, d, "repo_candidates").select("repo_id", "full_name", "stars")
    lines = rows.select(F.explode(F.array(F.concat(F.lit("# "), "full_name"), F.lit(""), F.to_json(F.struct("repo_id", "full_name", "stars")))).alias("value"))
    lines.write.text(at)
    return readers.read_commented_jsonl(spark, at, "repo_id long, full_name string, stars long")


@query("SELECT batch_no, experiment, repositories_acquired, licenses_clear FROM gh_pilot_batches")
def q_json_documents(spark: SparkSession, d: str) -> DataFrame:
    """One JSON file a batch, beside files that do not parse."""
    at = shared_path(spark, "documents")
    rows = table(spark, d, "gh_pilot_batches").select("batch_no", "experiment", "repositories_acquired", "licenses_clear")
    rows.withColumn("folder", F.col("batch_no")).repartition("batch_no").write.partitionBy("folder").json(at)
    rows.select(F.lit('{"batch_no": 7').alias("value")).coalesce(1).write.mode("append").text(f"{at}/folder=broken")
    got = readers.read_json_documents(spark, f"{at}/*", "batch_no long, experiment string, repositories_acquired long, licenses_clear long")
    return got.select("batch_no", "experiment", "repositories_acquired", "licenses_clear")


@query("SELECT source, CASE WHEN retained IS NULL THEN 'FAILED' ELSE 'ACQUIRED' END AS state, edition AS version FROM stage1_manifest")
def q_checkpoint_files(spark: SparkSession, d: str) -> DataFrame:
    """A checkpoint file a source, of a table of fixed size; and one that is broken."""
    at = shared_path(spark, "checkpoints")
    store = writers.TwoPhaseWriter(spark, at)
    state = F.struct(F.when(F.col("retained").isNull(), "FAILED").otherwise("ACQUIRED").alias("state"), F.col("edition").alias("version"))
    entries = table(spark, d, "stage1_manifest").select(F.to_json(F.create_map(F.col("source"), state)).alias("j")).collect()
    for n, r in enumerate(entries):
        store.put(f"{at}/s{n}_checkpoint.json", r.j)
    store.put(f"{at}/broken_checkpoint.json", "{")
    return readers.read_checkpoints(spark, at).select(F.col("key").alias("source"), "state", "version")


@query("SELECT o_orderkey, chunk AS page, place FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 5000 + 1 AS chunk, (row_number() OVER (ORDER BY o_orderkey) - 1) % 5000 AS place FROM orders) WHERE chunk > 1")
def q_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders in pages of 5000, read again from the second page on; a page after the last one is not reached."""
    from corpuskit.operators import qa

    at = shared_path(spark, "pages")
    placed = qa.with_global_place(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "place")
    last = placed.agg(F.max("place")).first()[0] // 5000 + 1
    page = (F.floor(F.col("place") / 5000) + 1).cast("long")
    pages = placed.groupBy(page.alias("page")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.struct(k.alias("o_orderkey"))).alias("items"))
    pages = pages.withColumn("has_more", F.col("page") < last)
    beyond = pages.filter("page = 1").withColumns({"page": F.lit(last + 1).cast("long"), "has_more": F.lit(False)})
    pages.unionByName(beyond).withColumn("folder", F.col("page")).repartition("folder").write.partitionBy("folder").json(at)
    return readers.read_pages(spark, f"{at}/*", "struct<o_orderkey: long>", after=1).select("o_orderkey", "page", F.col("place").cast("long").alias("place"))


@query("""SELECT o_orderkey AS question_id, count(l_linenumber) AS n_answers FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 20 >= 5)
 JOIN (SELECT * FROM lineitem WHERE l_partkey % 30 >= 10) ON l_orderkey = o_orderkey GROUP BY 1""")
def q_posts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as questions and their lines as answers in an XML dump, and the answers of the questions with a tag and scores."""
    at = shared_path(spark, "posts")
    asked = table(spark, d, "orders").select(F.format_string('<row Id="%d" PostTypeId="1" Score="%d" Tags="|%s|" Body="&lt;p&gt; a &amp;amp; b" />', "o_orderkey", F.col("o_custkey") % 20, F.when(F.col("o_orderkey") % 2 == 0, "python").otherwise("sql")).alias("value"))
    said = table(spark, d, "lineitem").select(F.format_string('<row Id="%d" PostTypeId="2" ParentId="%d" Score="%d" />', F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_orderkey", F.col("l_partkey") % 30).alias("value"))

    def dump(batches):
        yield pa.RecordBatch.from_arrays([pa.array(['<?xml version="1.0" encoding="utf-8"?>', "<posts>"])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("value")], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["</posts>"])], ["value"])

    asked.union(said).mapInArrow(dump, "value string").write.text(at)
    posts = readers.read_posts(spark, at)
    return readers.answers(posts, readers.questions(posts, ["python"], 5), 10).groupBy(F.col("ParentId").alias("question_id")).agg(F.count(F.lit(1)).alias("n_answers"))


@query(r"""SELECT DISTINCT record_id, sha256(code) AS code, 'explicit_python' AS detection_method, 'Part ' || record_id % 7 AS section FROM python_tutorial_code WHERE code IS NOT NULL AND code <> ''
 AND NOT regexp_matches(code, '(?m)^[\t\x0b-\r \x1c-\x1f\x{85}\x{a0}]*(>>> |\.\.\. )') AND NOT contains(code, chr(13)) AND NOT contains(code, chr(0))""")
def q_html_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Each code in a page of its own, beside blocks of other languages; the blocks that are Python, but for transcripts."""
    code = F.col("code")
    rows = table(spark, d, "python_tutorial_code").filter("code is not null and code <> ''").select("record_id", "code").filter(~F.contains(code, F.lit("\r")) & ~F.contains(code, F.lit("\x00"))).distinct()
    escaped = F.replace(F.replace(F.replace(code, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit("<html><head><title>T</title></head><body><h1>Part "), (F.col("record_id") % 7).cast("string"), F.lit("</h1><p>Text.</p><div class='highlight-sql'><pre>SELECT 1</pre></div><div class='highlight-python3 notranslate'><div class='highlight'><pre>"),
        escaped, F.lit("</pre></div></div></body></html>"),
    )
    found = html.extract_blocks(rows.select("record_id", page.alias("html")), "record_id").filter("detection_method = 'explicit_python'")
    return found.select("record_id", F.sha2("code", 256).alias("code"), "detection_method", "section").distinct()


@query("SELECT n, 'h' || n || '.html' AS path, '<p>' || r_name AS html FROM (SELECT r_regionkey AS n, r_name FROM region)")
def q_html_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a zip with one root folder, of a table of fixed size."""
    at = shared_path(spark, "pages")
    pages = table(spark, d, "region").select("r_regionkey", "r_name").collect()
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for r in pages:
            z.writestr(f"root/h{r.r_regionkey}.html", f"<p>{r.r_name}")
        z.writestr("root/style.css", "p {}")
    writers.TwoPhaseWriter(spark, at).put(f"{at}/docs.zip", data.getvalue())
    return readers.read_html(spark, f"{at}/docs.zip").select(F.regexp_extract("path", r"h(\d+)", 1).cast("long").alias("n"), "path", "html")


def _archives(parts: DataFrame) -> DataFrame:
    """path, content of a source archive for each part; every seventh is broken, every fifth has no metadata."""

    def run(batches):
        for batch in batches:
            out = []
            for key, size in zip(batch.column("p_partkey").to_pylist(), batch.column("p_size").to_pylist()):
                data = io.BytesIO()
                with tarfile.open(fileobj=data, mode="w:gz") as t:
                    members = [(f"pkg{key}/mod.py", f"x = {key}\n"), ("../outside.py", "no")]
                    if key % 5:
                        members.append((f"pkg{key}/PKG-INFO", f"Metadata-Version: 2.1\nName: pkg{key}\nVersion: 1.{size % 4}\n\ntext"))
                    for name, body in members:
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        t.addfile(info, io.BytesIO(body.encode()))
                out.append(b"broken" if key % 7 == 0 else data.getvalue())
            names = [f"pkg{k}-1.{s % 3}.tar.gz" for k, s in zip(batch.column("p_partkey").to_pylist(), batch.column("p_size").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("p_partkey"), pa.array(names, pa.string()), pa.array(out, pa.binary())], ["p_partkey", "path", "content"])

    return parts.select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("long").alias("p_size")).mapInArrow(run, "p_partkey long, path string, content binary")


@query("""WITH f AS (SELECT p_partkey::BIGINT AS p_partkey, p_partkey % 7 = 0 AS broken, '1.' || p_size % 3 AS asked, CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 THEN '1.' || p_size % 4 END AS stated FROM part)
SELECT p_partkey, CASE WHEN broken THEN 0 ELSE 1 END::BIGINT AS python_files, stated AS version, CASE WHEN stated <> asked THEN 'metadata_version_mismatch' ELSE 'identity_verified' END AS reason,
 CASE WHEN broken THEN 'EXTRACTION_FAILED' WHEN stated <> asked THEN 'IDENTITY_MISMATCH' ELSE 'RECOVERED_VERIFIED' END AS outcome FROM f""")
def q_archive_identity(spark: SparkSession, d: str) -> DataFrame:
    """From archives to members, the identity in their metadata, the gate, and the outcome of the recovery."""
    from corpuskit.session import cut_lineage

    archives = cut_lineage(_archives(table(spark, d, "part")))
    members = cut_lineage(readers.archive_members(archives, (".py", "PKG-INFO")))
    counts = members.groupBy("archive").agg(F.count_if(F.col("member").endswith(".py")).alias("python_files"), F.max("error").alias("archive_error"))
    facts = archives.select("p_partkey", F.col("path").alias("archive")).join(counts, "archive", "left").join(readers.archive_identity(members), "archive", "left")
    asked = text.archive_version("archive")
    none = F.lit(None).cast("string")
    gated = packages.identity_gate(facts.select("*", asked.alias("requested_version"), asked.alias("resolved_version"), F.col("archive").alias("archive_filename"), none.alias("archive_sha256_expected"), none.alias("archive_sha256_observed"), F.col("version").alias("metadata_version")))
    observed = gated.withColumns({"error": none, "sha_ok": F.lit(True), "identity_ok": F.col("status") == "ACCEPT", "extracted": F.col("archive_error").isNull()})
    return observed.withColumn("outcome", packages.recovery_class(observed)).select("p_partkey", "python_files", "version", "reason", "outcome")


@query("""WITH f AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN 1 END AS kind, o_orderdate FROM orders WHERE o_orderkey % 11 <> 0)
SELECT 'p' || o_custkey AS package, 'v' || o_orderkey AS version FROM f WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY kind, o_orderdate DESC, o_orderkey) = 1""")
def q_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Orders as releases in package index documents (one a customer), and the file that is chosen of each."""
    kind = F.when(F.col("o_orderkey") % 3 == 0, "sdist").when(F.col("o_orderkey") % 3 == 1, "bdist_wheel").otherwise("bdist_egg")
    file = F.struct(F.concat(F.lit("f"), "o_orderkey").alias("filename"), kind.alias("packagetype"), F.col("o_orderdate").cast("string").alias("upload_time"), (F.col("o_orderkey") % 11 == 0).alias("yanked"))
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.struct(F.concat(F.lit("v"), "o_orderkey").alias("key"), F.array(file).alias("value")).alias("r"))
    of = orders.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "r"))), lambda x: x["r"]).alias("rs"))
    documents = of.select(F.to_json(F.struct(F.struct(F.concat(F.lit("p"), "o_custkey").alias("name")).alias("info"), F.map_from_entries("rs").alias("releases"))).alias("json"))
    return packages.choose_distribution(readers.releases(documents)).select("package", "version")


@query("""SELECT 'customer' AS name, 'COMMITTED_FINAL_CLEANED' AS state, count(*) AS n FROM customer UNION ALL SELECT 'nation', 'COMMITTED_FINAL_CLEANED', count(*) FROM nation
 UNION ALL SELECT 'supplier', 'UNCOMMITTED_STAGING', count(*) FROM supplier UNION ALL SELECT 'refused', 'FROZEN', 0""")
def q_two_phase(spark: SparkSession, d: str) -> DataFrame:
    """Tables through the two-phase commit: what each write came to after an interruption, and what a frozen store refuses."""
    at = shared_path(spark, "store")
    store = writers.TwoPhaseWriter(spark, at)
    for name in ("customer", "nation"):
        store.commit(table(spark, d, name), name)
    store.stage(table(spark, d, "supplier"), "supplier")
    states = store.classify()
    rows = [(n, s, spark.read.parquet(f"{at}/{n}" if s.startswith("COMMITTED") else f"{at}/_staging/{n}-*").count()) for n, s in states.items()]
    store.freeze()
    try:
        store.commit(table(spark, d, "region"), "region")
    except writers.Frozen:
        rows.append(("refused", "FROZEN", 0))
    return spark.createDataFrame(rows, "name string, state string, n long")


@query("SELECT count(*) AS n_sources, (SELECT count(*) FROM documents) AS n_records, max(source) AS last_source FROM (SELECT DISTINCT source FROM documents)")
def q_report(spark: SparkSession, d: str) -> DataFrame:
    """A report of one row, and a table whose rows are counted again after it is written."""
    at = shared_path(spark, "report")
    docs = table(spark, d, "documents")
    writers.write_counted(docs.select("doc_id", "source"), f"{at}/rows")
    rows = spark.read.parquet(f"{at}/rows").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    writers.write_report(rows.agg(F.count(F.lit(1)).alias("n_sources"), F.sum("n").alias("n_records"), F.max("source").alias("last_source")), f"{at}/report")
    return spark.read.schema("n_sources long, n_records long, last_source string").json(f"{at}/report")


@query("SELECT batch_no % 3 AS part, count(*) AS files FROM gh_pilot_batches GROUP BY 1")
def q_tree(spark: SparkSession, d: str) -> DataFrame:
    """A directory of files, walked; each file counts once and has the hash of its content."""
    at = shared_path(spark, "tree")
    rows = table(spark, d, "gh_pilot_batches").select("batch_no", (F.col("batch_no") % 3).alias("part"), "experiment")
    rows.repartition("batch_no").write.partitionBy("part", "batch_no").json(at)
    files = readers.read_tree(spark, at, "*.json").filter("length > 0 and sha256 = sha2(content, 256)")
    return files.groupBy(F.regexp_extract("path", r"/part=(\d+)/", 1).cast("long").alias("part")).agg(F.count(F.lit(1)).alias("files"))


@query("SELECT doc_id, 0 AS source_rank FROM documents UNION ALL SELECT -repo_id, 2 FROM repo_candidates")
def q_fallback_sources(spark: SparkSession, d: str) -> DataFrame:
    """The union of the sources that are there; the second of three is not."""
    return readers.read_first_of(
        spark,
        [
            lambda s: table(s, d, "documents").select("doc_id"),
            lambda s: table(s, f"{d}/none", "documents").select("doc_id"),
            lambda s: table(s, d, "repo_candidates").select((-F.col("repo_id")).alias("doc_id")),
        ],
    )
