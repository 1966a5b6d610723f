"""Readers: declared schemas, tolerant and strict JSON, document trees, archives, posts, directories."""

from __future__ import annotations

import io
import posixpath
import tarfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from corpuskit.functions.text import metadata_field, source_type


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of JSON lines; blank and broken lines are skipped, and a path that does not exist has no records."""
    schema = _schema(schema)
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_manifest(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of JSON lines that must be there and must parse; blank lines are skipped."""
    return spark.read.schema(_schema(schema)).option("mode", "FAILFAST").json(path)


def read_commented_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines between lines that begin with #."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(F.from_json("value", _schema(schema)).alias("r")).filter("r is not null").select("r.*")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One record per JSON file, with its path; files that do not parse are left out."""
    schema = _schema(schema)
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(corrupt).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("path", F.input_file_name()).filter("_corrupt is null").drop("_corrupt")


def read_checkpoints(spark: SparkSession, directory: str, state: str = "struct<state: string, failure_reason: string, reason: string, version: string, archive_sha256: string>") -> DataFrame:
    """key and state fields of the ``*_checkpoint.json`` files of a directory, each {key: {...}}; unreadable ones hold nothing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_checkpoint.json").load(directory)
    entries = files.select(F.explode(F.from_json(F.decode("content", "UTF-8"), f"map<string, {state}>")).alias("key", "s"))
    return entries.select("key", "s.*")


def read_first_of(spark: SparkSession, readers: list) -> DataFrame:
    """The union, by name, of all readers (callables of the session) that work; a source that fails is passed over.

    Readers are lazy, so only failures to resolve a source are seen here; source_rank is the place in the list.
    """
    out = None
    for rank, reader in enumerate(readers):
        try:
            df = reader(spark).withColumn("source_rank", F.lit(rank))
        except Exception:  # noqa: BLE001 - whatever a source raises, the next one is tried
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source could be read")
    return out


POST = T.StructType(
    [T.StructField(f"_{n}", t) for n, t in (("Id", T.LongType()), ("PostTypeId", T.IntegerType()), ("ParentId", T.LongType()), ("AcceptedAnswerId", T.LongType()), ("Score", T.LongType()), ("Title", T.StringType()), ("Body", T.StringType()), ("Tags", T.StringType()), ("CreationDate", T.StringType()))]
)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of an XML dump: files with one root element and a <row .../> for each post."""
    rows = spark.read.format("xml").option("rowTag", "row").schema(POST).load(path)
    return rows.select(*[F.col(f.name).alias(f.name[1:]) for f in POST.fields])


def read_tree(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, length, content, sha256 of all files below a directory."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def _members(name: str, content: bytes):
    """(name, bytes) of the plain files of an archive in memory; members that lead outside are left out, nothing is extracted."""
    def safe(n):
        return not n.startswith(("/", "\\")) and ".." not in n.replace("\\", "/").split("/") and ":" not in n.split("/")[0]

    if name.endswith((".zip", ".whl")):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for i in sorted(z.infolist(), key=lambda i: i.filename):
                if not i.is_dir() and safe(i.filename):
                    yield i.filename, z.read(i)
    else:
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as t:
            for i in sorted((i for i in t.getmembers() if i.isfile()), key=lambda i: i.name):
                if safe(i.name):
                    yield i.name, t.extractfile(i).read()


def archive_members(archives: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """archive, member, content, error of the members of zip, wheel and tar archives (columns path and content).

    ``suffixes`` keeps members whose name ends so. An archive that cannot be read gives one row with the error.
    """

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = []
                try:
                    rows = [(path, n, b, None) for n, b in _members(path, content or b"") if not suffixes or n.endswith(suffixes)]
                except (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError, KeyError) as e:
                    rows = [(path, None, None, type(e).__name__)]
                if rows:
                    a, m, c, e = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(m, pa.string()), pa.array(c, pa.binary()), pa.array(e, pa.string())], ["archive", "member", "content", "error"])

    return archives.select("path", "content").mapInArrow(run, "archive string, member string, content binary, error string")


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """path and html of the pages of a directory or of zip archives; a zip's single common root is dropped."""
    if path.endswith(".zip"):
        members = archive_members(spark.read.format("binaryFile").load(path), (".html",))
        from pyspark.sql import Window

        whole = Window.partitionBy("archive")
        top = F.split("member", "/")[0]
        one = (F.min(top).over(whole) == F.max(top).over(whole)) & (F.min(F.instr("member", "/")).over(whole) > 0)
        name = F.when(one, F.substr("member", F.instr("member", "/") + 1)).otherwise(F.col("member"))
        return members.filter("member is not null").select(name.alias("path"), F.decode("content", "UTF-8").alias("html"))
    rows = read_tree(spark, path, "*.html")
    root = posixpath.normpath(path).rstrip("/") + "/"
    relative = F.regexp_replace("path", rf"^(?:file:)?/*{root.lstrip('/')}", "")
    return rows.select(relative.alias("path"), F.decode("content", "UTF-8").alias("html"))


def read_pages(spark: SparkSession, path: str, item: str, after: int = 0) -> DataFrame:
    """Items of a paged source, one JSON file a page ({page, has_more, items}): of the pages after ``after`` up to the first
    one without more, in the order of the pages. Pages that do not parse hold nothing."""
    pages = read_json_documents(spark, path, f"page long, has_more boolean, items array<{item}>").filter(F.col("page") > after)
    last = pages.filter(~F.coalesce("has_more", F.lit(False))).agg(F.min("page").alias("last"))
    upto = pages.filter(F.coalesce(F.col("page") <= last.scalar(), F.lit(True)))
    return upto.select("page", F.posexplode("items").alias("place", "item")).select("page", "place", "item.*")


RELEASES = "struct<info: struct<name: string, version: string>, releases: map<string, array<struct<filename: string, packagetype: string, upload_time: string, yanked: boolean>>>>"


def releases(documents: DataFrame, json_col: str = "json") -> DataFrame:
    """package, version, release_ordinal, files: the releases of package index documents, in their order; for
    ``packages.choose_distribution``. Documents that do not parse have none."""
    d = documents.select(F.from_json(json_col, RELEASES).alias("d")).filter("d.info.name is not null and d.releases is not null")
    rows = d.select(F.col("d.info.name").alias("package"), F.posexplode(F.map_entries("d.releases")).alias("release_ordinal", "r"))
    files = F.transform("r.value", lambda f: F.struct(f["filename"].alias("filename"), f["packagetype"].alias("kind"), f["upload_time"].alias("upload_time"), f["yanked"].alias("yanked")))
    return rows.select("package", F.col("r.key").alias("version"), F.col("release_ordinal").cast("long").alias("release_ordinal"), files.alias("files"))


def archive_identity(members: DataFrame) -> DataFrame:
    """archive, package, version from the first PKG-INFO or METADATA member of each archive."""
    info = members.filter(F.col("member").rlike(r"(?:^|/)(?:PKG-INFO|METADATA)$"))
    first = info.groupBy("archive").agg(F.min_by("content", F.struct(F.length("member"), "member")).alias("content"))
    text = F.decode("content", "UTF-8")
    return first.select("archive", metadata_field(text, "Name").alias("package"), metadata_field(text, "Version").alias("version"))


def inventory(files: DataFrame) -> DataFrame:
    """source_type, files, bytes, largest of a listing with path and length."""
    return files.groupBy(source_type("path").alias("source_type")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max(F.struct("length", "path"))["path"].alias("largest")
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def questions(posts: DataFrame, tags: list[str], min_score: int, accepted_only: bool = False, limit: int | None = None) -> DataFrame:
    """Questions with one of the tags and the score, newest first."""
    hit = F.lit(False)
    for t in tags:
        hit = hit | F.contains(F.col("Tags"), F.lit(t))
    rows = posts.filter((F.col("PostTypeId") == 1) & hit & (F.col("Score") >= min_score))
    rows = rows.filter("AcceptedAnswerId is not null") if accepted_only else rows
    return rows.orderBy(F.desc("CreationDate"), "Id").limit(limit) if limit else rows


def answers(posts: DataFrame, asked: DataFrame, min_score: int) -> DataFrame:
    """Answers of those questions, however many they are."""
    rows = posts.filter((F.col("PostTypeId") == 2) & (F.col("Score") >= min_score))
    return rows.join(asked.select(F.col("Id").alias("ParentId")), "ParentId", "left_semi")
