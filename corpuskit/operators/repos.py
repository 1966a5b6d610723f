"""Repository trees: file measures, snapshot manifests and their comparison, latest states, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import metrics


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_excluded(path: Column | str) -> Column:
    """Any part of the path begins with .git."""
    return F.exists(F.split(_c(path), "/"), lambda p: p.startswith(".git"))


def forbidden_entries(files: DataFrame) -> DataFrame:
    return files.filter(is_excluded("path"))


def tree_measures(files: DataFrame, repo: str = "repo_id", text: str = "content") -> DataFrame:
    """Per repository: files, Python files, lines of code, flagged files, and whether it has a readme or docs."""
    python = F.lower("path").endswith(".py")
    return files.groupBy(repo).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(python).alias("python_files"),
        F.sum(F.when(python, metrics.code_lines(text)).otherwise(0)).alias("python_lines"),
        F.sum(F.when(python, metrics.all_lines(text)).otherwise(0)).alias("total_lines"),
        F.count_if(metrics.has_generated_header(text)).alias("flagged"),
        F.coalesce(F.bool_or(F.col("path") == "README.md"), F.lit(False)).alias("has_readme"),
        F.coalesce(F.bool_or(F.col("path").startswith("docs/")), F.lit(False)).alias("has_docs"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def usable(measures: DataFrame, min_bytes: int = 1000) -> DataFrame:
    return measures.filter((F.col("files") > 0) & (F.col("bytes") > min_bytes))


def syntax_by_repo(files: DataFrame, repo: str = "repo_id") -> DataFrame:
    """accepted, rejected and analysis errors per repository of files with a validation record."""
    v = F.col("validation")
    return files.groupBy(repo).agg(F.count_if(v["is_valid"]).alias("accepted"), F.count_if(~v["is_valid"]).alias("rejected"), F.count_if(v["analysis_error_type"].isNotNull()).alias("analysis_errors"))


def snapshot_manifest(files: DataFrame, repo: list[str], text: str = "content") -> DataFrame:
    """Per repository: file_count, total_bytes, files (sorted by path) and a hash of them. Excluded paths are left out.

    The sorted list is the manifest itself, so it is as long as the repository has files.
    """
    rows = files.filter(~is_excluded("path")).select(*repo, "path", F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("size"))
    out = rows.groupBy(*repo).agg(F.count(F.lit(1)).alias("file_count"), F.sum("size").alias("total_bytes"), F.array_sort(F.collect_list(F.struct("path", "sha256", "size"))).alias("files"))
    return out.withColumn("manifest_hash", F.sha2(F.to_json(F.struct("file_count", "files", "total_bytes")), 256))


def compare_trees(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """keys and discrepancy: missing, unexpected, size_mismatch or hash_mismatch; equal files give no row."""
    e = expected.select(*keys, F.col("size").alias("_es"), F.col("sha256").alias("_eh"), F.lit(True).alias("_e"))
    a = actual.select(*keys, F.col("size").alias("_as"), F.col("sha256").alias("_ah"), F.lit(True).alias("_a"))
    kind = (
        F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
        .when(~F.col("_es").eqNullSafe(F.col("_as")), "size_mismatch").when(~F.col("_eh").eqNullSafe(F.col("_ah")), "hash_mismatch")
    )
    return e.join(a, keys, "full_outer").select(*keys, kind.alias("discrepancy")).filter("discrepancy is not null")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in a total order; combined before the shuffle, so a hot key costs one row a task."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(key, "_r.*").select(*df.columns)


def state_counts(states: DataFrame, state: str, *by: str) -> DataFrame:
    return states.groupBy(*by, state).agg(F.count(F.lit(1)).alias("n"))


def unprocessed(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def next_work(candidates: DataFrame, priority: Column, order: list[str], k: int = 1) -> DataFrame:
    """The k rows to do next: by priority, then in a stated order."""
    return candidates.withColumn("_p", priority).orderBy("_p", *order).limit(k).drop("_p")


def prunable(cached: DataFrame, active: DataFrame, key: str, age: str, k: int) -> DataFrame:
    """The k oldest entries that no active key uses."""
    return cached.join(active.select(key).distinct(), key, "left_anti").orderBy(age, key).limit(k)


def overlap(repos: DataFrame, packages: DataFrame, repo_name: Column, package: Column) -> DataFrame:
    """Adds in_packages: whether a repository has the name of a package."""
    names = packages.select(package.alias("_n")).distinct().withColumn("_hit", F.lit(True))
    return repos.withColumn("_n", repo_name).join(names, "_n", "left").withColumn("in_packages", F.coalesce("_hit", F.lit(False))).drop("_n", "_hit")


#: Parts of error texts that make another attempt worth while.
RETRYABLE = ["timeout", "network", "connection", "dns", "temporary", "rate limit", "unable to write", "input/output", "io error", "broken pipe"]


def is_retryable(error: Column | str) -> Column:
    return F.coalesce(metrics.contains_any(F.lower(_c(error)), RETRYABLE), F.lit(False))


def size_class(kb: Column | str, small: int = 51200, medium: int = 204800) -> Column:
    k = _c(kb)
    return F.when(k.isNull(), "ERROR").when(k <= small, "SMALL").when(k <= medium, "MEDIUM").otherwise("LARGE")


def check_transitions(events: DataFrame, key: str, state: str, order: list[str], allowed: dict[str, list[str]]) -> DataFrame:
    """Events whose state may not follow the one before (per key, in a total order); any state may come first.

    The window is over the history of one key.
    """
    before = F.lag(state).over(Window.partitionBy(key).orderBy(*order))
    ok = F.lit(False)
    for a, after in allowed.items():
        ok = ok | ((F.col("_before") == a) & F.col(state).isin(*after))
    return events.withColumn("_before", before).filter(F.col("_before").isNotNull() & ~ok).withColumnRenamed("_before", "previous_state")


def lease_overlaps(leases: DataFrame, resource: str, owner: str, start: str, end: str, slot: int = 600) -> DataFrame:
    """Leases that begin while a lease of another owner on the same resource, which began before, is still held.

    Times are numbers of seconds. A lease stands in every slot of that many seconds in which it is held and meets those that
    begin there, so a resource's history is never in one task; leases much longer than a slot stand in many. Of leases that
    begin together the one that ends first, then the owner's name, counts as the earlier one.
    """
    a, b = leases.alias("a"), leases.select(resource, owner, start, end).filter(F.col(end) > F.col(start))
    slots = F.sequence(F.floor(F.col(start) / slot), F.floor((F.col(end) - 1) / slot))
    held = b.withColumn("_slot", F.explode(slots)).alias("b")
    col = lambda t, c: F.col(f"{t}.{c}")
    earlier = F.struct(col("b", start), col("b", end), col("b", owner)) < F.struct(col("a", start), col("a", end), col("a", owner))
    meets = (col("a", resource) == col("b", resource)) & (F.floor(col("a", start) / slot) == F.col("b._slot"))
    return a.join(held, meets & (col("a", owner) != col("b", owner)) & (col("b", end) > col("a", start)) & earlier, "left_semi")


#: States of the acquisition of a repository during which work is going on, and what may follow each state.
IN_FLIGHT = ["FETCHING", "CHECKOUT", "SNAPSHOTTING", "VERIFYING", "PROMOTING"]
ALLOWED = {
    "QUEUED": ["FETCHING", "SKIPPED"], "FETCHING": ["CHECKOUT", "FAILED", "TIMEOUT_RETRYABLE"], "CHECKOUT": ["SNAPSHOTTING", "FAILED", "TIMEOUT_RETRYABLE"],
    "SNAPSHOTTING": ["VERIFYING", "FAILED", "TIMEOUT_RETRYABLE"], "VERIFYING": ["PROMOTING", "FAILED", "TIMEOUT_RETRYABLE"], "PROMOTING": ["ACQUIRED", "FAILED", "TIMEOUT_RETRYABLE"],
    "TIMEOUT_RETRYABLE": ["FETCHING", "CHECKOUT", "SNAPSHOTTING", "VERIFYING", "PROMOTING", "TIMEOUT_PERMANENT"],
}


def reset_interrupted(df: DataFrame, state: str = "state", attempts: str = "attempts", error: str = "error") -> DataFrame:
    """After a crash: what was in flight is queued again, without attempts or error."""
    lost = F.coalesce(F.col(state).isin(*IN_FLIGHT), F.lit(False))
    return df.withColumns({error: F.when(~lost, F.col(error)), attempts: F.when(lost, 0).otherwise(F.col(attempts)), state: F.when(lost, "QUEUED").otherwise(F.col(state))})


def reset_for_retry(df: DataFrame, state: str = "state", error: str = "error") -> DataFrame:
    """Another try: permanent timeouts may be retried, and failures whose error is worth it are queued again."""
    again = (F.col(state) == "FAILED") & is_retryable(error)
    return df.withColumn(state, F.when(F.col(state) == "TIMEOUT_PERMANENT", "TIMEOUT_RETRYABLE").when(again, "QUEUED").otherwise(F.col(state)))


def work_priority(state: Column | str, attempts: Column | str, most: int = 20) -> Column:
    """0 for a timeout with tries left, 1 for what is queued, null for what is not to be done."""
    s = _c(state)
    return F.when((s == "TIMEOUT_RETRYABLE") & (F.coalesce(_c(attempts), F.lit(0)) < most), 0).when(s == "QUEUED", 1)


def audit(facts: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Adds finding: the first discrepancy of an acquired snapshot, null if there is none.

    Facts: path, is_there, is_directory, commit, files, bytes, forbidden (a path), manifest_ok.
    """
    name = F.element_at(F.split("path", "/"), -1)
    none = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    finding = (
        F.when(F.coalesce(F.col("path"), F.lit("")) == "", "no_path")
        .when(none("is_there"), "missing")
        .when(none("is_directory"), "not_a_directory")
        .when(~name.eqNullSafe(F.col("commit")), "other_commit")
        .when(F.coalesce(F.col("files"), F.lit(0)) == 0, "empty")
        .when(F.coalesce(F.col("bytes"), F.lit(0)) <= least_bytes, "too_small")
        .when(F.col("forbidden").isNotNull(), "forbidden_metadata")
        .when(none("manifest_ok"), "manifest_differs")
    )
    return facts.withColumn("finding", finding)
