"""Package archives: ranking, choice of a distribution, identity gate, analysis, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import metrics
from corpuskit.functions.text import archive_version, content_hash, file_category, package_name
from corpuskit.operators.qa import with_global_place


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_by_popularity(df: DataFrame, count_col: str, name_col: str, limit: int | None = None) -> DataFrame:
    """Adds rank (from 1) by count, highest first, then by the name in lower case. With a limit only the top is ranked."""
    order = [F.desc(count_col), F.lower(name_col).asc(), F.col(name_col).asc()]
    if limit:  # a bounded top-k, so the window is small
        return df.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return with_global_place(df, order, "rank").withColumn("rank", F.col("rank") + 1)


#: Parts of license metadata by class.
PERMISSIVE = ["mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "psf-2.0", "unlicense", "wtfpl"]
SHARE_ALIKE = ["gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "mpl-2.0", "eupl-1.2", "cc-by-sa"]
CLEAR_SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense"]


def license_class(license_: Column | str, expression: Column | str | None = None, classifiers: Column | str | None = None) -> Column:
    """struct<status, reason> by parts of the license metadata (a part may stand inside a word)."""
    parts = [F.coalesce(_c(license_), F.lit(""))]
    if expression is not None:
        parts.append(F.coalesce(_c(expression), F.lit("")))
    if classifiers is not None:
        parts.append(F.coalesce(F.array_join(_c(classifiers), " "), F.lit("")))
    text = F.lower(F.concat_ws(" ", *parts))
    kind = (
        F.when(metrics.contains_any(text, PERMISSIVE), F.array(F.lit("CLEAR"), F.lit("permissive")))
        .when(metrics.contains_any(text, SHARE_ALIKE), F.array(F.lit("REVIEW_REQUIRED"), F.lit("share-alike")))
        .when(F.trim(text) == "", F.array(F.lit("UNKNOWN"), F.lit("no licence metadata")))
        .otherwise(F.array(F.lit("UNKNOWN"), F.lit("unclear")))
    )
    return F.struct(kind[0].alias("status"), kind[1].alias("reason"))


def repository_license_class(spdx: Column | str) -> Column:
    s = _c(spdx)
    return F.when(s.isNull(), "UNKNOWN").when(s.isin(*CLEAR_SPDX), "CLEAR").otherwise("RESTRICTED_OR_REVIEW")


def choose_distribution(releases: DataFrame, mode: str = "latest_upload") -> DataFrame:
    """One file per package of (package, version, release_ordinal, files array<struct<filename, kind, upload_time, yanked>>).

    Releases with a yanked file are out. A source archive is preferred to a wheel; 'first_listed' takes the first release
    that has one, 'latest_upload' the newest file. Within a release the newest file wins.
    """
    rows = releases.filter(~F.exists("files", lambda f: F.coalesce(f["yanked"], F.lit(False))))
    rows = rows.select("package", "version", "release_ordinal", F.explode("files").alias("f")).select("package", "version", "release_ordinal", "f.*")
    kind = F.when(F.col("kind") == "sdist", 0).when(F.col("kind") == "bdist_wheel", 1)
    newest = -F.col("upload_time").cast("timestamp").cast("double")
    place = F.struct(kind, F.col("release_ordinal"), newest) if mode == "first_listed" else F.struct(kind, newest, F.col("release_ordinal"))
    best = rows.filter(kind.isNotNull()).groupBy("package").agg(F.min_by(F.struct("version", "filename", "kind", "upload_time"), place).alias("d"))
    return best.select("package", "d.*")


def identity_gate(df: DataFrame) -> DataFrame:
    """Adds observed_filename_version, sha_verified, status and reason; the first check that fails decides.

    Columns: requested_version, resolved_version, archive_filename, archive_sha256_expected, archive_sha256_observed,
    metadata_version. An unknown requested version skips the version checks.
    """
    asked, seen = F.col("requested_version"), archive_version("archive_filename")
    differs = lambda c: asked.isNotNull() & c.isNotNull() & (c != asked)
    expected, observed = F.col("archive_sha256_expected"), F.col("archive_sha256_observed")
    reason = (
        F.when(expected.isNotNull() & ~expected.eqNullSafe(observed), "sha_mismatch")
        .when(asked.isNotNull() & ~asked.eqNullSafe(F.col("resolved_version")), "resolved_version_mismatch")
        .when(differs(seen), "filename_version_mismatch")
        .when(differs(F.col("metadata_version")), "metadata_version_mismatch")
        .when(asked.isNotNull() & seen.isNull() & F.col("metadata_version").isNull(), "identity_unprovable_no_sha")
        .otherwise("identity_verified")
    )
    status = F.when(reason == "identity_verified", "ACCEPT").when(reason == "identity_unprovable_no_sha", "QUARANTINE").otherwise("REJECT")
    return df.withColumns({"observed_filename_version": seen, "sha_verified": expected.isNotNull() & expected.eqNullSafe(observed), "reason": reason, "status": status})


def hash_lookup(wanted: DataFrame, files: DataFrame, key: str = "sha256") -> DataFrame:
    """Adds match ('none', 'one', 'many') and the path if there is one file of the digest."""
    found = files.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("path").alias("_path"))
    kind = F.when(F.col("_n").isNull(), "none").when(F.col("_n") == 1, "one").otherwise("many")
    return wanted.join(found, key, "left").withColumn("match", kind).withColumn("path", F.when(F.col("_n") == 1, F.col("_path"))).drop("_n", "_path")


def recovery_class(df: DataFrame) -> Column:
    """Outcome of one recovery attempt from observed facts (error, sha_ok, identity_ok, extracted, python_files, match)."""
    has = set(df.columns)
    anchored = F.when(F.col("match") != "one", "IDENTITY_UNPROVEN") if "match" in has else F.when(F.lit(False), "")
    return (
        anchored.when(F.col("error") == "network", "NETWORK_ERROR")
        .when(F.col("error") == "not_found", "ARCHIVE_UNAVAILABLE")
        .when(~F.col("sha_ok"), "HASH_MISMATCH")
        .when(~F.col("identity_ok"), "IDENTITY_MISMATCH")
        .when(~F.col("extracted"), "EXTRACTION_FAILED")
        .when(F.col("python_files") == 0, "NO_PYTHON_CODE")
        .when(F.col("error").isNull(), "RECOVERED_VERIFIED")
        .otherwise("OTHER_BLOCKED")
    )


def package_analysis(files: DataFrame, package: str = "package") -> DataFrame:
    """Per package, of its .py files (package, path, code, validation): files, lines, valid and invalid, docstrings,
    comments, generated or foreign ones, distinct contents, largest file, and the ratios."""
    python = files.filter(F.lower("path").endswith(".py") & ~metrics.is_binary("code"))
    v, loc = F.col("validation"), metrics.all_lines("code")
    rows = python.withColumns({"_loc": loc, "_h": content_hash("code"), "_g": metrics.is_generated_or_vendor("path", "code")})
    valid = v["is_valid"]
    return rows.groupBy(package).agg(
        F.count(F.lit(1)).alias("python_files"),
        F.sum(F.when(valid, F.col("_loc")).otherwise(0)).alias("python_loc"),
        F.count_if(valid).alias("ast_valid"),
        F.count_if(~valid).alias("ast_invalid"),
        F.sum(F.when(valid, v["docstring_count"]).otherwise(0)).alias("docstring_count"),
        F.sum(F.when(valid, v["comment_count"]).otherwise(0)).alias("comment_count"),
        F.count_if("_g").alias("generated_or_vendor_count"),
        F.countDistinct("_h").alias("distinct_contents"),
        F.max(F.struct("_loc", "path"))["path"].alias("largest_python_file"),
        F.max("_loc").alias("largest_python_loc"),
        (F.sum(F.when(valid, v["docstring_count"]).otherwise(0)) / F.count(F.lit(1))).alias("docstring_ratio"),
    )


def files_by_category(files: DataFrame) -> DataFrame:
    return files.groupBy(file_category("path").alias("category")).agg(F.count(F.lit(1)).alias("n"))


def totals(packages: DataFrame) -> DataFrame:
    """Sums and unweighted means over packages; zeros without any."""
    return packages.agg(
        F.count(F.lit(1)).alias("n_packages"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("python_files", "python_loc", "ast_valid", "ast_invalid")],
        F.coalesce(F.avg("docstring_ratio"), F.lit(0.0)).alias("docstring_ratio"),
    )


def reconcile(candidates: DataFrame, states: DataFrame, key: str = "package") -> DataFrame:
    """One row: candidates by the latest state of their key, those without one as remaining, and the share acquired."""
    n = candidates.select(package_name(key).alias("_k")).distinct().join(states.select(package_name(key).alias("_k"), "state"), "_k", "left")
    count = lambda s: F.count_if(F.col("state") == s)
    out = n.agg(F.count(F.lit(1)).alias("total"), count("ACQUIRED").alias("acquired"), count("FAILED").alias("failed"), count("TIMEOUT").alias("timeout"), count("SKIPPED").alias("skipped"), F.count_if(F.col("state").isNull()).alias("remaining"))
    share = F.when(F.col("total") > 0, 100 * F.col("acquired") / F.col("total")).otherwise(0.0)
    return out.withColumn("coverage", F.format_string("%d/%d (%.1f%%)", "acquired", "total", share))


def fill_missing(manifest: DataFrame, checkpoints: DataFrame, key: str, col: str) -> DataFrame:
    """A column of a manifest, filled from checkpoints where it is null."""
    other = checkpoints.groupBy(key).agg(F.max(col).alias("_other"))
    return manifest.join(other, key, "left").withColumn(col, F.coalesce(col, "_other")).drop("_other")
