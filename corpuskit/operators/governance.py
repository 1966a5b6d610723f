"""Datasets as a whole: canonical records, splits, versions, manifests, contamination."""

from __future__ import annotations

import datetime
import json
import platform
import sys
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


CANONICAL = ["source", "source_type", "source_url", "record_id", "content_hash", "acquisition_date", "license", "text"]


def canonical(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """The canonical record of a source; what the mapping does not name is null, other columns go to ``extra``."""
    used = {c for c in mapping.values() if isinstance(c, str)}
    rest = [c for c in df.columns if c not in used]
    cols = [(_c(mapping[f]) if f in mapping else F.lit(None)).cast("string").alias(f) for f in CANONICAL]
    extra = F.map_filter(F.create_map(*[x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull()) if rest else F.create_map().cast("map<string,string>")
    return df.select(*cols, extra.alias("extra"))


def split_of(hash_hex: Column | str, train: int = 90, validation: int = 4, holdout: int = 3) -> Column:
    """train, validation, holdout or test by the first 32 bits of a hash: equal contents share a split, on every run."""
    bucket = F.pmod(F.conv(F.substring(_c(hash_hex), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(bucket < train, "train").when(bucket < train + validation, "validation").when(bucket < train + validation + holdout, "holdout").otherwise("test")


def middle_out(df: DataFrame, text: str, key: Column, ratio: float = 0.5) -> DataFrame:
    """Fill-in-the-middle: for a share of the records (by a hash of the key) prefix, middle and suffix, cut by that hash."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")
    n = F.length(text)
    a, b = F.pmod(h, n + 1), F.pmod(F.shiftright(h, 20), n + 1)
    lo, hi = F.least(a, b).cast("int"), F.greatest(a, b).cast("int")
    chosen = F.pmod(F.shiftright(h, 40), F.lit(1000)) < int(ratio * 1000)
    t = F.col(text)
    return df.withColumn(
        "fim",
        F.when(chosen & t.isNotNull(), F.struct(F.substring(t, F.lit(1), lo).alias("prefix"), F.substring(t, lo + 1, hi - lo).alias("middle"), F.substring(t, hi + 1, n - hi).alias("suffix"))),
    )


def ngram_overlap(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str, n: int = 13) -> DataFrame:
    """Documents and items that share n consecutive words, and how many such runs: an equi-join of distinct word n-grams."""

    def grams(df, key):
        w = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda x: x != "")
        rows = df.select(F.col(key), w.alias("w")).filter(F.size("w") >= n)
        g = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.xxhash64(F.array_join(F.slice("w", i, F.lit(n)), " ")))
        return rows.select(key, F.explode(F.array_distinct(g)).alias("g"))

    return grams(docs, doc_id).join(grams(items, item_id), "g").groupBy(doc_id, item_id).agg(F.count(F.lit(1)).alias("n_shared"))


def next_version(versions: DataFrame, prefix: str, cap: int | None = None) -> str:
    """The label after the greatest ``prefix``0.n of the table's version column; 0.1 if there is none."""
    n = versions.agg(F.max(F.regexp_extract("version", rf"^{prefix}0\.(\d+)$", 1).try_cast("int"))).first()[0]
    n = 1 if n is None else n + 1
    return f"{prefix}0.{min(n, cap) if cap else n}"


def append_version(versions: DataFrame, row: dict) -> DataFrame:
    """The table with one more version; a version or a snapshot hash that changed is an error."""
    clash = versions.filter(F.col("version") == row["version"])
    if clash.limit(1).count():
        raise ValueError(f"version {row['version']} exists; versions are immutable")
    return versions.unionByName(versions.sparkSession.createDataFrame([row], versions.schema))


def provenance_chain(fields: dict[str, Column]) -> Column:
    """A struct of provenance fields; what is not known says so."""
    return F.struct(*[F.coalesce(c.cast("string"), F.lit("UNKNOWN (not recorded)")).alias(n) for n, c in fields.items()])


def token_status(version: Column | str) -> Column:
    return F.when(_c(version).isNull(), "PROVISIONAL").otherwise("FINAL")


def is_experiment_id(c: Column | str, prefix: str) -> Column:
    """``prefix``-<code>-NNN with parts of letters and digits and three digits or more."""
    return _c(c).rlike(rf"^{prefix}(?:-[A-Za-z0-9]+)+-[0-9]{{3,}}$")


#: Stage of the curriculum by source type.
def stage(source_type: Column | str, stages: dict[str, int], default: int = 3) -> Column:
    out = F.lit(default)
    for name, n in stages.items():
        out = F.when(_c(source_type) == name, n).otherwise(out)
    return out


def exclude_reasoning(df: DataFrame, source_type: str, experiment: str) -> DataFrame:
    """Reasoning data stays out unless it carries an experiment id."""
    return df.filter((F.col(source_type) != "reasoning") | F.col(experiment).isNotNull() | F.col(source_type).isNull())


def environment() -> dict:
    """Versions for a reproducibility manifest."""
    import pyspark

    return {"python": sys.version.split()[0], "pyspark": pyspark.__version__, "os": platform.platform()}


def reproducibility_manifest(infos: DataFrame, settings: dict) -> DataFrame:
    """One row: environment and settings as JSON, and the source infos as a sorted array (one entry a source)."""
    now = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    head = {"generated_at": now, "environment": environment(), "settings": settings}
    return infos.agg(F.array_sort(F.collect_list(F.struct(*sorted(infos.columns)))).alias("source_infos"), F.count(F.lit(1)).alias("n_sources")).withColumn("manifest", F.lit(json.dumps(head, sort_keys=True)))


def readiness(checks: dict[str, bool], gating: list[str]) -> tuple[str, list[str]]:
    """READY if all gating checks hold, else NOT_READY; and the checks that failed."""
    failed = [k for k, ok in checks.items() if not ok]
    return ("NOT_READY" if set(failed) & set(gating) else "READY"), failed


#: Fields of quality metadata; flags come as booleans or as 0 and 1.
QUALITY_FLAGS = ["ast_valid", "ast_invalid", "generated_or_vendor"]
QUALITY_TEXTS = ["license_status", "token_count_status"]


def quality_metadata(fields: dict[str, Column]) -> Column:
    """map of the given quality fields that are not null, flags as 'true' and 'false'; where none is, four null entries."""
    entries = [
        F.when(fields[n].isNotNull(), F.struct(F.lit(n).alias("key"), (fields[n].cast("boolean").cast("string") if n in QUALITY_FLAGS else fields[n].cast("string")).alias("value")))
        for n in [*QUALITY_FLAGS[:2], *QUALITY_TEXTS, QUALITY_FLAGS[2]]
        if n in fields
    ]
    found = F.map_from_entries(F.array_compact(F.array(*entries))) if entries else F.create_map().cast("map<string,string>")
    none = F.lit(None).cast("string")
    empty = F.create_map(*[x for n in [*QUALITY_FLAGS[:2], *QUALITY_TEXTS] for x in (F.lit(n), none)])
    return F.when(F.size(found) > 0, found).otherwise(empty)


def merged(base: Column, overrides: Column) -> Column:
    """Two maps as one; what the second one has replaces what the first has."""
    kept = F.map_filter(F.coalesce(base, F.create_map().cast("map<string,string>")), lambda k, v: ~F.coalesce(F.map_contains_key(overrides, k), F.lit(False)))
    return F.map_concat(kept, F.coalesce(overrides, F.create_map().cast("map<string,string>")))


def run_steps(spark, steps: list) -> DataFrame:
    """name, ok, error, seconds of each (name, callable), run in order; a step that fails does not stop the others."""
    rows = []
    for name, step in steps:
        began, error = time.monotonic(), None
        try:
            step()
        except Exception as e:  # noqa: BLE001 - whatever a step raises is its result
            error = type(e).__name__
        rows.append((name, error is None, error, time.monotonic() - began))
    return spark.createDataFrame(rows, "name string, ok boolean, error string, seconds double")


def all_hold(conditions: dict[str, Column]) -> Column:
    """Whether every condition holds; an unknown one does not."""
    out = F.lit(True)
    for c in conditions.values():
        out = out & F.coalesce(c, F.lit(False))
    return out
