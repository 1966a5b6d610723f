"""Source files that do not parse (problem 1).

Method: generalised LL parsing with a graph-structured stack (``gll``), all dialects of a language in one parse. A text
is a case where every supported dialect's grammar rejects it; nothing else decides. What the exact parser of the language
(Python's own ``ast.parse``, ``json``, ``tomllib``, expat) has against a rejected text is its ``error``; a text that this
parser takes all the same is ``disputed``, which ``rates`` counts.

For Python the supported dialect is 3.13; ``dialects`` tells which of the known ones accept a text, so files of an older
one can be told from broken ones. Defined results: null, empty and blank texts are no cases and have no verdict; files
of other extensions are not looked at; repeated rows of an item count once; null ids are kept as one item; empty tables
give empty tables; other columns are not read.
"""

from __future__ import annotations

import ast
import json
import tomllib
import warnings
import xml.parsers.expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.arrow import small_batches
from corpuskit.llm.mixing import source_name
from corpuskit.llm.syntax import data, python
from corpuskit.session import spread

#: Extension -> language.
LANGUAGES = {"py": "python", "json": "json", "toml": "toml", "xml": "xml"}


def _no_constant(name):
    raise ValueError(name)


def exact_error(language: str, text: str) -> str | None:
    """What the exact parser of the language has against a text; None if it accepts it."""
    try:
        if language == "python":
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(text)
        elif language == "json":
            json.loads(text, parse_constant=_no_constant, parse_int=float)  # int has a limit of digits
            if text.startswith("\ufeff"):
                return "ValueError"
        elif language == "toml":
            tomllib.loads(text)
        else:
            xml.parsers.expat.ParserCreate().Parse(text, True)
    except (SyntaxError, ValueError, xml.parsers.expat.ExpatError, RecursionError, MemoryError) as e:
        return type(e).__name__
    return None


def accepted(language: str, text: str) -> int:
    """Bit mask of the dialects that accept a text; other languages than Python have one."""
    if language == "python":
        return python.parse(text)
    parse = {"json": data.parse_json, "toml": data.parse_toml, "xml": data.parse_xml}[language]
    return int(parse(text))


def verdicts(df: DataFrame, keys: list[str], language_col: str, text_col: str) -> DataFrame:
    """keys, language, parses, dialects (names that accept), error, disputed: one row for each row with a text and a language."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    rows = df.select(*keys, F.col(language_col).alias("_language"), F.col(text_col).alias("_text"))
    rows = rows.filter(F.col("_language").isin(*LANGUAGES.values()) & F.col("_text").isNotNull() & F.col("_text").rlike(r"\S"))

    def run(batches):
        for batch in small_batches(batches, "_text"):
            languages, texts = batch.column("_language").to_pylist(), batch.column("_text").to_pylist()
            parses, names, errors, disputed = [], [], [], []
            for language, text in zip(languages, texts):
                mask = accepted(language, text)
                error = None if mask & 1 else exact_error(language, text)
                parses.append(bool(mask & 1))
                errors.append(error)
                disputed.append(not mask & 1 and error is None)
                names.append([n for i, n in enumerate(python.DIALECTS) if mask >> i & 1] if language == "python" else [language] * bool(mask & 1))
            verdict = [pa.array(parses), pa.array(names, pa.list_(pa.string())), pa.array(errors, pa.string()), pa.array(disputed)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), batch.column("_language"), *verdict], [*keys, "language", "parses", "dialects", "error", "disputed"]
            )

    return spread(rows).mapInArrow(run, f"{schema}, language string, parses boolean, dialects array<string>, error string, disputed boolean")


def file_language(path_col: str = "path"):
    """The language of a file by its extension, null for others."""
    extension = F.lower(F.regexp_extract(path_col, r"\.([^./]*)$", 1))
    out = F.lit(None).cast("string")
    for e, language in LANGUAGES.items():
        out = F.when(extension == e, language).otherwise(out)
    return out


def corpus_verdicts(code: DataFrame, files: DataFrame) -> DataFrame:
    """Verdicts of code blocks and repository files: item_table, item_id, origin (source or repository id), and the verdict."""
    blocks = code.select(F.lit("python_tutorial_code").alias("item_table"), F.col("record_id").alias("item_id"), source_name("source").alias("origin"), F.lit("python").alias("lang"), F.col("code").alias("text"))
    trees = files.select(F.lit("repo_files").alias("item_table"), F.col("file_id").alias("item_id"), F.col("repo_id").cast("string").alias("origin"), file_language().alias("lang"), F.col("content").alias("text"))
    both = verdicts(blocks.unionByName(trees), ["item_table", "item_id", "origin"], "lang", "text")
    return both.dropDuplicates(["item_table", "item_id"])


def rates(found: DataFrame) -> DataFrame:
    """Items, rejected items, their share, and those of them that the exact parser takes, by item_table, origin and language."""
    return found.groupBy("item_table", "origin", "language").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.when(F.col("parses"), 0).otherwise(1)).alias("n_rejected"),
        F.avg(F.when(F.col("parses"), 0.0).otherwise(1.0)).alias("rejected_rate"),
        F.count_if("disputed").alias("n_disputed"),
    )


def against_recorded(found: DataFrame, recorded: DataFrame) -> DataFrame:
    """Verdicts against those of earlier runs: counts by parses, recorded verdict and recorded error type."""
    latest = recorded.groupBy("record_id").agg(F.max_by(F.struct("is_valid", "error_type"), "validated_at").alias("r"))
    rows = found.filter("item_table = 'python_tutorial_code'").join(latest, F.col("item_id") == F.col("record_id"), "left")
    return rows.groupBy("parses", F.col("r.is_valid").alias("recorded_valid"), source_name("r.error_type").alias("recorded_error")).agg(F.count(F.lit(1)).alias("n_items"))
