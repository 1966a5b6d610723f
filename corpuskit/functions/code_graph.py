"""Entities of Python sources and how they are related, in one Arrow pass. Nothing is ever executed."""

from __future__ import annotations

import ast
import warnings

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import spread


def relations(source: str | None) -> list[tuple[str, str, str]]:
    """(entity, relation, target) of a source: what it and its classes define, what they inherit, what it imports.

    The source itself is the entity ''. A source that does not parse has none.
    """
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(source or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    out, todo = [], [("", tree)]
    while todo:
        owner, node = todo.pop()
        for child in ast.iter_child_nodes(node):
            inner = owner
            if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                inner = f"{owner}.{child.name}" if owner else child.name
                out.append((owner, "defines_class" if isinstance(child, ast.ClassDef) else "defines_function", inner))
                if isinstance(child, ast.ClassDef):
                    out += [(inner, "inherits", ast.unparse(b)) for b in child.bases]
            elif isinstance(child, ast.Import):
                out += [("", "imports", a.name) for a in child.names]
            elif isinstance(child, ast.ImportFrom):
                base = "." * child.level + (child.module or "")
                out += [("", "imports", base if a.name == "*" else f"{base}.{a.name}" if child.module else base + a.name) for a in child.names]
            todo.append((inner, child))
    return sorted(set(out))


def code_relations(df: DataFrame, key_col: str, code_col: str) -> DataFrame:
    """key, entity, relation, target of every source, each once; sources that are null or do not parse have no row."""
    key_type = df.schema[key_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            at, rows = [], []
            for i, source in enumerate(batch.column("code").to_pylist()):
                got = relations(source)
                at += [i] * len(got)
                rows += got
            cols = [pa.array([r[k] for r in rows], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int64())), *cols], ["key", "entity", "relation", "target"])

    rows = spread(df.select(F.col(key_col).alias("key"), F.col(code_col).alias("code")).filter("code is not null"))
    out = rows.mapInArrow(run, f"key {key_type}, entity string, relation string, target string").distinct()
    return out.withColumnRenamed("key", key_col)
