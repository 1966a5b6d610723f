"""Validation and structural measures of Python sources, in one Arrow pass. Nothing is ever executed."""

from __future__ import annotations

import ast
import io
import re
import tokenize
import warnings
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import spread

FIELDS = [
    ("is_valid", "boolean"), ("error_type", "string"), ("error_message", "string"), ("line_number", "long"), ("column_offset", "long"),
    ("node_count", "long"), ("has_comments", "boolean"), ("has_docstrings", "boolean"), ("comment_ratio", "double"), ("function_count", "long"),
    ("class_count", "long"), ("import_count", "long"), ("loop_count", "long"), ("conditional_count", "long"), ("return_count", "long"),
    ("comment_count", "long"), ("docstring_count", "long"), ("analysis_error_type", "string"), ("analysis_error_message", "string"),
]
VALIDATION_SCHEMA = "struct<" + ", ".join(f"{n}: {t}" for n, t in FIELDS) + ">"
_KIND = {"boolean": pa.bool_(), "string": pa.string(), "long": pa.int64(), "double": pa.float64()}
_GROUPS = {
    "function_count": (ast.FunctionDef, ast.AsyncFunctionDef),
    "class_count": (ast.ClassDef,),
    "import_count": (ast.Import, ast.ImportFrom),
    "loop_count": (ast.For, ast.AsyncFor, ast.While),
    "conditional_count": (ast.If,),
    "return_count": (ast.Return,),
}
_DOCUMENTED = (ast.Module, ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)


def _nodes(tree: ast.AST) -> list[ast.AST]:
    """All nodes of a tree, each as often as it is referred to."""
    out = [tree]
    for node in out:
        for name in node._fields:
            value = getattr(node, name, None)
            if type(value) is list:
                out += [v for v in value if isinstance(v, ast.AST)]
            elif isinstance(value, ast.AST):
                out.append(value)
    return out


def _tokens(source: str):
    return tokenize.generate_tokens(io.StringIO(source).readline)


def tokenised(source) -> tuple[list, Exception | None]:
    """The tokens of a source as far as it can be tokenised, and what stopped that."""
    out: list = []
    try:
        out.extend(_tokens(source or ""))
    except (tokenize.TokenError, SyntaxError) as e:
        return out, e
    return out, None


def validate(source, tokens: tuple[list, Exception | None] | None = None) -> dict:
    """The validation record of one source (``tokens``: those of it, if they are at hand). comment_ratio: lines with a
    comment or docstring over the lines not blank."""
    out = dict.fromkeys((n for n, _ in FIELDS))
    out.update(is_valid=False, has_comments=False, has_docstrings=False, comment_ratio=0.0, node_count=0, comment_count=0, docstring_count=0, **dict.fromkeys(_GROUPS, 0))
    if not isinstance(source, str):
        return out | {"error_type": "internal_error", "error_message": f"source is no text: {type(source).__name__}"}
    if not source.strip():
        return out | {"error_type": "empty_source", "error_message": "the source is empty"}
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(source)
    except SyntaxError as e:
        kind = "indentation_error" if isinstance(e, IndentationError) else "syntax_error"
        return out | {"error_type": kind, "error_message": e.msg, "line_number": e.lineno, "column_offset": e.offset}
    except (ValueError, RecursionError, MemoryError) as e:  # one hostile file must not end the job
        return out | {"error_type": "internal_error", "error_message": f"{type(e).__name__}: {e}"}
    out["is_valid"] = True
    marked: set[int] = set()
    nodes = _nodes(tree)
    kinds = Counter(map(type, nodes))
    out["node_count"] = len(nodes)
    for name, group in _GROUPS.items():
        out[name] = sum(kinds[k] for k in group)
    for node in nodes:
        if type(node) in _DOCUMENTED and node.body:
            first = node.body[0]
            if isinstance(first, ast.Expr) and isinstance(first.value, ast.Constant) and isinstance(first.value.value, str):
                out["docstring_count"] += 1
                marked.update(range(first.lineno, (first.end_lineno or first.lineno) + 1))
    found, error = tokens or tokenised(source)
    if error is None:
        comments = [t.start[0] for t in found if t.type == tokenize.COMMENT]
        out["comment_count"] = len(comments)
        marked.update(comments)
    else:
        out["analysis_error_type"], out["analysis_error_message"] = "tokenize_error", str(error)
    lines = sum(1 for line in source.splitlines() if line.strip())
    out["comment_ratio"] = len(marked) / lines if lines else 0.0
    out["has_comments"], out["has_docstrings"] = out["comment_count"] > 0, out["docstring_count"] > 0
    return out


_SILENT = {tokenize.COMMENT, tokenize.DEDENT, tokenize.ENCODING, tokenize.ENDMARKER, tokenize.INDENT, tokenize.NEWLINE, tokenize.NL}


def significant_tokens(source: str | None, tokens: tuple[list, Exception | None] | None = None) -> int:
    """Tokens that are neither comments nor layout; pieces between white space where the source cannot be tokenised."""
    if not source:
        return 0
    found, error = tokens or tokenised(source)
    return sum(1 for t in found if t.type not in _SILENT) if error is None else len(source.split())


_PAIRS = set("([{")
_BLANK_BEFORE = {"def", "class", "async", "@"}


def style_violations(source: str | None, max_line: int = 79, found: tuple[list, Exception | None] | None = None) -> int:
    """Style violations by the subset of PEP 8 checks that need no outside package.

    E501 long line, W291/W293 trailing white space, W191/E101 tabs, W391 blank line at the end, W292 no line end, E303 too
    many blank lines, E302/E305 missing blank lines at the top level, E701/E702 several statements, E711/E712 comparison
    with a singleton, E231 missing white space after a comma, E261/E262/E265 comment form, E225 operators.
    """
    if not source:
        return 0
    lines = source.split("\n")
    n = 0
    if lines[-1]:
        n += 1  # W292
        body = lines
    else:
        body = lines[:-1]
        n += bool(body) and not body[-1].strip()  # W391
    tabbed = any(line[: len(line) - len(line.lstrip())].count("\t") for line in body)
    for line in body:
        line = line.rstrip("\r")
        n += len(line) > max_line
        n += line != line.rstrip()
        indent = line[: len(line) - len(line.lstrip())]
        n += "\t" in indent
        n += tabbed and " " in indent and "\t" in indent
    tokens, error = found or tokenised(source)
    if error is not None:
        return n + 1
    blank, depth, previous, level, seen, statement = 0, 0, None, 0, False, False
    for i, t in enumerate(tokens):
        after = tokens[i + 1] if i + 1 < len(tokens) else None
        if t.type == tokenize.NL and (previous is None or previous.type in (tokenize.NL, tokenize.NEWLINE)):
            blank += depth == 0
        elif t.type == tokenize.INDENT:
            level += 1
        elif t.type == tokenize.DEDENT:
            level -= 1
        elif t.type not in (tokenize.NEWLINE, tokenize.NL, tokenize.ENDMARKER, tokenize.ENCODING):
            begins = previous is None or previous.type in (tokenize.NEWLINE, tokenize.INDENT, tokenize.DEDENT, tokenize.NL) and depth == 0
            if begins:
                n += blank > (1 if level else 2)  # E303
                if level == 0 and seen and t.type != tokenize.COMMENT:
                    starts = t.string in _BLANK_BEFORE
                    n += (starts and statement != "@" or statement == "body") and blank < 2 and (starts or statement == "body")  # E302, E305
                if t.type != tokenize.COMMENT:
                    seen = True
                    statement = "@" if t.string == "@" else "def" if t.string in ("def", "class", "async") else "plain"
                    if level:
                        statement = "body"
                blank = 0
            if t.type == tokenize.COMMENT:
                inline = bool(t.line[: t.start[1]].strip())
                if inline:
                    n += not t.line[: t.start[1]].endswith("  ")  # E261
                    n += not t.string.startswith("# ") and t.string != "#"  # E262
                else:
                    n += not re.match(r"#(?:[ !:#]|$)", t.string)  # E265
            elif t.type == tokenize.OP:
                if t.string in _PAIRS:
                    depth += 1
                elif t.string in ")]}":
                    depth -= 1
                elif t.string == "," and after is not None and after.start == t.end and after.type not in (tokenize.NL, tokenize.NEWLINE) and after.string not in ")]":
                    n += 1  # E231
                elif t.string == ";":
                    n += 1  # E702
                elif t.string == ":" and depth == 0 and after is not None and after.type not in (tokenize.NEWLINE, tokenize.NL, tokenize.COMMENT):
                    head = t.line.lstrip().split(" ", 1)[0].rstrip(":")
                    n += head in ("if", "for", "while", "def", "class", "try", "else", "elif", "with", "except", "finally") and "lambda" not in t.line[: t.start[1]]  # E701
                elif t.string in ("==", "!=") and after is not None:
                    n += after.string in ("None", "True", "False")  # E711, E712
                    n += not (t.line[t.start[1] - 1 : t.start[1]].isspace() and t.line[t.end[1] : t.end[1] + 1].isspace())  # E225
                elif t.string in ("=", "+=", "-=", "<", ">", "<=", ">=") and depth == 0 and t.start[0] == t.end[0]:
                    n += not (t.line[t.start[1] - 1 : t.start[1]].isspace() and t.line[t.end[1] : t.end[1] + 1].isspace())  # E225
        if t.type not in (tokenize.INDENT, tokenize.DEDENT) or previous is None:
            previous = t
    return n


def with_validation(df: DataFrame, code_col: str, out_col: str = "validation", measures: bool = True, once_by: str | None = None, keep_code: bool = True, is_spread: bool = False) -> DataFrame:
    """``df`` with a struct column of VALIDATION_SCHEMA, and (``measures``) token_count and pep8_violations.

    One pass over Arrow batches and over the tokens of a source; the other columns go through Python untouched, so project
    first. With ``once_by``, a key of the code, a repeated key within a task has nulls in place of what was measured before;
    without ``keep_code`` the code itself is left out. A frame that ``is_spread`` over the cores is not spread again.
    """
    if not keep_code:
        df = df.select(*[c for c in df.columns if c != code_col], code_col)
    names = [f.name for f in df.schema.fields]
    names = names if keep_code else [n for n in names if n != code_col]
    columns = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
    extra = ", token_count long, pep8_violations long" if measures else ""

    def run(batches):
        seen: set = set()
        for batch in batches:
            sources = batch.column(code_col).to_pylist()
            new = [True] * len(sources)
            if once_by:
                for i, key in enumerate(batch.column(once_by).to_pylist()):
                    new[i] = key not in seen
                    seen.add(key)
            tokens = [tokenised(s) if n and isinstance(s, str) else None for s, n in zip(sources, new)]
            records = [validate(s, t) if n else None for s, t, n in zip(sources, tokens, new)]
            struct = pa.StructArray.from_arrays([pa.array([r and r[n] for r in records], _KIND[t]) for n, t in FIELDS], [n for n, _ in FIELDS], mask=pa.array([not n for n in new]))
            out = [*(batch.column(n) for n in names), struct]
            labels = [*names, out_col]
            if measures:
                out += [
                    pa.array([significant_tokens(s, t) if n else None for s, t, n in zip(sources, tokens, new)], pa.int64()),
                    pa.array([style_violations(s, found=t) if n else None for s, t, n in zip(sources, tokens, new)], pa.int64()),
                ]
                labels += ["token_count", "pep8_violations"]
            yield pa.RecordBatch.from_arrays(out, labels)

    return (df if is_spread else spread(df)).mapInArrow(run, f"{columns}, `{out_col}` {VALIDATION_SCHEMA}{extra}")


def failure_reason(validation: str = "validation"):
    """A short reason from a validation record; null for a valid one without remarks."""
    v = F.col(validation)
    syntax = F.when(~v["is_valid"], F.concat_ws(" | ", F.concat(F.lit("syntax/"), v["error_type"]), v["error_message"]))
    analysis = F.when(v["analysis_error_type"].isNotNull(), F.concat(F.lit("analysis/"), v["analysis_error_type"]))
    text = F.concat_ws(" | ", syntax, analysis)
    return F.when(text != "", text)
