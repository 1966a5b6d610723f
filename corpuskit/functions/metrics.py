"""Measures of texts and code as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.text import SPACE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lines(c):
    return F.split(_c(c), "\n", -1)


def comment_line_ratio(c: Column | str) -> Column:
    """Share of lines that begin with # after white space, of all lines; rounded to four places."""
    n = F.size(F.filter(_lines(c), lambda s: s.rlike(rf"\A{SPACE}*#")))
    return F.round(n / F.size(_lines(c)), 4)


def docstring_line_ratio(c: Column | str) -> Column:
    """Share of lines with three double quotes, of all lines; rounded to four places."""
    return F.round(F.size(F.filter(_lines(c), lambda s: F.contains(s, F.lit('"""')))) / F.size(_lines(c)), 4)


def tokens_by_chars(c: Column | str) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(_c(c)) / 4)).cast("long")


def tokens_of_chars(total: Column | str) -> Column:
    """Tokens of a number of characters at 4.5 characters each."""
    return F.floor(_c(total) / 4.5).cast("long")


def tokens_of_bytes(total: Column | str) -> Column:
    """Tokens of a number of bytes at 1.8 bytes each."""
    return F.floor(_c(total) / 1.8).cast("long")


def tokens_of_lines(lines: Column | str) -> Column:
    """Tokens of lines of code at 60 characters a line and 4 a token."""
    return F.floor(_c(lines) * 60 / 4).cast("long")


def tokens_of_kilobytes(kb: Column | str) -> Column:
    return F.floor(_c(kb) * 1024 / 4).cast("long")


def words(c: Column | str) -> Column:
    """Number of pieces between white space."""
    return F.size(F.filter(F.split(_c(c), rf"{SPACE}+", -1), lambda x: x != "")).cast("long")


def has_code(c: Column | str) -> Column:
    return F.contains(_c(c), F.lit("```")) | F.contains(F.lower(_c(c)), F.lit("<code>"))


#: Words that make a text look like Python, and marks of generated or foreign code.
PYTHON_WORDS = ["def ", "import ", "class ", "print(", "range(", "if ", "for ", "while ", "return "]
GENERATED_MARKS = ["do not edit", "generated", "autogenerated", "third_party"]
PACKAGE_GENERATED_MARKS = ["autogenerated", "generated by", "do not edit", "machine-generated", "warning: generated"]
HEADER_MARKS = ["DO NOT EDIT", "GENERATED", "AUTOGENERATED"]
GENERATED_FILES = ["_pb2.py", "_pb2_grpc.py", "_version.py"]
VENDOR_FOLDERS = ["vendor", "third_party", "third-party", "_vendor", "bundled", "vendored"]


def contains_any(c: Column, values: list[str]) -> Column:
    out = F.lit(False)
    for v in values:
        out = out | F.contains(c, F.lit(v))
    return out


def looks_like_python(c: Column | str) -> Column:
    return contains_any(F.lower(_c(c)), PYTHON_WORDS)


def has_function(code: Column | str, comment: Column | str | None = None) -> Column:
    out = F.contains(F.lower(_c(code)), F.lit("def "))
    return out if comment is None else out | F.contains(F.lower(_c(comment)), F.lit("def "))


def has_generated_mark(c: Column | str) -> Column:
    return contains_any(F.lower(_c(c)), GENERATED_MARKS)


def is_generated_or_vendor(path: Column | str, text: Column | str) -> Column:
    """By a part of the path, the file's name, or a mark in its text."""
    parts = F.split(F.lower(_c(path)), "/")
    name = F.element_at(F.split(_c(path), "/"), -1)
    return (
        F.arrays_overlap(parts, F.array(*map(F.lit, VENDOR_FOLDERS)))
        | name.isin(*GENERATED_FILES)
        | F.coalesce(contains_any(F.lower(_c(text)), PACKAGE_GENERATED_MARKS), F.lit(False))
    )


def has_generated_header(text: Column | str) -> Column:
    """A mark, as it is written, in the first five lines."""
    return contains_any(F.array_join(F.slice(_lines(text), 1, 5), "\n"), HEADER_MARKS)


def code_lines(c: Column | str) -> Column:
    """Lines that are neither blank nor comments."""
    return F.size(F.filter(_lines(c), lambda s: ~s.rlike(rf"\A{SPACE}*(?:#(?s:.*))?\z"))).cast("long")


def all_lines(c: Column | str) -> Column:
    """Lines of a text; the end of the last line opens no further one."""
    n = F.size(_lines(c)) - F.when(F.endswith(_c(c), F.lit("\n")) | (_c(c) == ""), 1).otherwise(0)
    return n.cast("long")


def is_binary(c: Column | str, within: int = 4096) -> Column:
    """A NUL character among the first ``within``."""
    return F.contains(F.substring(_c(c), 1, within), F.lit("\x00"))


def to_int(c: Column | str) -> Column:
    """A whole number, 0 for what is none."""
    return F.coalesce(_c(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_float(c: Column | str) -> Column:
    return F.coalesce(_c(c).try_cast("double"), F.lit(0.0))
