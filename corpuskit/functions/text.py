"""String, hash and name functions as Column expressions; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as Python's strip() sees it (Java's \s and trim() know less). The look-ahead settles printable ASCII,
# nearly all characters, by one comparison before the class is tried member by member.
_CLASS = r"[\t{lf}\x0b\f\r\x1c-\x1f \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]"
SPACE = "(?:(?![!-~])" + _CLASS.format(lf=r"\n") + ")"
SPACE_NO_LF = "(?:(?![!-~])" + _CLASS.format(lf="") + ")"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without outer Unicode white space."""
    return F.regexp_replace(_c(c), rf"\A{SPACE}+|{SPACE}+\z", "")


def unify_newlines(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), "\r\n?", "\n")


def normalize_code(c: Column | str) -> Column:
    """Line ends as LF, outer white space removed."""
    return strip(unify_newlines(c))


def exact_hash(c: Column | str) -> Column:
    return F.sha2(normalize_code(c), 256)


def raw_hash(c: Column | str) -> Column:
    return F.sha2(_c(c), 256)


def normalized_text(c: Column | str) -> Column:
    """LF line ends, no trailing white space on lines, runs of blank lines as one blank line.

    A closed form without look-around: the ends of the text need rules of their own, as a blank first line and the
    empty piece after a last line end each count as a blank line.
    """
    x = unify_newlines(c)
    x = F.regexp_replace(x, rf"{SPACE_NO_LF}+\n", "\n")
    x = F.regexp_replace(x, rf"{SPACE_NO_LF}+\z", "")
    x = F.regexp_replace(x, "\n{3,}", "\n\n")
    x = F.when(x.rlike(r"\A\n+\z"), "").otherwise(x)
    x = F.regexp_replace(x, r"\A\n{2,}", "\n")
    return F.regexp_replace(x, r"\n{2,}\z", "\n")


def normalized_hash(c: Column | str) -> Column:
    return F.sha2(normalized_text(c), 256)


def rstripped_lines(c: Column | str) -> Column:
    """CRLF to LF, every line without trailing white space (a lone CR inside a line stays)."""
    x = F.regexp_replace(_c(c), "\r\n", "\n")
    x = F.regexp_replace(x, rf"{SPACE_NO_LF}+\n", "\n")
    return F.regexp_replace(x, rf"{SPACE_NO_LF}+\z", "")


def line_hash(c: Column | str) -> Column:
    """The canonical deduplication key: hash of the lines without trailing white space."""
    return F.sha2(rstripped_lines(c), 256)


def without_docstrings(c: Column | str) -> Column:
    """Triple double quoted spans removed with their quotes; an unclosed one reaches to the end."""
    return F.array_join(F.filter(F.split(rstripped_lines(c), '"""', -1), lambda v, i: i % 2 == 0), "")


def content_hash(c: Column | str) -> Column:
    return F.sha2(without_docstrings(c), 256)


def answer_hash(c: Column | str) -> Column:
    return F.sha2(F.lower(strip(c)), 256)


def package_hash(files: Column | str) -> Column:
    """Hash of a package from array<struct<path, code>>: the code without docstrings in the order of the paths."""
    return F.sha2(F.array_join(F.transform(F.array_sort(_c(files)), lambda f: without_docstrings(f["code"])), "\n"), 256)


def package_name(c: Column | str) -> Column:
    """Runs of hyphen, underscore and dot as one hyphen, in lower case."""
    return F.lower(F.regexp_replace(_c(c), "[-_.]+", "-"))


def package_record_id(name: Column | str, version: Column | str) -> Column:
    return F.concat_ws(":", F.lit("pypi"), F.regexp_replace(F.lower(_c(name)), "[-.]", "_"), _c(version))


def record_id(prefix: str, *parts: Column | str) -> Column:
    """``prefix`` and the parts joined by colons."""
    return F.concat_ws(":", F.lit(prefix), *[_c(p).cast("string") for p in parts])


def archive_version(filename: Column | str) -> Column:
    """The version a source archive's name ends with; null if what stands there begins with no digit."""
    stem = F.regexp_replace(_c(filename), r"\.tar\.gz|\.tgz|\.whl", "")
    tail = F.substring_index(F.substring_index(stem, "-", -1), "_", -1)
    return F.when(tail.rlike("^[0-9]"), tail)


def wheel_parts(filename: Column | str) -> Column:
    """struct<package, version> of a wheel's name; nulls if it is none."""
    pattern = r"^(.+?)-(\d[^-]*?)(?:-[^-.]+)?-([^-]+)-([^-]+)-[^/]+\.whl$"
    f = _c(filename)
    ok = f.rlike(pattern)
    return F.struct(
        F.when(ok, F.lower(F.regexp_replace(F.regexp_extract(f, pattern, 1), "_", "-"))).alias("package"),
        F.when(ok, F.regexp_extract(f, pattern, 2)).alias("version"),
    )


def sdist_version(filename: Column | str) -> Column:
    stem = F.regexp_replace(_c(filename), r"\.tar\.gz$|\.zip$", "")
    found = F.regexp_extract(stem, r"[-_]([0-9][0-9A-Za-z.+-]*(?:\.dev[0-9]*)?)$", 1)
    return F.when(found != "", found)


def metadata_field(text: Column | str, field: str) -> Column:
    """The first ``field: value`` line of a metadata file."""
    found = F.regexp_extract(_c(text), rf"(?m)^{field}:(.*)$", 1)
    return F.when(strip(found) != "", strip(found))


def docs_version(name: Column | str) -> Column:
    found = F.regexp_extract(_c(name), r"python-([0-9][A-Za-z0-9.]+)-docs", 1)
    return F.when(found != "", found)


def docs_archive_link(html: Column | str) -> Column:
    """The first link to an archive of HTML documentation in an index page."""
    found = F.regexp_extract(_c(html), r"href=[\"']([^\"']*python-[0-9][^/\"']*-docs-html\.zip)[\"']", 1)
    return F.when(found != "", found)


def parse_tags(c: Column | str) -> Column:
    """Tags of a bar-separated string: trimmed, empty ones dropped; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), r"\|", -1), strip)
    return F.filter(parts, lambda x: x != "")


def clean_tags(c: Column | str) -> Column:
    """The same for tags that come as an array."""
    return F.filter(F.transform(F.coalesce(_c(c), F.array().cast("array<string>")), strip), lambda x: x.isNotNull() & (x != ""))


def before_bar(c: Column | str) -> Column:
    return F.substring_index(_c(c), "|", 1)


def strip_html_tags(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), "<[^>]+>", "\n")


def strip_doctest_prompts(c: Column | str) -> Column:
    """The input lines of a doctest transcript without their prompts; output lines are dropped."""
    lines = F.transform(F.split(unify_newlines(c), "\n", -1), lambda s: F.regexp_replace(s, rf"\A{SPACE}+", ""))
    kept = F.filter(lines, lambda s: s.startswith(">>> ") | s.startswith("... ") | s.isin(">>>", "..."))
    return F.array_join(F.transform(kept, lambda s: F.when(s.isin(">>>", "..."), "").otherwise(F.substr(s, F.lit(5)))), "\n")


def header_fields(c: Column | str, fields: dict[str, str]) -> Column:
    """map of the ``Key: value`` lines before the first blank line; unknown keys are dropped, the last of equal keys wins."""
    lines = F.split(F.element_at(F.split(unify_newlines(c), rf"(?:\A|\n){SPACE_NO_LF}*(?:\n|\z)", 2), 1), "\n", -1)
    known = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    pairs = F.transform(
        F.filter(lines, lambda s: F.instr(s, ": ") > 0),
        lambda s: F.struct(
            known[F.lower(F.regexp_replace(strip(F.substring_index(s, ": ", 1)), "^:+", ""))].alias("k"),
            strip(F.substr(s, F.instr(s, ": ") + 2)).alias("v"),
        ),
    )
    pairs = F.filter(pairs, lambda p: p["k"].isNotNull())
    # the last of equal keys: those that no later entry repeats
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def split_chapters(c: Column | str) -> Column:
    """array<struct<title, text>> of the ``\\chapter{...}`` sections; what stands before the first is dropped."""
    pieces = F.split(_c(c), r"(?=\\chapter\{)", -1)
    kept = F.filter(pieces, lambda s: s.startswith("\\chapter{"))
    return F.transform(kept, lambda s: F.struct(F.regexp_extract(s, r"\A\\chapter\{([^}]*)\}", 1).alias("title"), s.alias("text")))


#: Directory names of file categories, in the order in which they are tried.
FILE_CATEGORIES = {
    "vendor": ["vendor", "third_party", "third-party", "_vendor", "bundled", "vendored"],
    "test": ["tests", "test", "testing", "unittests"],
    "example": ["examples", "example", "demos", "demo"],
    "docs": ["docs", "doc", "documentation"],
    "generated": ["generated", ".generated", "build", "dist", "__pycache__"],
}


def file_category(path: Column | str) -> Column:
    """Category of a file by the parts of its path; 'source' for all others."""
    parts = F.split(F.lower(_c(path)), "/")
    out = F.lit("source")
    for name, folders in reversed(FILE_CATEGORIES.items()):
        out = F.when(F.arrays_overlap(parts, F.array(*map(F.lit, folders))), name).otherwise(out)
    return out


def size_to_gb(c: Column | str) -> Column:
    """Gigabytes (of 1024^3 bytes) of sizes such as '4.9 TiB', '512M' or '100'; null if there is no number."""
    m = F.regexp_extract(strip(c), r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*([kmgtp]?)i?b?(?:ytes)?$", 1)
    unit = F.lower(F.regexp_extract(strip(c), r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*([kmgtp]?)i?b?(?:ytes)?$", 2))
    power = F.when(unit == "k", -2).when(unit == "m", -1).when(unit == "g", 0).when(unit == "t", 1).when(unit == "p", 2).otherwise(-3)
    return F.when(m != "", m.cast("double") * F.pow(F.lit(1024.0), power))


def join_url(base: str, relative: Column | str) -> Column:
    """A plain relative path below the directory of ``base``."""
    return F.concat(F.lit(base[: base.rfind("/") + 1]), _c(relative))


def owner_and_repo(c: Column | str) -> Column:
    """struct<owner, repo> of 'owner__repo', split at the first double underscore; nulls without one."""
    parts = F.split(_c(c), "__", 2)
    ok = F.size(parts) == 2
    return F.struct(F.when(ok, F.get(parts, F.lit(0))).alias("owner"), F.when(ok, F.get(parts, F.lit(1))).alias("repo"))


def is_commit(c: Column | str) -> Column:
    return _c(c).rlike("^[0-9a-f]{40}$")


def map_path(path: Column | str, local: str, remote: str, legacy: str | None = None) -> Column:
    """A path moved from one root to another; a path below neither root is an error."""
    p = _c(path)
    out = F.when(p.startswith(local), F.concat(F.lit(remote), F.substr(p, F.lit(len(local) + 1))))
    if legacy:
        out = out.when(p.startswith(legacy), F.concat(F.lit(remote), F.substr(p, F.lit(len(legacy) + 1))))
    return out.when(p.isNotNull(), F.raise_error(F.concat(F.lit("path outside of the root: "), p)))


#: File name parts that tell a source type, in the order in which they are tried.
SOURCE_TYPES = [
    ("python_docs", ["python_docs", "python-docs"]),
    ("textbooks", ["thinkpython", "atbs", "textbook"]),
    ("stackoverflow", ["stackoverflow"]),
    ("pypi", ["pypi"]),
    ("github", ["github"]),
    ("the_stack", ["the_stack"]),
    ("codesearchnet", ["codesearchnet"]),
    ("jupyter", ["jupyter"]),
    ("reasoning", ["reasoning"]),
    ("reddit", ["reddit"]),
]


def source_type(name: Column | str) -> Column:
    low, out = F.lower(_c(name)), F.lit("unknown")
    for label, parts in reversed(SOURCE_TYPES):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(low, F.lit(p))
        out = F.when(hit, label).otherwise(out)
    return out
