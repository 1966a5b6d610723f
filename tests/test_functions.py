import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import metrics, python_source, similarity, text
from corpuskit.functions.html import page_blocks


def column(spark, values, *exprs):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [tuple(r)[1:] for r in df.select("i", *[e.alias(f"e{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()]


EDGES = ["", "\n", "\n\n", "a", "a\n", "a\n\n\n", "\n\na", "a  \n\t\n \n\nb\n", "a\r\n\r\n\r\nb\r", "  \n  ", "x\n\n", "\r\r\ry", "\u00a0a\u3000\n", "def f():\r\n    pass\r\n"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def blank_lines_once(code):
    out = []
    for line in code.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        line = line.rstrip()
        if line or not out or out[-1]:
            out.append(line)
    return "\n".join(out)


def test_hashes(spark):
    got = column(spark, EDGES, text.exact_hash("x"), text.normalized_hash("x"), text.line_hash("x"), text.answer_hash("x"), text.raw_hash("x"))
    for value, (exact, normal, line, answer, raw) in zip(EDGES, got):
        assert exact == sha(value.replace("\r\n", "\n").replace("\r", "\n").strip())
        assert normal == sha(blank_lines_once(value)), repr(value)
        assert line == sha("\n".join(x.rstrip() for x in value.replace("\r\n", "\n").split("\n")))
        assert answer == sha(value.strip().lower()) and raw == sha(value)


def test_docstrings_are_cut_out(spark):
    values = ['a"""b"""c', 'a"""b', "a'''b'''c", '"""x"""', "plain", '"""a""" """b']
    got = [r[0] for r in column(spark, values, text.without_docstrings("x"))]
    assert got == ["ac", "a", "a'''b'''c", "", "plain", " "]


def test_names_and_versions(spark):
    values = ["absl-py-0.1.0.tar.gz", "Events-0.1.0.tar.gz", "", "not-a-version.tar.gz", "a_b-1.0-py3-none-any.whl"]
    got = column(spark, values, text.archive_version("x"), text.wheel_parts("x")["package"], text.wheel_parts("x")["version"], text.package_name("x"))
    assert [g[0] for g in got] == ["0.1.0", "0.1.0", None, None, None]
    assert got[4][1:3] == ("a-b", "1.0") and got[0][1:3] == (None, None)
    assert column(spark, ["A__b-.c"], text.package_name("x"), text.package_record_id("x", F.lit("1")))[0] == ("a-b-c", "pypi:a__b__c:1")
    assert column(spark, ["4.9 TiB", "512M", "100", "x", "1 GB"], text.size_to_gb("x")) == [(4.9 * 1024,), (0.5,), (100 / 1024**3,), (None,), (1.0,)]
    assert column(spark, ["a__b__c", "ab"], text.owner_and_repo("x")["owner"], text.owner_and_repo("x")["repo"]) == [("a", "b__c"), (None, None)]
    assert column(spark, ["python-3.14-docs-html.zip", "x"], text.docs_version("x")) == [("3.14",), (None,)]
    assert column(spark, ["a" * 40, "g" * 40, "a"], text.is_commit("x")) == [(True,), (False,), (False,)]


def test_tags_headers_and_chapters(spark):
    assert column(spark, ["a| b ||c", None, ""], text.parse_tags("x")) == [(["a", "b", "c"],), ([],), ([],)]
    fields = {"pep": "pep", "title": "title", "author": "authors", "status": "status"}
    header = "PEP: 1\nTitle: Test: A\n:Author: A, B\nOther: x\nPEP: 2\nStatus: Active\n\nTitle: Body"
    assert column(spark, [header], text.header_fields("x", fields))[0][0] == {"pep": "2", "title": "Test: A", "authors": "A, B", "status": "Active"}
    got = column(spark, ["pre \\chapter{One} a \\chapter{Two} b", "none"], text.split_chapters("x"))
    assert [(c.title, c.text) for c in got[0][0]] == [("One", "\\chapter{One} a "), ("Two", "\\chapter{Two} b")] and got[1][0] == []
    assert column(spark, [">>> value = 1\n>>> value\n1\n>>>\n  ... x"], text.strip_doctest_prompts("x")) == [("value = 1\nvalue\n\nx",)]


def test_categories(spark):
    values = ["a/tests/b.py", "vendor/tests/a.py", "docs/x", "Build/x", "src/a.py", "examples/a"]
    assert [r[0] for r in column(spark, values, text.file_category("x"))] == ["test", "vendor", "docs", "generated", "source", "example"]
    assert [r[0] for r in column(spark, ["my_pypi_dump", "thinkpython_github", "x"], text.source_type("x"))] == ["pypi", "textbooks", "unknown"]


def test_measures(spark):
    values = ["# a\nx = 1\n", '"""d"""\n\n', "x", "a\r# b", "#GENERATED\n" + "y\n" * 9]
    got = column(spark, values, metrics.comment_line_ratio("x"), metrics.docstring_line_ratio("x"), metrics.tokens_by_chars("x"), metrics.words("x"), metrics.code_lines("x"), metrics.all_lines("x"), metrics.has_generated_header("x"))
    for v, (comment, doc, tokens, words, code, lines, mark) in zip(values, got):
        rows = v.split("\n")
        assert comment == round(sum(r.lstrip().startswith("#") for r in rows) / len(rows), 4)
        assert doc == round(sum('"""' in r for r in rows) / len(rows), 4)
        assert tokens == max(1, len(v) // 4) and words == len(v.split())
        assert code == sum(bool(r.strip()) and not r.strip().startswith("#") for r in rows)
        assert lines == len(rows) - (rows[-1] == "") and mark == ("GENERATED" in v)


def test_similarity(spark):
    values = ["Hello, world", "hello world", "ab", "completely different text"]
    df = similarity.with_trigrams(spark.createDataFrame([(v,) for v in values], "x string"), "x")
    sets = {r.x: set(r.trigrams) for r in df.collect()}
    for v in values:
        t = re.sub(r"[^\w\s]|_", "", v.lower())
        assert sets[v] == {t[i : i + 3] for i in range(len(t) - 2)}
    prints = {r.i: r.simhash for r in similarity.simhash(spark.createDataFrame([(i, v) for i, v in enumerate(["a b c d", "a b c d", "# only", "x"])], "i int, x string"), "i", "x").collect()}
    assert prints[0] == prints[1] and 2 not in prints
    word = int(hashlib.md5(b"x").hexdigest()[:16], 16)
    assert prints[3] == (word - (1 << 64) if word >> 63 else word)


CASES = {
    "def add(a, b):\n    return a + b\n": dict(is_valid=True, function_count=1, return_count=1, error_type=None),
    "def add(a, b)\n    return a + b\n": dict(is_valid=False, error_type="syntax_error", line_number=1),
    "def add(a, b):\nreturn a + b\n": dict(is_valid=False, error_type="indentation_error"),
    "": dict(is_valid=False, error_type="empty_source"),
    " \n\t\n": dict(is_valid=False, error_type="empty_source"),
    "# calculate result\nx = 1\n": dict(has_comments=True, comment_count=1, has_docstrings=False, comment_ratio=0.5),
    '"""m"""\nclass A:\n    """c"""\n    def f(self):\n        """d"""\n': dict(docstring_count=3, class_count=1, function_count=1),
    "# привет\nзначение = 1\n": dict(is_valid=True, comment_count=1),
    "raise RuntimeError('must not execute')\n": dict(is_valid=True),
    "x = 1\x00": dict(is_valid=False),
}


@pytest.mark.parametrize("source", list(CASES))
def test_validation(source):
    got = python_source.validate(source)
    assert {k: got[k] for k in CASES[source]} == CASES[source]


def test_validation_in_batches(spark):
    rows = [(i, s) for i, s in enumerate(CASES)] + [(99, None)]
    got = python_source.with_validation(spark.createDataFrame(rows, "i int, code string"), "code").orderBy("i").collect()
    assert [r.validation.is_valid for r in got][:3] == [True, False, False] and got[-1].validation.error_type == "internal_error"
    assert python_source.style_violations("def f(a, b):\n    # note\n    return a + b\n") == 0
    assert python_source.style_violations("x=1;y = 2 \n") >= 3 and python_source.style_violations("x" * 90 + "\n") == 1
    assert python_source.significant_tokens("x = 1  # c\n") == 3 and python_source.significant_tokens("'''open x") == 2


PAGE = """<html><title>T</title><h1>Top</h1><h2>Part</h2><p>Some text.</p><div class="highlight-python notranslate"><div class="highlight"><pre>x = 1\n</pre></div></div>
<div class="highlight-pycon"><pre>&gt;&gt;&gt; v = 1\n1\n</pre></div><div class="highlight-bash"><pre>ls</pre></div><div class="highlight-python"><pre>def f(</pre></div></html>"""


def test_html_blocks():
    got = page_blocks(PAGE)
    assert [b["raw"].strip() for b in got] == ["x = 1", "x = 1", ">>> v = 1\n1", "def f("]
    assert got[0]["section"] == "Part" and got[0]["context"] == "Top Part Some text." and got[2]["detection_method"] == "doctest"
    assert page_blocks(None) == [] and page_blocks("") == []
