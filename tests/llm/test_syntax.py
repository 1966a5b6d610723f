import ast
import json
import random
import re
import textwrap
import tomllib
import warnings

import pytest
from pyspark.sql import functions as F

from corpuskit.llm.syntax import data, operator, python
from corpuskit.llm.syntax.gll import Grammar

warnings.simplefilter("ignore")
VALID = [
    "x = 1\n", "def f(a, /, b=1, *c, d, **e) -> int:\n    return a\n", "async def f():\n    async with a as b, c: pass\n    return [x async for x in y]\n",
    "match x:\n    case [1, *r] if r: pass\n    case {'a': int(v), **k}: pass\n    case _: pass\n", "match = case = type = 1\nprint(match)\n", "type A[T: int, *S, **P] = dict[T, P]\n",
    "f'{x!r:>{w}} {y=} {{}} {d[\"k\"]}'\n", "f'''{\nx}'''\n", "try:\n  a\nexcept* E as e:\n  b\nelse: c\nfinally: d\n", "with (open(a) as b, c): pass\n", "lambda *a, b=1, **c: (yield)\n",
    "x: list[int] = []\n(y): int\n", "a, *b = c = d\n", "del (a, [b]), c.d, e[0]\n", "if (n := 1): pass\nelif x: pass\nelse:\n\tpass\n", "@a.b(c)\n@d\nclass E(F, metaclass=G): '''doc'''\n", "return\n",
    "x = [i for i in range(3) if i if not i]\n", "f(*a, **b, c=1)\nf(x for x in y)\n", "a = b'x' b'y'\n", "1if x else 2\n", "x[1:2, ::3, *a]\n", "é = 'ü'\n", "# only a comment", "x = \\\n  1\n",
]
INVALID = [
    "x = ", "def f(:\n", "def f(a=1, b): pass\n", "f(a=1, b)\n", "print 'x'\n", "if x:\npass\n", "  x\n y\n", "(1, 2]\n", "'abc\n", "x = 0777\n", "a + = 1\n", "f() = 1\n", "None = 1\n", "x++\n",
    "else: pass\n", "try: x\n", "case 1: pass\n", "class A\n", "<<<<<<< HEAD\nx\n=======\ny\n>>>>>>> b\n", "'\\x1'\n", "b'é'\n", "'a' b'b'\n", "f'{x'\n", "f'{x!z}'\n", "for x in: pass\n", "a b\n",
    "import a.b as c.d\n", "from a import *, b\n", "lambda x=1, y: 0\n", "f(x for x in y, 1)\n", "{**a for a in b}\n", "x = {1: 2, 3}\n", "def f():\n", "\x00", "if x:\n        a\n\tb\n", "@x\ny = 1\n", "except: pass",
]


def accepts(text):
    try:
        ast.parse(text)
        return True
    except (SyntaxError, ValueError):
        return False


@pytest.mark.parametrize("text", VALID + INVALID)
def test_python_as_the_language_has_it(text):
    assert bool(python.parse(text) & python.PY3) == accepts(text)


def test_mutated_sources_are_never_accepted_wrongly():
    rng, pool = random.Random(5), "( ) [ ] { } , : . = == := * ** - not in if else for lambda yield await x 1 's' b'b' f'{x}' @ -> ... match case _ import from as def class del try ! 0777 \n".split(" ")
    with open(textwrap.__file__) as lines, open(json.__file__) as more:
        source = lines.read() + more.read()
    rows, wrong = source.split("\n"), 0
    for _ in range(2500):
        at = rng.randrange(len(rows))
        tokens = python._TOKEN.findall(textwrap.dedent("\n".join(rows[at : at + rng.choice((1, 2, 5))])))
        if not tokens:
            continue
        k = rng.randrange(len(tokens))
        tokens[k : k + rng.randint(0, 1)] = [" " + rng.choice(pool) + " "] * rng.randint(0, 1)
        text = "".join(tokens)
        ours, theirs = bool(python.parse(text) & python.PY3), accepts(text)
        assert not (ours and not theirs), text
        wrong += theirs and not ours
    assert wrong == 0


def test_dialects_run_together():
    assert python.parse("print 'x'\n") == python.PY2
    assert python.parse("print('x')\n") == python.PY3 | python.PY2
    assert python.parse("x: int = 1\n") == python.PY3
    assert python.parse("try:\n  a\nexcept A, e:\n  b\n") == python.PY2
    assert python.parse("x = 0777L\nexec 'y' in z\n") == python.PY2


def test_gll_on_left_recursion_ambiguity_and_empty_rules():
    g = Grammar("s : s s | a | @2 b\ne : ( a )* x?\nl : l a | a", {"a": "a", "b": "b", "x": "x"}, 2)
    assert g.recognise("aaaa", "s") == 3 and g.recognise("aba", "s") == 2 and g.recognise("", "s") == 0
    assert g.recognise("", "e") == 3 and g.recognise("aax", "e") == 3 and g.recognise("xa", "e") == 0
    assert g.recognise("a" * 50, "l") == 3


SAMPLES = {
    "json": ['{"a": [1, -2.5e3, true, null, "\\u00e9"]}', "[]", '"x"', "[1,]", "{'a': 1}", "NaN", "01", "{} {}", '{"a" 1}', '["\t"]', "", "[" * 60 + "]" * 60],
    "toml": ['a = 1\n[t]\nb.c = "x"\n[[u]]\nd = [1, 2,\n# c\n3,]\n', "a = 1979-05-27T07:32:00Z\nb = 0x1F\nc = {x = 1, y = 'z'}\n", "a = 1\na = 2\n", "[t]\n[t]\n", "a = \n", "= 1", "a = 1 b = 2", 'a = "\\x"', "a = 01", "a = '''x\ny'''\n", "[a\n", "a = [1, 2"],
    "xml": ['<?xml version="1.0"?>\n<a x="1"><b/>t &amp; <!-- c --><![CDATA[<]]></a>', "<a><b></a></b>", "<a>", "<a/><b/>", '<a x="1" x="2"/>', "<a>&x;</a>", "<a x=1/>", "text", " <?xml version='1.0'?><a/>", "<a>]]></a>", "<!DOCTYPE a><a/>", "<a><!-- -- --></a>"],
}


DECLARED = [
    '<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>', '<!DOCTYPE a [<!ENTITY x "<b>">]><a>&x;</a>', '<!DOCTYPE a [<!ENTITY x "<b/>">]><a>&x;</a>',
    '<!DOCTYPE a [<!ENTITY x "&y;"><!ENTITY y "&x;">]><a>&x;</a>', '<!DOCTYPE a SYSTEM "a.dtd"><a>&x;</a>', '<!DOCTYPE a><a>&x;</a>',
    '<!DOCTYPE a PUBLIC "-//A" "b"><a/>', '<!DOCTYPE a PUBLIC "-//A"><a/>', '<!DOCTYPE a [<!ELEMENT a (b,c?)*><!ELEMENT b (#PCDATA|c)*><!ELEMENT c EMPTY>]><a/>',
    '<!DOCTYPE a [<!ELEMENT a (b|c,d)>]><a/>', '<!DOCTYPE a [<!ELEMENT a (#PCDATA|b)>]><a/>',
    '<!DOCTYPE a [<!ATTLIST a b CDATA #REQUIRED c (x|y) "x" d NMTOKEN #IMPLIED>]><a/>', '<!DOCTYPE a [<!ATTLIST a b FOO #REQUIRED>]><a/>',
    '<!DOCTYPE a [<!NOTATION n SYSTEM "x"><!ENTITY u SYSTEM "u" NDATA n>]><a>&u;</a>', '<!DOCTYPE a [<!ENTITY u SYSTEM "u">]><a>&u;</a>',
    '<!DOCTYPE a [<!ENTITY u SYSTEM "u">]><a b="&u;"/>', '<!DOCTYPE a [<!ENTITY x "<">]><a b="&x;"/>', '<!DOCTYPE a [<!ENTITY x "&#60;">]><a>&x;</a>',
    '<!DOCTYPE a [<!ENTITY % p "x">%p;]><a>&z;</a>', '<!DOCTYPE a [ <!-- ] > --> <?pi ] ?> ]  ><a/>', '<!DOCTYPE a []><a/>', '<!DOCTYPE 1><a/>', '<!DOCTYPE a b><a/>',
    '\ufeff<a/>', '<a>&#0;</a>', '<a>&#x1F;</a>', '<a>&#xD800;</a>', '<a>&#x10FFFF;</a>', '<a b="&#0;"/>', '<a>\x85é²</a>', '<a·/>', '<a²/>',
    '<!DOCTYPE a><!DOCTYPE a><a/>', '<a/><!DOCTYPE a>', '<a><?xml x?></a>', '<a><?XmL x?></a>', '<a><?b?></a>', '<a><?b ???></a>', '<a b="]]>"/>',
    '<a xmlns:b="c" b:d="1" e:f="2"/>', '<a:b:c/>', '<!DOCTYPE a [<!ENTITY x "y"><!ENTITY x "<b>">]><a>&x;</a>', '<!DOCTYPE a [<!ENTITY x "a%b">]><a/>',
    '<!DOCTYPE a [<!ELEMENT a (b)+>]><a/>', '<!DOCTYPE a [<!ELEMENT a ((b|c)+,d*)?>]><a/>', '<!DOCTYPE a [<!ELEMENT a ()>]><a/>',
    '<!DOCTYPE a [<!ELEMENT a (b)><!ELEMENT a (b)>]><a/>',
]
TABLES = [
    'a = 1\na.b = 2\n', 'a = 1\n[a]\n', '[[a]]\n[a]\n', 'x = {a = 1, a = 2}\n', 'x={a.b=1,a.c=2}\n', 'x={a.b=1,a.b.c=2}\n', 'x={a=1}\nx.b=2\n', 'x={a=1}\n[x]\n',
    'x={a=1}\n[x.b]\n', '[a.b]\nx=1\n[a]\nb.y=2\n', '[a.b.c]\nz=9\n[a]\nb.t=1\n', '[a.b.c]\nz=9\n[a]\nb.c.t=1\n', '[f]\na.c=1\na.t.s=2\n[f.a]\n',
    '[f]\na.c=1\na.t.s=2\n[f.a.t]\n', '[f]\na.c=1\na.t.s=2\n[f.a.x]\n', '[[f]]\n[f.a]\n[[f]]\n[f.a]\n', '[[f]]\n[f.a]\n[f.a]\n', '[[f]]\nx.y=1\n[[f.x]]\n',
    'a=[]\n[[a]]\n', 'a=[{b=1}]\n[[a]]\n', '[a]\n[a.b]\n[[a.b]]\n', '[a]\nb=1\n[a.b]\n', '"a"=1\na=2\n', '"\\u0061"=1\na=2\n', "'a'=1\na=2\n", 'x=2023-02-30\n',
    'x=2024-02-29T00:00:00Z\n', 'x=0000-01-01\n', 'x="\\ud800"\n', '"\\ud800"=1\n', 'x="\\U00110000"\n', 'a.b.c=1\na.b.d=2\n', 'a.b=1\n[a]\n', 'a.b=1\n[a.c]\n[a]\n',
    '[a]\n[a]\n', '[a.b]\n[a]\n[a]\n', 'x = {}\n', 'x = { , }\n', 'x={a=1,}\n', 'x=[{a=1},{a=1}]\n', 'x=[{a={b=1}, c=[{d=1,d=2}]}]\n', '[]\n', '[a.]\n', '=1\n',
    '[[a]]\nb.c=1\n[[a]]\nb.c=1\n[a.b]\n', '[[a.b]]\n[a]\n', '[a]\n[[a.b]]\n[a.b.c]\n[[a.b]]\n[a.b.c]\n', 'a={b=1}\n[a.b.c]\n', '[t]\na=1\n[u]\n[t.v]\n',
    't.a=1\n[t.b]\nc=1\n[u]\n', 'x=1979-05-27 07:32:00\n', 'x=07:32\n', 'x=1e5\n', 'x=+0\n', 'x=1__0\n', 'x=0b102\n', '"""a"""=1\n',
]
NUMBERS = [
    'match x:\n case 1+2: pass', 'match x:\n case 1+2j: pass', 'match x:\n case -1-2j: pass', 'match x:\n case 1j+2j: pass', 'match x:\n case 1j: pass',
    'match x:\n case {1+2j: a}: pass', 'x=1j+0x1j', 'x=0xj', 'x=1J', 'x=1_0j', '\ufeffx=1', 'x=0777j', 'x=00j',
]


@pytest.mark.parametrize(("language", "text"), [(k, t) for k, v in SAMPLES.items() for t in v] + [("xml", t) for t in DECLARED] + [("toml", t) for t in TABLES] + [("python", t) for t in NUMBERS])
def test_the_grammar_agrees_with_the_exact_parser(language, text):
    if text.strip():
        assert bool(operator.accepted(language, text) & 1) == (operator.exact_error(language, text) is None)


def test_xml_declarations_are_those_of_the_standard():
    # expat takes these; XML 1.0 has them otherwise
    for version in ("1", "01.0", "1.-", "a1.0", ""):
        text = f'<?xml version="{version}"?><a/>'
        assert not data.parse_xml(text) and operator.exact_error("xml", text) is None
    assert data.parse_xml('<?xml version="1.0" encoding="utf-8" standalone="yes"?><a/>') and data.parse_xml("<?xml version='1.1'?><a/>")


def test_only_the_grammar_decides(spark):
    files = [(1, '<?xml version="1"?><a/>'), (2, "<a/>"), (3, "<a>")]
    rows = spark.createDataFrame([(i, "xml", t) for i, t in files], "i int, l string, t string")
    got = operator.verdicts(rows, ["i"], "l", "t").withColumnsRenamed({"i": "item_id"}).withColumns({"item_table": F.lit("f"), "origin": F.lit("o")})
    assert {(r.item_id, r.parses, r.error, r.disputed) for r in got.collect()} == {(1, False, None, True), (2, True, None, False), (3, False, "ExpatError", False)}
    rate = operator.rates(got).first()
    assert (rate.n_items, rate.n_rejected, rate.n_disputed) == (3, 2, 1)


@pytest.mark.parametrize("language", list(SAMPLES))
def test_mutated_data_has_the_verdict_of_the_exact_parser(language):
    rng, pool = random.Random(6), ['"', "'", "{", "}", "[", "]", ",", ":", "=", "\n", " ", "<", ">", "/", "&", "1", "a", ".", "#", "\\", "-->", "<a>", "</a>"]
    for _ in range(2500):
        text = rng.choice(SAMPLES[language][:2])
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(text) + 1)
            text = text[:k] + rng.choice([*pool, ""]) + text[k + rng.randint(0, 2) :]
        if text.strip() and not re.match(r"\s*<\?xml", text):
            assert bool(operator.accepted(language, text)) == (operator.exact_error(language, text) is None), text


def test_operator(spark):
    code = spark.createDataFrame(
        [(1, "x = 1", " A"), (1, "x = 1", " A"), (2, "x = ", "a"), (3, None, "a"), (4, " \n", None), (5, "print 'x'", None)], "record_id long, code string, source string"
    ).withColumn("language", F.lit("clash"))
    files = spark.createDataFrame([(7, 1, "a/b.PY", "x ="), (8, 1, "c.json", "[1]"), (9, 1, "d.txt", "x ="), (10, None, None, "x ="), (11, 2, "e.xml", "<a>")], "file_id long, repo_id long, path string, content string")
    got = operator.corpus_verdicts(code, files)
    assert {(r.item_table, r.item_id) for r in got.filter("not parses").collect()} == {("python_tutorial_code", 2), ("python_tutorial_code", 5), ("repo_files", 7), ("repo_files", 11)}
    assert {r.item_id: r.dialects for r in got.filter("item_table = 'python_tutorial_code'").collect()}[5] == ["python2.7"]
    rates = {(r.item_table, r.origin): (r.n_items, r.n_rejected) for r in operator.rates(got).filter("language = 'python'").collect()}
    assert rates[("python_tutorial_code", "a")] == (2, 1)
    assert operator.corpus_verdicts(code.limit(0), files.limit(0)).count() == 0


def test_very_long_and_deep_sources():
    assert python.parse("x = 1\n" * 20000) & 1
    assert not python.parse("(" * 1000)
    deep = "[" * 20000 + "]" * 20000
    assert data.parse_json(deep) and not data.parse_json(deep[1:]) and not data.parse_json(deep[:-1])
    assert data.parse_json("[" + "1," * 20000 + "1]")
    tomllib.loads("a = 1")
