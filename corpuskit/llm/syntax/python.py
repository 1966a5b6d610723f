"""Python sources: lexing to kinds, a generalised LL grammar for logical lines, and one for the lines of a block.

Two dialects run together: bit 0 is Python 3.13, bit 1 is Python 2.7 (print and exec statements, ``except A, e``,
backquotes, ``<>``, old octal and long numbers; no annotations and other later syntax). The grammar is context-free,
so the verdict on a logical line depends on its kinds alone and is remembered; likewise that on a compound statement,
by the kinds of its lines, inner blocks being one symbol each. A file is therefore parsed from its innermost blocks
outwards, and the stack machine runs only on sequences not met before. Where the lexer is in doubt (letters beyond the
plain ones) it rejects: the grammar never accepts what Python 3.13 does not.
"""

from __future__ import annotations

import keyword
import re
import unicodedata

from corpuskit.llm.syntax.gll import Grammar

PY3, PY2 = 1, 2
DIALECTS = ("python3.13", "python2.7")

_HARD = [*keyword.kwlist]
_SOFT = ["match", "case", "type", "print", "exec"]
_OPS = "** **= // //= >> >>= << <<= != <> -> := ... + += - -= * *= / /= % %= & &= | |= ^ ^= @ @= < <= > >= = == ~ ( ) [ ] { } , : ; . `".split()
_KINDS = {w: chr(0xE000 + i) for i, w in enumerate([*_HARD, *_SOFT, *_OPS])}
_NAME, _NUM, _NUM2, _IMAG, _STR, _BYTES, _BAD = "n", "0", "o", "j", "s", "b", "?"
_FOPEN, _FCLOSE, _LB, _RB, _BANG = "F", "f", "<", ">", "!"
_OPEN, _SHUT = {_KINDS[x] for x in "([{"}, {_KINDS[x] for x in ")]}"}
#: symbols that EBNF needs for itself, by name
_ALIAS = {"(": "LP", ")": "RP", "|": "BAR", "*": "STAR", "+": "PLUS", "@": "AT", "**": "POW"}
TERMINALS = {_ALIAS.get(w, w): k for w, k in _KINDS.items()}
TERMINALS |= {"NAME": _NAME, "NUM": _NUM, "NUM2": _NUM2, "IMAG": _IMAG, "STR": _STR, "BYTES": _BYTES, "FOPEN": _FOPEN, "FCLOSE": _FCLOSE, "LB": _LB, "RB": _RB, "BANG": _BANG}

LINES = """
simple_line : simple ( ; simple )* ;?
simple : assign | star_exprs | @1 type_alias | pass | break | continue | return star_exprs? | raise ( expr ( @1 from expr )? )? | @2 raise expr , expr ( , expr )? | del del_list | global names | @1 nonlocal names | assert expr ( , expr )? | import_ | yield_ | @2 print_ | @2 exec bitor ( in expr ( , expr )? )?
print_ : print | print expr ( , expr )* ,? | print >> expr ( , expr )* ,?
names : name ( , name )*
name : NAME | @1 print | @1 exec | @1 match | @1 case | @1 type | @2 match | @2 case | @2 type | @2 nonlocal | @2 async | @2 await
type_alias : type name type_params? = expr
type_params : [ type_param ( , type_param )* ,? ]
type_param : name ( : expr )? ( = expr )? | STAR name ( = star_expr )? | POW name ( = expr )?
import_ : import dotted_as ( , dotted_as )* | from dots* dotted import from_what | from dots dots* import from_what
dots : . | ...
dotted : name ( . name )*
dotted_as : dotted ( as name )?
from_what : STAR | LP as_names ,? RP | as_names
as_names : as_name ( , as_name )*
as_name : name ( as name )?
assign : @1 name : expr ( = rhs )? | @1 LP single RP : expr ( = rhs )? | @1 member : expr ( = rhs )? | ( star_targets = )+ rhs | single aug rhs
rhs : yield_ | star_exprs
aug : PLUSASSIGN | -= | STARASSIGN | /= | %= | &= | BARASSIGN | ^= | <<= | >>= | POWASSIGN | //= | @1 ATASSIGN
single : name | member | LP single RP
member : primary . name | primary [ slices ]
star_targets : star_target ( , star_target )* ,?
star_target : @1 STAR target | target
target : member | target_atom
target_atom : name | LP target RP | LP RP | LP star_target , RP | LP star_target ( , star_target )+ ,? RP | [ ] | [ star_targets ]
del_list : del_target ( , del_target )* ,?
del_target : member | name | LP del_target RP | LP del_list? RP | [ del_list? ]
yield_ : yield | yield star_exprs | @1 yield from expr
star_exprs : star_expr ( , star_expr )* ,?
star_expr : @1 STAR bitor | expr
star_named : @1 STAR bitor | named
named : @1 name := expr | expr
expr : disj | disj if disj else expr | lambda lparams? : expr
disj : inv ( boolop inv )*
boolop : or | and
inv : not inv | bitor ( cmp bitor )*
cmp : == | != | @2 <> | < | <= | > | >= | in | not in | is | is not
bitor : factor ( binop factor )*
binop : BAR | ^ | & | << | >> | PLUS | - | STAR | / | // | % | @1 AT
factor : PLUS factor | - factor | ~ factor | power
power : primary ( POW factor )? | @1 await primary ( POW factor )?
primary : atom trailer*
trailer : . name | LP args? RP | LP gen RP | [ slices ]
atom : name | @1 True | @1 False | None | @2 True | @2 False | NUM | IMAG | @2 NUM2 | strings | @1 ... | LP RP | LP yield_ RP | LP named RP | LP star_named , RP | LP star_named ( , star_named )+ ,? RP | LP gen RP | [ ] | [ star_named ( , star_named )* ,? ] | [ gen ] | { } | { pair ( , pair )* ,? } | { expr : expr comp+ } | { star_named ( , star_named )* ,? } | { gen } | @2 ` expr ( , expr )* `
pair : @1 POW bitor | expr : expr
gen : named comp+
comp : for star_targets in disj ( if disj )* | @1 async for star_targets in disj ( if disj )*
strings : str str* | BYTES BYTES* | @2 anystr anystr*
anystr : STR | BYTES
str : STR | @1 FOPEN field* FCLOSE
field : LB field_expr =? ( BANG NAME )? ( : field* )? RB
field_expr : yield_ | star_exprs
slices : index ( , index )* ,?
index : named | expr? : expr? ( : expr? )? | @1 STAR expr | @2 ...
args : arg ( , arg )* ( , kwargs )? ,? | kwargs ,?
arg : STAR expr | named
kwargs : kws ( , kws )* ( , kwd ( , kwd )* )? | kwd ( , kwd )*
kws : name = expr | STAR expr
kwd : name = expr | POW expr
params : n0
n0 : P tn0 | D td0 | star_p
tn0 : ( , n1? )?
n1 : P tn0 | D td0 | @1 / ts_n | star_p
td0 : ( , d1? )?
d1 : D td0 | @1 / ts_d | star_p
ts_n : ( , n2? )?
n2 : P ts_n | D ts_d | star_p
ts_d : ( , d2? )?
d2 : D ts_d | star_p
star_p : STAR PS tk | @1 STAR , k1 | POW PK ,?
tk : ( , k2? )?
k1 : K tk
k2 : @1 K tk | POW PK ,?
K : P | D
P : name ( @1 : expr )?
PS : name ( @1 : star_expr )?
PK : name ( @1 : expr )?
D : P = expr
lparams : ln0
ln0 : name ltn0 | LD ltd0 | lstar
ltn0 : ( , ln1? )?
ln1 : name ltn0 | LD ltd0 | @1 / lts_n | lstar
ltd0 : ( , ld1? )?
ld1 : LD ltd0 | @1 / lts_d | lstar
lts_n : ( , ln2? )?
ln2 : name lts_n | LD lts_d | lstar
lts_d : ( , ld2? )?
ld2 : LD lts_d | lstar
lstar : STAR name ltk | @1 STAR , lk1 | POW name ,?
ltk : ( , lk2? )?
lk1 : LK ltk
lk2 : @1 LK ltk | POW name ,?
LK : name | LD
LD : name = expr
if_ : if named :
elif_ : elif named :
else_ : else :
while_ : while named :
for_ : for star_targets in star_exprs : | @1 async for star_targets in star_exprs :
try_ : try :
except_ : except : | except expr ( as name )? : | @2 except expr , target :
except_star : @1 except STAR expr ( as name )? :
finally_ : finally :
with_ : with items : | @1 with LP item ( , item )* ,? RP : | @1 async with items : | @1 async with LP item ( , item )* ,? RP :
items : item ( , item )*
item : expr ( as star_target )?
def_ : def name type_p LP params? RP arrow : | @1 async def name type_p LP params? RP arrow :
type_p : ( @1 type_params )?
arrow : ( @1 -> expr )?
class_ : class name type_p ( LP args? RP )? :
decorator : AT named
match_ : @1 match subject :
subject : named | star_named , ( star_named ( , star_named )* ,? )?
case_ : @1 case patterns ( if named )? :
patterns : open_seq | pattern
open_seq : may_star , ( may_star ( , may_star )* ,? )?
may_star : STAR name | pattern
pattern : closed ( BAR closed )* ( as name )?
closed : None | True | False | strings | number | name | name_attr | LP pattern RP | LP open_seq? RP | [ ( may_star ( , may_star )* ,? )? ] | { } | { map_items ,? } | name_or_attr LP RP | name_or_attr LP class_args ,? RP
number : -? NUM | -? IMAG | -? NUM PLUS IMAG | -? NUM - IMAG
name_attr : name . name ( . name )*
name_or_attr : name | name_attr
map_items : map_item ( , map_item )* ( , POW name )? | POW name
map_item : map_key : pattern
map_key : None | True | False | strings | number | name_attr
class_args : pattern ( , pattern )* ( , kw_pattern )* | kw_pattern ( , kw_pattern )*
kw_pattern : name = pattern
if_i : if_ simple_line
elif_i : elif_ simple_line
else_i : else_ simple_line
while_i : while_ simple_line
for_i : for_ simple_line
try_i : try_ simple_line
except_i : except_ simple_line
except_star_i : except_star simple_line
finally_i : finally_ simple_line
with_i : with_ simple_line
def_i : def_ simple_line
class_i : class_ simple_line
case_i : case_ simple_line
"""
TERMINALS |= {"PLUSASSIGN": _KINDS["+="], "STARASSIGN": _KINDS["*="], "BARASSIGN": _KINDS["|="], "POWASSIGN": _KINDS["**="], "ATASSIGN": _KINDS["@="]}
_LINE_GRAMMAR = Grammar(LINES, TERMINALS, 2)

#: First kind of a logical line -> rules it can be; a name of the language that is no keyword there may start a simple line.
_K = _KINDS
_STARTS = {
    _K["if"]: ["if_"], _K["elif"]: ["elif_"], _K["else"]: ["else_"], _K["while"]: ["while_"], _K["for"]: ["for_"], _K["try"]: ["try_"],
    _K["except"]: ["except_", "except_star"], _K["finally"]: ["finally_"], _K["with"]: ["with_"], _K["def"]: ["def_"], _K["class"]: ["class_"],
    _K["async"]: ["for_", "with_", "def_"], _K["match"]: ["match_"], _K["case"]: ["case_"], _K["@"]: ["decorator"],
}
_MAYBE_SIMPLE = {_K["match"], _K["case"], _K["async"]}
#: Symbols of the lines of a block: a letter for each rule; lower case where the body is on the same line.
_SYMBOL = {
    "simple_line": "S", "decorator": "@", "if_": "I", "elif_": "L", "else_": "E", "while_": "W", "for_": "R", "try_": "T", "except_": "X",
    "except_star": "Z", "finally_": "Y", "with_": "H", "def_": "D", "class_": "C", "match_": "M", "case_": "A",
}
_BLOCK, _CASES = "B", "K"
STATEMENTS = """
block : stmt stmt*
cases : case case*
case : A BLOCK | a
stmt : S | if_s | while_s | for_s | try_s | with_s | def_s | class_s | DECO DECO* def_s | DECO DECO* class_s | M CASES
if_s : if_b elif_b* else_b?
if_b : I BLOCK | i
elif_b : L BLOCK | l
else_b : E BLOCK | e
while_s : while_b else_b?
while_b : W BLOCK | w
for_s : for_b else_b?
for_b : R BLOCK | r
try_s : try_b except_b+ else_b? finally_b? | try_b star_b+ else_b? finally_b? | try_b finally_b
try_b : T BLOCK | t
except_b : X BLOCK | x
star_b : Z BLOCK | z
finally_b : Y BLOCK | y
with_s : H BLOCK | h
def_s : D BLOCK | d
class_s : C BLOCK | c
"""
_BLOCK_GRAMMAR = Grammar(STATEMENTS, {c: c for c in "SILEWRTXZYHDCMAilewrtxzyhdca"} | {"DECO": "@", "BLOCK": _BLOCK, "CASES": _CASES}, 2)

_QUOTED = (
    r"'''(?:[^\\]|\\[\s\S])*?'''|\"\"\"(?:[^\\]|\\[\s\S])*?\"\"\""
    r"|'(?!'')[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*'|\"(?!\"\")[^\"\\\n]*(?:\\[\s\S][^\"\\\n]*)*\""
)
_FPLAIN = (
    r"'(?!'')(?:[^'\\\n{}]|\{\{|\}\}|\{[^'\"{}\\\n]*\})*'|\"(?!\"\")(?:[^\"\\\n{}]|\{\{|\}\}|\{[^'\"{}\\\n]*\})*\""
)
_FSTART = r"(?:[fF][rR]?|[rR][fF])(?=['\"])"
_NUMBER = (
    r"0[xX](?:_?[0-9a-fA-F])+[lL]?|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+"
    r"|(?:\d(?:_?\d)*\.(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*|\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?[jJlL]?"
)
_OPERATOR = r"\*\*=?|//=?|>>=?|<<=?|!=|<>|->|:=|\.\.\.|[+\-*/%&|^@<>=]=?|[~()\[\]{},:;.`]"
_TOKEN = re.compile(
    rf"[ \t\f]+|#[^\n]*|\n[ \t\f]*|\\\n|(?:[fF][rR]?|[rR][fF])(?:{_FPLAIN})|{_FSTART}['\"]"
    rf"|(?:[uUbB]|[bB]?[rR]|[rR][bB])?(?:{_QUOTED})|{_NUMBER}|[^\W\d]\w*|{_OPERATOR}|[\s\S]"
)
_ESCAPE = re.compile(r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U(?:000[0-9a-fA-F]{5}|0010[0-9a-fA-F]{4})|N\{([^}]*)\}|[\s\S])")


def _bad_escape(body: str, is_bytes: bool) -> bool:
    for m in _ESCAPE.finditer(body):
        t = m.group()
        if is_bytes:
            if t == "\\x":
                return True
        elif t in ("\\x", "\\u", "\\U", "\\N"):
            return True
        elif m.group(1) is not None:
            try:
                unicodedata.lookup(m.group(1))
            except KeyError:
                return True
    return False


def _string_kind(token: str) -> str:
    q = min(i for i in (token.find("'"), token.find('"')) if i >= 0)
    prefix, n = token[:q].lower(), 3 if token[q : q + 3] in ("'''", '"""') and len(token) >= q + 6 else 1
    body, is_bytes = token[q + n : len(token) - n], "b" in prefix
    if is_bytes and not body.isascii():
        return _BAD
    if "r" not in prefix and "\\" in body and _bad_escape(body, is_bytes):
        return _BAD
    return _BYTES if is_bytes else _STR


class _Kinds(dict):
    """The kind (or, for f-strings, kinds) of a token, by its text."""

    def __missing__(self, token):
        c = token[0]
        if c in " \t\f#" or token == "\\\n":
            return ""
        if c == "\n":
            return "\n"
        kind = self._of(token, c)
        if len(token) <= 40:
            if len(self) > 300_000:
                self.clear()
            self[token] = kind
        return kind

    @staticmethod
    def _of(token, c):
        if token in _KINDS:
            return _KINDS[token]
        if c.isdigit() or (c == "." and len(token) > 1):
            if not token.isascii():
                return _BAD
            if token[-1] in "lL":
                return _NUM2
            if token[-1] in "jJ" and token[:2] not in ("0x", "0X"):
                return _IMAG
            old = token[0] == "0" and token.replace("_", "").isdigit() and token.strip("0_")
            return _NUM2 if old else _NUM
        last = token[-1]
        if last in "'\"" and len(token) > 1:
            q = min(i for i in (token.find("'"), token.find('"')) if i >= 0)
            if "f" in token[:q].lower():
                return "\x00" if len(token) == q + 1 else _plain_fstring(token, q)
            return _string_kind(token)
        if c == "_" or c.isalpha():
            return _NAME if token.isidentifier() and (token.isascii() or unicodedata.normalize("NFKC", token) not in _KINDS) else _BAD
        return _BAD


KINDS = _Kinds()


def _plain_fstring(token: str, q: int) -> str:
    out, body = [_FOPEN], token[q + 1 : -1]
    for m in re.finditer(r"\{\{|\}\}|\{([^{}]*)\}", body):
        if m.group(1) is not None:
            out.append(_field(m.group(1)))
    out.append(_FCLOSE)
    return "".join(out)


def _field(inner: str, spec_kinds: str = "", has_spec: bool = False) -> str:
    """Kinds of a replacement field from its text (expression, '=', conversion, plain format specification)."""
    depth, cut, bang = 0, len(inner), -1
    i = 0
    while i < len(inner):
        c = inner[i]
        if c in "([{":
            depth += 1
        elif c in ")]}":
            depth -= 1
        elif not depth and c == "!" and inner[i + 1 : i + 2] != "=":
            bang = i
            cut = i
            break
        elif not depth and c == ":":
            cut = i
            break
        elif c == "#":
            return _BAD
        i += 1
    expr, rest = inner[:cut], inner[cut:]
    conv = ""
    if bang >= 0:
        m = re.match(r"![ ]?([rsa])\s*(?=:|$)", rest)
        if not m or rest[1:2] == " ":
            return _BAD
        conv, rest = _BANG + _NAME, rest[m.end() :]
    kinds = "".join(map(KINDS.__getitem__, _TOKEN.findall(expr))).replace("\n", "")
    if "\x00" in kinds:
        return _BAD
    colon = _KINDS[":"] + spec_kinds if rest.startswith(":") or has_spec else ""
    return _LB + kinds + conv + colon + _RB


def _scan_fstring(text: str, at: int, prefix: str) -> tuple[str, int]:
    """Kinds and end of an f-string that starts at ``at`` (of its quote); nested quotes, braces and specifications."""
    quote = text[at : at + 3] if text[at : at + 3] in ("'''", '"""') else text[at]
    raw, i, out = "r" in prefix.lower(), at + len(quote), [_FOPEN]
    n = len(text)
    while i < n:
        c = text[i]
        if text.startswith(quote, i):
            return "".join(out) + _FCLOSE, i + len(quote)
        if c == "\\":
            if not raw and text[i + 1 : i + 2] in "xuUN" and _bad_escape(text[i : i + 12] if text[i + 1] != "N" else text[i : max(i + 2, text.find("}", i) + 1)], False):
                return _BAD, n
            if not raw and text.startswith("\\N{", i):
                i = text.find("}", i) + 1
                continue
            i += 1 if raw and text[i + 1 : i + 2] in "{}" else 2
        elif c == "\n" and len(quote) == 1:
            return _BAD, n
        elif text[i : i + 2] in ("{{", "}}"):
            i += 2
        elif c == "{":
            kinds, i = _scan_field(text, i + 1, quote)
            if i < 0:
                return _BAD, n
            out.append(kinds)
        elif c == "}":
            return _BAD, n
        else:
            i += 1
    return _BAD, n


def _scan_field(text: str, at: int, quote: str) -> tuple[str, int]:
    depth, kinds, i = 0, [], at
    while i < len(text):
        if not depth:
            c = text[i]
            if c == "}":
                return _LB + "".join(kinds) + _RB, i + 1
            if c == "!" and text[i + 1 : i + 2] != "=":
                m = re.compile(r"!([rsa])\s*(?=[:}])").match(text, i)
                if not m:
                    return "", -1
                kinds.append(_BANG + _NAME)
                i = m.end()
                continue
            if c == ":":
                kinds.append(_KINDS[":"])
                i += 1
                while i < len(text) and text[i] != "}":
                    if text.startswith(quote, i) or (text[i] == "\n" and len(quote) == 1):
                        return "", -1
                    if text[i] == "{":
                        inner, i = _scan_field(text, i + 1, quote)
                        if i < 0:
                            return "", -1
                        kinds.append(inner)
                    else:
                        i += 1
                continue
        m = _TOKEN.match(text, i)
        kind = KINDS[m.group()]
        i = m.end()
        if kind == "\x00":
            kind, i = _scan_fstring(text, i - 1, m.group()[:-1])
        if _BAD in kind:
            return "", -1
        depth += (kind in _OPEN) - (kind in _SHUT)
        if depth < 0:
            return "", -1
        kinds.append("" if kind == "\n" else kind)
    return "", -1


def _tokens(text: str) -> tuple[str, list[str]] | None:
    """All kinds of a text as one string, and its line breaks with the indentation after each."""
    tokens = _TOKEN.findall(text)
    kinds = "".join(map(KINDS.__getitem__, tokens))
    breaks = [t for t in tokens if t[0] == "\n"]
    if "\x00" not in kinds:
        return kinds, breaks
    out, breaks, at = [], [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        token = m.group()
        kind, at = KINDS[token], m.end()
        if kind == "\x00":
            kind, at = _scan_fstring(text, at - 1, token[:-1])
        if token[0] == "\n":
            breaks.append(token)
        out.append(kind)
    return "".join(out), breaks


_line_memo: dict[str, tuple[tuple[str, int], ...]] = {}
_group_memo: dict[str, tuple[int, int]] = {}
_depth_memo: dict[str, int] = {}
_MEMO_MAX = 500_000
_RUN = re.compile(f"({_KINDS[',']}[{_NAME}{_NUM}{_STR}{_BYTES}]|{_STR}|{_BYTES})\\1{{3,}}")


def line_symbols(kinds: str) -> tuple[tuple[str, int], ...]:
    """What a logical line can be, as (symbol, dialects)."""
    # No rule counts list elements, or strings in a row, beyond three: longer runs of like ones say no more.
    kinds = _RUN.sub(r"\1\1\1", kinds)
    got = _line_memo.get(kinds)
    if got is not None:
        return got
    out = []
    if _BAD not in kinds:
        c = kinds[0]
        for rule in _STARTS.get(c, ()):
            if kinds[-1] == _KINDS[":"] or rule == "decorator":
                mask = _LINE_GRAMMAR.recognise(kinds, rule)
                if mask:
                    out.append((_SYMBOL[rule], mask))
            if kinds[-1] != _KINDS[":"] and rule not in ("decorator", "match_"):
                mask = _LINE_GRAMMAR.recognise(kinds, rule + "i" if rule.endswith("_") else rule + "_i")
                if mask:
                    out.append((_SYMBOL[rule].lower(), mask))
        if c not in _STARTS or c in _MAYBE_SIMPLE:
            mask = _LINE_GRAMMAR.recognise(kinds, "simple_line")
            if mask:
                out.append(("S", mask))
    if len(_line_memo) > _MEMO_MAX:
        _line_memo.clear()
    got = _line_memo[kinds] = tuple(out)
    return got


_HEADS = set("ILEWRTXZYHDCA")
_CLAUSES = set("LEXZYlexzy")


def _group(symbols: str) -> tuple[int, int]:
    """Dialects in which the symbols of some lines are statements, and in which they are case clauses."""
    got = _group_memo.get(symbols)
    if got is None:
        if len(_group_memo) > _MEMO_MAX:
            _group_memo.clear()
        got = _group_memo[symbols] = (_BLOCK_GRAMMAR.recognise(symbols, "block"), _BLOCK_GRAMMAR.recognise(symbols, "cases"))
    return got


def _block(lines: list) -> tuple[int, int]:
    """(dialects as statements, dialects as cases) of the lines of one block: (symbols, inner block or None) each.

    Statements are told apart by their first line (clauses belong to what is before them), and each is looked up by itself."""
    both = [PY3 | PY2, PY3 | PY2]
    group: list = []
    flat: list[list] = []
    for symbols, inner in lines:
        heads = {s for s, _ in symbols}
        joins = bool(flat) and (heads <= _CLAUSES or flat[-1][-1][0][0][0] == "@")
        if joins:
            flat[-1].append((symbols, inner))
        else:
            flat.append([(symbols, inner)])
    for group in flat:
        readings = [("", PY3 | PY2)]
        for symbols, inner in group:
            new = []
            for s, mask in symbols:
                for text, m in readings:
                    m &= mask
                    if not m:
                        continue
                    if inner is None:
                        if s not in _HEADS and s != "M":
                            new.append((text + s, m))
                    elif s == "M":
                        new.append((text + "M" + _CASES, m & inner[1]))
                    elif s in _HEADS:
                        new.append((text + s + _BLOCK, m & inner[0]))
            readings = new
        statements = cases = 0
        for text, m in readings:
            a, b = _group(text)
            statements |= a & m
            cases |= b & m
        both[0] &= statements
        both[1] &= cases
        if not (both[0] or both[1]):
            return 0, 0
    return both[0], both[1]


def _indent(space: str) -> tuple[int, int]:
    """Columns of an indentation with tabs of eight and of one."""
    space = space.rpartition("\f")[2]
    if "\t" not in space:
        return len(space), len(space)
    col = 0
    for c in space:
        col = (col // 8 + 1) * 8 if c == "\t" else col + 1
    return col, len(space)


def parse(text: str) -> int:
    """The dialects (bit mask) whose grammar accepts a source text."""
    if "\x00" in text:
        return 0
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if text.endswith("\\\n") or text.endswith("\\"):
        return 0
    kinds, breaks = _tokens("\n" + text)
    if _BAD in kinds:
        return 0
    stack: list[list] = [[(0, 0), []]]  # indentation and lines of every open block
    logical, depth, space = [], 0, ""

    def close() -> bool:
        """End the innermost block: it becomes the body of the line before it."""
        lines = stack.pop()[1]
        verdict = _block(lines)
        owner = stack[-1][1]
        if not owner or owner[-1][1] is not None or not (verdict[0] or verdict[1]):
            return False
        owner[-1] = (owner[-1][0], verdict)
        return True

    for physical, here in zip(kinds.split("\n")[1:], breaks):
        if not logical:
            if not physical:
                continue
            space = here[1:]
        logical.append(physical)
        got = _depth_memo.get(physical)
        if got is None:
            if len(_depth_memo) > _MEMO_MAX:
                _depth_memo.clear()
            got = _depth_memo[physical] = sum((c in _OPEN) - (c in _SHUT) for c in physical)
        depth += got
        if depth > 0:
            if depth > 200:
                return 0
            continue
        if depth < 0:
            return 0
        line = logical[0] if len(logical) == 1 else "".join(logical)
        logical = []
        symbols = line_symbols(line)
        if not symbols:
            return 0
        at = _indent(space)
        top = stack[-1][0]
        if at[0] > top[0]:
            if at[1] <= top[1] or not stack[-1][1] or len(stack) >= 100:
                return 0
            stack.append([at, []])
        else:
            while at[0] < stack[-1][0][0]:
                if not close():
                    return 0
            if at != stack[-1][0]:
                return 0
        stack[-1][1].append((symbols, None))
    if depth or logical:
        return 0
    while len(stack) > 1:
        if not close():
            return 0
    return _block(stack[0][1])[0] if stack[0][1] else PY3 | PY2
