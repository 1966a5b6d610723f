"""JSON (RFC 8259), TOML 1.0 and XML 1.0 texts: lexing to kinds and generalised LL grammars.

As for Python sources, the innermost groups (brackets, elements) are looked up first and become one symbol, so the
stack machine runs on short sequences and remembers them. What a context-free grammar cannot say is checked beside it:
equal names in the start and end of an element, repeated attributes, entities, keys and tables defined twice, days that
no month has, references to characters that XML does not allow.
"""

from __future__ import annotations

import re
from datetime import date

from corpuskit.llm.syntax.gll import Grammar

_MEMO_MAX = 200_000

# ---- JSON ----

_JSON = Grammar(
    """
value : s | 0 | t | v | object | array
object : LB RB | LB member ( , member )* RB
member : s : value
array : [ ] | [ value ( , value )* ]
""",
    {c: c for c in "s0tv,:[]"} | {"LB": "{", "RB": "}"},
    1,
)
_JSON_TOKEN = re.compile(
    r'[ \t\n\r]+|"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|[{}\[\],:]|[\s\S]'
)
_JSON_PARTS = re.compile(r"[{}\[\]]|[^{}\[\]]+")
_json_memo: dict[str, bool] = {}


def _json_kind(t: str) -> str:
    c = t[0]
    if c in " \t\n\r":
        return ""
    if c == '"':
        return "s" if len(t) > 1 else "?"
    if c in "{}[],:":
        return c
    if t in ("true", "false", "null"):
        return "t"
    return "0" if c.isdigit() or (c == "-" and len(t) > 1) else "?"


_JSON_RUN = re.compile(r"(,(?:s:)?[s0tv])\1{3,}")


def _json_ok(kinds: str) -> bool:
    kinds = _JSON_RUN.sub(r"\1\1\1", kinds)  # more members of one kind in a row say no more
    got = _json_memo.get(kinds)
    if got is None:
        if len(_json_memo) > _MEMO_MAX:
            _json_memo.clear()
        got = _json_memo[kinds] = bool(_JSON.recognise(kinds, "value"))
    return got


def parse_json(text: str) -> bool:
    kinds = "".join(map(_json_kind, _JSON_TOKEN.findall(text)))
    if "?" in kinds:
        return False
    groups: list[list[str]] = [[]]  # kinds of the open groups; a closed one is a value of the group around it
    for part in _JSON_PARTS.findall(kinds):
        if part in "{[":
            groups.append([part])
        elif part in "}]":
            groups[-1].append(part)
            group = "".join(groups.pop())
            if not groups or not _json_ok(group):
                return False
            groups[-1].append("v")
        else:
            groups[-1].append(part)
    return len(groups) == 1 and _json_ok("".join(groups[0]))


# ---- TOML ----

_TOML = Grammar(
    """
document : line ( n line )*
line : pair | table | array_table |
table : [ key ]
array_table : OPEN2 key CLOSE2
pair : key = value
key : k ( . k )*
value : v | [ nl* ] | [ nl* value ( nl* , nl* value )* nl* ( , nl* )? ] | LB RB | LB pair ( , pair )* RB
nl : n
""",
    {c: c for c in "nk=v[],."} | {"LB": "{", "RB": "}", "OPEN2": "<", "CLOSE2": ">"},
    1,
)
_BASIC = r'"(?:[^"\\\x00-\x08\x0a-\x1f\x7f]|\\(?:[btnfr"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}))*"'
_LITERAL = r"'[^'\x00-\x08\x0a-\x1f\x7f]*'"
_ML_BASIC = r'"""(?:[^"\\\x00-\x08\x0b-\x1f\x7f]|\\(?:[btnfr"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[ \t]*\n[ \t\n]*)|"{1,2}(?!"))*"{3,5}'
_ML_LITERAL = r"'''(?:[^'\x00-\x08\x0b-\x1f\x7f]|'{1,2}(?!'))*'{3,5}"
_SPACE = r"[ \t]+|#[^\n\x00-\x08\x0b-\x1f\x7f]*"
_TOML_KEY = re.compile(rf"{_SPACE}|\n|{_BASIC}|{_LITERAL}|[A-Za-z0-9_-]+|[\[\]{{}}=.,]|[\s\S]")
_TIME = r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?"
_DATE = r"\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])"
_TOML_VALUE = re.compile(
    rf"{_SPACE}|\n|{_ML_BASIC}|{_ML_LITERAL}|{_BASIC}|{_LITERAL}"
    rf"|(?:{_DATE}(?:[Tt ]{_TIME}(?:[Zz]|[+-](?:[01]\d|2[0-3]):[0-5]\d)?)?|{_TIME}|0x[0-9a-fA-F]+(?:_[0-9a-fA-F]+)*|0o[0-7]+(?:_[0-7]+)*|0b[01]+(?:_[01]+)*"
    r"|[+-]?(?:inf|nan)|true|false|[+-]?(?:0|[1-9](?:_?\d)*)(?:\.\d(?:_?\d)*)?(?:[eE][+-]?\d(?:_?\d)*)?)(?![A-Za-z0-9_.:+-])|[\[\]{},]|[\s\S]"
)
_toml_memo: dict[str, bool] = {}


_TOML_ESCAPE = re.compile(r'\\(?:u([0-9a-fA-F]{4})|U([0-9a-fA-F]{8})|([btnfr"\\]))')
_TOML_PLAIN = {"b": "\b", "t": "\t", "n": "\n", "f": "\f", "r": "\r", '"': '"', "\\": "\\"}


def _scalars(token: str) -> bool:
    """Whether all escapes of a basic string are characters that there are."""
    for m in _TOML_ESCAPE.finditer(token):
        if not m.group(3):
            code = int(m.group(1) or m.group(2), 16)
            if 0xD800 <= code <= 0xDFFF or code > 0x10FFFF:
                return False
    return True


def _toml_name(token: str) -> str:
    """The key that a token stands for."""
    if token[0] == "'":
        return token[1:-1]
    if token[0] != '"':
        return token
    return _TOML_ESCAPE.sub(lambda m: _TOML_PLAIN[m.group(3)] if m.group(3) else chr(int(m.group(1) or m.group(2), 16)), token[1:-1])


def _is_value(token: str) -> bool:
    """Whether a value token has a meaning: escapes of characters that there are, a date of the calendar."""
    if token[0] == '"':
        return "\\" not in token or _scalars(token)
    if token[4:5] == "-" and token[:4].isdigit():
        try:
            date.fromisoformat(token[:10])
        except ValueError:
            return False
    return True


class _Table:
    """A table by its way of definition: by a header, by the header of a table in it, by dotted keys, or inline."""

    __slots__ = ("kind", "items")

    def __init__(self, kind: str):
        self.kind, self.items = kind, {}

    def child(self, name: str):
        """The table of a name on the way of a header, made if there is none; of an array of tables the last; None for a value."""
        at = self.items.get(name)
        if at is None:
            if name in self.items:
                return None
            at = self.items[name] = _Table("implicit")
        elif isinstance(at, list):
            at = at[-1]
        return None if at.kind == "inline" else at

    def header(self, path, array: bool):
        """The table of a header below this one; None if it may not be defined there."""
        at = self
        for name in path[:-1]:
            at = at.child(name)
            if at is None:
                return None
        name = path[-1]
        old = at.items.get(name)
        new = _Table("header")
        if array:
            if name not in at.items:
                at.items[name] = [new]
            elif isinstance(old, list):
                old.append(new)
            else:
                return None
            return new
        if name not in at.items:
            at.items[name] = new
            return new
        if isinstance(old, _Table) and old.kind == "implicit":
            old.kind = "header"
            return old
        return None

    def pair(self, path, value) -> bool:
        """Define a (dotted) key with a value: None, or an inline table. False if it may not be defined."""
        at = self
        for name in path[:-1]:
            old = at.items.get(name)
            if old is None:
                if name in at.items:
                    return False
                old = at.items[name] = _Table("dotted")
            elif not isinstance(old, _Table) or old.kind in ("header", "inline"):
                return False
            old.kind = "dotted"
            at = old
        if path[-1] in at.items:
            return False
        at.items[path[-1]] = value
        return True


def _toml_kinds(text: str) -> str | None:
    """Kinds of a TOML text; None where a token fits nowhere or a name is defined twice."""
    out, at, n = [], 0, len(text)
    stack: list = []  # open brackets of the current value: "[" or an inline table
    key = line_start = True
    path: list[str] = []
    root = _Table("header")
    table = root
    entered, header = None, ""
    while at < n:
        m = (_TOML_KEY if key else _TOML_VALUE).match(text, at)
        t, at = m.group(), m.end()
        c = t[0]
        if c in " \t#":
            continue
        if c == "\n":
            if stack and stack[-1] != "[":
                return None
            out.append("n")
            if not stack:
                key, line_start, path, header = True, True, [], ""
            continue
        if key:
            if line_start and c == "[":
                header = "<" if text.startswith("[", at) else "["
                at += header == "<"
                out.append(header)
                line_start = False
                continue
            line_start = False
            if header and c == "]":
                if header == "<" and not text.startswith("]", at):
                    return None
                at += header == "<"
                out.append(">" if header == "<" else "]")
                table = root.header(path, header == "<") if path else None
                if table is None:
                    return None
                continue
            if c == "=":
                out.append("=")
                if header or not path:
                    return None
                # An inline table is filled after it is entered here; it is closed to others in any case.
                value = _Table("inline") if _OPENS_TABLE.match(text, at) else None
                if not (stack[-1] if stack else table).pair(path, value):
                    return None
                entered, path, key = value, [], False
            elif c == "." or c == "," and stack:
                out.append(c)
            elif c == "}" and stack and stack[-1] != "[":
                out.append("}")
                stack.pop()
                key = False
            elif len(t) > 1 or c.isalnum() or c in "_-":
                if c == '"' and not _scalars(t):
                    return None
                out.append("k")
                path.append(_toml_name(t))
            else:
                return None
            continue
        if c in "[{" and len(t) == 1:
            out.append(c)
            if c == "{":
                stack.append(entered or _Table("inline"))
                key, path = True, []
            else:
                stack.append("[")
            entered = None
        elif c in "]}" and len(t) == 1:
            if not stack or (stack.pop() == "[") != (c == "]"):
                return None
            out.append(c)
        elif t == ",":
            out.append(",")
            key, path = bool(stack) and stack[-1] != "[", []
        elif (len(t) > 1 or c.isdigit()) and _is_value(t):
            out.append("v")
        else:
            return None
    return None if stack else "".join(out)


_OPENS_TABLE = re.compile(r"[ \t]*\{")


def parse_toml(text: str) -> bool:
    text = text.replace("\r\n", "\n")
    kinds = _toml_kinds(text)
    if kinds is None:
        return False
    # Lines outside of brackets are looked up one by one.
    depth, start = 0, 0
    for i, c in enumerate(kinds + "n"):
        if c in "[{<":
            depth += 1
        elif c in "]}>":
            depth -= 1
        elif c == "n" and depth == 0:
            line = kinds[start:i]
            start = i + 1
            ok = _toml_memo.get(line)
            if ok is None:
                if len(_toml_memo) > _MEMO_MAX:
                    _toml_memo.clear()
                ok = _toml_memo[line] = bool(_TOML.recognise(line, "line"))
            if not ok:
                return False
    return depth == 0


# ---- XML ----

_XML = Grammar(
    """
document : d? misc* ( y misc* )? root misc*
misc : m | w
root : e | o content c
content : ( e | t | w | m | x )*
element : o content c
model : group | mixed
group : LP part ( BAR part )+ end | LP part ( , part )* end
part : n | N | group
end : RP | R | S
mixed : LP p RP | LP p ( BAR n )* S
""",
    {c: c for c in "dymwetxocnNpRS,"} | {"LP": "(", "RP": ")", "BAR": "|"},
    1,
)
_START = r"A-Za-z_:\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02ff\u0370-\u037d\u037f-\u1fff\u200c\u200d\u2070-\u218f\u2c00-\u2fef\u3001-\ud7ff\uf900-\ufdcf\ufdf0-\ufffd\U00010000-\U000effff"
_LATER = _START + r"\-.0-9\u00b7\u0300-\u036f\u203f\u2040"
_NAME = rf"[{_START}][{_LATER}]*"
_S = r"[ \t\r\n]"
_REF = rf"&(?:{_NAME}|#[0-9]+|#x[0-9a-fA-F]+);"
_VALUE = rf"(?:\"(?:[^<&\"]|{_REF})*\"|'(?:[^<&']|{_REF})*')"
_ATTR = rf"{_S}+({_NAME}){_S}*={_S}*{_VALUE}"
_NOTE = rf"<!--(?:[^-]|-[^-])*-->|<\?(?![xX][mM][lL][ \t\r\n?])(?:{_NAME})(?:{_S}(?:[^?]|\?(?!>))*)?\?>"
_LITERAL = r"(?:\"[^\"]*\"|'[^']*')"
_PUBLIC = r"(?:\"[ \r\na-zA-Z0-9\-'()+,./:=?;!*#@$_%]*\"|'[ \r\na-zA-Z0-9\-()+,./:=?;!*#@$_%]*')"
_EXTERNAL = rf"(?:SYSTEM{_S}+{_LITERAL}|PUBLIC{_S}+{_PUBLIC}{_S}+{_LITERAL})"
_NMTOKENS = rf"\({_S}*[{_LATER}]+(?:{_S}*\|{_S}*[{_LATER}]+)*{_S}*\)"
_KIND = rf"(?:CDATA|IDREFS?|ID|ENTITY|ENTITIES|NMTOKENS?|NOTATION{_S}+\({_S}*{_NAME}(?:{_S}*\|{_S}*{_NAME})*{_S}*\)|{_NMTOKENS})"
_ATTDEF = rf"{_S}+{_NAME}{_S}+{_KIND}{_S}+(?:#REQUIRED|#IMPLIED|(?:#FIXED{_S}+)?{_VALUE})"
_TEXT = rf"(?:\"(?:[^%&\"]|{_REF})*\"|'(?:[^%&']|{_REF})*')"
#: A declaration of the internal subset: the name and text of an internal entity, an external one, the model of an element.
_DECLARED = re.compile(
    rf"{_S}+|{_NOTE}|(?P<pe>%{_NAME};)|<!ENTITY{_S}+(?P<name>{_NAME}){_S}+(?:(?P<text>{_TEXT})|(?P<external>{_EXTERNAL})(?P<unparsed>{_S}+NDATA{_S}+{_NAME})?){_S}*>"
    rf"|<!ENTITY{_S}+%{_S}+{_NAME}{_S}+(?:{_TEXT}|{_EXTERNAL}){_S}*>|<!ATTLIST{_S}+{_NAME}(?:{_ATTDEF})*{_S}*>"
    rf"|<!NOTATION{_S}+{_NAME}{_S}+(?:{_EXTERNAL}|PUBLIC{_S}+{_PUBLIC}){_S}*>|<!ELEMENT{_S}+{_NAME}{_S}+(?:EMPTY|ANY|(?P<model>\([^<>\[\]]*[)*?+])){_S}*>"
)
_MODEL = re.compile(rf"{_S}+|#PCDATA|\)[*?+]?|[(|,]|{_NAME}[*?+]?|[\s\S]")
_DOCTYPE = re.compile(rf"<!DOCTYPE{_S}+{_NAME}(?P<external>{_S}+{_EXTERNAL})?{_S}*(?:\[(?P<subset>[\s\S]*)\]{_S}*)?>")
_XML_TOKEN = re.compile(
    rf"(?P<d><\?xml{_S}[^?]*\?>)|(?P<m>{_NOTE})"
    rf"|(?P<x><!\[CDATA\[(?:(?!\]\]>)[\s\S])*\]\]>)|(?P<y><!DOCTYPE{_S}(?:[^\[\]<>\"']|{_LITERAL})*(?:\[(?:[^\]\"'<]|{_LITERAL}|<!--(?:[^-]|-[^-])*-->|<\?(?:[^?]|\?(?!>))*\?>|<)*\]{_S}*)?>)|(?P<c></({_NAME}){_S}*>)"
    rf"|(?P<o><({_NAME})(?:{_ATTR})*{_S}*/?>)|(?P<w>{_S}+(?=<|\Z))|(?P<t>(?:(?!\]\]>)[^<&]|{_REF})+)|(?P<bad>[\s\S])"
)
_ATTR_NAME = re.compile(_ATTR)
_DECLARATION = re.compile(rf"<\?xml{_S}+version{_S}*={_S}*(?:\"1\.[0-9]+\"|'1\.[0-9]+')(?:{_S}+encoding{_S}*={_S}*(?:\"[A-Za-z][A-Za-z0-9._-]*\"|'[A-Za-z][A-Za-z0-9._-]*'))?(?:{_S}+standalone{_S}*={_S}*(?:\"(?:yes|no)\"|'(?:yes|no)'))?{_S}*\?>")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_REFERENCE = re.compile(rf"&(?:#([0-9]+)|#x([0-9a-fA-F]+)|({_NAME}));")
#: The entities that need no declaration.
_KNOWN = {"lt", "gt", "amp", "apos", "quot"}
_xml_memo: dict[tuple[str, str], bool] = {}


def _xml_ok(kinds: str, rule: str) -> bool:
    # Runs of content say no more than one piece of it.
    kinds = re.sub(r"[etwmx]{2,}", lambda m: "e" + "t", kinds) if rule == "element" else kinds
    got = _xml_memo.get((kinds, rule))
    if got is None:
        if len(_xml_memo) > _MEMO_MAX:
            _xml_memo.clear()
        got = _xml_memo[kinds, rule] = bool(_XML.recognise(kinds, rule))
    return got


def _is_char(code: int) -> bool:
    return code in (9, 10, 13) or 0x20 <= code <= 0xD7FF or 0xE000 <= code <= 0xFFFD or 0x10000 <= code <= 0x10FFFF


def _code(m: re.Match) -> int:
    digits = (m.group(1) or m.group(2)).lstrip("0") or "0"
    return int(digits, 10 if m.group(1) else 16) if len(digits) < 9 else -1


class _Entities:
    """What references may stand in a document: characters, known entities, declared ones whose text is well-formed itself."""

    def __init__(self):
        self.texts: dict[str, str | None] = {}  # None for an external entity
        self.unparsed: set[str] = set()
        self.open = False  # other declarations may exist outside of the document

    def declare(self, doctype: str) -> bool:
        m = _DOCTYPE.fullmatch(doctype)
        if not m:
            return False
        self.open = m["external"] is not None
        subset, at = m["subset"] or "", 0
        while at < len(subset):
            d = _DECLARED.match(subset, at)
            if not d:
                return False
            at = d.end()
            if d["pe"]:
                self.open = True
            elif d["model"]:
                parts = "".join(_model_kind(t) for t in _MODEL.findall(d["model"]))
                if "?" in parts or not _xml_ok(parts, "model"):
                    return False
            elif d["name"]:
                text = d["text"][1:-1] if d["text"] else None
                if text and any((m.group(1) or m.group(2)) and not _is_char(_code(m)) for m in _REFERENCE.finditer(text)):
                    return False
                self.texts.setdefault(d["name"], text)
                if d["unparsed"]:
                    self.unparsed.add(d["name"])
        return True

    def allow(self, text: str, in_value: bool, within: tuple[str, ...] = ()) -> bool:
        """Whether the references of a piece of text, or of an attribute's value, may stand there."""
        for m in _REFERENCE.finditer(text):
            name = m.group(3)
            if not name:
                if not _is_char(_code(m)):
                    return False
            elif name not in _KNOWN and not self._allows(name, in_value, within):
                return False
        return True

    def _allows(self, name: str, in_value: bool, within: tuple[str, ...]) -> bool:
        if name in within or name in self.unparsed:
            return False
        if name not in self.texts:
            return self.open
        text = self.texts[name]
        if text is None:
            return not in_value
        # Characters that are referred to are part of the text; entities are looked up where it is put.
        text = re.sub(r"&#(?:[0-9]+|x[0-9a-fA-F]+);", lambda m: chr(_code(_REFERENCE.match(m.group()))), text)
        if in_value:
            return "<" not in text and not re.search(rf"&(?!{_REF[1:]})", text) and self.allow(text, True, (*within, name))
        return _xml_parts(text, "content", self, (*within, name))


def _model_kind(t: str) -> str:
    if t[0] in " \t\r\n":
        return ""
    if t[0] == ")":
        return {")": ")", ")*": "S"}.get(t, "R")
    if t in "(|,":
        return t
    if t == "#PCDATA":
        return "p"
    return ("N" if t[-1] in "*?+" else "n") if len(t) > 1 or re.match(_NAME, t) else "?"


def parse_xml(text: str) -> bool:
    text = text.removeprefix("\ufeff")
    return not _CONTROL.search(text) and _xml_parts(text, "document", _Entities())


def _xml_parts(text: str, rule: str, entities: _Entities, within: tuple[str, ...] = ()) -> bool:
    stack: list[tuple[str, list[str]]] = [("", [])]
    for m in _XML_TOKEN.finditer(text):
        kind, t = m.lastgroup, m.group()
        if kind == "bad":
            return False
        if kind == "d" and (m.start() or not _DECLARATION.fullmatch(t)):
            return False
        if kind == "y" and not entities.declare(t):
            return False
        if kind in "ot" and "&" in t and not entities.allow(t, kind == "o", within):
            return False
        if kind == "o":
            name = re.match(rf"<({_NAME})", t).group(1)
            if "=" in t:
                attrs = [a.group(1) for a in _ATTR_NAME.finditer(t)]
                if len(attrs) != len(set(attrs)):
                    return False
            if t.endswith("/>"):
                stack[-1][1].append("e")
            else:
                stack.append((name, ["o"]))
        elif kind == "c":
            name, parts = stack.pop()
            if not stack or name != t[2:-1].rstrip(" \t\r\n"):
                return False
            if not _xml_ok("".join(parts) + "c", "element"):
                return False
            stack[-1][1].append("e")
        else:
            stack[-1][1].append(kind)
    return len(stack) == 1 and _xml_ok("".join(stack[0][1]), rule)
