"""License of each code file and repository (problem 3).

Method: templates of license names and of phrases that state a license are token sequences, indexed by length; each
length has a metric tree under token edit distance, which is computed bit-parallel. A query visits only the children that
the triangle inequality leaves open, and the nearest template is accepted if its distance is within a bound that grows
with its length, and (for names) no template of another license is as near.

The standard license bodies and headers are templates too, looked for at every place of every text, with a name or
without one, within a tenth of their length; the nearest decides. A text that begins with the title of a whole license
text is that license.

A text is read whole: every place that names a license is looked up with the words around it, and a phrase that states
it counts unless the words before it in its part of the sentence deny it (``DENYING``): a negation, a contrast, the past, a
doubt, or other works that it speaks of. Other places mention the license only. Two names that are a free choice (``MIT OR
Apache-2.0``) state that choice.

Defined results: null, empty and blank texts state nothing; repeated rows of a file count once; files of a repository
that is no candidate have their own and their directories' licenses, or UNKNOWN; null paths are no .py files; several
license files of one directory that state different licenses give CONFLICT, as do different statements within a text;
empty tables give an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit.llm.arrow import small_batches
from corpuskit.llm.license_texts import BODIES, TITLES
from corpuskit.session import cut_lineage, spread

UNKNOWN, CONFLICT = "UNKNOWN", "CONFLICT"

#: The names by which licenses go.
NAMES = {
    "MIT": ["mit", "mit license", "mit expat", "expat license"],
    "Apache-2.0": ["apache 2", "apache license 2", "apache license version 2", "apache software license 2", "apache software license version 2", "asl 2"],
    "BSD-3-Clause": ["bsd 3 clause", "3 clause bsd", "3 clause bsd license", "bsd 3 clause license", "new bsd license", "modified bsd license", "bsd 3 clauses", "new bsd"],
    "BSD-2-Clause": ["bsd 2 clause", "2 clause bsd", "2 clause bsd license", "bsd 2 clause license", "simplified bsd license", "bsd 2 clauses", "simplified bsd"],
    "GPL-3.0": ["gpl 3", "gnu gpl 3", "gpl version 3", "gnu gpl version 3", "gnu general public license version 3", "gnu general public license 3"],
    "GPL-2.0": ["gpl 2", "gnu gpl 2", "gpl version 2", "gnu gpl version 2", "gnu general public license version 2", "gnu general public license 2"],
    "LGPL-3.0": ["lgpl 3", "gnu lgpl 3", "lgpl version 3", "gnu lgpl version 3", "gnu lesser general public license version 3", "gnu lesser general public license 3"],
    "AGPL-3.0": ["agpl 3", "gnu agpl 3", "agpl version 3", "gnu agpl version 3", "gnu affero general public license version 3", "gnu affero general public license 3", "affero gpl 3"],
    "MPL-2.0": ["mpl 2", "mpl version 2", "mozilla public license 2", "mozilla public license version 2"],
    "ISC": ["isc", "isc license"],
    "Unlicense": ["unlicense"],
}
#: Ways to say that something comes under a license; L is its name, bars are line ends.
_VERBS = "licensed released distributed redistributed published provided offered shared supplied issued available used relicensed".split()
_TERMS = ["", "the terms of ", "the terms and conditions of ", "the conditions of ", "either of ", "the following license : "]
STATING = [
    *(f"{v} under {t}L" for v in _VERBS for t in _TERMS), *(f"{v} to you under {t}L" for v in ("licensed", "offered", "given", "provided") for t in _TERMS[:2]),
    *(f"{v} {t}L" for v in ("covered by", "governed by", "subject to", "is under", "are under") for t in _TERMS[:3]), *(f"{p} {t}L" for p in ("under", "according to") for t in _TERMS[1:3]),
    "license : L", "license = L", "license is L", "license L |", "spdx license identifier : L", "spdx license identifier L", "__license__ = L", "__license__ : L", "| L |", "dual licensed L", "dual licensed choose one : L",
    "sous license L", "sous la license L", "sous la license suivante : L", "sous les termes de la license L",
    "steht unter L", "steht unter der L", "unter der lizenz L", "unter folgender lizenz : L", "lizenziert unter L", "lizenziert unter der L",
    "bajo la licencia L", "bajo licencia L", "sob a licença L", "sotto la licenza L",
]
#: Words before such a phrase, in its part of the sentence, that make it no statement about the text itself: it is denied,
#: past, doubted, or about other works.
DENYING = set(
    "not no never cannot nor neither without unlike than instead opposed contrary nothing none nicht kein keine pas nunca "
    "isn aren wasn weren doesn don won couldn shouldn wouldn ain "
    "was were had formerly previously once until before originally earlier past "
    "whether if should would could might ask todo fixme consider perhaps maybe question unclear "
    "packages projects dependencies libraries works repositories components assets programs things others some parts portions bundled vendored third upstream "
    "reject rejects rejected accept accepts accepted allow allows allowed forbidden denied detect detects match matches find finds maps names such example compatible incompatible requires depends".split()
)

_TOKEN = re.compile(r"__license__|[^\W\d_]+(?:[-_][\w.\-]*\w)?|\d+(?:\.\d+)*|[:=+\n]")
_ANCHOR = re.compile(r"\b(?:mit|apache2?|bsd|[al]?gpl(?:v\d)?|mpl(?:v\d)?|mozilla|isc|unlicense|gnu|affero|expat|asl)\b")
_REACH = 300  # characters around a name that can belong to its sentence; more than any template is long
_WORDY = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")
_STARTS = {"mit", "expat", "apache", "asl", "bsd", "3", "2", "new", "modified", "simplified", "gpl", "gnu", "lgpl", "agpl", "affero", "mpl", "mozilla", "isc", "unlicense"}
_SAME = {"licence": "license", "licenses": "license", "three": "3", "two": "2"}
_NAME_WORDS = {w for names in NAMES.values() for n in names for w in n.split()} | {"v", "the", "only", "or", "later", "and"}


class MetricTree:
    """A Burkhard-Keller tree of token sequences under edit distance."""

    def __init__(self):
        self.root = None

    def add(self, tokens: tuple[str, ...], value: str) -> None:
        node = [tokens, masks(tokens), {value}, {}]
        if self.root is None:
            self.root = node
            return
        at = self.root
        while True:
            d = distance(at[1], len(at[0]), tokens)
            if d == 0:
                at[2].add(value)
                return
            if d not in at[3]:
                at[3][d] = node
                return
            at = at[3][d]

    def nearest(self, tokens, bound: int) -> tuple[int, set[str]]:
        """Least distance within the bound, and the values there (empty if none is within)."""
        best, values, todo = bound, set(), [self.root] if self.root else []
        while todo:
            node = todo.pop()
            d = distance(node[1], len(node[0]), tokens)
            if d < best or (d == best and not values):
                best, values = d, set(node[2])
            elif d == best:
                values |= node[2]
            # The triangle inequality: what lies at distance e from the node is at least |d - e| away.
            todo += [child for e, child in node[3].items() if abs(d - e) <= best]
        return (best, values) if values else (bound + 1, set())


def masks(tokens) -> dict[str, int]:
    """For each token, the bits of the positions it has."""
    out: dict[str, int] = {}
    for i, t in enumerate(tokens):
        out[t] = out.get(t, 0) | (1 << i)
    return out


def distance(pattern: dict[str, int], length: int, tokens) -> int:
    """Edit distance between a pattern (its masks) and tokens: all rows of a column at once, in the bits of integers."""
    if not length:
        return len(tokens)
    full, top, score = (1 << length) - 1, 1 << (length - 1), length
    plus, minus = full, 0
    for t in tokens:
        eq = pattern.get(t, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        score += 1 if up & top else -1 if down & top else 0
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return score


class TemplateIndex:
    """Metric trees by length."""

    def __init__(self):
        self.trees: dict[int, MetricTree] = {}

    def add(self, tokens, value: str) -> None:
        self.trees.setdefault(len(tokens), MetricTree()).add(tuple(tokens), value)

    def nearest(self, tokens, bound: int) -> tuple[int, set[str]]:
        best, values = bound + 1, set()
        for n in range(max(1, len(tokens) - bound), len(tokens) + bound + 1):
            if n in self.trees:
                d, got = self.trees[n].nearest(tokens, min(bound, best))
                if got and d < best:
                    best, values = d, got
                elif got and d == best:
                    values = values | got
        return best, values


@lru_cache(maxsize=1)
def _indexes():
    names, sentences = TemplateIndex(), TemplateIndex()
    for license_, variants in NAMES.items():
        for v in variants:
            names.add(v.split(), license_)
    shapes = set()
    for t in STATING:
        tokens = t.split()
        at = tokens.index("L")
        shapes.add((at, len(tokens) - at - 1))
        sentences.add(tokens, t)
    return names, sentences, sorted(shapes)


@lru_cache(maxsize=200_000)
def _nearest(kind: int, tokens: tuple[str, ...], bound: int) -> tuple[int, frozenset[str]]:
    """Nearest name (0) or sentence (1) template; texts repeat the same few windows."""
    d, values = _indexes()[kind].nearest(tokens, bound)
    return d, frozenset(values)


def _words(text: str) -> list[str]:
    """Words of a name: letters, and numbers without a final .0."""
    out = []
    for w in _WORDY.findall(text.lower()):
        w = _SAME.get(w, w)
        if w[0].isdigit():
            w = re.sub(r"(?:\.0)+$", "", w)
        out.append(w)
    # 'gplv3' and 'apache2' come as one run of letters and a number; a trailing v belongs to the number.
    return [w[:-1] if w in ("gplv", "lgplv", "agplv", "mplv") else w for w in out]


def _stream(text: str, places: list | None = None, asked: set[tuple[int, int]] | None = None):
    """Tokens of a text with line ends as bars, license names still apart.

    ``places`` gets the (line, sentence, part of it) of each token. A sentence ends with its mark, and with a line after
    which another kind of line follows: an empty one, code after a comment and the like. ``asked`` gets the lines and sentences that
    end by asking.
    """
    tokens, low = [], text.lower()
    line = sentence = part = end = 0
    for m in _TOKEN.finditer(low):
        t = m.group()
        if places is not None:
            for mark in _MARK.finditer(low, end, m.start() + 1):
                if mark.group() in ",:()":
                    part += 1
                elif mark.end() >= len(low) or low[mark.end()] in " \t\r\n\"'*)":
                    if mark.group() == "?":
                        asked.add((line, sentence))
                    sentence += 1
            end = m.end()
        had = len(tokens)
        if t == "\n":
            if not tokens or tokens[-1] != "|":
                tokens.append("|")
            if places is not None:
                if not _goes_on(low, m.start()):
                    sentence += 1
                line += 1
        elif t == "__license__" or t in ":=+":
            tokens.append(t)
        else:
            parts = _words(t)
            # hyphened names are one token unless they are words of license names
            tokens += parts if all(p in _NAME_WORDS or p.isalpha() and p in ("spdx", "identifier", "clause", "clauses") or p[0].isdigit() for p in parts) else [t]
        if places is not None:
            places += [(line, sentence, part)] * (len(tokens) - had)
    return tokens


_ARTICLES = ("the", "a", "an")
_MARK = re.compile(r"[.!?;,:()]")
_COMMENT = re.compile(r"[ \t]*(#|//|/?\*|;|--|%|\.\.|rem\b)?[#/*;%!\- \t]*([^\n]*)")


def _goes_on(low: str, at: int) -> bool:
    """Whether a sentence can go on behind the line end at ``at``: both lines are prose of one kind, neither is empty."""
    one, two = _COMMENT.match(low, low.rfind("\n", 0, at) + 1), _COMMENT.match(low, at + 1)
    if not one.group(2).strip() or not two.group(2).strip() or one.group(1) != two.group(1):
        return False
    return bool(one.group(1)) or not re.search(r"[=(){}\[\]]", one.group(2) + two.group(2))


def _names(tokens: list[str]) -> list[tuple[int, int, str]]:
    """Places (start, stop, license) of license names in a token stream; the longest name at each place."""
    out, i = [], 0
    while i < len(tokens):
        if tokens[i] not in _STARTS:
            i += 1
            continue
        best = None
        plain, ends = [], []
        for j in range(i, min(len(tokens), i + 14)):
            if tokens[j] in ("|", "v"):
                continue
            if tokens[j] not in _NAME_WORDS or tokens[j] == "license" and tokens[j + 1 : j + 2] in ([":"], ["="]):
                break  # a word with a colon after it begins the next statement
            plain.append(tokens[j])
            ends.append(j + 1)
            if len(plain) == 8:
                break
        for n in range(len(plain), 0, -1):
            d, values = _nearest(0, tuple(plain[:n]), n // 4 if n > 5 else 0)
            if len(values) == 1 and (best is None or d < best[0]):
                best = (d, ends[n - 1], next(iter(values)))
                if d == 0:
                    break
        if best is None:
            i += 1
            continue
        _, stop, license_ = best
        # suffixes that do not change the license
        while stop < len(tokens) and tokens[stop] in ("or", "and") and tokens[stop + 1 : stop + 2] == ["later"]:
            stop += 2
        if tokens[stop : stop + 1] in (["only"], ["+"]):
            stop += 1
        while stop < len(tokens) and tokens[stop] == "license" and tokens[stop + 1 : stop + 2] not in ([":"], ["="]):
            stop += 1
        out.append((i, stop, license_))
        i = stop
    return out


def _choice(licenses: list[str]) -> str:
    both = sorted(set(licenses))
    return " OR ".join(both)


def stated_name(text: str | None) -> str | None:
    """The license that a key or a line of metadata names as a whole; None for placeholders and other words."""
    if not text or not text.strip():
        return None
    last = text.split("::")[-1]
    tokens = [t for t in _stream(last) if t not in ("|", "the", ":", "=")]
    found = _names(tokens)
    if not found:
        return None
    rest = list(tokens)
    for a, b, _ in reversed(found):
        rest[a:b] = ["L"]
    if rest == ["L"]:
        return found[0][2]
    if rest == ["L", "or", "L"]:
        return _choice([x[2] for x in found])
    return None


_PLAIN = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")
_SEED = 4  # words


def _plain(text: str) -> list[str]:
    return [_SAME.get(w, w) for w in _PLAIN.findall(text.lower())]


@lru_cache(maxsize=1)
def _bodies():
    """Templates (license, masks, length, bound) and the seeds that find them.

    A template cut into bound + 1 parts has one unchanged part in every text within the bound; the first words of the parts
    are the seeds.
    """
    templates, seeds = [], {}
    for license_, body in BODIES:
        words = _plain(body)
        bound = len(words) // 10
        for i in range(bound + 1):
            at = i * len(words) // (bound + 1)
            seeds.setdefault(tuple(words[at : at + _SEED]), set()).add(len(templates))
        templates.append((license_, masks(words), len(words), bound))
    return templates, seeds, [(license_, _plain(t)) for license_, t in TITLES]


def nearest_places(pattern: dict[str, int], length: int, tokens, bound: int) -> list[tuple[int, int]]:
    """Ends of runs of the tokens that lie within the bound of the pattern, and their distances: as ``distance``, with a free start."""
    full, top, score = (1 << length) - 1, 1 << (length - 1), length
    plus, minus, out = full, 0, []
    for end, t in enumerate(tokens):
        eq = pattern.get(t, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        score += 1 if up & top else -1 if down & top else 0
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score <= bound:
            out.append((end, score))
    return out


def _bodies_in(text: str) -> tuple[set[str], bool]:
    """Licenses whose body or header a text has, and whether it is a whole license text."""
    words = _plain(text)
    templates, seeds, titles = _bodies()
    for license_, title in titles:
        if words[: len(title)] == title:
            return ({license_} if license_ else set()), True
    grams = zip(words, words[1:], words[2:], words[3:])
    near = set().union(*(seeds[g] for g in seeds.keys() & set(grams)))
    places = []
    for k in near:
        license_, pattern, length, bound = templates[k]
        for end, d in nearest_places(pattern, length, words, bound):
            places.append((d / length, -length, end - length, end, license_))
    # The nearest template has its place; others that overlap it are variants of it.
    taken, found = [], set()
    for _, _, start, end, license_ in sorted(places, key=lambda x: x[:4]):
        if all(end <= a or start >= b for a, b in taken):
            taken.append((start, end))
            if license_:
                found.add(license_)
    return found, False


def stated_license(text: str | None) -> str | None:
    """The license a text states for itself: None if it states none, CONFLICT for different ones."""
    if not text:
        return None
    stated, whole = _bodies_in(text)
    if whole:
        return next(iter(stated), None)
    low = text.lower()
    spans: list[list[int]] = []
    for m in _ANCHOR.finditer(low):
        a = low.rfind("\n", 0, max(0, m.start() - _REACH)) + 1
        b = low.find("\n", m.end() + _REACH)
        b = len(low) if b < 0 else b
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    for a, b in spans:
        stated |= _stated_in(low[a:b])
    if not stated:
        return None
    return stated.pop() if len(stated) == 1 else CONFLICT


def _stated_in(low: str) -> set[str]:
    """The licenses stated by some whole lines of a text."""
    shapes = _indexes()[2]
    places: list[tuple[int, int, int]] = []
    asked: set[tuple[int, int]] = set()
    tokens = ["|", *_stream(low, places, asked), "|"]
    found = _names(tokens)
    if not found:
        return set()
    places = [(-1, -1, -1), *places, (-2, -2, -2)]
    # The names become single tokens; names joined by 'or', or listed below each other, become one choice.
    out, where, at, k = [], [], 0, 0
    while k < len(found):
        a, b, license_ = found[k]
        out += tokens[at:a]
        where += places[at:a]
        if out[-1:] == ["|"] and out[-2:-1] and out[-2] in _ARTICLES:
            del out[-2], where[-2]
        elif out and out[-1] in _ARTICLES:
            del out[-1], where[-1]
        many = [license_]
        while k + 1 < len(found):
            gap = [t for t in tokens[b : found[k + 1][0]] if t not in ("|", "the")]
            listed = not gap and "choose one" in " ".join(t for t in out[-6:] if isinstance(t, str) and t not in ("|", ":"))
            if gap != ["or"] and not listed:
                break
            k += 1
            b = found[k][1]
            many.append(found[k][2])
        out.append((_choice(many),))
        where.append(places[a])
        at = b
        k += 1
    out += tokens[at:]
    where += places[at:]
    stated = set()
    for i, t in enumerate(out):
        if not isinstance(t, tuple) or t[0] in stated:
            continue
        best, starts = 99, set()
        for before, after in shapes:
            for lines in (True, False):  # with line ends, and as one run of words
                left = [k for k in range(max(0, i - before * 3 - 3), i) if lines or out[k] != "|"]
                right = [k for k in range(i + 1, min(len(out), i + 1 + after * 3 + 3)) if lines or out[k] != "|"]
                left, right = left[max(0, len(left) - before) :], right[:after]
                if len(left) != before or len(right) != after:
                    continue
                window = tuple("L" if isinstance(out[k], tuple) else out[k] for k in (*left, i, *right))
                if not _CORE & set(window):
                    continue
                d, got = _nearest(1, window, 0 if len(window) <= 4 else 1 if len(window) <= 7 else 2)
                if got and d <= best:
                    if d < best:
                        best, starts = d, set()
                    starts.add((left[0] if left else i, any(x in y for y in got for x in ("license :", "=", "|", "spdx", "__"))))
        # Where several phrases fit equally well, any that is denied denies all.
        if starts and not any(_denied(out, where, asked, i, start, label) for start, label in starts):
            stated.add(t[0])
    return stated


_CORE = {w for t in STATING for w in t.split()} - {"L", "the", "of", "is", "are", "to", "you", "la", "a", "der", "de", "les", "terms", "conditions", "and", "one", "either", "following", "suivante", "folgender"}


def _denied(out: list, where: list, asked: set[tuple[int, int]], at: int, start: int, label: bool) -> bool:
    """Whether words of the phrase from ``start``, or before it in its part of the sentence, deny that it states a license.

    A label counts with its line alone. A short part before a comma ("Until then, ...") belongs to the next one.
    """
    line, sentence, _ = where[start]
    if not label and where[at][:2] in asked:
        return True
    parts: list[list[int]] = [[]]
    for k in range(start - 1, -1, -1):
        if where[k][0] != line if label else where[k][1] != sentence:
            break
        if where[k][2] != where[parts[-1][-1] if parts[-1] else start][2]:
            parts.append([])
        parts[-1].append(k)
    used = [*parts[0], *(parts[1] if label or len(parts) > 1 and len(parts[1]) <= 3 else [])] if len(parts) > 1 else parts[0]
    said = [out[k] for k in sorted((*used, *range(start, at))) if isinstance(out[k], str) and out[k] != "|"]
    return not DENYING.isdisjoint(said) or ("used", "to") in zip(said, said[1:])


_LICENSE_FILE = r"^(?:licen[sc]e|copying)(?:\.[^/]*)?$"


def _states(batches):
    for batch in small_batches(batches, "content"):
        got = [stated_license(t) for t in batch.column("content").to_pylist()]
        keep = [n for n in batch.schema.names if n != "content"]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(got, pa.string())], [*keep, "stated"])


def _merged(c):
    """One license for several statements: none UNKNOWN, different ones CONFLICT."""
    return F.when(F.count(c) == 0, UNKNOWN).when(F.min(c) == F.max(c), F.min(c)).otherwise(CONFLICT)


@F.pandas_udf(T.StringType())
def _name_udf(names: pd.Series) -> pd.Series:
    return pd.Series([stated_name(x) if isinstance(x, str) else None for x in names], dtype=object)


class Licenses:
    """Licenses of a set of repositories: ``files`` (file_id, license, own, around) and ``repos`` (repo_id, license)."""

    def __init__(self, files: DataFrame, repos: DataFrame, manifest: DataFrame):
        rows = files.select("file_id", "repo_id", "path", "content")
        name = F.lower(F.element_at(F.split("path", "/"), -1))
        is_python = name.endswith(".py")
        is_license = name.rlike(_LICENSE_FILE) & ~is_python  # license.py is code
        folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
        wanted = rows.filter(is_license | is_python).select("file_id", "repo_id", folder.alias("folder"), is_license.alias("is_license"), "content")
        read = spread(wanted).mapInArrow(_states, "file_id long, repo_id long, folder string, is_license boolean, stated string").distinct()
        read = cut_lineage(read)  # what files state is looked at four times and holds no texts: they are read once
        self.read = read
        license_files = read.filter("is_license")
        keys = repos.filter("repo_id is not null").select("repo_id", _name_udf("license_key").alias("stated"))
        free = manifest.filter("repo_id is not null").select("repo_id", _name_udf("license").alias("stated"))
        root = license_files.filter("folder = ''").select("repo_id", "stated")
        said = keys.unionByName(root.join(repos.select("repo_id"), "repo_id", "left_semi")).unionByName(free.join(repos.select("repo_id"), "repo_id", "left_semi"))
        self.repos = said.groupBy("repo_id").agg(_merged("stated").alias("license"))
        self.files = self._files(read.filter("not is_license"), license_files.filter("folder <> ''"))

    def _files(self, python: DataFrame, license_files: DataFrame) -> DataFrame:
        by_folder = license_files.groupBy("repo_id", "folder").agg(_merged("stated").alias("license"))
        # Directories are resolved once each, not file by file: (repository, directory) -> nearest license at or above it.
        folders = python.filter("folder <> ''").select("repo_id", "folder").distinct()
        parts = F.split("folder", "/")
        above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("at")))
        steps = folders.select("repo_id", "folder", F.explode(above).alias("s")).select("repo_id", "folder", "s.depth", F.col("s.at").alias("at"))
        near = (
            steps.join(by_folder.withColumnRenamed("folder", "at"), ["repo_id", "at"])
            .groupBy("repo_id", "folder")
            .agg(F.max_by("license", "depth").alias("nearest"))
        )
        own = F.col("stated")
        around = F.coalesce("nearest", "license", F.lit(UNKNOWN))
        known = ~around.isin(UNKNOWN, CONFLICT)
        included = F.array_contains(F.split(around, " OR "), own)
        verdict = F.when(own.isNull(), around).when(known & (own != around) & ~included, CONFLICT).otherwise(own)
        return (
            python.join(near, ["repo_id", "folder"], "left")
            .join(self.repos, "repo_id", "left")
            .select("file_id", "repo_id", verdict.alias("license"), own.alias("own"), around.alias("around"))
        )

    def found(self) -> DataFrame:
        """item_kind, item_id, license: one row for each .py file and each repository."""
        files = self.files.select(F.lit("file").alias("item_kind"), F.col("file_id").alias("item_id"), "license")
        return files.unionByName(self.repos.select(F.lit("repo").alias("item_kind"), F.col("repo_id").alias("item_id"), "license"))
