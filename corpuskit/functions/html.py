"""Python code blocks of HTML documentation, by the standard library's parser in one pass over each page."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.text import strip_doctest_prompts

#: Class marks of Python blocks, elements without an end tag.
PYTHON_MARKS = {"python", "python3", "pycon", "python-console"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, set[str]]] = []
        self.blocks: list[dict] = []
        self.title, self.heading, self.texts = "", "", []
        self.open: list[dict] = []  # blocks whose first <pre> is still to come or running
        self.run: list[str] | None = None
        self.run_tag = ""

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        classes = set((dict(attrs).get("class") or "").split())
        self.stack.append((tag, classes))
        if tag == "div" and any("highlight" in c for c in classes):
            self.open.append({"depth": len(self.stack), "code": None, "done": False, "context": self.texts[-3:], "section": self.heading or self.title})
        elif tag == "pre":
            for b in self.open:
                if not b["done"] and b["code"] is None:
                    b["code"] = []
        elif tag in ("h1", "h2", "h3", "p", "title"):
            self.run, self.run_tag = [], tag

    def handle_data(self, data):
        if self.run is not None:
            self.run.append(data)
        for b in self.open:
            if b["code"] is not None and not b["done"]:
                b["code"].append(data)

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while True:
            t, _ = self.stack[-1]
            if t == "pre":
                for b in self.open:
                    if b["code"] is not None:
                        b["done"] = True
            for b in [b for b in self.open if b["depth"] == len(self.stack)]:
                self.open.remove(b)
                if b["code"] is not None:
                    marks = {c.removeprefix("highlight-").lower() for _, cs in self.stack for c in cs}
                    self.blocks.append({"raw": "".join(b["code"]), "marks": marks, "context": " ".join(b["context"]), "section": b["section"]})
            self.stack.pop()
            if t == tag:
                break
        if self.run is not None and tag == self.run_tag:
            text = " ".join("".join(self.run).split())
            if text and tag == "title":
                self.title = self.title or text
            elif text:
                self.texts.append(text)
                if tag != "p":
                    self.heading = text
            self.run = None


def page_blocks(html: str | None) -> list[dict]:
    """Blocks of a page: raw code, detection (doctest or explicit_python), section, context. Others are left out."""
    if not html:
        return []
    page = _Page()
    page.feed(html)
    page.close()
    out = []
    for b in page.blocks:
        prompt = any(line.lstrip().startswith((">>> ", "... ")) for line in b["raw"].splitlines())
        how = "doctest" if "pycon" in b["marks"] or prompt else "explicit_python" if b["marks"] & PYTHON_MARKS else None
        if how:
            out.append({"raw": b["raw"], "detection_method": how, "section": b["section"], "context": b["context"]})
    return out


def extract_blocks(pages: DataFrame, key_col: str = "path", html_col: str = "html") -> DataFrame:
    """key, ordinal, code, detection_method, section, context: one row for each Python block of each page."""
    key_type = pages.schema[key_col].dataType.simpleString()
    names = ["raw", "detection_method", "section", "context"]

    def run(batches):
        for batch in batches:
            at, order, rows = [], [], []
            for i, html in enumerate(batch.column("html").to_pylist()):
                for k, b in enumerate(page_blocks(html)):
                    at.append(i)
                    order.append(k)
                    rows.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int64())), pa.array(order, pa.int32()), *(pa.array([r[n] for r in rows], pa.string()) for n in names)],
                ["key", "ordinal", *names],
            )

    got = pages.select(F.col(key_col).alias("key"), F.col(html_col).alias("html")).mapInArrow(run, f"key {key_type}, ordinal int, raw string, detection_method string, section string, context string")
    code = F.when(F.col("detection_method") == "doctest", strip_doctest_prompts("raw")).otherwise(F.col("raw"))
    return got.select(F.col("key").alias(key_col), "ordinal", code.alias("code"), "detection_method", "section", "context")
