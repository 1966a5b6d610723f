"""Registered queries of the training-text operators do the whole of their job."""

import __spark_entry__


def save(df, at, name="documents"):
    df.write.parquet(f"{at}/{name}.parquet")


def test_what_the_exact_parsers_reject_is_found(spark, tmp_path):
    broken = [
        ("a.toml", "a = 1\na.b = 2\n"), ("b.toml", "a = 1\n[a]\n"), ("c.toml", "[[a]]\n[a]\n"), ("d.toml", "x = {a = 1, a = 2}\n"), ("e.toml", "x = 2023-02-30\n"),
        ("a.xml", "<a>&#0;</a>"), ("b.xml", "<a>&#x1F;</a>"), ("c.xml", "<!DOCTYPE 1><a/>"), ("a.py", "match x:\n    case 1 + 2:\n        pass\n"),
    ]
    good = [("z.toml", "[a]\n[a.b]\n[[c]]\n[[c]]\n"), ("z.xml", "<a>&#9;</a>"), ("z.py", "match x:\n    case 1 + 2j:\n        pass\n"), ("z.json", "9" * 5000), ("y.json", "[" * 3000 + "]" * 3000)]
    files = [(i, 1, p, t) for i, (p, t) in enumerate(broken + good)]
    save(spark.createDataFrame(files, "file_id long, repo_id long, path string, content string"), tmp_path, "repo_files")
    save(spark.createDataFrame([(7, "s", "x = 1")], "record_id long, source string, code string"), tmp_path, "python_tutorial_code")
    got = {r.item_id for r in __spark_entry__.queries()["p1_found"](spark, str(tmp_path)).collect()}
    assert got == set(range(len(broken)))


def test_license_bodies_without_a_name():
    from corpuskit.llm import license_texts, licenses

    def put(text, mark="# "):
        return "".join(f"{mark}{line}\n" for line in ("Copyright (c) 2020 A. Person\n\n" + text).splitlines()) + "\nimport os\n"

    for license_, body in license_texts.BODIES:
        if license_ or "Apache" not in body:
            assert licenses.stated_license(put(body)) == license_, (license_, body[:60])
            assert licenses.stated_license(put(body.replace("the", "teh", 2), " * ")) == license_, (license_, body[:60])
    for license_, title in license_texts.TITLES:
        assert licenses.stated_license(f"   {title}\n\nunlike the GNU Affero General Public License, version 3\n") == license_
    assert licenses.stated_license("permission to use this is granted to anyone\n" * 30) is None
