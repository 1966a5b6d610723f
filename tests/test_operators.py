import io
import os
import random
import shutil
import tarfile
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.functions import code_graph
from corpuskit.operators import alike, dedup, governance, joins, packages, qa, quality, repos
from corpuskit.operators.components import connected_components
from corpuskit.sources import readers, writers
from corpuskit.streaming import jobs


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_gate_and_summaries(spark):
    df = spark.createDataFrame([(1, "a", "# c\n" + "x = 1\n" * 60), (2, "a", "x"), (3, None, ""), (4, "b", None), (5, "b", "y\n" * 5000)], "id int, source string, code string")
    got = {r.id: r for r in quality.quality_gate(df, "code").collect()}
    assert got[2].reason_codes == ["token_min", "comment_ratio"] and "token_count 1 < MIN_TOKEN_LENGTH 50" in got[2].rejection_reasons
    assert got[3].rejection_reasons == got[4].rejection_reasons == ["empty code field"] and got[5].reason_codes == ["token_max", "comment_ratio"]
    strict = quality.quality_gate(df, "code", F.lit(False), F.lit(6), min_ratio=0.0).filter("id = 1").first()
    assert strict.reason_codes == ["pep8", "ast"]
    total = {(r.source, r.is_total): r for r in quality.summary_rollup(quality.quality_gate(df, "code")).collect()}
    assert total[None, 1].records_examined == 5 and total["a", 0].records_examined == 2 and total[None, 0].records_examined == 1
    assert sum(r.n for r in quality.reason_histogram(quality.quality_gate(df, "code")).collect()) == 7
    assert quality.summary_by(quality.quality_gate(df.limit(0), "code")).count() == 0


def test_funnel_takes_the_first_failure(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b "), (3, ""), (4, None), (5, "c"), (6, "c")], "id int, code string")
    got = rows(quality.funnel(df, "code", ["id"], F.col("code") != "c", F.lit(60), F.lit(0.5), F.when(F.col("id") == 1, 9).otherwise(0)), "id", "bucket")
    assert got == [(1, "pep8_rejected"), (2, "exact_duplicates"), (3, "syntax_invalid"), (4, "syntax_invalid"), (5, "syntax_invalid"), (6, "exact_duplicates")]


def test_first_seen_and_provenance(spark):
    df = spark.createDataFrame([(3, "h", "s", 5), (1, "h", "t", 9), (2, None, "s", 1), (4, "g", "s", 1), (4, "g", "s", 1)], "id int, h string, source string, at int")
    assert rows(dedup.first_seen(df, ["h"], ["id"]), "id") == [(1,), (2,), (4,)]
    assert rows(dedup.first_seen(df, ["h"], ["id"], flag="f"), "id", "f") == [(1, True), (2, True), (3, False), (4, True), (4, True)]
    assert rows(dedup.duplicate_of(df, "h", "id", ["id"]), "id", "duplicate_of") == [(1, None), (2, None), (3, 1), (4, None), (4, None)]
    p = {r.content_hash: r for r in dedup.provenance(df, "h", "source", "at", ["id"]).collect()}
    assert p["h"].kept_source == "t" and p["h"].discarded_sources == ["s"] and p["g"].n_records == 2


def test_pairs_against_brute_force(spark):
    rng = random.Random(2)
    prints = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(40)]
    prints += [(100 + i, h ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 11)))) for i, h in prints[:30]]
    df = spark.createDataFrame(prints, "id long, h long")
    want = {(min(a, b), max(a, b)) for i, (a, x) in enumerate(prints) for b, y in prints[i + 1 :] if bin((x ^ y) & ((1 << 64) - 1)).count("1") <= 9}
    assert {(r.id_a, r.id_b) for r in dedup.simhash_pairs(df, "id", "h").collect()} == want
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(25))) for i in range(30)]
    texts += [(100 + i, t.replace(t[:6], "zz", 1)) for i, t in texts[:15]] + [(200, None), (201, "ab"), (202, texts[0][1].upper())]
    tri = {i: {t.lower()[k : k + 3] for k in range(len(t) - 2)} for i, t in texts if t}
    want = {(a, b) for a in tri for b in tri if a < b and tri[a] and tri[b] and len(tri[a] & tri[b]) / len(tri[a] | tri[b]) > 0.85}
    pairs = dedup.trigram_pairs(spark.createDataFrame(texts, "id long, t string"), "id", "t").persist()
    assert {(r.id_a, r.id_b) for r in pairs.collect()} == want and len(want) > 5
    records = spark.createDataFrame([(i, rng.randint(0, 5), i) for i, _ in texts], "id long, score int, place long")
    score = {r.id: r.score for r in records.collect()}
    kept = []
    for i, _ in sorted(texts):
        hit = next((k for k in kept if (min(i, k), max(i, k)) in want), None)
        if hit is None:
            kept.append(i)
        elif score[i] > score[hit]:
            kept.remove(hit)
            kept.append(i)
    assert {r.id for r in dedup.greedy_survivors(records, pairs, "id", "score", "place").collect()} == set(kept)


def test_trigram_pairs_shuffle_texts_and_no_pairs(spark):
    sites, words = ["one-guide", "two-press", "six-notes"], ["buffer", "velvet", "rabbit"]
    urls = [(i, f"https://{s}.example/{w}/{k}") for i, (s, w, k) in enumerate((s, w, k) for s in sites for w in words for k in range(100, 200))]
    urls += [(9000 + i, urls[7][1]) for i in range(600)] + [(9700, "https://two-press.example/one-guide"), (9701, "HTTPS://Two-Press.example/one.guide"), (9800, None), (9801, "a-b"), (9802, "")]
    urls += [(9900, "xyxyxy1"), (9901, "xyxyxyxyxy1"), (9902, urls[3][1]), (9902, urls[4][1]), (9902, urls[3][1]), (None, urls[3][1])]
    tri = [(i, frozenset(n[k : k + 3] for k in range(len(n) - 2))) for i, u in urls if i is not None and u and len(n := "".join(c for c in u.lower() if c.isalnum())) > 2]
    of = {}
    for i, t in tri:
        of.setdefault(t, set()).add(i)
    want = set()
    for x, some in of.items():
        for y, others in of.items():
            if (s := len(x & y) / len(x | y)) > 0.85:
                want |= {(a, b, s) for a in some for b in others if a < b}

    def shuffled():
        store, none = spark._jsc.sc().statusStore(), spark._jvm.java.util.ArrayList()
        stages = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    for some in (urls, [(i, u) for i, u in urls if i != 9902]):
        before = shuffled()
        got = [tuple(r) for r in dedup.trigram_pairs(spark.createDataFrame(some, "id long, t string"), "id", "t").collect()]
        assert len(got) == len(set(got)) and set(got) == {p for p in want if len(some) == len(urls) or 9902 not in p[:2]}
    assert len(got) > 200_000 and shuffled() - before < 20 * len(urls)
    named = spark.createDataFrame([(str(i), u) for i, u in urls[:40]], "id string, t string")
    assert {tuple(r) for r in dedup.trigram_pairs(named, "id", "t").collect()} == {(min(str(a), str(b)), max(str(a), str(b)), s) for a, b, s in want if max(a, b) < 40}


def test_trigram_pairs_of_long_texts_beside_short_ones(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    texts = []
    for n in [5, 20] * 4 + [36, 37, 38, 39, 40, 41] * 2 + [300] * 3:
        base = [rng.choice(words) for _ in range(n)]
        texts += [" ".join(base), " ".join(base), *(" ".join([*base, *rng.sample(words, k)]) for k in (1, 2, 3)), " ".join(base[: n - 1 - n // 20])]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(60_000)), None]
    texts += [texts[-7]] * 520
    tri = [{t[k : k + 3] for k in range(len(t) - 2)} if t else set() for t in texts]
    of = {}
    for i, t in enumerate(texts):
        of.setdefault(t, []).append(i)
    heads = {t: tri[i[0]] for t, i in of.items() if t}
    want = [(a, b, s) for t, x in heads.items() for u, y in heads.items() if (s := len(x & y) / len(x | y)) > 0.85 for a in of[t] for b in of[u] if a < b]
    sizes = [sorted((len(tri[a]), len(tri[b]))) for a, b, _ in want]
    assert any(x <= 256 < y for x, y in sizes) and any(y <= 256 for _, y in sizes) and any(x > 1000 for x, _ in sizes)
    got = dedup.trigram_pairs(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t")
    assert sorted(map(tuple, got.collect())) == sorted(want) and got.schema["id_a"].dataType.simpleString() == "int"


def test_alike_sets_parted_by_frequency(monkeypatch):
    rng = random.Random(3)
    for threshold, block in [(0.85, 4), (0.85, 512), (0.5, 16), (0.95, 4), (0.75, 1)]:
        monkeypatch.setattr(alike, "_BLOCK", block)
        words = ["".join(rng.choice("abcdé漢 0") for _ in range(rng.randint(1, 8))) for _ in range(12)]
        texts = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + str(rng.randint(10, 99)) for _ in range(200)})
        rank = np.array(rng.sample(range(alike.BUCKETS), alike.BUCKETS), np.int32)
        rows = sorted((int(g), t, [i]) for i, (t, own) in enumerate(zip(texts, alike.prefixes(texts, rank, threshold, 99))) for g in own if len(t) > 2)
        batches = pa.table({"g": pa.array([g for g, *_ in rows], pa.int64()), "t": [t for _, t, _ in rows], "ids": pa.array([i for *_, i in rows], pa.list_(pa.int64()))}).to_batches(max_chunksize=7)
        tri = [{t[k : k + 3] for k in range(len(t) - 2)} for t in texts]
        want = [(i, j, s) for i, x in enumerate(tri) for j in range(i + 1, len(tri)) if x and tri[j] and (s := len(x & tri[j]) / len(x | tri[j])) > threshold]
        assert sorted(p for a, b, s in alike.pairs(batches, rank, threshold) for p in zip(a.tolist(), b.tolist(), s.tolist())) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (102, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_joins_by_size(spark):
    named = spark.createDataFrame([("x" * 1000,), (None,)], "k string")
    assert joins._small(named, 2000) and not joins._small(named, 1000) and joins._small(named.limit(0), 0)
    df, keys = spark.range(10), spark.createDataFrame([(1,), (1,), (3,), (None,)], "id long")
    for most in (0, 1000):
        assert rows(joins.semi_join(df, keys, ["id"], most)) == [(1,), (3,)] and joins.anti_join(df, keys, ["id"], most).count() == 8


GATE = [
    ("2.5.0", "2.5.0", "a-0.1.0.tar.gz", None, None, "0.1.0", "REJECT", "filename_version_mismatch"),
    ("1.0.0", "1.0.0", "a-1.0.0.tar.gz", None, None, "1.0.0", "ACCEPT", "identity_verified"),
    ("2.0.0", "2.0.0", "a-0.1.0.tar.gz", "x", "x", "0.1.0", "REJECT", "filename_version_mismatch"),
    ("9.9.9", "9.9.9", None, None, None, None, "QUARANTINE", "identity_unprovable_no_sha"),
    ("0.1.0", "2.5.0", "a-0.1.0.tar.gz", "x", "x", "0.1.0", "REJECT", "resolved_version_mismatch"),
    ("1.0.0", "1.0.0", "a-1.0.0.tar.gz", "x", None, "1.0.0", "REJECT", "sha_mismatch"),
    (None, "1.0.0", None, None, None, None, "ACCEPT", "identity_verified"),
]


def test_identity_gate(spark):
    cols = "requested_version string, resolved_version string, archive_filename string, archive_sha256_expected string, archive_sha256_observed string, metadata_version string, s string, r string"
    assert all(r.status == r.s and r.reason == r.r for r in packages.identity_gate(spark.createDataFrame(GATE, cols)).collect())


def test_distributions_and_licenses(spark):
    files = "array<struct<filename: string, kind: string, upload_time: string, yanked: boolean>>"
    df = spark.createDataFrame(
        [("a", "1", 1, [("a1.tar.gz", "sdist", "2020-01-01", False)]), ("a", "2", 2, [("a2.tar.gz", "sdist", "2021-01-01", False)]), ("a", "3", 3, [("a3.tar.gz", "sdist", "2022-01-01", True)]), ("b", "1", 1, [("b.whl", "bdist_wheel", "2020-01-01", None)])],
        f"package string, version string, release_ordinal int, files {files}",
    )
    assert rows(packages.choose_distribution(df), "package", "version") == [("a", "2"), ("b", "1")]
    assert rows(packages.choose_distribution(df, "first_listed"), "package", "version") == [("a", "1"), ("b", "1")]
    names = spark.createDataFrame([("MIT",), ("limited",), ("GPL-3.0",), ("",), ("Proprietary",), (None,)], "l string")
    assert [r[0] for r in names.select(packages.license_class("l")["reason"]).collect()] == ["permissive", "permissive", "share-alike", "no licence metadata", "unclear", "no licence metadata"]


def test_tiers_budget_and_places(spark):
    df = spark.createDataFrame([(10, True), (20, False), (5, True), (19, False), (None, True), (50, None)], "s int, a boolean")
    assert [r[0] for r in df.select(qa.tier("s", "a")).collect()] == ["A", "B", "C", None, None, None]
    rng = random.Random(3)
    data = [(i, rng.choice("ABC"), rng.randint(0, 3), rng.randint(0, 9), rng.randint(1, 50)) for i in range(200)] + [(900, None, 3, 1, 5)]
    rec = spark.createDataFrame(data, "id long, tier string, score int, ts int, tokens int")
    for minimum in (1, 700, 10**6):
        want, total = [], 0
        for r in sorted((r for r in data if r[1]), key=lambda r: (r[1], -r[2], r[3], r[0])):
            if total < minimum:
                want.append(r[0])
                total += r[4]
        got = qa.select_budget(rec, "tokens", [("score", True), ("ts", False)], minimum)
        assert {r.id for r in got.collect()} == set(want)
    placed = qa.with_global_place(rec.filter("tier is not null"), ["score", "id"]).collect()
    assert [r.id for r in sorted(placed, key=lambda r: r.place)] == [r[0] for r in sorted((r for r in data if r[1]), key=lambda r: (r[2], r[0]))]
    diverse = qa.diverse_exact(rec.filter("tier is not null"), ["ts"], ["id"], "tier")
    assert diverse.count() == diverse.select("tier", "ts").distinct().count()
    pairs = qa.qa_pairs(spark.range(3).withColumnRenamed("id", "question_id"), spark.createDataFrame([(0, 2, 1), (0, 1, 9), (5, 1, 1)], "parent_id long, ordinal int, score int"), True)
    assert rows(pairs, "question_id", "score") == [(0, 9)]


def test_trees_states_and_leases(spark):
    a = spark.createDataFrame([("x", 1, "h"), ("y", 1, "h"), ("z", 2, "h"), ("w", 1, "h")], "path string, size long, sha256 string")
    b = spark.createDataFrame([("x", 1, "h"), ("y", 1, "i"), ("z", 1, "h"), ("v", 1, "h")], "path string, size long, sha256 string")
    assert rows(repos.compare_trees(a, b, ["path"])) == [("v", "unexpected"), ("w", "missing"), ("y", "hash_mismatch"), ("z", "size_mismatch")]
    files = spark.createDataFrame([(1, "a.py", "x"), (1, ".github/w.yml", "y"), (1, "b/.gitignore", "z")], "repo int, path string, content string")
    m = repos.snapshot_manifest(files, ["repo"]).first()
    assert m.file_count == 1 and [f.path for f in m.files] == ["a.py"] and repos.forbidden_entries(files).count() == 2
    events = spark.createDataFrame([("k", 1, "A"), ("k", 2, "B"), ("k", 3, "A"), ("j", 1, "B")], "k string, t int, s string")
    assert rows(repos.latest(events, "k", ["t"])) == [("j", 1, "B"), ("k", 3, "A")]
    assert rows(repos.check_transitions(events, "k", "s", ["t"], {"A": ["B"]}), "k", "t") == [("k", 3)]
    leases = spark.createDataFrame([("r", "p", 0, 10), ("r", "q", 5, 15), ("r", "q", 20, 30)], "r string, o string, s int, e int")
    assert rows(repos.lease_overlaps(leases, "r", "o", "s", "e")) == [("r", "q", 5, 15)]
    many = [("r", "A", 0, 100), ("r", "B", 10, 50), ("r", "A", 20, 30), ("s", "A", 20, 30), ("r", "B", 100, 120), ("r", "C", 5, 5), ("r", "A", 3000, 9000), ("r", "B", 8500, 8501)]
    found = repos.lease_overlaps(spark.createDataFrame(many, "r string, o string, s int, e int"), "r", "o", "s", "e")
    assert rows(found) == [("r", "A", 20, 30), ("r", "B", 10, 50), ("r", "B", 8500, 8501), ("r", "C", 5, 5)]
    work = spark.createDataFrame([(1, "FETCHING", 3, "x"), (2, "FAILED", 1, "Connection lost"), (3, "FAILED", 1, "bad"), (4, "TIMEOUT_PERMANENT", 20, None), (5, "TIMEOUT_RETRYABLE", 19, None), (6, "TIMEOUT_RETRYABLE", 20, None), (7, None, None, None)], "id int, state string, attempts int, error string")
    assert rows(repos.reset_interrupted(work).filter("id in (1, 2)"), "id", "state", "attempts", "error") == [(1, "QUEUED", 0, None), (2, "FAILED", 1, "Connection lost")]
    assert [r.state for r in repos.reset_for_retry(work).orderBy("id").collect()] == ["FETCHING", "QUEUED", "FAILED", "TIMEOUT_RETRYABLE", "TIMEOUT_RETRYABLE", "TIMEOUT_RETRYABLE", None]
    assert [r[0] for r in work.orderBy("id").select(repos.work_priority("state", "attempts")).collect()] == [None, None, None, None, 0, None, None]
    errors = spark.createDataFrame([("Timeout!",), ("bad",), (None,)], "e string")
    assert [r[0] for r in errors.select(repos.is_retryable("e")).collect()] == [True, False, False]


def test_governance(spark):
    df = spark.createDataFrame([(1, "u", "text")], "id int, url string, body string")
    c = governance.canonical(df, {"record_id": "id", "text": "body"}).first()
    assert c.record_id == "1" and c.extra == {"url": "u"} and c.license is None
    v = spark.createDataFrame([("d-v0.1",), ("d-v0.4",), ("other",)], "version string")
    assert governance.next_version(v, "d-v") == "d-v0.5" and governance.next_version(v.limit(0), "d-v") == "d-v0.1"
    with pytest.raises(ValueError):
        governance.append_version(v, {"version": "d-v0.1"})
    fim = governance.middle_out(spark.createDataFrame([(i, "abc" * i) for i in range(50)], "id int, t string"), "t", F.col("id")).filter("fim is not null").collect()
    assert fim and all(r.fim.prefix + r.fim.middle + r.fim.suffix == r.t for r in fim)
    assert governance.readiness({"a": True, "b": False}, ["a"]) == ("READY", ["b"])
    infos = spark.createDataFrame([("s", 1)], "source string, n int")
    assert governance.reproducibility_manifest(infos, {"x": 1}).first().n_sources == 1


def test_metadata_maps_and_steps(spark):
    df = spark.createDataFrame([(1, True, "CLEAR"), (0, None, None), (None, None, None)], "v int, g boolean, l string")
    got = [r[0] for r in df.select(governance.quality_metadata({"ast_valid": F.col("v"), "generated_or_vendor": F.col("g"), "license_status": F.col("l")})).collect()]
    assert got == [{"ast_valid": "true", "generated_or_vendor": "true", "license_status": "CLEAR"}, {"ast_valid": "false"}, dict.fromkeys(["ast_valid", "ast_invalid", "license_status", "token_count_status"])]
    maps = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": None}), (None, {"x": "y"}), ({"x": "y"}, None)], "a map<string,string>, b map<string,string>")
    assert [r[0] for r in maps.select(governance.merged(F.col("a"), F.col("b"))).collect()] == [{"a": "1", "b": "3", "c": None}, {"x": "y"}, {"x": "y"}]
    ran = governance.run_steps(spark, [("good", lambda: None), ("bad", lambda: 1 / 0), ("after", lambda: 2)]).collect()
    assert [(r.name, r.ok, r.error) for r in ran] == [("good", True, None), ("bad", False, "ZeroDivisionError"), ("after", True, None)]
    assert [r[0] for r in df.select(governance.all_hold({"v": F.col("v") == 1, "g": F.col("g")})).collect()] == [True, False, False]


def test_relations_of_code(spark):
    source = "import a.b, c\nfrom . import d\nfrom e import *\nclass A(B, c.C):\n    def f(self):\n        import g\ndef h(): pass\n"
    assert set(code_graph.relations(source)) == {("", "imports", x) for x in ("a.b", "c", ".d", "e", "g")} | {
        ("", "defines_class", "A"), ("A", "inherits", "B"), ("A", "inherits", "c.C"), ("A", "defines_function", "A.f"), ("", "defines_function", "h"),
    }
    df = spark.createDataFrame([(1, source), (2, None), (3, "x ="), (4, "import z")], "id long, code string")
    assert rows(code_graph.code_relations(df, "id", "code").filter("id > 1")) == [(4, "", "imports", "z")]


def test_readers_and_writers(spark, tmp_path):
    at = str(tmp_path)
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\nnot json\n{"x": 2}\n')
    assert rows(readers.read_jsonl(spark, f"{at}/a.jsonl", "x int").dropna()) == [(1,), (2,)]
    assert readers.read_jsonl(spark, f"{at}/none.jsonl", "x int").count() == 0
    with pytest.raises(Exception):  # noqa: B017
        readers.read_manifest(spark, f"{at}/a.jsonl", "x int").collect()
    (tmp_path / "c.jsonl").write_text('# 2\n{"x": 1}\n')
    assert rows(readers.read_commented_jsonl(spark, f"{at}/c.jsonl", "x int")) == [(1,)]
    (tmp_path / "p_checkpoint.json").write_text('{"pkg": {"state": "ACQUIRED"}}')
    (tmp_path / "q_checkpoint.json").write_text("broken")
    assert rows(readers.read_checkpoints(spark, at), "key", "state") == [("pkg", "ACQUIRED")]
    (tmp_path / "posts.xml").write_text('<posts><row Id="1" PostTypeId="1" Score="5" Tags="|python|" Body="b"/><row Id="2" PostTypeId="2" ParentId="1" Score="12"/></posts>')
    posts = readers.read_posts(spark, f"{at}/posts.xml")
    asked = readers.questions(posts, ["python"], 1)
    assert rows(asked, "Id") == [(1,)] and rows(readers.answers(posts, asked, 10), "Id") == [(2,)]
    arch = tmp_path / "arch"
    arch.mkdir()
    with zipfile.ZipFile(arch / "d.zip", "w") as z:
        z.writestr("root/x.html", "<p>1")
        z.writestr("root/y.html", "<p>2")
        z.writestr("../evil.html", "no")
    with tarfile.open(arch / "p-1.0.tar.gz", "w:gz") as t:
        for name, body in (("p/PKG-INFO", b"Name: p\nVersion: 1.0\n"), ("p/a.py", b"x = 1")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    (arch / "bad.zip").write_text("no zip")
    members = readers.archive_members(readers.read_tree(spark, str(arch)))
    assert members.filter("error is not null").count() == 1 and members.filter("member like '%evil%'").count() == 0
    assert [(r.package, r.version) for r in readers.archive_identity(members).collect()] == [("p", "1.0")]
    assert rows(readers.read_html(spark, str(arch / "d.zip"))) == [("x.html", "<p>1"), ("y.html", "<p>2")]
    writers.write_jsonl(spark.createDataFrame([(1, None)], "b int, a string"), f"{at}/out")
    assert spark.read.text(f"{at}/out").first()[0] == '{"a":null,"b":1}'
    assert writers.write_counted(spark.range(5), f"{at}/n") == 5


def test_two_phase_commit(spark, tmp_path):
    w = writers.TwoPhaseWriter(spark, f"file://{tmp_path}/store")
    w.commit(spark.range(10), "t")
    assert spark.read.parquet(f"{w.root}/t").count() == 10 and w.classify() == {"t": "COMMITTED_FINAL_CLEANED"}
    with pytest.raises(FileExistsError):
        w.commit(spark.range(3), "t")
    w.commit(spark.range(3), "t", replace=True)
    assert spark.read.parquet(f"{w.root}/t").count() == 3
    w.freeze()
    with pytest.raises(writers.Frozen):
        w.commit(spark.range(3), "u")


def arriving(spark, at, files):
    """Parquet files of a folder that the stream takes in the order given."""
    for n, data in enumerate(files):
        spark.createDataFrame(data, "k int, t string, s string").withColumn("t", F.col("t").cast("timestamp")).coalesce(1).write.parquet(f"{at}/new")
        os.makedirs(f"{at}/in", exist_ok=True)
        part = next(p for p in os.listdir(f"{at}/new") if p.endswith(".parquet"))
        os.rename(f"{at}/new/{part}", f"{at}/in/{n}.parquet")
        os.utime(f"{at}/in/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
        shutil.rmtree(f"{at}/new")
    return spark.read.parquet(f"{at}/in").schema


EARLY = [(1, "2024-01-01 00:00:00", "A"), (1, "2024-01-01 00:00:05", "B"), (None, "2024-01-01 00:00:01", "N")]
LATE = [(2, "2024-01-01 00:10:00", "A"), (1, "2024-01-01 00:09:00", "C"), (None, "2024-01-01 00:00:01", "N")]


@pytest.mark.parametrize("order", [(EARLY, LATE), (LATE, EARLY), (EARLY[:1], LATE, EARLY[1:])])
def test_firsts_and_latest_of_streams_in_any_order(spark, tmp_path, order):
    at = str(tmp_path)
    schema = arriving(spark, at, order)
    for _ in range(2):  # the second run finds nothing new
        jobs.run_batches(jobs.stream_files(spark, f"{at}/in", schema, 1), jobs.first_rows_table(f"{at}/firsts", ["k"], ["t"]), f"{at}/cp")
    assert rows(jobs.read_firsts(spark, f"{at}/firsts", ["k"], ["t"]), "k", "s") == [(1, "A"), (2, "A"), (None, "N")]
    jobs.run_batches(jobs.stream_files(spark, f"{at}/in", schema), jobs.latest_state_table(f"{at}/states", "k", "t"), f"{at}/cp2")
    assert rows(jobs.read_states(spark, f"{at}/states", "k", "t"), "k", "s") == [(1, "C"), (2, "A"), (None, "N")]


def test_stream_within_a_watermark(spark, tmp_path):
    at = str(tmp_path)
    schema = arriving(spark, at, [EARLY[:2], LATE[:1], EARLY[:1]])
    jobs.run_available(jobs.deduplicated(jobs.stream_files(spark, f"{at}/in", schema, 1), ["k"], "t", "1 minute"), f"{at}/out", f"{at}/cp")
    assert rows(spark.read.parquet(f"{at}/out"), "k") == [(1,), (2,)]


def test_batches_stop_and_go_on(spark, tmp_path):
    at = str(tmp_path)
    schema = arriving(spark, at, [EARLY, LATE, EARLY])
    done = []
    step = lambda batch, n: done.append((n, batch.count()))
    stream = lambda: jobs.stream_files(spark, f"{at}/in", schema, 1)
    assert not jobs.run_batches(stream(), step, f"{at}/cp", may_go_on=lambda: len(done) < 2) and len(done) == 2
    assert not jobs.run_batches(stream(), step, f"{at}/cp", seconds=-1) and len(done) == 2
    assert jobs.run_batches(stream(), step, f"{at}/cp", seconds=600) and done == [(0, 3), (1, 3), (2, 3)]
    left = jobs.unfinished(spark.createDataFrame([("a",), ("b",), (None,)], "path string"), spark.createDataFrame([("a",), (None,)], "path string"), "path")
    assert rows(left) == [("b",), (None,)]
