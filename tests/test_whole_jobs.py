"""Registered queries do the whole of their operator's job."""

import random

import __spark_entry__
from corpuskit.functions import similarity


def save(df, at, name="documents"):
    df.write.parquet(f"{at}/{name}.parquet")


def test_simhash_pairs_up_to_nine_bits(spark, tmp_path):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
    texts = [[rng.choice(words) for _ in range(80)] for _ in range(20)]
    for t in texts[:15]:
        for n in (0, 2, 6, 12):
            texts.append([rng.choice(words) if k < n else w for k, w in enumerate(t)])
    save(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, "")], "doc_id long, text string"), tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    prints = sorted((r.doc_id, r.simhash & (1 << 64) - 1) for r in similarity.simhash(docs, "doc_id", "text").collect())
    links = {a: sum(a != b and (x ^ y).bit_count() <= 9 for b, y in prints) for a, x in prints}
    least = {a: min(b for b, y in prints if x == y) for a, x in prints}
    got = [tuple(r) for r in __spark_entry__.queries()["q_simhash_links"](spark, str(tmp_path)).select("id", "class_id", "n_links").collect()]
    assert sorted(got) == sorted((a, least[a], n) for a, n in links.items()) and sum(links.values()) > 20


def test_near_duplicates_are_those_of_the_texts(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(6)) for _ in range(900)]
    rows = []
    for n in [4] * 10 + [60] * 20 + [500] * 8 + [900] * 4:
        t = [rng.choice(words) for _ in range(n)]
        for share in (0, 0, 0.03, 0.06, 0.09):
            rows.append(" ".join(rng.choice(words) if rng.random() < share else w for w in t))
    rng.shuffle(rows)
    rows = [(i, t.upper() if i % 5 == 0 else t, rng.choice(["https://one.example/page/1", None, f"https://{i}.example/{rng.random()}"]), "s", rng.randint(1, 9)) for i, t in enumerate(rows)]
    rows += [(900, None, "https://one.example/page/1", "s", 1), (901, "ab", None, "s", 1), (902, "", None, "s", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, url string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    tri = {i: {t.lower()[k : k + 3] for k in range(len(t) - 2)} for i, t, *_ in rows if t}
    want = {(a, b) for a in tri for b in tri if a < b and tri[a] and tri[b] and len(tri[a] & tri[b]) / len(tri[a] | tri[b]) > 0.85}
    queries = __spark_entry__.queries()
    pairs = [(r.id_a, r.id_b) for r in queries["q_text_trigram_pairs"](spark, str(tmp_path)).collect()]
    assert len(pairs) == len(want) and set(pairs) == want and len(want) > 60
    near = {i: {a + b - i for a, b in want if i in (a, b)} for i, *_ in rows}
    cluster = {i: i for i in near}
    for _ in range(20):
        cluster = {i: min([cluster[i], *(cluster[j] for j in near[i])]) for i in near}
    got = {r.id: (r.cluster, r.near_duplicate_status) for r in queries["q_near_clusters"](spark, str(tmp_path)).collect()}
    assert got == {i: (c, None if c == i else f"similar_to_s_{c}") for i, c in cluster.items()}
    score, kept = {r[0]: r[4] for r in rows}, []
    for i in sorted(near):
        hit = next((k for k in kept if k in near[i]), None)
        if hit is None:
            kept.append(i)
        elif score[i] > score[hit]:
            kept.remove(hit)
            kept.append(i)
    survivors = [r.id for r in queries["q_greedy_near_dedup"](spark, str(tmp_path)).collect()]
    assert sorted(survivors) == sorted(kept)
