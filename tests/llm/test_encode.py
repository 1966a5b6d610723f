import random

import pytest
import tiktoken  # noqa: F401
from pyspark.sql import functions as F

from corpuskit.llm import encode
from corpuskit.llm.bpe import load_bpe
from corpuskit.llm.split import split_oversized, split_text

BPE = load_bpe()
ALPHABET = "ab Z09_'\"\n\t\r\x0b\x1c\x85\xa0 ​²½éßЖ中一３　 🙂sn't've -#.,́"


def exact(text):
    return BPE._all.encode_ordinary(text or "")


def test_fast_path_gives_the_encoders_ids():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 20)))
        assert BPE.encode(text) == exact(text)
        assert BPE.count(text) == len(exact(text))
        assert "".join(BPE.pieces(text)) == text


def test_every_checked_character():
    for cp in [*range(0x3000), *range(0xFE00, 0x10000, 3), *range(0x1F300, 0x1F700)]:
        text = " " + chr(cp) + "a1"
        if BPE.splitter(text) is not None:
            assert BPE.encode(text) == exact(text), hex(cp)


def texts():
    rng = random.Random(2)
    words = ["tea", "Straße", "x=1", "中文字", "don't", "  ", "\n\n", "🙂", "été"]
    out = [None, "", " \n", "plain text", "same", "same"]
    out += [" ".join(rng.choice(words) for _ in range(n)) for n in (5, 300, 3000)]
    out += ["x" * 5000, " " * 4000, "中" * 3000, "a b" * 2000 + "y" * 4000 + " z" * 1000]
    return out


@pytest.mark.parametrize(("chunk", "overlap"), [(700, 64), (512, 8), (1 << 16, 1 << 10)])
def test_whole_texts_in_overlapping_chunks(spark, chunk, overlap):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: r.ids for r in encode.encode_corpus(df, chunk_chars=chunk, overlap_chars=overlap).collect()}
    assert got == {i: exact(t) for i, t in rows}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    long = "word " * 500
    df = spark.createDataFrame([(None, "a"), (1, long), (1, long), (2, ""), (2, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, len(r.ids)) for r in encode.encode_corpus(df, chunk_chars=600, overlap_chars=50).collect())
    assert got == sorted([(0, 1), (1, len(exact(long))), (1, len(exact(long))), (2, 0), (2, 0)])
    assert encode.encode_corpus(df.limit(0)).count() == 0


def test_round_trip(spark):
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts())], "doc_id long, text string")
    back = encode.decode_texts(encode.encode_corpus(df, chunk_chars=700, overlap_chars=64), "doc_id")
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in df.collect()}


def check_pieces(text, pieces, max_tokens=2048, overlap=128):
    ids = exact(text)
    assert bool(pieces) == (len(ids) > max_tokens)
    if not pieces:
        return
    assert pieces[0][0] == 0 and pieces[0][2] == 0 and pieces[-1][1] == len(text)
    for k, (a, b, s, e) in enumerate(pieces):
        assert 0 < e - s <= max_tokens
        assert len(exact(text[a:b])) <= max_tokens
        assert text[b - 1].isspace() or len(exact(text[a:b])) == e - s
        if k:
            assert pieces[k - 1][0] < a <= pieces[k - 1][1]
            assert overlap <= pieces[k - 1][3] - s <= overlap + (0 if text.isascii() else 3)


def prose(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    return "".join(word() + rng.choice([" ", " ", " ", ". ", ", ", "\n", "\n\n"]) for _ in range(n))


@pytest.mark.parametrize("text", [None, "", "short", prose(3000), "x" * 30000, "中" * 5000, " " * 9000, "\n" * 5000, "é" * 5000 + " x" * 3000, "🙂" * 4000, "ab1" * 6000 + prose(2000) + "=" * 9000 + prose(2000), "Жук" * 7000])
def test_pieces_cover_the_text(text):
    pieces = split_text(BPE, text)
    check_pieces(text, pieces)
    assert all(split_text(BPE, text, segment=n) == pieces for n in (100, 5000))


def test_cuts_stand_at_natural_boundaries_with_exact_overlap():
    text = prose(20000, 3)
    pieces = split_text(BPE, text)
    check_pieces(text, pieces)
    assert all(text[b - 1] in "\n." for _, b, _, _ in pieces[:-1])
    assert all(p[3] - q[2] == 128 for p, q in zip(pieces, pieces[1:]))


def test_an_edit_alters_only_pieces_near_it():
    text = prose(20000, 4)
    edited = text[:20000] + "inserted words here " + text[20000:]
    old = {text[a:b] for a, b, _, _ in split_text(BPE, text)}
    new = [edited[a:b] for a, b, _, _ in split_text(BPE, edited)]
    assert sum(p not in old for p in new) <= 4


def test_split_operator(spark):
    rows = [(1, prose(4000)), (1, prose(4000)), (2, "small"), (3, None), (4, ""), (None, prose(3000, 9))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece_no", F.lit(9))
    got = split_oversized(df).collect()
    assert {r.doc_id for r in got} == {1, None}
    texts_of = {(r.doc_id, r.piece_no): r for r in got}
    for r in got:
        source = rows[0][1] if r.doc_id == 1 else rows[5][1]
        assert r.text == source[r.start_char : r.end_char] and r.n_tokens == r.end_token - r.start_token <= 2048
    assert len([r for r in got if r.doc_id == 1]) == 2 * len({k for k in texts_of if k[0] == 1})
    assert split_oversized(df.limit(0)).count() == 0
