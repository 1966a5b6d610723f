"""Encoding a whole corpus with a public byte-level BPE (problem 6).

Method: overlapping chunk encoding. Texts longer than ``chunk_chars`` are cut into chunks that overlap.
Every chunk is pre-tokenised by itself, in parallel; where the pre-token boundaries of a chunk's tail and
of the next chunk's head meet for the first time, both agree from there on (the pattern looks at nothing
before a pre-token), so the text is cut there. The pieces between those points are then encoded in parallel
and their ids joined. Where two chunks never meet inside their overlap, they are joined into one piece,
which is exact too. Shorter texts are one piece and take no shuffle.

Defined results: a null and an empty text give an empty list, never null; a null id is kept; repeated rows
come out as often as they go in; an empty table gives an empty table; other columns are not read. The ids
joined and decoded (``decode_texts``) are the bytes of the text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.arrow import lists, small_batches
from corpuskit.llm.bpe import BYTE_BPE_50K, TOKENIZER_DIR, load_bpe
from corpuskit.session import spread

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10


def _encoder(keys: list[str], directory: str, name: str):
    def run(batches):
        bpe = load_bpe(directory, name)
        for batch in small_batches(batches, "text"):
            ids = lists([bpe.encode(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), ids], [*keys, "ids"])

    return run


#: What tells the texts of equal ids apart.
_TEXT = ["id", "h", "h2", "n"]


def _chunks(chunk_chars: int, overlap: int):
    """Chunks of each text, each with the head of the next one."""

    def run(batches):
        for batch in batches:
            keys = [batch.column(k) for k in ("id", "h", "h2")]
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                n = -(-len(text) // chunk_chars)
                for at in range(0, n, 64):
                    ks = range(at, min(n, at + 64))
                    take = pa.array([i] * len(ks), pa.int64())
                    parts = [text[k * chunk_chars : (k + 1) * chunk_chars + overlap] for k in ks]
                    sizes, places = pa.array([len(text)] * len(ks), pa.int32()), pa.array(list(ks), pa.int32())
                    yield pa.RecordBatch.from_arrays([*(c.take(take) for c in keys), sizes, places, pa.array(parts, pa.string())], [*_TEXT, "k", "text"])

    return run


def _boundaries(chunk_chars: int, overlap: int, directory: str, name: str):
    def run(batches):
        bpe = load_bpe(directory, name)
        for batch in small_batches(batches, "text"):
            heads, tails = [], []
            for text in batch.column("text").to_pylist():
                at, head, tail = 0, [], []
                for piece in bpe.pieces(text):
                    if at < overlap:
                        head.append(at)
                    if at >= chunk_chars:
                        tail.append(at - chunk_chars)
                    at += len(piece)
                heads.append(head)
                tails.append(tail)
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), batch.column("text"), lists(heads), lists(tails)], [*keep, "text", "head", "tail"])

    return run


def encode_corpus(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    directory: str = TOKENIZER_DIR,
    name: str = BYTE_BPE_50K,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    long_text = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    # A text of at most chunk_chars bytes is short for sure: most rows are told apart without counting characters.
    short = rows.filter((F.coalesce(F.octet_length("text"), F.lit(0)) <= chunk_chars) | ~long_text)
    done = short.mapInArrow(_encoder(["id"], directory, name), f"id {id_type}, ids array<int>")
    parts = _encode_long(rows.filter((F.octet_length("text") > chunk_chars) & long_text), id_type, directory, name, chunk_chars, overlap_chars)
    return done.unionByName(parts).select(F.col("id").alias(id_col), "ids")


def _encode_long(rows: DataFrame, id_type: str, directory: str, name: str, chunk_chars: int, overlap: int) -> DataFrame:
    whole = rows.select("id", F.xxhash64("text").alias("h"), F.md5(F.col("text").cast("binary")).alias("h2"), "text")
    chunks = (
        whole.mapInArrow(_chunks(chunk_chars, overlap), f"id {id_type}, h long, h2 string, n int, k int, text string")
        .groupBy(*_TEXT, "k")
        .agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    marked = chunks.mapInArrow(
        _boundaries(chunk_chars, overlap, directory, name),
        f"id {id_type}, h long, h2 string, n int, k int, copies long, text string, head array<int>, tail array<int>",
    )
    of_text = Window.partitionBy(*_TEXT).orderBy("k")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(of_text)))
    synced = marked.withColumn("meet", meet).withColumn("from", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.lag("meet").over(of_text)))
    # Chunks that did not meet their predecessor stay in its piece.
    pieces = synced.withColumn("piece", F.count("from").over(of_text.rowsBetween(Window.unboundedPreceding, 0)))
    core = F.transform(F.slice("all", 1, F.size("all") - 1), lambda c: F.substring(c["text"], F.lit(1), F.lit(chunk_chars)))
    end = F.element_at("all", -1)
    span = (
        pieces.groupBy(*_TEXT, "copies", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("k", "from", "meet", "text"))).alias("all"))
        .withColumn("joined", F.concat(F.array_join(core, ""), end["text"]))
        .withColumn("begin", F.element_at("all", 1)["from"])
        .withColumn("stop", F.when(end["meet"].isNull(), F.length("joined")).otherwise((F.size("all") * chunk_chars) + end["meet"]))
        .select(*_TEXT, "copies", "piece", F.substring(F.col("joined"), F.col("begin") + 1, F.col("stop") - F.col("begin")).alias("text"))
    )
    encoded = span.mapInArrow(_encoder([*_TEXT, "copies", "piece"], directory, name), f"id {id_type}, h long, h2 string, n int, copies long, piece long, ids array<int>")
    whole = encoded.groupBy(*_TEXT, "copies").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("all"))
    ids = F.flatten(F.transform("all", lambda p: p["ids"]))
    return whole.select("id", F.explode(F.array_repeat(ids, F.col("copies").cast("int"))).alias("ids"))


def decode_texts(df: DataFrame, id_col: str, ids_col: str = "ids", directory: str = TOKENIZER_DIR, name: str = BYTE_BPE_50K) -> DataFrame:
    """``id_col`` and ``text``: the raw bytes of the ids joined, as UTF-8. A null list gives a null text."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = load_bpe(directory, name)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    out = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {id_type}, text string")
    return out.select(F.col("id").alias(id_col), "text")
