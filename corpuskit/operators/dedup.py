"""Exact and near duplicates of records, with the provenance of what is dropped."""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from corpuskit.functions.similarity import trigram_text
from corpuskit.operators import alike
from corpuskit.operators.components import connected_components
from corpuskit.session import cut_lineage, spread


def first_seen(df: DataFrame, keys: list[str], order: list[str], flag: str | None = None) -> DataFrame:
    """The first row of each key in a total order; with ``flag`` all rows, marked.

    Kept rows alone come from a filter on row_number, of which each task passes on one row a key before the shuffle.
    A marked table compares each row with its key's first order value, an aggregate that is combined before the shuffle.
    """
    place = F.struct(*order)
    if flag is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    firsts = df.groupBy(*keys).agg(F.min(place).alias("_first"))
    joined = df.alias("d").join(firsts.alias("f"), [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys])
    return joined.select("d.*", (F.struct(*[F.col(f"d.{o}") for o in order]) == F.col("_first")).alias(flag))


def duplicate_of(df: DataFrame, hash_col: str, id_col: str, order: list[str]) -> DataFrame:
    """Adds duplicate_of: the first record of the same content, null for that record itself."""
    firsts = df.filter(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min_by(id_col, F.struct(*order)).alias("_one"))
    return df.join(firsts, hash_col, "left").withColumn("duplicate_of", F.when(F.col("_one") != F.col(id_col), F.col("_one"))).drop("_one")


#: Orders in which the source of a kept record may be chosen.
POLICIES = {"fifo": ["acquired", "source_rank"], "priority": ["source_rank", "acquired"], "license": ["license_rank", "source_rank", "acquired"]}


def provenance(df: DataFrame, hash_col: str, source_col: str, acquired_col: str, order: list[str]) -> DataFrame:
    """Per content: kept source, discarded sources, first acquisition of each source. One row a source meets the others,
    not one a record: records are first combined by content and source."""
    per = df.groupBy(F.col(hash_col).alias("content_hash"), F.col(source_col).alias("source")).agg(F.min(acquired_col).alias("acquired"), F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("place"))
    out = per.groupBy("content_hash").agg(
        F.min_by("source", "place").alias("kept_source"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "acquired")))).alias("acquisition_timestamps"),
        F.sum("n").alias("n_records"),
    )
    return out.select("content_hash", "kept_source", F.array_except("sources", F.array("kept_source")).alias("discarded_sources"), "acquisition_timestamps", "n_records")


#: Pairs of fingerprints that are compared at once.
_BLOCK = 1 << 21


def _tasks(df: DataFrame) -> int:
    """Shuffle partitions of pair comparisons, whose work isn't told by their bytes."""
    return max(df.sparkSession.sparkContext.defaultParallelism * 4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _groups(batches, keys: list[str], cols: list[str]):
    """Key and columns of each run of rows with one key; batches are sorted by the keys."""
    held: list[list[np.ndarray]] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, c = ([batch.column(n).to_numpy(zero_copy_only=False) for n in names] for names in (keys, cols))
        cut = np.flatnonzero(np.any([x[1:] != x[:-1] for x in k], axis=0)) + 1
        for lo, hi in zip([0, *cut], [*cut, batch.num_rows]):
            own = tuple(int(x[lo]) for x in k)
            if own != key:
                if held:
                    yield key, [np.concatenate(x) for x in zip(*held)]
                held, key = [], own
            held.append([x[lo:hi] for x in c])
    if held:
        yield key, [np.concatenate(x) for x in zip(*held)]


class _Bands:
    """Bands of 64-bit fingerprints; with more of them than differing bits, two alike fingerprints agree in one."""

    def __init__(self, max_distance: int, bands: int):
        if bands <= max_distance:
            raise ValueError("more bands than differing bits are needed")
        edges = [i * 64 // bands for i in range(bands + 1)]
        self.most, self.cuts = max_distance, list(zip(edges, edges[1:]))
        self.masks = [np.uint64(((1 << (hi - lo)) - 1) << lo) for lo, hi in self.cuts]

    def spread(self, rows: DataFrame) -> DataFrame:
        """The rows (with a column h) once for each band, those that agree in it in one task and in order."""
        cuts = F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("h", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("v")) for i, (lo, hi) in enumerate(self.cuts)])
        banded = rows.select("*", F.explode(cuts).alias("b")).select(*rows.columns, "b.band", "b.v")
        return banded.repartition(_tasks(rows), "band", "v").sortWithinPartitions("band", "v")

    def near(self, band: int, prints: np.ndarray):
        """Places i < j of fingerprints that differ in few bits and agree in no band before this one, and the bits, in blocks."""
        for at in range(0, len(prints), step := max(1, _BLOCK // len(prints))):
            x = prints[at : at + step, None] ^ prints[None, at:]
            i, j = np.nonzero(np.bitwise_count(x) <= self.most)
            i, j = i[i < j], j[i < j]
            differ = x[i, j]
            first = np.ones(len(i), bool)
            for mask in self.masks[:band]:
                first &= (differ & mask) != 0
            yield i[first] + at, j[first] + at, np.bitwise_count(differ[first]).astype(np.int64)


def simhash_pairs(df: DataFrame, id_col: str, hash_col: str, max_distance: int = 9, bands: int = 10) -> DataFrame:
    """id_a < id_b of records whose fingerprints differ in max_distance bits at most; bands > max_distance make it exact.

    Records that agree in a band meet in one task, sorted, and are compared in blocks; a pair is emitted in the first band
    that it agrees in, so pairs, of which there can be far more than records, are never shuffled. For records alone,
    ``simhash_links`` counts them instead.
    """
    of = _Bands(max_distance, bands)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(hash_col).alias("h")).filter("id is not null and h is not null").distinct()

    def run(batches):
        for (band, _), (ids, prints) in _groups(batches, ["band", "v"], ["id", "h"]):
            for i, j, differ in of.near(band, prints.view(np.uint64)):
                for k in range(0, len(i), 1 << 16):
                    one, two = ids[i[k : k + (1 << 16)]], ids[j[k : k + (1 << 16)]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(differ[k : k + (1 << 16)])], ["id_a", "id_b", "distance"])

    return of.spread(rows).mapInArrow(run, "id_a long, id_b long, distance long")


def simhash_links(df: DataFrame, id_col: str, hash_col: str, max_distance: int = 9, bands: int = 10) -> DataFrame:
    """One row per record: id, class_id (least id of its fingerprint), n_links (records whose fingerprint differs in
    max_distance bits at most, itself not counted). Exact.

    Only different fingerprints are compared, each with the number of its records; links are counted where they are found.
    """
    of = _Bands(max_distance, bands)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(hash_col).alias("h")).filter("id is not null and h is not null").distinct()
    prints = cut_lineage(rows.groupBy("h").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")))

    def run(batches):
        for (band, _), (h, n) in _groups(batches, ["band", "v"], ["h", "n"]):
            links = np.zeros(len(h), np.int64)
            for i, j, _ in of.near(band, h.view(np.uint64)):
                links += np.bincount(i, n[j], len(h)).astype(np.int64) + np.bincount(j, n[i], len(h)).astype(np.int64)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(links[some])], ["h", "links"])

    found = of.spread(prints.select("h", "n")).mapInArrow(run, "h long, links long").groupBy("h").agg(F.sum("links").alias("links"))
    of_print = prints.join(found, "h", "left").select("h", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.join(of_print, "h").select("id", "class_id", "n_links")


#: Records of one text that travel together; more of them are several rows.
_COPIES = 512
#: Sets of more trigrams are compared by their sketches.
_SHORT = 256


def trigram_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.85) -> DataFrame:
    """id_a < id_b and similarity of texts whose trigram sets have a Jaccard similarity above the threshold. Exact.

    Prefix filter: with the trigrams of a text rarest first (any order is exact), two similar texts share one of their
    first |A| - ceil(t |A|) + 1. A text goes to the tasks of those, with the ids of its records; it is compared there on
    the whole set, and a pair is given at the first trigram that its texts share. So candidates and pairs, of which there
    can be far more than texts, are never shuffled. A text travels once for each trigram of its prefix, so this is for
    short texts; pairs with a long one are found as whole texts are. The driver collects the trigrams' counts by bucket.
    """
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), trigram_text(text_col).alias("t")).filter("id is not null and length(t) >= 3")
    copies = rows.repartition(_tasks(df), "t").groupBy("t").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    parts = F.transform(F.sequence(F.lit(0), F.size("ids") - 1, F.lit(_COPIES)), lambda k: F.slice("ids", k + 1, F.lit(_COPIES)))
    texts = cut_lineage(copies.select("t", F.explode(parts).alias("ids")))

    def count(batches):
        n = np.zeros(alike.BUCKETS, np.int64)
        for batch in batches:
            for part in alike.pieces(batch, "t"):
                n += np.bincount(alike.bucket(alike.trigrams(part.column("t").to_pylist())[1]), minlength=alike.BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some])], ["b", "n"])

    often = np.zeros(alike.BUCKETS, np.int64)
    for b, n in texts.select("t").mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n")).collect():
        often[b] = n
    rank = np.empty(alike.BUCKETS, np.int32)
    rank[np.argsort(often, kind="stable")] = np.arange(alike.BUCKETS, dtype=np.int32)

    def prefix(batches):
        for batch in batches:
            for part in alike.pieces(batch, "t"):
                own = alike.prefixes(part.column("t").to_pylist(), rank, threshold, _SHORT)
                grams = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate(own)))
                yield pa.RecordBatch.from_arrays([part.column("t"), part.column("ids"), grams], ["t", "ids", "grams"])

    kinds = StructType([*texts.schema.fields, StructField("grams", ArrayType(LongType()))])
    sent = texts.mapInArrow(prefix, kinds).select(F.explode("grams").alias("g"), "t", "ids")

    def pairs(batches):
        for a, b, similarity in alike.pairs(batches, rank, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(a, to_arrow_type(kind)), pa.array(b, to_arrow_type(kind)), pa.array(similarity)], ["id_a", "id_b", "similarity"])

    out = StructType([StructField("id_a", kind), StructField("id_b", kind), StructField("similarity", DoubleType())])
    found = sent.repartition(_tasks(df), "g").sortWithinPartitions("g").mapInArrow(pairs, out)
    if not texts.filter(F.length("t") > _SHORT + 2).isEmpty():
        found = found.unionByName(_long_pairs(texts, threshold))
    # An id with several texts can have the same pair from each of them.
    several = texts.select(F.explode("ids").alias("id")).groupBy("id").count().filter("count > 1")
    return found if several.isEmpty() else found.distinct()


def _long_pairs(texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs of trigram_pairs in which a set has more than _SHORT trigrams."""
    rows = cut_lineage(texts.filter(F.length("t") - 2 > _SHORT * threshold).withColumn("k", F.monotonically_increasing_id()))
    classes = text_classes(rows, "k", "t", threshold).filter(F.col("n") > _SHORT * threshold)
    one = rows.join(classes, rows.k == classes.id).select(F.col("k").alias("id_a"), F.col("n").alias("na"), F.col("ids").alias("x"))
    two = one.withColumnsRenamed({"id_a": "id_b", "na": "nb", "x": "y"})
    apart = with_copies(class_pairs(rows, classes, "k", "t", threshold), classes).join(one, "id_a").join(two, "id_b")
    same = one.withColumns({"id_b": F.col("id_a"), "nb": F.col("na"), "y": F.col("x"), "similarity": F.lit(1.0)})
    both = apart.select("id_a", "id_b", F.explode("x").alias("x"), "y", "similarity", F.greatest("na", "nb").alias("n")).unionByName(
        same.select("id_a", "id_b", F.explode("x").alias("x"), "y", "similarity", F.col("na").alias("n"))
    )
    pairs = both.filter((F.col("n") > _SHORT) & (F.col("similarity") > threshold)).select("id_a", "id_b", "x", F.explode("y").alias("y"), "similarity")
    once = F.when(F.col("id_a") == F.col("id_b"), F.col("x") < F.col("y")).otherwise(F.col("x") != F.col("y"))
    return pairs.filter(once).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def _codes(text: str) -> np.ndarray:
    """The trigrams of a normalised text as sorted numbers, each once."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(c[:-2] | c[1:-1] << 21 | c[2:] << 42)


def _bits(n: int) -> int:
    """Bits of the sketch of a set of n trigrams."""
    return max(512, 1 << (max(1, n // 2) - 1).bit_length())


def _sketch(codes: np.ndarray, bits: int) -> bytes:
    """The parity of the trigrams in each of ``bits`` places; two sketches differ in no more bits than their sets in trigrams."""
    place = (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40) & np.uint64(bits - 1)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def text_classes(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.85) -> DataFrame:
    """id, class (the least id with the same trigram set), n (trigrams), and the set's sketch; texts without trigrams have no row."""
    step = _size_step(threshold)
    rows = df.select(F.col(id_col).cast("long").alias("id"), trigram_text(text_col).alias("t")).filter("id is not null and length(t) >= 3")

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column("t").to_pylist():
                codes = _codes(t)
                # as wide as the next size's sketches, with which it is compared
                out.append((hashlib.blake2b(codes.tobytes(), digest_size=16).digest(), len(codes), _sketch(codes, _bits(int(len(codes) * step * step) + 1))))
            key, n, sketch = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(sketch, pa.binary())], ["id", "k", "n", "sketch"])

    keyed = cut_lineage(spread(rows).mapInArrow(run, "id long, k binary, n long, sketch binary").dropDuplicates(["id", "k"]))
    firsts = keyed.groupBy("k").agg(F.min("id").alias("class"))
    return cut_lineage(keyed.join(firsts, "k").select("id", "class", "n", "sketch"))


def _size_step(threshold: float) -> float:
    """Sizes are grouped by powers of this; similar sets are of one group or of two neighbours."""
    return 1.001 / threshold


def class_pairs(df: DataFrame, classes: DataFrame, id_col: str, text_col: str, threshold: float = 0.85) -> DataFrame:
    """id_a < id_b (classes) and similarity of different trigram sets whose Jaccard similarity is above the threshold. Exact.

    For whole texts, whose rare trigrams are not rare enough for a prefix filter. All sets of like sizes are compared by
    their sketches, whose difference is a lower bound of that of the sets; what is left is verified on the texts. Only
    texts that have such a link travel.
    """
    sets = classes.filter("id = class").select(F.col("class").alias("id"), "n", "sketch")
    slices = min(64, max(4, sets.count() // 16384))
    share, step = (1 - threshold) / (1 + threshold), _size_step(threshold)
    group = F.floor(F.log("n") / F.lit(math.log(step))).cast("int")
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    own = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")
    # role 0: compared with all of its group (1) and of the group below (2)
    roles = F.concat(
        F.array(F.struct(group.alias("g"), own.alias("s"), F.lit(0).alias("role"))),
        F.transform(every, lambda s: F.struct(group.alias("g"), s.alias("s"), F.lit(1).alias("role"))),
        F.transform(every, lambda s: F.struct((group + 1).alias("g"), s.alias("s"), F.lit(2).alias("role"))),
    )
    sent = sets.select("id", "n", "sketch", F.explode(roles).alias("r")).select("r.g", "r.s", "r.role", "id", "n", "sketch")

    def links(batches):
        for _, (role, ids, n, sketch) in _groups(batches, ["g", "s"], ["role", "id", "n", "sketch"]):
            mine = role == 0
            if not mine.any():
                continue
            words = min(len(x) for x in sketch) // 8
            bits = np.empty((words, len(ids)), np.uint64)
            for i, x in enumerate(sketch):
                bits[:, i] = np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0)
            left, right = np.flatnonzero(mine), np.flatnonzero(~mine)
            other = bits[:, right]
            for at in range(0, len(left), size := max(1, (_BLOCK >> 2) // max(1, len(right)))):
                part = left[at : at + size]
                most = ((n[part][:, None] + n[right][None, :]) * share).astype(np.float32) + np.float32(0.01)
                differ = np.zeros(most.shape, np.uint16)
                first = words * 3 // 4
                for w in range(first):
                    differ += np.bitwise_count(bits[w, part][:, None] ^ other[w][None, :])
                i, j = np.nonzero(differ <= most)
                a, b = part[i], right[j]
                keep = (np.minimum(n[a], n[b]) > np.maximum(n[a], n[b]) * threshold) & ((role[b] == 2) | (ids[a] < ids[b]))
                i, j, a, b = i[keep], j[keep], a[keep], b[keep]
                for lo in range(0, len(a), 1 << 16):
                    x, y = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
                    total = np.bitwise_count(bits[:, x] ^ bits[:, y]).sum(axis=0, dtype=np.int64)
                    near = total <= (n[x] + n[y]) * share
                    one, two = ids[x[near]], ids[y[near]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["id_a", "id_b"])

    near = cut_lineage(sent.repartition(_tasks(df), "g", "s").sortWithinPartitions("g", "s").mapInArrow(links, "id_a long, id_b long"))
    linked = near.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(linked, "id", "left_semi").withColumn("t", trigram_text("t")).filter("length(t) >= 3").dropDuplicates(["id"])
    both = near.join(texts.withColumnsRenamed({"id": "id_a", "t": "ta"}), "id_a").join(texts.withColumnsRenamed({"id": "id_b", "t": "tb"}), "id_b")

    def verify(batches):
        codes = lru_cache(256)(_codes)
        for batch in batches:
            scores = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                x, y = codes(ta), codes(tb)
                common = len(np.intersect1d(x, y, assume_unique=True))
                scores.append(common / (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("id_a"), batch.column("id_b"), pa.array(scores, pa.float64())], ["id_a", "id_b", "similarity"])

    return both.select("id_a", "id_b", "ta", "tb").mapInArrow(verify, "id_a long, id_b long, similarity double").filter(F.col("similarity") > threshold)


def with_copies(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes and pairs within a class as pairs of records."""
    left, right = classes.select(F.col("class").alias("id_a"), F.col("id").alias("x")), classes.select(F.col("class").alias("id_b"), F.col("id").alias("y"))
    apart = pairs.join(left, "id_a").join(right, "id_b").select("x", "y", "similarity")
    same = left.join(right, F.col("id_a") == F.col("id_b")).filter("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    return apart.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def class_edges(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges with the components of with_copies: each copy is tied to its class alone."""
    return pairs.select("id_a", "id_b").unionByName(classes.filter("id <> class").select(F.col("class").alias("id_a"), F.col("id").alias("id_b")))


def near_clusters(df: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """id and cluster (least id of the component) of every record; records without a partner are their own cluster."""
    labels = connected_components(pairs, "id_a", "id_b")
    ids = df.select(F.col(id_col).alias("id")).distinct()
    return ids.join(labels, ids.id == labels.node, "left").select("id", F.coalesce("component", "id").alias("cluster"))


def near_duplicate_status(clusters: DataFrame, records: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Marks, never drops: the status names the record that stands for the cluster; null for that record itself."""
    heads = records.select(F.col(id_col).alias("cluster"), F.col(source_col).alias("_source"))
    out = clusters.join(heads, "cluster", "left")
    status = F.concat_ws("_", F.lit("similar_to"), "_source", F.col("cluster").cast("string"))
    return out.select("id", "cluster", F.when(F.col("id") != F.col("cluster"), status).alias("near_duplicate_status"))


def greedy_survivors(records: DataFrame, pairs: DataFrame, id_col: str, score_col: str, order_col: str, classes: DataFrame | None = None) -> DataFrame:
    """Ids kept by the sequential rule: in order of arrival, a record like one that is kept replaces the first such one if
    its score is higher, else it is dropped.

    Only similar records act on each other, so each connected component is replayed by itself, with its pairs. A
    component is one task's input: texts are not in it, ids and scores only. With ``classes`` (id and class), records of
    one class are alike and the pairs are those of classes.
    """
    labels = connected_components(pairs if classes is None else class_edges(pairs, classes), "id_a", "id_b")
    rows = records.select(F.col(id_col).cast("long").alias("id"), F.col(score_col).cast("double").alias("score"), F.col(order_col).cast("long").alias("place"))
    own = rows.withColumn("class", F.col("id")) if classes is None else rows.join(classes.select("id", "class"), "id", "left").withColumn("class", F.coalesce("class", "id"))
    tied = own.join(labels, own.id == labels.node).select("component", "id", "score", "place", "class")
    edges = pairs.join(labels, pairs.id_a == labels.node).select("component", F.col("id_a").cast("long").alias("id"), F.col("id_b").cast("long").alias("other"))
    both = tied.select("component", "id", "score", "place", F.col("class").alias("other")).unionByName(
        edges.select("component", "id", F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("place"), "other")
    )

    def replay(part: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, set[int]] = {}
        for a, b in part.loc[part["place"].isna(), ["id", "other"]].itertuples(index=False):
            near.setdefault(int(a), set()).add(int(b))
            near.setdefault(int(b), set()).add(int(a))
        own = part[part["place"].notna()].sort_values("place")
        kept: dict[int, tuple[int, int, float]] = {}  # class -> turn, id, score; a class has one kept record at most
        for turn, (i, c, score) in enumerate(own[["id", "other", "score"]].itertuples(index=False)):
            score = 0.0 if score != score else float(score)
            hit = min((kept[k] + (k,) for k in (*near.get(int(c), ()), int(c)) if k in kept), default=None)
            if hit is None or score > hit[2]:
                if hit is not None:
                    del kept[hit[3]]
                kept[int(c)] = (turn, int(i), score)
        return pd.DataFrame({"id": [i for _, i, _ in kept.values()]}, dtype="int64")

    survivors = both.groupBy("component").applyInPandas(replay, "id long")
    alone = rows.join(labels, rows.id == labels.node, "left_anti").select("id")
    return alone.unionByName(survivors)


def kept_by(policy: str, id_col: str) -> Column:
    """Aggregate: the id that a policy keeps of a group; what is unknown comes last, ties go to the least id."""
    place = [x for c in POLICIES[policy] for x in (F.col(c).isNull(), F.col(c))]
    return F.min_by(id_col, F.struct(*place, F.col(id_col)))
