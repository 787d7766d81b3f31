"""SimHash near-duplicates: pigeonhole blocks find all fingerprints within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import SEPARATOR, Words, pieces, row_hash, shingle_hashes, table, word_hashes, words_of
from .graph import close_rows, comparisons, components, dealt, forest, per_group, per_meeting

WORDS, RADIUS, SEED = 4, 4, 42
SAME = 3  # least number of blocks that must agree; there are RADIUS + SAME blocks then
CROWD = 32  # prints of a bucket beyond which blocks get wider, were they spread at random
FINE_WORDS, FINE_RADIUS = 2, 6  # of the fingerprints that propose pairs for `deduplicate`
SHINGLE, SIMILARITY = 5, 0.8  # what decides there
COLUMNS = 4096  # shingles of which one step of a comparison counts who holds them


def fingerprints(w: Words, k: int) -> np.ndarray:
    """64-bit fingerprint of each text: a bit is 1 if it is set in over half of the shingles' XXH64."""
    inside = ~SEPARATOR[w.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    moved = np.cumsum(keep) - 1  # place of each byte once words are joined by single spaces
    plain = np.where(inside, w.data, 0x20).astype(np.uint8)[keep].tobytes()
    counts = w.counts
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    ends = np.cumsum(runs)
    at = np.repeat(w.first[:-1] - (ends - runs), runs) + np.arange(runs.sum())
    last = at + np.minimum(k, np.repeat(counts, runs)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(plain[a:b], SEED) for a, b in zip(moved[w.start[at]].tolist(), (moved[w.end[last] - 1] + 1).tolist())], np.uint64)
    ones = np.zeros((len(runs), 64), np.int64)
    step = 1 << 18
    for i, (to, n) in enumerate(zip(ends.tolist(), runs.tolist())):
        for a in range(to - n, to, step):
            ones[i] += np.unpackbits(h[a : min(to, a + step)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > runs[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint(text: Column, k: int = WORDS) -> Column:
    """Fingerprint of a text as a long; a null or a text without words has 0."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        out = [fingerprints(words_of(p), k).view(np.int64) for p in pieces(texts)]
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))

    return of(text)


def block_masks(radius: int, same: int = SAME) -> list[int]:
    """Masks of every choice of `same` out of radius + same blocks, as signed longs."""
    n = radius + same
    edge = [round(64 * i / n) for i in range(n + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    masks = [sum(c) for c in combinations(block, same)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_that_agree(n: int, radius: int) -> int:
    """Blocks that must agree so that n prints spread at random are at most CROWD to a bucket; at least SAME."""
    same = SAME
    while n >> (64 * same // (radius + same)) > CROWD and same < 2 * radius:
        same += 1
    return same


def links(prints: DataFrame, radius: int = RADIUS, same: int | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column print) that differ in at most `radius` bits.

    Two such fingerprints agree in at least `same` of radius + same blocks, so they meet in the bucket
    of one choice of blocks; there the whole fingerprint is compared. Any `same` gives the same links; by
    default blocks get wider as the prints get more, so that buckets stay small. The edges are a spanning
    forest of the links of every meeting, so they are linear in the rows dealt and join exactly the texts that
    the links join.
    """
    same = same or blocks_that_agree(prints.count(), radius)
    buckets = F.array(*[F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(block_masks(radius, same))])
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a stored table of prints can be one small file
    rows = prints.repartition(tasks, "print").select(F.explode(buckets).alias("bucket"), "print")

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        p = batch.column("print").to_numpy()
        a, b = close_rows(batch.column("meeting").to_numpy(), lambda x, y: np.bitwise_count((p[x] ^ p[y]).view(np.uint64)) <= radius)
        return pa.record_batch({"a": p[a], "b": p[b]}) if len(a) else None

    return dealt(rows, "bucket", "print").mapInArrow(per_meeting(compare, "meeting"), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = WORDS, radius: int = RADIUS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, print (long), component_id.

    Documents link if their fingerprints differ in at most `radius` bits; component_id is the smallest
    doc_id reachable. Documents without words have fingerprint 0 and link like any others. Repeated rows
    stay repeated. A null doc_id is never the smallest; a component of nulls only has a null id. Only the
    two named columns are read, so other columns may have any name. No documents give no rows.
    """
    printed = materialise(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), k).alias("print")), "prints")
    distinct = materialise(printed.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = components(links(distinct.select("print"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    named = materialise(named, "roots")
    label = materialise(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "labels")
    label = materialise(named.join(label, "root").select("print", "component_id"), "labels")
    return printed.join(label, "print").select("doc_id", "print", "component_id")


def shingle_set(text: Column) -> Column:
    """Distinct hashes of a text's runs of five words."""

    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for piece in pieces(texts):
            w = words_of(piece)
            h, first = shingle_hashes(w, word_hashes(w), SHINGLE)
            edge = np.searchsorted(first, w.first)
            out += [np.unique(h[a:b]).view(np.int64) for a, b in zip(edge, edge[1:])]
        return pa.array(out, pa.list_(pa.int64()))

    return of(text)


def verified(group: pa.RecordBatch, least: float) -> pa.RecordBatch | None:
    """Spanning forest (a, b) of the texts of one comparison whose shingle sets have a Jaccard similarity of `least`."""
    own, part_a, of = (group.column(c).to_numpy() for c in ("own", "part_a", "of"))
    shingles = group.column("shingles")
    size = pa.compute.list_value_length(shingles).to_numpy()
    number, which = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
    row = np.repeat(np.arange(len(of)), size)
    often = np.bincount(which, minlength=len(number)) > 1  # a shingle of one text is in no intersection
    row, which = row[often[which]], (np.cumsum(often) - 1)[which[often[which]]]
    order = np.argsort(which, kind="stable")
    row, which = row[order], which[order]
    left = np.flatnonzero(own == part_a)
    right = left if (own == part_a).all() else np.flatnonzero(own != part_a)
    shared = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(often.sum()), COLUMNS):
        x, y = np.searchsorted(which, (low, low + COLUMNS))
        holds = np.zeros((len(of), min(COLUMNS, int(often.sum()) - low)), np.float32)
        holds[row[x:y], which[x:y] - low] = 1
        shared += holds[left] @ holds[right].T
    union = size[left][:, None] + size[right][None, :] - shared
    linked = np.zeros((len(of), len(of)), bool)
    linked[np.ix_(left, right)] = (union == 0) | (shared >= least * union)
    root = forest(linked | linked.T)
    moved = root != np.arange(len(of))
    return pa.record_batch({"a": of[moved], "b": of[root[moved]]}) if moved.any() else None


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = FINE_WORDS, radius: int = FINE_RADIUS, least: float = SIMILARITY) -> DataFrame:
    """`docs` with one document of each group of near-duplicates, columns as they are.

    Fingerprints over short shingles at a wider radius propose, five-word shingles decide: texts whose
    fingerprints are equal or joined by links within `radius` bits form a SimHash component, all pairs of
    texts of a component are compared exactly, in tasks of bounded size, and pairs with a Jaccard
    similarity of at least `least` are linked. The connected texts are a group.
    Of a group the smallest doc_id stays (nulls last, then by hash of the row); rows equal in all columns
    are one document. Texts without words are equal to each other. No documents give no rows.
    """
    content = F.coalesce(docs[text], F.lit(""))
    slim = docs.select(docs[doc_id].alias("doc_id"), row_hash(docs).alias("row"), F.xxhash64(content).alias("of"), fingerprint(content, k).alias("print"))
    slim = materialise(slim, "prints")
    texts = materialise(slim.groupBy("of", "print").agg(F.min("doc_id").alias("doc_id")), "texts")
    roots = components(links(texts.select("print").distinct(), radius))
    named = texts.join(roots.withColumnRenamed("node", "print"), "print", "left").select("of", "doc_id", F.coalesce("root", "print").alias("proposed"))
    named = materialise(named, "proposed")
    several = named.groupBy("proposed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("proposed")
    several = materialise(several, "several")  # of known size: a hot component stays where its texts are
    wanted = materialise(named.join(several, "proposed").select(F.col("of").alias("want"), F.col("doc_id").alias("want_id"), "proposed"), "wanted")
    source = docs.select(docs[doc_id].alias("doc_id"), content.alias("text")).withColumn("of", F.xxhash64("text"))
    met = source.join(wanted.hint("shuffle_hash"), (F.col("of") == F.col("want")) & F.col("doc_id").eqNullSafe(F.col("want_id")))
    sets = met.select("of", "proposed", shingle_set(F.col("text")).alias("shingles")).groupBy("of").agg(F.any_value("proposed").alias("proposed"), F.any_value("shingles").alias("shingles"))
    met = comparisons(materialise(sets, "shingles"), ["proposed"], "of")
    compare = per_group(lambda g: verified(g, least), ["proposed", "part_a", "part_b"])
    found = components(materialise(met.mapInArrow(compare, "a long, b long").distinct(), "alike"))
    moved = materialise(found.join(texts, found["node"] == texts["of"]).select("node", "root", "doc_id"), "groups")
    firsts = moved.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("f")).select("root", F.col("f.node").alias("head"))
    merged = materialise(moved.join(firsts, "root").select("node", "head"), "merged")
    group = slim.join(merged, slim["of"] == merged["node"], "left").select("doc_id", "row", F.coalesce("head", "of").alias("head"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("row")))
    kept = group.groupBy("head").agg(best.alias("k")).select(F.col("k.doc_id").alias("kept_id"), F.col("k.row").alias("kept_row"))
    counts = group.groupBy(F.col("doc_id").alias("kept_id"), F.col("row").alias("kept_row")).agg(F.count(F.lit(1)).alias("rows"))
    kept = materialise(kept.join(counts, kept["kept_id"].eqNullSafe(counts["kept_id"]) & (kept["kept_row"] == counts["kept_row"])).select(kept["kept_id"], kept["kept_row"], "rows"), "kept")

    def rows_of(keys: DataFrame) -> DataFrame:
        return docs.join(keys.hint("shuffle_hash"), docs[doc_id].eqNullSafe(keys["kept_id"]) & (row_hash(docs) == keys["kept_row"]), "left_semi")

    return rows_of(kept.where("rows = 1")).union(rows_of(kept.where("rows > 1")).dropDuplicates())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
