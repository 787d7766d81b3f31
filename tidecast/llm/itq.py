"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import table
from .graph import comparisons, components, forest, per_group

COSINE = 0.93
BITS = 64  # of a code; vectors of fewer dimensions get several rotations of their own
TABLES = 8  # blocks of a code; codes that differ in fewer bits always share a block
TRAIN = 20_000  # distinct vectors that the rotation is learned from at most, chosen by hash
ROUNDS = 50


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the map from a centred unit vector to the values whose signs are its code.

    Iterative quantisation (Gong and Lazebnik 2011): principal directions, then a rotation that alternates
    between the signs and the orthogonal map that comes nearest to them.
    """
    size = sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) else np.zeros(size)
    centred = sample - mean
    main = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, : min(bits, size)]
    flat, turns = centred @ main, []
    for k in range(-(-bits // size)):
        turn = np.linalg.qr(np.random.default_rng(seed + k).normal(size=(main.shape[1],) * 2))[0]
        for _ in range(rounds if len(sample) > 1 else 0):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        turns.append(main @ turn)
    return mean, np.concatenate(turns, axis=1)[:, :bits]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    flat, length = column.flatten().to_numpy(zero_copy_only=False).astype(float), np.array(pa.compute.list_value_length(column))
    if (length == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(length), size))
    out[np.arange(size)[None, :] < length[:, None]] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(blocks: np.ndarray, t: int, vectors: np.ndarray, length: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs at the cosine or above that meet in table t and in no earlier one."""
    near = (vectors @ vectors.T >= cosine) & (length[:, None] == length[None, :])
    np.fill_diagonal(near, False)
    for s in range(t):
        near &= blocks[:, None, s] != blocks[None, :, s]
    return near


def near_vectors(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", train: int = TRAIN) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine, in double precision, is at least
    `cosine`; candidates share a block of their codes, and every candidate's original vectors are
    compared. Vectors that are null, zero, or hold a null or non-finite component link with nothing;
    vectors of different lengths do not link. Equal vectors are one class that is compared once and
    counted by its size, so repeated rows link with each other; buckets of any size are compared in
    parts, and only counts and a spanning forest leave them. component_id is the smallest vec_id
    reachable; a null vec_id is never the smallest. Only the named columns are read.
    """
    spark = vectors.sparkSession
    e = F.col("embedding")
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[label].alias("label"), vectors[embedding].cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.withColumn("valid", F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)))
    hashes = [F.when(F.col("valid"), F.xxhash64(F.lit(s), e)).alias(s) for s in ("k1", "k2")]
    slim = materialise(rows.select("vec_id", "label", "valid", *hashes), "vectors")
    key = ["label", "k1", "k2"]
    classes = rows.where("valid").select("vec_id", "label", *hashes, "embedding").groupBy(*key).agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.any_value("embedding").alias("embedding"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")  # ids hold once written

    size = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    sample = classes.orderBy("k1", "k2", "label").limit(train).select("embedding").toArrow()
    found = matrix(sample.column(0).combine_chunks(), size) if sample.num_rows else np.zeros((0, size))
    mean, turn = learn(unit(found) if len(found) else found)
    sent = spark.sparkContext.broadcast((mean, turn))

    @F.arrow_udf("binary")
    def code(batch: pa.Array) -> pa.Array:
        m, r = sent.value
        bits = np.packbits((unit(matrix(batch, size)) - m) @ r > 0, axis=1)
        return pa.array([x.tobytes() for x in bits], pa.binary())

    coded = classes.select("class", "label", F.col("n").alias("weight"), "embedding", code("embedding").alias("code"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(TABLES - 1)), lambda t: F.struct(t.alias("table_no"), F.substring("code", t + 1, F.lit(1)).alias("block")))
    dealt = comparisons(coded.select("*", F.inline(blocks)), ["label", "table_no", "block"], "class")

    def compare(group: pa.RecordBatch) -> pa.RecordBatch | None:
        own = group.column("own").to_numpy()
        of = np.array([list(x.as_py()) for x in group.column("code")], np.uint8)
        v = group.column("embedding")
        near = linked(of, group.column("table_no")[0].as_py(), unit(matrix(v, size)), np.array(pa.compute.list_value_length(v)), cosine)
        if group.column("part_a")[0].as_py() != group.column("part_b")[0].as_py():  # pairs of one part meet in its own group
            near &= own[:, None] != own[None, :]
        some = near.any(axis=1)
        if not some.any():
            return None
        ids = group.column("class").to_numpy()
        return pa.record_batch({"a": ids[some], "b": ids[forest(near)][some], "links": (near @ group.column("weight").to_numpy())[some]})

    met = materialise(dealt.mapInArrow(per_group(compare, ["label", "table_no", "block", "part_a", "part_b"]), "a long, b long, links long"), "met")
    counts = met.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(met.select("a", "b"))
    named = classes.select("class", *key, "first_id", "n").join(counts, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = materialise(named.withColumn("root", F.coalesce("root", "class")), "roots")
    lowest = materialise(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "labels")
    known = named.join(lowest, "root").select(*[F.col(k).alias(f"of_{k}") for k in key], "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    known = materialise(known, "known")
    on = [slim[k] == known[f"of_{k}"] for k in key]
    out = slim.join(known, on, "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op9_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
