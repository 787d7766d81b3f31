"""Connected components over edge tables of any size, and forests inside bounded buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.session import materialise

CHUNK = 512  # rows of one side of a comparison task


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long, not null); root is the smallest node reachable.

    Alternates the two star steps of Kiveris et al. (SoCC 2014): hang all larger neighbours on the
    smallest one, then all smaller ones. Minima are pre-aggregated and stored, so a node with very
    many edges meets them in a skew join that Spark can split. No table is collected.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = materialise(_star(both, now.groupBy("a").agg(F.min("b").alias("m")).union(now.select(F.col("b").alias("a"), F.col("b").alias("m"))), larger=True), "edges")
        now = materialise(_star(now, now.groupBy("a").agg(F.min("b").alias("m")), larger=False), "edges")
        mark, before = _mark(now), mark
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(edges: DataFrame, lowest: DataFrame, larger: bool) -> DataFrame:
    lowest = materialise(lowest.groupBy("a").agg(F.min("m").alias("m")), "lowest").withColumnRenamed("a", "hub")
    met = edges.join(lowest, edges["a"] == lowest["hub"])
    if larger:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select(F.col("hub").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b"))).first())


def comparisons(rows: DataFrame, key: list[str], item: str, chunk: int = CHUNK) -> DataFrame:
    """`rows` (key columns, item, ...) dealt so that any two items of a bucket meet in a task of bounded size.

    Buckets of one row go. A bucket of n rows is cut by item hash into ceil(n / chunk) parts; every pair
    of parts is a group of its own (`part_a`, `part_b`), so a hot bucket spreads over many tasks.
    """
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    met = rows.join(sizes, key).withColumn("parts", parts).drop("n").withColumn("own", F.pmod(F.xxhash64(item), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    out = met.select("*", other).select(*[c for c in met.columns if c not in ("own", "parts")], "own", F.least("own", "other").alias("part_a"), F.greatest("own", "other").alias("part_b"))
    return out.repartition(*key, "part_a", "part_b").sortWithinPartitions(*key, "part_a", "part_b", item)


def dealt(rows: DataFrame, bucket: str, item: str) -> DataFrame:
    """(meeting, item): every two items of a bucket are in some meeting of at most about 2 * CHUNK rows.

    For slim rows in buckets that are mostly small: all rows travel once, whether alone or not. Only a bucket
    of n > CHUNK rows is cut, by item hash, into ceil(n / CHUNK) parts that meet in pairs. Two meetings under
    one hash are one larger meeting. The table of hot buckets is stored, so Spark knows its size before it joins.
    """
    hot = rows.groupBy(F.col(bucket).alias("hot")).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts")).where("parts > 1")
    hot = materialise(hot, "hot")
    met = rows.join(hot, rows[bucket] == hot["hot"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(item), F.col("parts")).cast("int")
    met = met.select(bucket, item, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    out = met.select(F.xxhash64(bucket, F.least("own", "other"), F.greatest("own", "other")).alias("meeting"), item)
    return out.repartition("meeting").sortWithinPartitions("meeting", item)


def close_rows(meeting: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (rows, their smallest reachable rows) of the links within meetings, equal numbers side by side.

    `near` tells which of the given pairs of rows are linked. Rows are compared with the next one of their
    meeting, then the one after it, until no meeting is that long.
    """
    n = len(meeting)
    edge = np.flatnonzero(np.concatenate((meeting[1:] != meeting[:-1], [True]))) + 1 if n else np.zeros(0, np.int64)
    end = np.repeat(edge, np.diff(edge, prepend=0))
    left, right, at, ahead = [], [], np.arange(n), 1
    while len(at := at[at + ahead < end[at]]):
        hit = at[near(at, at + ahead)]
        left.append(hit)
        right.append(hit + ahead)
        ahead += 1
    root = np.arange(n)
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while (root[a] != root[b]).any():
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def per_meeting(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over rows sorted by `key`: `fn` sees batches that hold meetings whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if batch.num_rows else held
            if not batch.num_rows:
                continue
            v = batch.column(key).to_numpy()
            cut = int(np.searchsorted(v, v[-1]))
            held = batch.slice(cut)
            if cut and (r := fn(batch.slice(0, cut))) is not None:
                yield r
        if held is not None and (r := fn(held)) is not None:
            yield r

    return run


def per_group(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], keys: list[str], least: int = 2) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over rows sorted by `keys`: `fn` sees the rows of one group of `least` rows or more at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held:
                batch = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            cut = np.zeros(batch.num_rows, bool)
            for k in keys:
                v = batch.column(k).to_numpy(zero_copy_only=False)
                cut[1:] |= v[1:] != v[:-1]
            at = np.flatnonzero(cut).tolist()
            out = [r for a, b in zip([0, *at], at) if b - a >= least and (r := fn(batch.slice(a, b - a))) is not None]
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            held = [batch.slice(at[-1] if at else 0)]
        if held and held[0].num_rows >= least and (r := fn(held[0])) is not None:
            yield r

    return run


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row of a symmetric matrix of links."""
    n = len(linked)
    linked = linked | np.eye(n, dtype=bool)
    root = np.arange(n)
    while True:
        new = np.where(linked, root[None, :], n).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new
