"""Boosted regression trees over binned features, with sums that no layout of the rows can change.

Features are cut once into at most 256 bins of one byte. A level of a tree needs, for every open node,
feature and bin, the sum and number of the rows' gradients; gradients are whole numbers on a fixed
scale, so sums are exact: rows may lie in any order and partition, and a lost task repeats the same
bits. Several models (one per segment, say) grow in the same jobs. A model whose rows fit a task is
grown there, in one job for all such models; a larger one takes a job per level, in which tasks send
sums only and splits are found per node. Both ways give the same trees.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import fresh_path, materialise

BINS = 256
SAMPLE = 1 << 16  # rows, chosen by the hash of their keys, that place the bins' edges
TASK_ROWS = 1 << 18  # rows of a model that one task may hold (some 20 MB)
BLOCK = 1 << 16  # rows that are counted at once; sums of so many low halves and their number fit one double
LOW = 20  # bits of a gradient's low half
STORE_EVERY = 16  # trees after which the rows' forecasts are stored anew
SENT = 64  # models' sums of a level (2 MB at most) that reach the driver; those of more tasks are added in tasks before
PRECISION = 40  # bits of a gradient
ROWS = "model string, h long, y double, held boolean, x array<double>"
BINNED = "model string, h long, y double, held boolean, bins binary, margin double"
TREES = "model string, number int, feature binary, cut binary, value binary, gain binary"


@dataclass
class Tree:
    """Nodes in heap order; the feature of a leaf is -1, rows whose bin is above the cut go right."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def node_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row after some levels; rows in a leaf above stay there."""
        node = np.zeros(len(bins), np.int64)
        for _ in range(levels):
            node = self.down(bins, node)
        return node

    def down(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Nodes of rows a level below."""
        f = self.feature[node]
        right = bins[np.arange(len(bins)), np.maximum(f, 0)] > self.cut[node]
        return np.where(f >= 0, 2 * node + 1 + right, node)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.node_of(bins, len(self.feature).bit_length() - 1)]

    def row(self, model: str, number: int) -> tuple:
        return model, number, self.feature.tobytes(), self.cut.tobytes(), self.value.tobytes(), self.gain.tobytes()

    @staticmethod
    def of(r: Mapping[str, Any]) -> Tree:
        return Tree(*(np.frombuffer(r[c], t) for c, t in (("feature", np.int16), ("cut", np.uint8), ("value", np.float64), ("gain", np.float64))))


@dataclass(frozen=True)
class Plan:
    """What every task must know of a model: parameters, first forecast and the scales of its sums."""

    p: dict
    base: float
    scale: float  # of gradients
    loss_scale: float
    n_features: int

    @staticmethod
    def of(p: Mapping[str, Any], n: int, base: float, most: float, n_features: int) -> Plan:
        size = max(1, math.ceil(math.log2(n + 1)))
        top = math.frexp(4 * most + 1e-300)[1]  # forecasts stay within the range of the labels, with room
        bits, loss_bits = min(PRECISION, 62 - size), min(25, (62 - size) // 2)
        return Plan(dict(p), base, 2.0 ** (bits - top), 2.0 ** (loss_bits - top), n_features)

    def gradients(self, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.rint((margin - y) * self.scale).astype(np.int64)

    def loss(self, margin: np.ndarray, y: np.ndarray) -> int:
        whole = np.rint((margin - y) * self.loss_scale).astype(np.int64)
        return int((whole * whole).sum())

    def drawn(self, h: np.ndarray, tree: int) -> np.ndarray:
        """Rows of a tree's subsample, by the hash of their keys."""
        if self.p["subsample"] >= 1:
            return np.ones(len(h), bool)
        x = h.view(np.uint64) ^ np.uint64(((self.p["random_state"] << 20) + tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) >> np.uint64(11) < np.uint64(int(self.p["subsample"] * (1 << 53)))

    def columns(self, tree: int) -> np.ndarray:
        """Features of a tree."""
        n = max(1, round(self.p["colsample_bytree"] * self.n_features))
        return np.sort(np.random.default_rng([self.p["random_state"], tree]).choice(self.n_features, n, replace=False))

    def leaf(self, total: float, n: float) -> float:
        """Step of a leaf: penalties L1 on the sum, L2 on the number, then the learning rate."""
        g = total / self.scale
        g = math.copysign(max(0.0, abs(g) - self.p.get("reg_alpha", 0.0)), g)
        return -self.p["learning_rate"] * g / (n + self.p.get("reg_lambda", 1.0))

    def split(self, tree: Tree, node: int, sums: np.ndarray, columns: np.ndarray, last: bool) -> None:
        """Set the node's leaf value and, unless it is on the last level, its best split (ties: first feature, first bin)."""
        total, n = int(sums[0, :, 0].sum()), int(sums[0, :, 1].sum())
        tree.value[node] = self.leaf(total, n)
        if last:
            return
        left = sums.cumsum(axis=1)[:, :-1]
        right = np.array([total, n]) - left
        soft = lambda s: np.maximum(np.abs(s / self.scale) - self.p.get("reg_alpha", 0.0), 0.0) ** 2
        fits = lambda s: soft(s[..., 0]) / np.maximum(s[..., 1] + self.p.get("reg_lambda", 1.0), 1e-12)
        gain = fits(left) + fits(right) - fits(np.array([total, n]))
        least = self.p["min_child_weight"]
        gain = np.where((left[..., 1] >= least) & (right[..., 1] >= least), gain, -np.inf)
        at = int(gain.argmax())
        if gain.flat[at] > self.p["gamma"]:
            tree.feature[node], tree.cut[node], tree.gain[node] = columns[at // (BINS - 1)], at % (BINS - 1), gain.flat[at]


def histogram(bins: np.ndarray, node: np.ndarray, q: np.ndarray, columns: np.ndarray, n_nodes: int) -> np.ndarray:
    """Sums (node, feature, bin, [gradient, rows]) as whole numbers; halves of a gradient add up exactly in doubles.

    The number of rows lies above the low halves' sum in the same double.
    """
    out = np.zeros((n_nodes, len(columns), BINS, 2), np.int64)
    size, above = n_nodes * BINS, LOW + BLOCK.bit_length() - 1
    for a in range(0, len(bins), BLOCK):
        b, base, k = bins[a : a + BLOCK], node[a : a + BLOCK].astype(np.int64) * BINS, q[a : a + BLOCK]
        high, low = (k >> LOW).astype(np.float64), ((k & ((1 << LOW) - 1)) + (1 << above)).astype(np.float64)
        for i, c in enumerate(columns):
            place = base + b[:, c]
            two = np.bincount(place, low, size).astype(np.int64).reshape(n_nodes, BINS)
            out[:, i, :, 0] += (np.bincount(place, high, size).astype(np.int64) << LOW).reshape(n_nodes, BINS) + (two & ((1 << above) - 1))
            out[:, i, :, 1] += two >> above
    return out


class Growth:
    """A tree that grows level by level: which nodes' rows have to be counted, and what follows from their sums.

    Of two children only the one with fewer rows is counted; the other's sums are the rest of their parent's.
    The last level's values follow from the sums of the level above.
    """

    def __init__(self, plan: Plan, number: int) -> None:
        self.plan, self.number, self.level = plan, number, 0
        self.tree, self.columns = Tree.empty(plan.p["max_depth"]), plan.columns(number)
        self.counted, self.parents = [0], {}

    def sums(self, bins: np.ndarray, node: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Sums of the nodes to be counted, of rows of a subsample; bins by feature."""
        place = np.full(len(self.tree.feature), -1)
        place[self.counted] = np.arange(len(self.counted))
        place = place[node]
        here = np.flatnonzero(place >= 0)
        return histogram(np.take(bins, here, axis=1).T, place[here], q[here], self.columns, len(self.counted))

    def take(self, sums: np.ndarray) -> None:
        """Split the nodes of this level by the sums of those that were counted."""
        known = dict(zip(self.counted, sums))
        if self.level:
            known |= {n + 1 if n % 2 else n - 1: self.parents[(n - 1) // 2] - s for n, s in known.items()}
        self.counted, self.parents = [], {}
        last = self.level == self.plan.p["max_depth"]
        self.level += 1
        for node in sorted(known):
            own = known[node]
            self.plan.split(self.tree, node, own, self.columns, last)
            if self.tree.feature[node] < 0:
                continue
            split = own[np.searchsorted(self.columns, self.tree.feature[node])]
            left = split[: int(self.tree.cut[node]) + 1].sum(axis=0)
            right = split.sum(axis=0) - left
            for child, (total, n) in ((2 * node + 1, left.tolist()), (2 * node + 2, right.tolist())):
                self.tree.value[child] = self.plan.leaf(total, n)
            if self.level < self.plan.p["max_depth"]:
                self.parents[node] = own
                self.counted.append(2 * node + 1 if left[1] <= right[1] else 2 * node + 2)


class Rounds:
    """Trees of one model so far, and when to end."""

    def __init__(self, plan: Plan, has_held: bool) -> None:
        self.plan, self.trees, self.losses = plan, [], []
        self.patience = plan.p["early_stopping_rounds"] if has_held else 0
        self.best, self.at = None, 0

    def add(self, tree: Tree, loss: int) -> None:
        self.trees.append(tree)
        self.losses.append(loss)
        if self.best is None or loss < self.best:
            self.best, self.at = loss, len(self.trees)

    @property
    def done(self) -> bool:
        n = len(self.trees)
        return n >= self.plan.p["n_estimators"] or bool(self.patience and n - self.at >= self.patience)

    def kept(self) -> list[Tree]:
        """Trees up to the best held-out round: a prefix, nothing is fitted again."""
        return self.trees[: max(self.at, 1)] if self.patience else self.trees


def grown_here(plan: Plan, h: np.ndarray, y: np.ndarray, held: np.ndarray, bins: np.ndarray) -> Rounds:
    """All rounds of a model whose rows are at hand."""
    rounds = Rounds(plan, bool(held.any()))
    margin = np.full(len(y), plan.base)
    own, by_feature = ~held, np.ascontiguousarray(bins.T)
    while not rounds.done:
        growth = Growth(plan, len(rounds.trees))
        use = np.flatnonzero(own & plan.drawn(h, growth.number))
        b, q = np.take(by_feature, use, axis=1), plan.gradients(margin[use], y[use])
        node = np.zeros(len(use), np.int64)
        while growth.counted:
            growth.take(growth.sums(b, node, q))
            node = growth.tree.down(b.T, node)
        margin = margin + growth.tree.predict(by_feature.T)
        rounds.add(growth.tree, plan.loss(margin[held], y[held]))
    return rounds


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def grown_in_tasks(binned: DataFrame, plans: dict[str, Plan]) -> dict[str, list[Tree]]:
    """Small models, each in a task of its own, all in one job."""

    def grow(group: pa.Table) -> pa.Table:
        model = group.column("model")[0].as_py()
        c = lambda n: group.column(n).to_numpy()
        rounds = grown_here(plans[model], c("h"), c("y"), c("held").astype(bool), _matrix(group.column("bins").combine_chunks(), plans[model].n_features))
        names = [f.split()[0] for f in TREES.split(", ")]
        types = [pa.string(), pa.int32(), *[pa.binary()] * 4]
        rows = [t.row(model, i) for i, t in enumerate(rounds.kept())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = binned.where(F.col("model").isin(list(plans))).groupBy("model").applyInArrow(grow, TREES).collect()
    out: dict[str, list[Tree]] = {m: [] for m in plans}
    for r in sorted(rows, key=lambda r: r["number"]):
        out[r["model"]].append(Tree.of(r))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition as pickled blocks (model, h, y, held, bins by feature, margin) of about BLOCK rows."""

    def out(m: str) -> pa.RecordBatch:
        h, y, held, bins, margin = zip(*kept.pop(m))
        block = m, np.concatenate(h), np.concatenate(y), np.concatenate(held), np.concatenate(bins, axis=1), np.concatenate(margin)
        return pa.record_batch({"block": pa.array([pickle.dumps(block, 5)], pa.binary())})

    kept: dict[str, list[tuple[np.ndarray, ...]]] = {}
    for batch in batches:
        names = np.array(batch.column("model").to_pylist(), object)
        for m in sorted(set(names)):
            part = batch.take(pa.array(np.flatnonzero(names == m)))
            h, y, margin = (part.column(c).to_numpy() for c in ("h", "y", "margin"))
            bins = _matrix(part.column("bins"), len(part.column("bins")[0].as_py())).T
            kept.setdefault(m, []).append((h, y, part.column("held").to_numpy(zero_copy_only=False).astype(bool), bins, margin))
            if sum(len(k[0]) for k in kept[m]) >= BLOCK:
                yield out(m)
    for m in sorted(kept):
        yield out(m)


def _added(one: dict, other: dict) -> dict:
    return one | {k: one[k] + v if k in one else v for k, v in other.items()}


def grown_by_level(binned: DataFrame, plans: dict[str, Plan]) -> dict[str, list[Tree]]:
    """Large models: a job per level for all of them; only sums and losses leave the tasks.

    Rows lie in blocks in the executors' memory, or on their disks. A tree's forecasts are added in the first job of the
    next tree, which also tells the loss. After STORE_EVERY trees the blocks are written, so that a lost one comes from there.
    """
    spark = binned.sparkSession
    own = binned.where(F.col("model").isin(list(plans)))
    seen = {r["model"]: r for r in own.groupBy("model").agg(F.max("held").alias("held"), F.count(F.lit(1)).alias("n")).collect()}
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(r["n"] for r in seen.values()) // TASK_ROWS))
    packed = own.repartition(parts, "h").mapInArrow(_blocks, "block binary").rdd
    blocks = packed.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)

    def counted(blocks: RDD, growing: dict[str, Growth]) -> dict:
        """Sums of each model's nodes by its name, and before the root is split its loss by (name,)."""

        def partial(rows: Iterable[tuple]) -> Iterator[dict]:
            total: dict = {}
            for m, h, y, held, bins, margin in rows:
                if (g := growing.get(m)) is None:
                    continue
                plan = plans[m]
                use = np.flatnonzero(~held & plan.drawn(h, g.number))
                b = np.take(bins, use, axis=1)
                found = {m: g.sums(b, g.tree.node_of(b.T, g.level), plan.gradients(margin[use], y[use]))}
                total = _added(total, found if g.level else found | {(m,): plan.loss(margin[held], y[held])})
            yield total

        found = blocks.mapPartitions(partial)
        senders = max(1, SENT // len(growing))
        if found.getNumPartitions() > senders:
            found = found.mapPartitionsWithIndex(lambda i, x: ((i % senders, t) for t in x)).reduceByKey(_added, senders).values()
        total: dict = {}
        for t in found.collect():
            total = _added(total, t)
        return total

    def moved(blocks: RDD, trees: dict[str, Tree]) -> RDD:
        def step(block: tuple) -> tuple:
            m, h, y, held, bins, margin = block
            return (m, h, y, held, bins, margin + trees[m].predict(bins.T)) if m in trees else block

        return blocks.map(step).persist(StorageLevel.MEMORY_AND_DISK)

    rounds = {m: Rounds(plan, seen[m]["held"]) for m, plan in plans.items()}
    active, number, before = [m for m, r in rounds.items() if not r.done], 0, None
    trees: dict[str, Tree] = {}
    while active:
        growing = {m: Growth(plans[m], number) for m in active}  # all models started together
        sums = counted(blocks, growing)
        if before is not None:
            before.unpersist()
        for m in trees:
            rounds[m].add(trees[m], sums[m,])
        active = [m for m in active if not rounds[m].done]
        while todo := {m: growing[m] for m in active if growing[m].counted}:
            sums = sums if next(iter(todo.values())).level == 0 else counted(blocks, todo)
            for m, g in todo.items():
                g.take(sums[m])
        trees = {m: growing[m].tree for m in active}
        number += 1
        if active and number % STORE_EVERY == 0:
            path = fresh_path(spark, "margins")
            blocks.saveAsPickleFile(path, 1)
            blocks.unpersist()
            blocks = spark.sparkContext.pickleFile(path)
        before, blocks = blocks, moved(blocks, trees) if active else blocks
    blocks.unpersist()
    return {m: r.kept() for m, r in rounds.items()}


@dataclass
class Booster:
    """A fitted model: names and edges of its features, first forecast and trees."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out = out + t.predict(bins)
        return out

    def importance(self) -> dict[str, float]:
        """Share of each feature in the gain of all splits; no splits, no shares."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            split = t.feature >= 0
            np.add.at(total, t.feature[split], t.gain[split])
        whole = total.sum()
        return dict(zip(self.features, (total / whole if whole else total).tolist()))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        return df.withColumn("prediction", forecasts({"": self}, F.lit(""), F.col(features)))

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per tree, and one with names, edges and first forecast."""
        head = json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges], "base": self.base})
        spark.createDataFrame([(head, *t.row("", i)) for i, t in enumerate(self.trees)], f"head string, {TREES}").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        rows = spark.read.parquet(path).orderBy("number").collect()
        head = json.loads(rows[0]["head"])
        return Booster(head["features"], [np.array(e, np.float64) for e in head["edges"]], head["base"], [Tree.of(r) for r in rows])


def forecasts(models: dict[str, Booster], model, features):
    """Forecast of each row by the model it names; rows of other names have none."""

    @F.arrow_udf("double")
    def of(name: pa.Array, x: pa.Array) -> pa.Array:
        names = np.array(name.to_pylist(), object)
        out = np.full(len(names), np.nan)
        for m in set(names) & set(models):
            own = np.flatnonzero(names == m)
            out[own] = models[m].predict(binned_rows(x.take(pa.array(own)), models[m].edges))
        return pa.array(out, mask=np.isnan(out))

    return of(model, features)


def binned_rows(x: pa.Array, edges: Sequence[np.ndarray]) -> np.ndarray:
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(edges))
    return np.stack([np.searchsorted(e, values[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8) if len(x) else np.zeros((0, len(edges)), np.uint8)


def edges_of(rows: DataFrame, n: int, width: int) -> list[np.ndarray]:
    """Edges of each feature's bins: between all values if there are few, else quantiles of a sample by key hash."""
    share = 1.0 if n <= SAMPLE else SAMPLE / n
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("x").toArrow().column("x").combine_chunks()
    values = sample.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    out = []
    for i in range(width):
        v = np.unique(values[:, i])
        if len(v) > BINS:
            v = np.unique(np.quantile(values[:, i], np.arange(1, BINS) / BINS, method="lower"))
            out.append(v)
        else:
            out.append(v[:-1])
    return out


def fit(rows: DataFrame, features: list[str], p: Mapping[str, Any], task_rows: int = TASK_ROWS) -> dict[str, Booster]:
    """A model for every name in `rows` (ROWS), fitted on rows that are not held, ended by those that are.

    At most `n_estimators` trees; `early_stopping_rounds` rounds without a lower held-out error end a
    model, and it keeps its trees up to the best round. Without held rows, or with 0 rounds of patience,
    all trees stay. `reg_alpha` and `reg_lambda` (1 by default) are L1 and L2 penalties of the leaves.
    A name whose rows are all held has no model.
    """
    own = F.when(~F.col("held"), F.col("y"))
    total = F.sum(own.cast("decimal(28,6)")).alias("total")
    stats = rows.groupBy("model").agg(F.count(own).alias("n"), total, F.max(F.abs(own)).alias("most"), F.count(F.lit(1)).alias("all")).collect()
    stats = [r for r in stats if r["n"]]
    if not stats:
        return {}
    edges = edges_of(rows.where("not held"), sum(r["n"] for r in stats), len(features))
    plans, base = {}, {}
    for r in stats:
        base[r["model"]] = float(r["total"] / r["n"])
        plans[r["model"]] = Plan.of(p, r["all"], base[r["model"]], r["most"] + abs(base[r["model"]]), len(features))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = binned_rows(b.column("x"), edges)
            margin = np.array([base.get(m, 0.0) for m in b.column("model").to_pylist()], np.float64)
            yield pa.record_batch({"model": b.column("model"), "h": b.column("h"), "y": b.column("y"), "held": b.column("held"), "bins": pa.array([x.tobytes() for x in bins], pa.binary()), "margin": margin})

    binned = materialise(rows.select("model", "h", "y", "held", "x").mapInArrow(cut, BINNED), "binned")
    small = {r["model"]: plans[r["model"]] for r in stats if r["all"] <= task_rows}
    large = {m: plan for m, plan in plans.items() if m not in small}
    trees = (grown_in_tasks(binned, small) if small else {}) | (grown_by_level(binned, large) if large else {})
    return {m: Booster(list(features), edges, base[m], t) for m, t in trees.items()}
