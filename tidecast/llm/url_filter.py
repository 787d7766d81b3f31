"""URL filters: path rules, and a Bloom filter cascade with exact membership over a corpus's keys."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import mix, table

SHARD_KEYS = 1 << 20  # keys of one shard, built in one task
BROADCAST_BYTES = 64 << 20  # filters that one pass over the rows carries
MAX_LEVELS = 64
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SPAM = r"(^|[.-])(casino|bets|pills|spam|adult|ads)([.-]|$)"
CASCADE = "shard int, level int, hashes int, bits long, filter binary"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null or a text without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest fitting rule (of equals, the one of the longer host) and its verdict, or nulls."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    fits = [((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2]) for r in ranked]
    name = F.coalesce(F.lit(None).cast("string"), *[F.when(f, F.lit(r[1] + r[2])) for f, r in zip(fits, ranked)])
    return name, F.coalesce(F.lit(None).cast("string"), *[F.when(f, F.lit(r[0])) for f, r in zip(fits, ranked)])


def _places(h1: np.ndarray, h2: np.ndarray, level: int, i: int, bits: np.ndarray | int) -> np.ndarray:
    salt = mix(np.array([64 * level + i + 1], np.uint64))[0]
    return mix((h1 ^ salt) + h2) % np.asarray(bits, np.uint64)


def build_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(hashes, bits, filter) of each level for one shard's complete keys.

    Level 0 holds the listed keys; each next one holds the keys of the other kind that passed the one
    before, until none pass. The first level's rate balances the two kinds, later ones pass half.
    """
    levels = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        level = len(levels)
        if level == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have the same hashes")
        rate = min(0.5, max(1e-6, len(inside) / max(1, len(outside)) / math.sqrt(2))) if level == 0 else 0.5
        hashes = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(len(inside) * -math.log(rate) / math.log(2) ** 2))
        set_ = np.zeros(bits, bool)
        for i in range(hashes):
            set_[_places(h1[inside], h2[inside], level, i, bits)] = True
        levels.append((hashes, bits, np.packbits(set_)))
        passed = np.ones(len(outside), bool)
        for i in range(hashes):
            passed &= set_[_places(h1[outside], h2[outside], level, i, bits)]
        inside, outside = outside[passed], inside
    return levels


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit("a"), key), F.xxhash64(F.lit("b"), key)


def build(keys: DataFrame, listed: DataFrame) -> tuple[DataFrame, int]:
    """Cascade over the distinct `keys` (key), exact for each of them, and its number of shards.

    Both sides are reduced to distinct keys before they meet, so a key with very many rows weighs as any
    other. Keys are dealt by hash to shards of about SHARD_KEYS, so no task grows with the corpus. A
    null key is no key. Without listed keys there are no levels and nothing is a member.
    """
    both = keys.select("key", F.lit(False).alias("listed")).union(listed.select("key", F.lit(True).alias("listed")))
    both = materialise(both.where("key is not null").groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    shards = max(1, math.ceil(both.count() / SHARD_KEYS))
    h1, h2 = key_hashes(F.col("key"))
    rows = both.select(F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards)).cast("int").alias("shard"), h1.alias("h1"), h2.alias("h2"), "listed")

    def one(shard: pa.Table) -> pa.Table:
        h = [shard.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")]
        levels = build_levels(*h, shard.column("listed").to_numpy(zero_copy_only=False))
        return pa.table(
            {
                "shard": pa.array([shard.column("shard")[0].as_py()] * len(levels), pa.int32()),
                "level": pa.array(range(len(levels)), pa.int32()),
                "hashes": pa.array([x[0] for x in levels], pa.int32()),
                "bits": pa.array([x[1] for x in levels], pa.int64()),
                "filter": pa.array([x[2].tobytes() for x in levels], pa.binary()),
            }
        )

    return materialise(rows.groupBy("shard").applyInArrow(one, CASCADE), "cascade"), shards


class Cascade:
    """Levels of some shards, laid behind each other for vector look-ups."""

    def __init__(self, rows: list) -> None:
        depth = max((r["level"] for r in rows), default=-1) + 1
        shards = sorted({r["shard"] for r in rows})
        self.index = {s: i for i, s in enumerate(shards)}
        self.bits = np.zeros((len(shards) + 1, depth), np.int64)  # 0: no such level; the last row is a shard without levels
        self.hashes, self.begin = np.zeros_like(self.bits), np.zeros_like(self.bits)
        parts, at = [], 0
        for r in rows:
            i = self.index[r["shard"]], r["level"]
            self.bits[i], self.hashes[i], self.begin[i] = r["bits"], r["hashes"], at
            parts.append(np.frombuffer(r["filter"], np.uint8))
            at += len(parts[-1]) * 8
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def holds(self, shard: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        own = np.array([self.index.get(s, -1) for s in shard.tolist()], np.int64)
        answer, alive = np.zeros(len(shard), bool), np.ones(len(shard), bool)
        for level in range(self.bits.shape[1]):
            alive &= self.bits[own, level] > 0
            passes = alive.copy()
            for i in range(int(self.hashes[:, level].max(initial=0))):
                test = np.flatnonzero(passes & (self.hashes[own, level] > i))
                at = self.begin[own[test], level] + _places(h1[test], h2[test], level, i, self.bits[own[test], level]).astype(np.int64)
                passes[test] = (self.flat[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            answer = np.where(passes, level % 2 == 0, answer)  # a key has the kind of the last level that holds it
            alive = passes
        return answer


def judge(rows: DataFrame, key: str, cascade: DataFrame, shards: int, out: str = "listed", most: int = BROADCAST_BYTES) -> DataFrame:
    """`rows` with a boolean `out`: whether `key` is listed. No join: the filters travel to the rows.

    Filters are packed into passes of at most `most` bytes (a shard is far smaller); a pass judges the
    rows of its shards, so each row is judged once. One pass is the usual case. A null key is not listed.
    """
    sizes = cascade.groupBy("shard").agg(F.sum(F.length("filter")).alias("size")).orderBy("shard").collect()  # a row per SHARD_KEYS keys
    passes: list[list[int]] = [[]]
    left = most
    for s in sizes:
        if s["size"] > left and passes[-1]:
            passes.append([])
            left = most
        passes[-1].append(s["shard"])
        left -= s["size"]
    shard = F.coalesce(F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)).cast("int"), F.lit(-1))
    edges = [-1, *[p[0] for p in passes[1:]], shards]
    spark, done = rows.sparkSession, []
    for low, high in zip(edges, edges[1:]):
        rows_of_pass = cascade.where(F.col("shard").between(max(low, 0), high - 1)).collect()
        sent = spark.sparkContext.broadcast([r.asDict() for r in rows_of_pass])

        @F.arrow_udf("boolean")
        def listed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            filters = Cascade(sent.value)
            for s, a, b in batches:
                yield pa.array(filters.holds(s.to_numpy(), a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64)))

        part = rows if len(passes) == 1 else rows.where(shard.between(low, high - 1))
        judged = part.withColumn(out, listed(shard, *key_hashes(F.col(key))) & F.col(key).isNotNull())
        done.append(judged if len(passes) == 1 else materialise(judged, "judged"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole


def filter_urls(pages: DataFrame, listed: DataFrame, url: str = "url", page_id: str = "page_id", rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, listed, verdict.

    `listed` holds blocked hosts (key). The longest fitting rule decides; else a page is blocked if its
    host is listed, by a cascade built over all hosts of these very pages, so the answer is exact. A null
    url, or one without `://`, has an empty host and path. Repeated rows and null ids are judged like any
    others; only the two named columns are read. No pages give no rows.
    """
    host, path = host_path(pages[url])
    parsed = pages.select(pages[page_id].alias("page_id"), host.alias("host"), path.alias("path"))
    cascade, shards = build(parsed.select(F.col("host").alias("key")), listed)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judge(parsed, "host", cascade, shards).withColumn("rule", name)
    return judged.withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(host_path(pages["url"])[0].alias("key")).distinct()
    found = filter_urls(pages, hosts.where(F.col("key").rlike(SPAM)))
    return found.select("page_id", "host", "path", "rule", "verdict", "listed")


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN coalesce(instr(url, '://'), 0) > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) AS t(verdict, rule_host, rule_path)
), j AS (
  SELECT page_id, host, path, regexp_matches(host, '(^|[.-])(casino|bets|pills|spam|adult|ads)([.-]|$)') AS listed,
         (SELECT max_by(struct_pack(rule := rule_host || rule_path, verdict := r.verdict), length(rule_host || rule_path)) FROM r
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
  FROM p
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM j
"""
