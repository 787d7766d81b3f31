"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming look-ups, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import code_points, pieces, shingle_hashes, table, word_count, word_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8  # of 8 bits each
BLOCK_RADIUS = 2  # a window within BLOCKS * (BLOCK_RADIUS + 1) - 1 bits is within this in some block
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
PASS_WORDS = 2_000_000  # benchmark words that one pass over the documents carries
STEP = 1 << 15  # windows worked on at once
MATCH = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("similarity", pa.float64()), ("distance", pa.int32())])

_BLOCK_NEAR = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.uint8(v)) <= BLOCK_RADIUS) for v in range(256)]


def window_prints(shingles: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of n shingles that begin at `start` (rising); a repeated shingle weighs more."""
    base = int(start[0])
    part = shingles[base : int(start[-1]) + n]
    bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(part) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[start - base + n] - total[start - base]
    return np.packbits(ones * 2 > n, axis=1)  # one byte for each block


class Size:
    """Items of one number of words: fingerprints, look-up tables by block, and weighted shingles."""

    def __init__(self, item: list[int], shingles: list[np.ndarray]) -> None:
        self.n = len(shingles[0])
        self.item = np.array(item)
        self.prints = np.concatenate([window_prints(s, np.array([0]), self.n) for s in shingles])
        self.weighted = [np.unique(s, return_counts=True) for s in shingles]
        self.tables = []
        for b in range(BLOCKS):
            found: list[list[int]] = [[] for _ in range(256)]
            for i, v in enumerate(self.prints[:, b].tolist()):
                for near in _BLOCK_NEAR[v].tolist():
                    found[near].append(i)
            self.tables.append((np.cumsum([0, *map(len, found)]), np.array([i for x in found for i in x], np.int64)))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within RADIUS."""
        pairs = []
        for b, (offset, ids) in enumerate(self.tables):
            low, count = offset[prints[:, b]], offset[prints[:, b].astype(int) + 1] - offset[prints[:, b]]
            window = np.repeat(np.arange(len(prints)), count)
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            pairs.append(window * len(self.item) + ids[at])
        pair = np.unique(np.concatenate(pairs))
        window, item = pair // len(self.item), pair % len(self.item)
        distance = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        near = distance <= RADIUS
        return window[near], item[near], distance[near]

    def similarity(self, shingles: np.ndarray, i: int) -> float:
        """Weighted Jaccard: shared shingles by shared count, over all by the larger count."""
        own, count = np.unique(shingles, return_counts=True)
        other, weight = self.weighted[i]
        _, a, b = np.intersect1d(own, other, assume_unique=True, return_indices=True)
        shared = int(np.minimum(count[a], weight[b]).sum())
        return shared / (len(shingles) + int(weight.sum()) - shared)


class Items:
    """All items of a pass, by number of words, and the shingles that any of them holds."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        w = words_of(pa.array([t for _, t in items], pa.string()))
        h = word_hashes(w)
        groups: dict[int, tuple[list, list]] = {}
        for i, n in enumerate(w.counts.tolist()):
            if n:
                one = type(w)(w.data, w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]], np.array([0, n]))
                ids, shingles = groups.setdefault(n, ([], []))
                ids.append(items[i][0])
                shingles.append(shingle_hashes(one, h[w.first[i] : w.first[i + 1]], SHINGLE)[0])
        self.sizes = {n: Size(*g) for n, g in sorted(groups.items())}
        holds = np.unique(np.concatenate([np.stack([s, np.full(len(s), n, np.uint64)], 1) for n, g in groups.items() if n >= SHINGLE for s in g[1]] or [np.zeros((0, 2), np.uint64)]), axis=0)
        self.seed, first = np.unique(holds[:, 0], return_index=True)
        self.seed_size, self.seed_first = holds[:, 1].astype(int), np.append(first, len(holds))
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.seed & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def seeds(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that some item holds, and which."""
        at = np.flatnonzero(self.sieve[(shingles & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if not len(at) or not len(self.seed):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.seed, shingles[at]), len(self.seed) - 1)
        good = self.seed[which] == shingles[at]
        return at[good], which[good]


def _best(size: Size, words: int, shingles: np.ndarray, starts: np.ndarray, n: int, found: dict, least: float) -> None:
    for a in range(0, len(starts), STEP):
        block = starts[a : a + STEP]
        for run in np.split(block, np.flatnonzero(np.diff(block) > 4 * n) + 1):
            for window, i, distance in zip(*(x.tolist() for x in size.candidates(window_prints(shingles, run, n)))):
                at = int(run[window])
                s = size.similarity(shingles[at : at + n], i)
                item = int(size.item[i])
                if s >= least and (item not in found or s > found[item][0]):
                    found[item] = (s, at, n, distance, words)


def find(items: Items, column: pa.Array, least: float = SIMILARITY) -> Iterator[list[dict]]:
    """Matches of each text. Only windows that hold a shingle of an item of their size are fingerprinted:
    any other has a similarity of 0 to all of them."""
    w = words_of(column)
    h = word_hashes(w)
    by_k = {k: shingle_hashes(w, h, k) for k in {SHINGLE, *(n for n in items.sizes if n < SHINGLE)}}
    shingles, first = by_k[SHINGLE]
    place, which = items.seeds(shingles)
    owner = np.searchsorted(w.first, first[place], side="right") - 1
    begin = np.searchsorted(first, w.first)  # of each text's shingles
    for row in range(len(column)):
        found: dict[int, tuple] = {}
        if w.counts[row]:
            low, high = begin[row], begin[row + 1]
            a, b = np.searchsorted(owner, [row, row + 1])
            if b > a:
                here, seeds = place[a:b], which[a:b]
                count = items.seed_first[seeds + 1] - items.seed_first[seeds]
                at = np.repeat(items.seed_first[seeds] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                size_of, hit = items.seed_size[at], np.repeat(here, count)
                for words in np.unique(size_of).tolist():
                    size = items.sizes[words]
                    n = min(size.n, high - low)  # a text of fewer words is one window
                    reach = np.zeros(high - low - n + 2, np.int64)
                    hits = hit[size_of == words] - low
                    np.add.at(reach, np.maximum(0, hits - n + 1), 1)
                    np.add.at(reach, np.minimum(hits, high - low - n) + 1, -1)
                    _best(size, words, shingles, low + np.flatnonzero(np.cumsum(reach[:-1]) > 0), n, found, least)
            for words, size in items.sizes.items():
                if words < SHINGLE and w.counts[row] >= words:
                    own, at = by_k[words]
                    mine = np.searchsorted(at, [w.first[row], w.first[row + 1]])
                    _best(size, words, own, np.arange(*mine), 1, found, least)
        out = []
        for item, (s, at, n, distance, words) in sorted(found.items()):
            word = int((by_k[words] if words < SHINGLE else by_k[SHINGLE])[1][at])
            last = min(word + n - 1 + min(words, SHINGLE), int(w.first[row + 1])) - 1
            text_begin = int(w.start[w.first[row]])
            span = code_points(w.data[text_begin : w.end[last]], np.array([w.start[word], w.end[last]]) - text_begin, 0)
            out.append({"item_id": item, "start": int(span[0]), "end": int(span[1]), "similarity": s, "distance": distance})
        yield out


def passes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", most: int = PASS_WORDS) -> list[DataFrame]:
    """The benchmark in parts of about `most` words; each is sent to all tasks of one pass."""
    items = benchmark.select(benchmark[item_id].cast("long").alias("item_id"), benchmark[text].alias("text")).where("item_id is not null and text is not null").distinct()
    words = items.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    n = max(1, -(-words // most))
    if n > 1:
        items = materialise(items, "items")
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def matches(text: Column, part: DataFrame, least: float = SIMILARITY) -> Column:
    """Array of an item's best window in a text, for every item of the part that has one (see `contaminated`)."""
    rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]  # PASS_WORDS words
    sent = part.sparkSession.sparkContext.broadcast(rows)

    @F.arrow_udf("array<struct<item_id:long,start:int,end:int,similarity:double,distance:int>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(sent.value)
        for texts in batches:
            out = [m for piece in pieces(texts) for m in find(items, piece, least)]
            yield pa.array(out, pa.list_(MATCH))

    return of(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, start, end, similarity, distance.

    A document holds an item if a window of the item's number of words (the whole text, if it has fewer)
    has a weighted five-word-shingle similarity of at least `least` to it, words A-Z lower-cased and split
    at blanks; the best window is given (the first of equals), in code points of the first word's begin and
    the last word's end. Items of fewer than five words are one shingle. An item or document without
    words, or null, matches nothing. Items that share an id compete for one row; repeated documents each
    have theirs. The benchmark travels in parts of bounded size, a pass each; documents are not shuffled.
    """
    found = None
    for part in passes(benchmark):
        rows = docs.select(docs[doc_id].alias("doc_id"), F.inline(matches(docs[text], part, least)))
        found = rows if found is None else found.union(rows)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The documents that hold no item, with their columns as they are."""
    for part in passes(benchmark):
        docs = docs.where(F.size(matches(docs[text], part, least)) == 0)
    return docs


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
