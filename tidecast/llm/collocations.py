"""Phrase collocations by dynamic itemset counting: lengths are interleaved in cyclic scans of shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import fresh_path, materialise

from .common import Words, mix, pieces, table, text_bytes, word_hashes, words_of

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
SHARDS = 6  # scans of a cycle
COVERED = 80  # percent of a phrase's occurrences that a longer one must have to replace it
TOP = 2000  # phrases of a language in the report
SLICE = 4 << 20  # text that one counting step works on
PROBES = 4  # bits of a phrase in a filter
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29  # of a filter: 128 KB to 64 MB
COUNTS = "lang string, phrase string, h long, len int, since int, c long"
SPLIT = np.zeros(256, bool)
SPLIT[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
SPLIT |= BREAK


def holds(slots: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes a filter (bits in longs, a power of two) may hold; never misses one that it holds."""
    found = np.zeros(len(h), bool)
    rest = np.arange(len(h))
    for i in range(PROBES):
        own = h[rest]
        at = ((own & np.uint64(0xFFFFFFFF)) + np.uint64(i) * ((own >> np.uint64(32)) | np.uint64(1))) & np.uint64(len(slots) * 64 - 1)
        bit = (slots[(at >> np.uint64(6)).view(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        rest = rest[bit.astype(bool)]
    found[rest] = True
    return found


def filled(filters: tuple[np.ndarray, ...], known: DataFrame) -> list[np.ndarray]:
    """The filters with the phrases of `known` (h: long, filter: its number) added; bits are united on the executors."""
    bits = len(filters[0]) * 64
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1).cast("long"))
    at = F.explode(F.array(*[(low + high * i).bitwiseAND(F.lit(bits - 1).cast("long")) for i in range(PROBES)]))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    rows = known.select("filter", at.alias("at")).groupBy("filter", F.shiftright("at", 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    number, slot, new = (rows[c].to_numpy() for c in ("filter", "slot", "bits"))
    out = [f.copy() for f in filters]
    for i, f in enumerate(out):
        f[slot[number == i]] |= new[number == i].view(np.uint64)
    return out


def _joined(names: pa.Array, at: np.ndarray, words: np.ndarray, k: int) -> pa.Array:
    """Phrases of k words that begin at the given words."""
    parts = [names.take(pa.array(words[at + i])) for i in range(k)]
    return parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", parts[0].type))


def _vocabulary(w: Words) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of each word among the distinct ones, the distinct words and their hashes."""
    offsets = np.concatenate(([0], np.cumsum(w.end - w.start)))
    words = pa.Array.from_buffers(pa.large_string(), len(w.start), [None, pa.py_buffer(offsets), pa.py_buffer(w.data[~SPLIT[w.data]])])
    coded = words.dictionary_encode()
    data, at = text_bytes(coded.dictionary)
    return coded.indices.to_numpy(), coded.dictionary, word_hashes(Words(data, at[:-1], at[1:], np.array([0, len(at) - 1])))


def _distinct(key: np.ndarray, values: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct key, the number of each key among them, and their counts; keys are below `values`."""
    if values > 4 * len(key):
        _, first, dense, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return first, dense, count
    count = np.bincount(key, minlength=values)
    own = np.flatnonzero(count)
    number = np.zeros(values, np.int64)
    number[own] = np.arange(len(own))
    dense = number[key]
    first = np.zeros(len(own), np.int64)
    first[dense[::-1]] = np.arange(len(key))[::-1]
    return first, dense, count[own]


def count_slice(lang: pa.Array, text: pa.Array, step: int, suspect: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Occurrences of what is active in one slice of a shard.

    The filter under t holds the phrases known as suspects before step t. Words are active
    in the first cycle, a longer phrase in the cycle that begins with the first step whose filter holds
    both its ends: it is counted by hash alone, to see whether it is frequent in a shard. Once it
    is active and a suspect, it is counted under its name for the cycle that begins then.
    """
    w = words_of(text, SPLIT)
    n = len(w.start)
    if not n:
        return
    row = w.row
    piece = np.concatenate(([0], np.cumsum(BREAK[w.data])))[w.start]
    number, names, word_h = _vocabulary(w)
    tongue = lang.dictionary_encode()
    of_word = tongue.indices.to_numpy()[row].astype(np.int64)
    tongue_h = np.array([hash_of(t) for t in tongue.dictionary.to_pylist()], np.uint64)
    near = np.zeros(n, bool)  # the next word is in the same piece
    near[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    gone = step - SHARDS
    if gone < 0:
        words = np.bincount(of_word, minlength=len(tongue_h))
        none = np.zeros(len(words), np.int64)
        yield pa.record_batch({"lang": tongue.dictionary.cast(pa.string()), "phrase": pa.nulls(len(words), pa.string()), "h": none, "len": none.astype(np.int32), "since": none.astype(np.int32), "c": words})
    tail = [mix(word_h + np.uint64(k)) for k in range(LONGEST + 1)]
    active = np.zeros(n, np.int64)  # since this step
    at = np.arange(n)  # words at which a phrase of k words begins whose ends are suspects
    key, values = of_word * len(names) + number, len(tongue_h) * len(names)
    head = tongue_h[of_word]
    for k in range(1, LONGEST + 1):
        own_h = mix(head * np.uint64(0xD6E8FEB86659FD93) + tail[k][number[at + k - 1]])
        if gone >= 0 and k > 1:  # most phrases are done and no part of a longer one
            keep = (active > gone) | holds(suspect[step], own_h)
            active, at, key, own_h = active[keep], at[keep], key[keep], own_h[keep]
            if not len(at):
                return
        first, dense, count = _distinct(key, values)
        begin, h = at[first], own_h[first]
        seen = first_step(suspect, h, step)
        detect = (seen < 0) & (active[first] > gone)
        since = np.where(seen < 0, -1, np.maximum(seen, active[first]))  # not before both ends are suspects
        since[since <= gone] = -1
        for own, named in ((np.flatnonzero(since >= 0), True), (np.flatnonzero(detect), False)):
            if len(own):
                yield pa.record_batch(
                    {
                        "lang": tongue.dictionary.take(pa.array(of_word[begin[own]])).cast(pa.string()) if named else pa.nulls(len(own), pa.string()),
                        "phrase": _joined(names, begin[own], number, k).cast(pa.string()) if named else pa.nulls(len(own), pa.string()),
                        "h": h[own].view(np.int64), "len": np.full(len(own), k, np.int32),
                        "since": since[own].astype(np.int32), "c": count[own].astype(np.int64),
                    }
                )
        if k == LONGEST:
            break
        known = seen[dense]
        known = np.where(known < 0, -1, np.maximum(known, active))  # a part counts from when its own parts do
        place = np.full(n + 1, -1, np.int64)
        place[at] = np.arange(len(at))
        ahead = place[at + 1]
        both = (ahead >= 0) & near[at + k - 1] & (known >= 0)
        both[both] &= known[ahead[both]] >= 0
        left, right = np.flatnonzero(both), ahead[both]
        if not len(left):
            return
        active = np.maximum(known[left], known[right])
        head = own_h[left]
        key, values = dense[left].astype(np.int64) * len(names) + number[at[left] + k], len(first) * len(names)
        at = at[left]


def first_step(filters: dict[int, np.ndarray], h: np.ndarray, step: int) -> np.ndarray:
    """First step whose filter holds each hash, or -1; steps before the last cycle are not told apart."""
    since = np.full(len(h), -1, np.int64)
    rest = np.flatnonzero(holds(filters[step], h))
    since[rest] = step
    for t in range(step - 1, max(-1, step - SHARDS - 1), -1):
        rest = rest[holds(filters[t], h[rest])]
        since[rest] = t
    return since


def hash_of(name: str) -> int:
    """Hash of a language's name, equal in every task."""
    out = 0xCBF29CE484222325
    for b in name.encode():
        out = (out ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return out


def counted(shard: DataFrame, step: int, sent: dict[int, Broadcast]) -> DataFrame:
    """Counts (COUNTS) of the active phrases of a shard, by slice; phrases that are no suspects have no name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspect = {t: b.value for t, b in sent.items()}
        for batch in batches:
            lang, text, at = batch.column("lang"), batch.column("text"), 0
            for piece in pieces(text, SLICE):
                yield from count_slice(lang.slice(at, len(piece)), piece, step, suspect)
                at += len(piece)

    return shard.select("lang", "text").mapInArrow(run, COUNTS)


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, len, f) of 1 to LONGEST words, and words per language (lang, n).

    The corpus is written once, dealt at random into SHARDS shards. Step t scans shard t mod SHARDS and
    counts all lengths that are active there, words from the first step on. Most active phrases are rare, and their
    names and sums would outgrow the corpus; so an active phrase is first counted by its hash within the shard. One
    with `least` occurrences has least / SHARDS in one of the shards of its cycle at least; there it becomes a
    suspect, enters the filter, and is counted by name for the full cycle from the next step on. A phrase of k + 1
    words becomes active once both its parts of k words are suspects; it does not wait until they are counted, so each
    length adds one cycle, not two. The scans end when nothing is active. Parts occur at least as often
    as the whole, so every phrase with `least` occurrences is counted, over all shards. A filter answers
    yes too often at times, so that some rare phrases are counted in vain; it changes no result. Its size
    follows the size of the texts and ends at 64 MB; a corpus that fills it counts more phrases in vain.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].alias("text"), (F.rand(7) * SHARDS).cast("int").alias("shard"))
    path = fresh_path(spark, "shards")
    plain.where("length(text) > 0").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    shards = spark.read.schema("lang string, text string, shard int").parquet(path)
    size = shards.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_BITS, min(MOST_BITS, 1 << (size // 32).bit_length()))
    filters = [np.zeros(bits // 64, np.uint64)]  # suspects before each step
    sent: dict[int, Broadcast] = {}
    tables: list[DataFrame] = []
    step = 0
    while step < SHARDS or (filters[step] != filters[step - SHARDS]).any():
        sent[step] = spark.sparkContext.broadcast(filters[step])
        rows = counted(shards.where(F.col("shard") == step % SHARDS), step, sent)
        if step:
            rows = rows.union(tables[-1].where((F.col("since") >= 0) & (F.col("since") + SHARDS > step)))
        total = rows.groupBy("lang", "phrase", "h", "len", "since").agg(F.sum("c").alias("c"))
        tables.append(materialise(total.where((F.col("since") >= 0) | (F.col("c") >= -(-least // SHARDS))), "phrases"))
        filters += filled((filters[step],), tables[-1].where("since < 0").select("h", F.lit(0).alias("filter")))
        if step >= SHARDS:  # no later scan asks for these
            sent.pop(step - SHARDS).destroy()
            filters[step - SHARDS] = np.zeros(0, np.uint64)
        step += 1
    for b in sent.values():
        b.destroy()
    done = [t.where((F.col("since") >= 0) & (F.col("since") + SHARDS - 1 == i) & (F.col("c") >= least) & (F.col("len") > 0)) for i, t in enumerate(tables)]
    whole = reduce(DataFrame.union, done).select("lang", "phrase", "len", F.col("c").alias("f"))
    words = tables[SHARDS - 1].where("len = 0").select("lang", F.col("c").alias("n"))
    return materialise(whole, "frequent"), words


def part(words: Column, first: int | Column, n: int | Column) -> Column:
    """Some words of a phrase as a phrase."""
    return F.array_join(F.slice(words, first, n), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, len, a, l, r, score) by their lowest-scoring cut, ties to the first."""
    whole = frequent.where("len > 1").select("lang", "phrase", "len", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    n = F.col("len") - F.col("k")
    cut = cut.select("lang", "phrase", "len", "a", "k", part(F.col("w"), F.lit(1), F.col("k")).alias("head"), part(F.col("w"), F.col("k") + 1, n).alias("tail"))
    left = frequent.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("head_l"), F.col("f").alias("l"))
    right = frequent.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("tail_r"), F.col("f").alias("r"))
    # A frequent word begins many phrases; a join that is written at once can be split where it is skewed.
    cut = materialise(cut.join(left, (cut["lang"] == left["lang_l"]) & (cut["head"] == left["head_l"])).drop("lang_l", "head_l", "head"), "heads")
    cut = materialise(cut.join(right, (cut["lang"] == right["lang_r"]) & (cut["tail"] == right["tail_r"])).drop("lang_r", "tail_r", "tail"), "tails")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", F.lit(2000000).cast("decimal(7,0)") * wide("a"), wide("l") + wide("r"))
    best = cut.select("*", score.alias("score")).groupBy("lang", "phrase", "len", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "len", "a", "best.l", "best.r", "best.score")


def covers(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, most): how often the most frequent longer phrase occurs that has the phrase inside."""
    longer = frequent.where("len > 2").withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(2), F.col("len") - 1)))
    inside = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("k") + 1)))
    return inside.groupBy(F.col("lang").alias("lang_c"), part(F.col("w"), F.col("at"), F.col("k")).alias("phrase_c")).agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words stand between spaces and tabs in the pieces between punctuation marks and line ends, A-Z
    lower-cased; phrases are 2 to LONGEST words of one piece with `least` occurrences, and go where a longer
    phrase has COVERED percent of these. score is floor(2000000 a / (l + r)), exact in decimals, for the cut
    that gives the least. Ranks go by score and a, downwards, then by the phrase's bytes, so they have no
    ties. A null language is `und`; null and empty texts hold no words; repeated rows count each time.
    Only the two named columns are read. A language without candidates, or no documents, gives no rows.
    """
    frequent, words = phrases(docs, text, lang, least)
    found = materialise(scored(frequent), "scored")
    over = covers(frequent)
    met = found.join(over, (found["lang"] == over["lang_c"]) & (found["phrase"] == over["phrase_c"]), "left")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    kept = met.where(F.col("most").isNull() | (wide("most") * F.lit(100).cast("decimal(3,0)") < wide("a") * F.lit(COVERED).cast("decimal(3,0)")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM w, range(1, {LONGEST + 1}) t(k)) GROUP BY ALL
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1
), c AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {LEAST}
), cuts AS (
  SELECT lang, phrase, a, i, array_to_string(ws[1:i], ' ') AS head, array_to_string(ws[i + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS i FROM c)
), s AS (
  SELECT cuts.lang, cuts.phrase, a, i, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), o AS (
  SELECT lang, array_to_string(ws[j:j + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY 1, 2
), r AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN o USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < {COVERED}::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= {TOP}
"""
