"""Conversation structure repair: Hirschberg's divide and conquer over four-state cost vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import table
from .graph import per_group

ROWS = 4096  # rows of a segment
FAN = 10  # a node of the next level holds 2 ** FAN of this one
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired turns end with so far
STATES = 4
NEXT = (USER, USER, ASSISTANT, USER)  # state after an inserted or reroled turn
NAME = {USER: "user", ASSISTANT: "assistant"}
CLOSING = {EMPTY: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # turns to insert at the end
NEVER = 1 << 60
BLANK = r"^[\x20\x09-\x0D]*$"
TRIM = " \t\n\x0b\x0c\r"
SEGMENTS = "k string, part int, idx int, roles array<string>, texts array<string>, codes binary"
NODES = "k string, seq long, cost array<long>, rank array<long>, first int, last int, illegal long, blank long, duplicate long, truncated long"


@dataclass(frozen=True)
class Step:
    """Cheapest edits of some rows from each state to each state; rank orders the edits' initials of all 16."""

    cost: tuple[int, ...]
    rank: tuple[int, ...]


def ranked(keys: Sequence[tuple]) -> tuple[int, ...]:
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    return tuple(order[k] for k in keys)


def moves(code: int) -> list[tuple[int, str]]:
    """(cost, initials) of the cheapest edits of one row for each pair of states: some inserts, then its own edit.

    A code is 4 * fault + initial: the initial is s, u, a or another (0 to 3), a row with fault 1 is
    truncated, one with fault 2 or 3 is blank or a duplicate. Initials of different edits of the same
    rows are never the beginning of one another, as they end with a row's own edit; so their order stays
    the same whatever follows.
    """
    fault, initial = divmod(code, 4)
    best = [(NEVER, "")] * (STATES * STATES)
    for s in range(STATES):
        at, inserts = s, 0
        while inserts < 4:
            edits = [(at, DELETE, "D")]
            if fault < 2:
                extra = TRUNCATED if fault else 0
                edits.append((NEXT[at], REROLE + extra, "R"))
                kept = {0: SYSTEM if at == EMPTY else None, 1: USER if at != USER else None, 2: ASSISTANT if at == USER else None}.get(initial)
                if kept is not None:
                    edits.append((kept, KEEP + extra, "K"))
            for t, cost, letter in edits:
                best[s * STATES + t] = min(best[s * STATES + t], (cost + inserts * INSERT, "I" * inserts + letter))
            at, inserts = NEXT[at], inserts + 1
    return best


@lru_cache(None)
def row_step(code: int) -> Step:
    m = moves(code)
    return Step(tuple(c for c, _ in m), ranked([(x,) for _, x in m]))


def joined(a: Step, b: Step) -> Step:
    """Both steps one behind the other; of equal costs the least initials."""
    best = []
    for s in range(STATES):
        for t in range(STATES):
            best.append(min((min(NEVER, a.cost[s * STATES + u] + b.cost[u * STATES + t]), a.rank[s * STATES + u], b.rank[u * STATES + t]) for u in range(STATES)))
    return Step(tuple(x[0] for x in best), ranked([x[1:] for x in best]))


def forward(steps: Sequence[Step], state: int) -> list[tuple[int, int]]:
    """Cost vector, with ranks, of the states after the steps."""
    at = [(0 if s == state else NEVER, 0) for s in range(STATES)]
    for step in steps:
        best = [min((min(NEVER, at[s][0] + step.cost[s * STATES + t]), at[s][1], step.rank[s * STATES + t]) for s in range(STATES)) for t in range(STATES)]
        at = list(zip([x[0] for x in best], ranked([x[1:] for x in best])))
    return at


def backward(steps: Sequence[Step], state: int) -> list[tuple[int, int]]:
    """Cost vector, with ranks, of the states before the steps."""
    at = [(0 if s == state else NEVER, 0) for s in range(STATES)]
    for step in reversed(steps):
        best = [min((min(NEVER, at[t][0] + step.cost[s * STATES + t]), step.rank[s * STATES + t], at[t][1]) for t in range(STATES)) for s in range(STATES)]
        at = list(zip([x[0] for x in best], ranked([x[1:] for x in best])))
    return at


def crossings(steps: Sequence[Step], begin: int, end: int) -> list[int]:
    """States after each step on the cheapest way from `begin` to `end` with the least initials.

    Forward and backward vectors meet in the middle; the crossing with the least cost, of equal ones that
    with the least initials, splits the work in two. Only two vectors are held at a time.
    """
    if len(steps) <= 1:
        return [end] * len(steps)
    mid = len(steps) // 2
    f, b = forward(steps[:mid], begin), backward(steps[mid:], end)
    at = min(range(STATES), key=lambda s: (f[s][0] + b[s][0], f[s][1], b[s][1]))
    return crossings(steps[:mid], begin, at) + crossings(steps[mid:], at, end)


def closing(whole: Step) -> int:
    """State in which the rows of a conversation end best, before the inserts that close it."""
    return min(range(STATES), key=lambda s: (whole.cost[s] + CLOSING[s] * INSERT, whole.rank[s], CLOSING[s]))


@lru_cache(1 << 14)
def composed(codes: bytes) -> Step:
    """All rows of a segment as one step."""
    steps = [row_step(c) for c in codes]
    while len(steps) > 1:
        steps = [joined(*steps[i : i + 2]) if i + 1 < len(steps) else steps[i] for i in range(0, len(steps), 2)]
    return steps[0]


@lru_cache(1 << 14)
def edits(codes: bytes, begin: int, end: int) -> tuple[str, ...]:
    """Initials of the edits of every row of a segment."""
    states = [begin, *crossings([row_step(c) for c in codes], begin, end)]
    return tuple(moves(c)[a * STATES + b][1] for c, a, b in zip(codes, states, states[1:]))


def repaired(initials: Sequence[str], roles: Sequence[str], texts: Sequence[str], begin: int) -> list[str]:
    """`role:text` of the turns that the edits leave or make; the last initials may be inserts only."""
    out, at = [], begin
    for i, own in enumerate(initials):
        for letter in own:
            if letter == "D":
                continue
            if letter == "I":
                at = NEXT[at]
                out.append(f"{NAME[at]}:")
            elif letter == "R":
                at = NEXT[at]
                out.append(f"{NAME[at]}:{texts[i]}")
            else:
                out.append(f"{roles[i]}:{texts[i]}")
                at = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[roles[i][0]]
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """Rows (k, turn, role, text) with faults put in by crc32 of `conv_id:turn`; nulls are one space, k names the conversation."""
    plain = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = turns.select(key_of(turns["conv_id"]).alias("k"), turns["turn"].alias("turn"), plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("k", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("one")).drop("one")


def key_of(conv_id: Column) -> Column:
    """Name of a conversation that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def faults(role: Column, text: Column) -> Column:
    """Code of a row as `moves` reads it, before duplicates are known."""
    initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring(role, 1, 1)), F.lit(0)), F.lit(4)) - 1
    last = F.substring(F.rtrim(text, F.lit(TRIM)), -1, 1)
    initial = F.when(F.length(role) == 0, 3).otherwise(initial)
    return (F.when(text.rlike(BLANK), 2).when(last.isin(".", "!", "?"), 0).otherwise(1) * 4 + initial).cast("tinyint")


def segments(rows: DataFrame) -> DataFrame:
    """Runs of at most ROWS rows of a conversation, in its order: SEGMENTS, with `seq`, their number in the order of all.

    Rows are dealt by sampled ranges of conversation, turn, role, text and a random number, so that no
    conversation, and no repeated row, has to fit one task.
    """
    coded = rows.withColumn("code", faults(F.col("role"), F.col("text"))).withColumn("salt", F.rand(11))
    order = ["k", F.col("turn").asc_nulls_first(), "role", "text", "salt"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, idx = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("k")
            new = np.flatnonzero(pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)) + 1
            begin = np.union1d(np.concatenate(([0], new)), np.arange(0, batch.num_rows, ROWS))
            offsets = pa.array(np.append(begin, batch.num_rows).astype(np.int32))
            codes = batch.column("code").to_numpy().astype(np.uint8)
            yield pa.record_batch(
                {
                    "k": k.take(pa.array(begin)), "part": np.full(len(begin), part, np.int32), "idx": np.arange(idx, idx + len(begin), dtype=np.int32),
                    "roles": pa.ListArray.from_arrays(offsets, batch.column("role")), "texts": pa.ListArray.from_arrays(offsets, batch.column("text")),
                    "codes": pa.array([codes[a:b].tobytes() for a, b in zip(begin, [*begin[1:], batch.num_rows])], pa.binary()),
                }
            )
            idx += len(begin)

    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "role", "text", "code")
    cuts = materialise(dealt.mapInArrow(cut, SEGMENTS), "segments")
    parts = cuts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(F.col("part").alias("of_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row per range
    return cuts.join(F.broadcast(parts), cuts["part"] == parts["of_part"]).withColumn("seq", F.col("before") + F.col("idx")).drop("of_part", "before")


def duplicates(cuts: DataFrame) -> DataFrame:
    """(k, seq, again): places in a segment of rows that are not blank and whose role and text came earlier."""
    each = F.posexplode(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text")))
    rows = cuts.select("k", "seq", each.alias("at", "row")).select("k", "seq", "at", F.md5(F.concat_ws(":", F.length("row.role"), "row.role", "row.text")).alias("h"), F.col("row.text").rlike(BLANK).alias("blank"))
    rows = materialise(rows.where(~F.col("blank")).select("k", "seq", "at", F.unhex("h").alias("h")), "turn-hashes")
    first = rows.groupBy("k", "h").agg(F.min(F.struct("seq", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("k").alias("k_f"), F.col("h").alias("h_f"), "first")
    met = rows.join(first, (rows["k"] == first["k_f"]) & (rows["h"] == first["h_f"])).where(F.struct("seq", "at") > F.col("first"))
    return materialise(met.select("k", "seq", "at"), "repeated").groupBy("k", "seq").agg(F.collect_list("at").alias("again"))


def illegal(a: int, b: int) -> bool:
    """Whether the initials of two adjacent rows (0 to 3 for s, u, a and others) break the order."""
    return (a, b) not in ((0, 1), (1, 2), (2, 1))


def leaves(cuts: DataFrame) -> DataFrame:
    """A node (NODES) for every segment of (k, seq, codes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, seq, codes in zip(*(batch.column(c).to_pylist() for c in ("k", "seq", "codes"))):
                step, kinds, fault = composed(codes), [c % 4 for c in codes], [c // 4 for c in codes]
                wrong = sum(map(illegal, kinds, kinds[1:]))
                out.append((k, seq, step.cost, step.rank, kinds[0], kinds[-1], wrong, fault.count(2), fault.count(3), fault.count(1)))
            yield node_batch(out)

    return cuts.select("k", "seq", "codes").mapInArrow(run, NODES)


def node_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.int32()] * 2, *[pa.int64()] * 4]
    names = [f.split()[0] for f in NODES.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array([list(v) if isinstance(v, tuple) else v for v in c], t) for c, t in zip(columns, types)], names=names)


def united(group: pa.RecordBatch) -> pa.RecordBatch:
    """The node over the nodes of one group, which are in order."""
    rows = group.to_pylist()
    step = Step(tuple(rows[0]["cost"]), tuple(rows[0]["rank"]))
    for r in rows[1:]:
        step = joined(step, Step(tuple(r["cost"]), tuple(r["rank"])))
    wrong = sum(r["illegal"] for r in rows) + sum(illegal(a["last"], b["first"]) for a, b in zip(rows, rows[1:]))
    sums = [sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")]
    return node_batch([(rows[0]["k"], rows[0]["seq"] >> FAN, step.cost, step.rank, rows[0]["first"], rows[-1]["last"], wrong, *sums)])


def plans(levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """(k, seq, begin, end) of every segment: states in which its rows begin and end, found from the roots down."""

    def down(group: pa.RecordBatch) -> pa.RecordBatch:
        rows = group.to_pylist()
        states = [rows[0]["begin"], *crossings([Step(tuple(r["cost"]), tuple(r["rank"])) for r in rows], rows[0]["begin"], rows[0]["end"])]
        return pa.record_batch({"k": [r["k"] for r in rows], "seq": [r["seq"] for r in rows], "begin": pa.array(states[:-1], pa.int32()), "end": pa.array(states[1:], pa.int32())})

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [closing(Step(tuple(r["cost"]), tuple(r["rank"]))) for r in b.to_pylist()]
            yield pa.record_batch({"k": b.column("k"), "level": b.column("level"), "seq": b.column("seq"), "begin": pa.array([EMPTY] * len(ends), pa.int32()), "end": pa.array(ends, pa.int32())})

    top = materialise(roots.select("k", "level", "seq", "cost", "rank").mapInArrow(close, "k string, level int, seq long, begin int, end int"), "roots")
    plan = top.where(F.col("level") == len(levels) - 1).drop("level")
    for level in range(len(levels) - 2, -1, -1):
        over = plan.select(F.col("k").alias("k_p"), F.col("seq").alias("parent"), "begin", "end")
        nodes = levels[level].select("k", "seq", "cost", "rank")
        met = nodes.join(over, (nodes["k"] == over["k_p"]) & (F.shiftright(nodes["seq"], FAN) == over["parent"]))
        sorted_ = met.repartition("k", "parent").sortWithinPartitions("k", "parent", "seq")
        below = sorted_.mapInArrow(per_group(down, ["k", "parent"], 1), "k string, seq long, begin int, end int")
        plan = materialise(below.union(top.where(F.col("level") == level).drop("level")), "plan")
    return plan


def outcomes(cuts: DataFrame, plan: DataFrame) -> DataFrame:
    """(k, audit, repaired_sha256) per conversation.

    Segments and their plans meet in order; text by text the digest goes on, as SHA-256 can only be told
    in one pass. A task holds one segment of texts at a time, and the initials of one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, audit, lines, plan_row, out = None, hashlib.sha256(), [], 0, None, []

        def add(more: list[str]) -> None:
            nonlocal lines
            for line in more:
                digest.update((b"\n" if lines else b"") + line.encode())
                lines += 1

        def finish(k: str, end: int) -> tuple[str, str, str]:
            audit.append("I" * CLOSING[end])
            add(repaired([audit[-1]], [], [], end))
            return k, "".join(audit), digest.hexdigest()

        for batch in batches:
            for r in batch.to_pylist():
                if r["k"] != now:
                    if now is not None:
                        out.append(finish(now, plan_row["end"]))
                    now, digest, audit, lines = r["k"], hashlib.sha256(), [], 0
                if r["codes"] is None:
                    plan_row = r
                    continue
                codes = bytearray(r["codes"])
                for i in plan_row["again"] or ():
                    codes[i] = 12 + codes[i] % 4
                own = edits(bytes(codes), plan_row["begin"], plan_row["end"])
                audit.append("".join(own))
                add(repaired(own, r["roles"], r["texts"], plan_row["begin"]))
            if out:
                yield pa.record_batch(list(map(pa.array, zip(*out))), names=["k", "audit", "repaired_sha256"])
                out = []
        if now is not None:
            yield pa.record_batch(list(map(pa.array, zip(finish(now, plan_row["end"])))), names=["k", "audit", "repaired_sha256"])

    null = lambda t: F.lit(None).cast(t)
    texts = cuts.select("k", "seq", F.lit(1).alias("kind"), "roles", "texts", "codes", null("int").alias("begin"), null("int").alias("end"), null("array<int>").alias("again"))
    told = plan.select("k", "seq", F.lit(0).alias("kind"), null("array<string>").alias("roles"), null("array<string>").alias("texts"), null("binary").alias("codes"), "begin", "end", "again")
    both = texts.union(told).repartition("k").sortWithinPartitions("k", "seq", "kind")
    return both.mapInArrow(run, "k string, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (k, turn, role, text): k, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn (nulls first), then role and text; rows equal in all are duplicates of one another.
    A conversation is cut into segments of at most ROWS rows. Each becomes a step of 4 x 4 costs, with the
    order of the edits' initials instead of their texts; steps are joined level by level, 2 ** FAN at a
    time, until every conversation is one node. Then the crossings are found from the top down, by forward
    and backward vectors that meet in the middle, to the single row. So a task holds one segment, or one
    node's children, however long a conversation is; only its digest is told text by text in one task.
    No rows give no rows.
    """
    cuts = segments(rows)
    again = materialise(duplicates(cuts), "again").select(F.col("k").alias("k_a"), F.col("seq").alias("seq_a"), "again")
    slim = cuts.select("k", "seq", "codes")
    met = materialise(slim.join(again, (slim["k"] == again["k_a"]) & (slim["seq"] == again["seq_a"]), "left").select("k", "seq", "codes", "again"), "codes")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [bytearray(c) for c in b.column("codes").to_pylist()]
            for c, places in zip(codes, b.column("again").to_pylist()):
                for i in places or ():
                    c[i] = 12 + c[i] % 4
            yield pa.record_batch({"k": b.column("k"), "seq": b.column("seq"), "codes": pa.array(list(map(bytes, codes)), pa.binary())})

    levels = [materialise(leaves(met.mapInArrow(mark, "k string, seq long, codes binary")), "nodes")]
    roots = None
    while True:
        counts = levels[-1].groupBy(F.col("k").alias("k_n")).agg(F.count(F.lit(1)).alias("n"))
        told = materialise(levels[-1].join(counts, levels[-1]["k"] == counts["k_n"]).drop("k_n"), "levels")
        own = told.where("n = 1").drop("n").withColumn("level", F.lit(len(levels) - 1))
        roots = own if roots is None else roots.union(own)
        levels[-1] = told.where("n > 1").drop("n")
        if levels[-1].isEmpty():
            break
        parent = levels[-1].withColumn("parent", F.shiftright("seq", FAN)).repartition("k", "parent").sortWithinPartitions("k", "parent", "seq")
        levels.append(materialise(parent.mapInArrow(per_group(united, ["k", "parent"], 1), NODES), "nodes"))
    plan = plans(levels, roots)
    told = met.select(F.col("k").alias("k_c"), F.col("seq").alias("seq_c"), "again")
    plan = plan.join(told, (plan["k"] == told["k_c"]) & (plan["seq"] == told["seq_c"])).select("k", "seq", "begin", "end", "again")
    found = outcomes(cuts, materialise(plan, "plan"))
    least = F.array_min(F.transform(F.slice("cost", 1, STATES), lambda c, s: c + F.element_at(F.lit([CLOSING[i] * INSERT for i in range(STATES)]), s + 1)))
    sums = roots.select(F.col("k").alias("k_r"), "blank", "duplicate", "truncated", "illegal", least.alias("cost"))
    return found.join(sums, found["k"] == sums["k_r"]).drop("k_r")


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Damage conversations and repair them: a row per conv_id of the table, null included.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. gaps counts the
    turn numbers that are missing between the least and greatest. A conversation of which no row is left
    has zeros, an empty audit and the digest of an empty text. Only conv_id, turn, role and text are read.
    """
    rows = damaged(turns)
    done = materialise(repair(rows), "repaired")
    numbers = rows.where("turn is not null").groupBy("k", "turn").agg(F.lit(1).alias("one"))
    missing = numbers.groupBy(F.col("k").alias("k_g")).agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    named = turns.select(turns["conv_id"].alias("conv_id")).distinct().withColumn("name", key_of(F.col("conv_id")))
    met = named.join(done, named["name"] == done["k"], "left")
    met = met.join(missing, met["name"] == missing["k_g"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_CRC = f"""xor(list_reduce(flatten(list_transform(string_split({_KEY}, ''), lambda c: list_transform(range(8), lambda i: (ascii(c)::BIGINT >> i) & 1))),
  lambda crc, b: xor(crc >> 1, (xor(crc, b) & 1) * 3988292384), 4294967295::BIGINT), 4294967295::BIGINT)"""
_WAY = "{{'c': {c}, 'a': {a}, 'o': {o}}}"


def _least(*ways: tuple[str, str, str, str]) -> str:
    """The cheapest of some ways, of equal ones the one with the least initials: (state they come from, cost, initial, turn)."""
    own = [_WAY.format(c=f"{s}.c + {c}", a=f"{s}.a || '{a}'" if a else f"{s}.a", o=f"list_append({s}.o, {o})" if o else f"{s}.o") for s, c, a, o in ways]
    return f"list_min([{', '.join(own)}])"


_INSERTED = {
    "v0": "v.v0", "v1": "v.v1",
    "v2": _least(("v.v2", "0", "", ""), *[(f"v.{s}", "3", "I", "'user:'") for s in ("v0", "v1", "v3")]),
    "v3": _least(("v.v3", "0", "", ""), ("v.v2", "3", "I", "'assistant:'")),
}
_TWICE = _least(("w.v3", "0", "", ""), ("w.v2", "3", "I", "'assistant:'"))
_ROW = "r.role || ':' || r.text"
_KEEP = "(CASE WHEN r.fault IN ('blank', 'duplicate') OR left(r.role, 1) <> '{0}' THEN 1000000000 WHEN r.fault = 'truncated' THEN 3 ELSE 0 END)"
_ROLE = "(CASE WHEN r.fault IN ('blank', 'duplicate') THEN 1000000000 WHEN r.fault = 'truncated' THEN 6 ELSE 3 END)"
_EDITED = {
    "v0": _least(("w.v0", "4", "D", "")),
    "v1": _least(("w.v1", "4", "D", ""), ("w.v0", _KEEP.format("s"), "K", _ROW)),
    "v2": _least(("w.v2", "4", "D", ""), *[(f"w.{s}", c, a, o) for s in ("v0", "v1", "v3") for c, a, o in ((_KEEP.format("u"), "K", _ROW), (_ROLE, "R", "'user:' || r.text"))]),
    "v3": _least(("w.v3", "4", "D", ""), ("w.v2", _KEEP.format("a"), "K", _ROW), ("w.v2", _ROLE, "R", "'assistant:' || r.text")),
}


def _vector(parts: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{k}': {v}" for k, v in parts.items()) + "}"


_START = _vector({f"v{i}": _WAY.format(c=f"{0 if i == 0 else 1000000000}::BIGINT", a="''", o="[]::VARCHAR[]") for i in range(4)})
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, range(CASE kind WHEN 3 THEN 2 ELSE 1 END) t(i) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS shown
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM numbered
), told AS (
  SELECT conv_id, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, {_START} AS v FROM told
  UNION ALL
  SELECT conv_id, i, {_vector(_EDITED)} AS v
  FROM (SELECT conv_id, i, r, {_vector({"v0": "w.v0", "v1": "w.v1", "v2": "w.v2", "v3": _TWICE})} AS w
        FROM (SELECT ways.conv_id, r.i, r, {_vector(_INSERTED)} AS w FROM ways JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM ways.conv_id AND r.i = ways.i + 1))
), ended AS (
  SELECT conv_id, {_least(("v.v0", "0", "", ""), ("w.v3", "0", "", ""), ("w.v2", "3", "I", "'assistant:'"))} AS best
  FROM (SELECT conv_id, v, {_vector(_INSERTED)} AS w FROM ways QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id
"""
