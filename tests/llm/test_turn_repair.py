"""Conversation repair against plain Python that carries whole edit sequences."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidecast.llm import turn_repair as tr

from . import edge

LEGAL = re.compile("(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Least (cost, initials) over all edits, by rows; keeps a whole sequence per legal role string's end."""
    ends = {"": (0, "", ())}  # last initial so far, '' at the start

    def better(to, end, way):
        if end not in to or way[:2] < to[end][:2]:
            to[end] = way

    def inserted(at):
        out = dict(at)
        for _ in range(3):
            for end, (cost, audit, turns) in list(out.items()):
                role = "assistant" if end == "u" else "user"
                better(out, role[0], (cost + 3, audit + "I", (*turns, f"{role}:")))
        return out

    for (role, text), fault in zip(rows, brute_faults(rows)):
        now = {}
        for end, (cost, audit, turns) in inserted(ends).items():
            better(now, end, (cost + 4, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                for new, price, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if new and end + new[0] in ("s", "u", "su", "ua", "au"):
                        better(now, new[0], (cost + price + 3 * (fault == "truncated"), audit + letter, (*turns, f"{new}:{text}")))
        ends = now
    return min(w for e, w in inserted(ends).items() if e in ("", "a"))


def brute(rows):
    whole = defaultdict(list)
    for r in brute_damage(rows):
        whole[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(whole[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        plain = [r[2:] for r in own]
        n = Counter(brute_faults(plain))
        wrong = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        cost, audit, text = brute_repair(plain)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], wrong, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def test_every_short_conversation():
    """All sequences of three rows: the costs and initials of an enumeration of edits, and those of the states."""
    rows = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("x.", "y", "")]
    edits = [(i, e) for i in range(2) for e in "DKua"]
    for three in itertools.product(rows, repeat=3):
        faults = brute_faults(three)
        codes = bytes({"": 0, "truncated": 1, "blank": 2, "duplicate": 3}[f] * 4 + "suat".index(r[0]) for (r, _), f in zip(three, faults))
        step = tr.composed(codes)
        end = tr.closing(step)
        got = (step.cost[end] + 3 * tr.CLOSING[end], "".join(tr.edits(codes, 0, end)) + "I" * tr.CLOSING[end])
        assert brute_repair(three)[:2] == got, three
        if random.Random(str(three)).random() > 0.02:  # the enumeration is slow
            continue
        best = (99, "")
        for way in itertools.product(edits, repeat=3):
            for last in range(3):
                cost, audit, roles = 3 * last, "", ""
                for (n, e), (role, _), fault in zip(way, three, faults):
                    cost, audit = cost + 3 * n, audit + "I" * n
                    for _ in range(n):
                        roles += "a" if roles[-1:] == "u" else "u"
                    if e != "D" and fault in ("blank", "duplicate"):
                        cost = 99
                    cost += {"D": 4, "K": 0}.get(e, 3) + 3 * (e != "D" and fault == "truncated")
                    audit += e if e in "DK" else "R"
                    roles += {"D": "", "K": role[0]}.get(e, e)
                for _ in range(last):
                    roles += "a" if roles[-1:] == "u" else "u"
                if LEGAL.fullmatch(roles):
                    best = min(best, (cost, audit + "I" * last))
        assert got == best, three


@pytest.mark.parametrize("rows_of_segment, fan", [(4096, 10), (2, 1), (1, 1)])
def test_repair(spark, monkeypatch, rows_of_segment, fan):
    monkeypatch.setattr(tr, "ROWS", rows_of_segment)
    monkeypatch.setattr(tr, "FAN", fan)
    r = random.Random(7)
    roles, texts = ["user", "assistant", "system", "user", "assistant", None, "", "Tool"], ["Yes.", "No", "Why?\n", "", " \t", "é!", None, "ok", "x. y", "line\nend."]
    rows = [(c, t, r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"{t} of {c}.") for c in range(25) for t in range(r.randrange(1, 9))]
    rows += [(50, t, r.choice(roles[:2]), f"long {t % 70}" + r.choice([".", ""])) for t in range(300)]  # a conversation with half of all rows
    rows += [(60, None, "user", "late?"), (60, None, "assistant", "tie."), (60, 0, "user", None), (None, 0, "user", "nobody."), (None, None, None, None)]
    rows += [rows[0], rows[1], *[(70, 5, "user", "again.")] * 9] + [(80, 3, "user", "gone.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "dropped.")]
    df = spark.createDataFrame([(*x, "k") for x in rows], "conv_id int, turn int, role string, text string, k string").repartition(5)
    got = {x["conv_id"]: tuple(x)[1:] for x in tr.repaired_conversations(df).collect()}
    want = brute(rows)
    assert got == want
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[50][5] > 100 and any("I" in w[6] for w in want.values())


def test_very_long_texts(spark):
    long = edge.words(400_000, 3)
    rows = [(1, 1, "user", long + "."), (1, 2, "user", long), (1, 3, "assistant", long + ".")]
    got = tr.repaired_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert tuple(got[0])[1:] == brute(rows)[1]
