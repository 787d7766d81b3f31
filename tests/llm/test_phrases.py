"""Collocations and license passages against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidecast.llm import collocations, licenses

from . import edge
from .test_operators import LOWER


def brute_counts(rows, longest=4):
    out = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                out.update(("und" if lang is None else lang, " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    return out


def zipf(r, n):
    return " ".join(f"w{int(r.paretovariate(0.7)) % 60}" + r.choice(["", "", "", ",", ".\n", "\t"]) for _ in range(n))


@pytest.mark.parametrize("least, parts, size, bits", [(3, 1, 8 << 20, 1 << 20), (8, 7, 200, 256)])
def test_counts_are_whole(spark, monkeypatch, least, parts, size, bits):
    """Every phrase that is frequent at last is counted in all shards, whenever it becomes active.

    A filter of 256 bits answers yes to nearly everything, and the counts stay the same.
    """
    monkeypatch.setattr(collocations, "SLICE", size)
    monkeypatch.setattr(collocations, "LEAST_BITS", bits)
    monkeypatch.setattr(collocations, "MOST_BITS", bits)
    r = random.Random(least)
    rows = [(r.choice(["en", "de", None, "und", ""]), zipf(r, r.choice([0, 1, 5, 60, 400]))) for _ in range(60)]
    rows += [("en", None), (None, None), ("en", "late late late late " * 3), *rows[:5]]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "lang string, text string, phrase int").repartition(parts)
    got, words = collocations.phrases(docs, least=least)
    want = {k: n for k, n in brute_counts(rows).items() if n >= least}
    assert {(x["lang"], x["phrase"]): x["f"] for x in got.collect()} == want
    assert Counter(k.count(" ") for _, k in want).keys() == {0, 1, 2, 3}
    n = Counter()
    for (lang, phrase), c in brute_counts(rows, 1).items():
        n[lang] += c
    assert {x["lang"]: x["n"] for x in words.collect()} == dict(n)


def test_each_length_adds_one_cycle(spark, monkeypatch):
    """Longer phrases do not wait until their parts are counted; all that late crossings add is one cycle a length."""
    scans = []
    monkeypatch.setattr(collocations, "counted", lambda *a, own=collocations.counted: scans.append(a[1]) or own(*a))
    r = random.Random(5)
    rows = [("en", f"a{i % 40} b{i % 40} c{i % 40} d{i % 40} " + zipf(r, 20)) for i in range(1300)]
    got, _ = collocations.phrases(spark.createDataFrame(rows, "lang string, text string"))
    want = {k: n for k, n in brute_counts(rows).items() if n >= collocations.LEAST}
    assert {(x["lang"], x["phrase"]): x["f"] for x in got.collect()} == want
    assert len(scans) <= (collocations.LONGEST + 1) * collocations.SHARDS


def test_filter(spark):
    h = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    rows = spark.createDataFrame([(int(x), i % 2) for i, x in enumerate(h[:3000])], "h long, filter int")
    even, odd = collocations.filled([np.zeros(1 << 12, np.uint64)] * 2, rows)
    known = collocations.holds(even | odd, h.view(np.uint64))
    assert collocations.holds(even, h[:3000:2].view(np.uint64)).all() and collocations.holds(odd, h[1:3000:2].view(np.uint64)).all()
    assert known[:3000].all() and known[3000:].mean() < 0.01


def test_scores_beyond_64_bits(spark):
    big = 1 << 61
    rows = [("en", "a", 1, big + 7), ("en", "b", 1, big + 9), ("en", "c", 1, big), ("en", "a b", 2, big - 3), ("en", "b c", 2, big - 5), ("en", "a b c", 3, big - 9)]
    f = {p: n for _, p, _, n in rows}
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["score"]) for r in collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, len int, f long")).collect()}
    for p in ("a b", "b c", "a b c"):
        w = p.split()
        cuts = [(2000000 * f[p] // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        assert got[p] == (f[p], f[" ".join(w[:k])], f[" ".join(w[k:])], score)


def test_top_ends_the_report(spark):
    rows = [("en", f"x{i} y{i}. " * (3 + i % 4)) for i in range(9)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=3, top=4).collect()
    assert [(r["rank"], r["score"], r["a"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1000000, 6), (2, 1000000, 6), (3, 1000000, 5), (4, 1000000, 5)]


def notice(label, n=0):
    return [t for x, t in licenses.TEMPLATES if x == label][n]


def test_passages(spark):
    r = random.Random(3)
    filler = edge.words(200, 1, 5000)
    isc = notice("isc").split()
    changed = isc[:8] + ["really"] + isc[8:20] + isc[21:30] + ["plainly", "so"] + isc[30:]  # words put in and one left out
    half = " ".join(isc[: len(isc) // 2])
    cases = {
        1: (f"{filler} {notice('bsd')} {filler}", "", "bsd"),
        2: (f"{filler} {' '.join(changed)}\n{filler}", "", "isc"),
        3: (f"{filler} {half} {filler}", "", ""),
        4: ("Licensed under CC-BY-NC 4.0", "", "cc-by-nc"),
        5: (notice("gpl", 1), "gpl", "gpl"),
        6: ("the Apache\nlicense. The MIT, License! 漢字mit license", "apache,mit", "apache,mit"),
        7: (" ".join(r.sample(isc, len(isc))), "", ""),
        8: (f"{notice('mpl')} {filler} " * 50 + notice("unlicense").upper(), "", "mpl,unlicense"),
    }
    rows = [(i, t, 9) for i, (t, _, _) in cases.items()]
    rows += [rows[0], (None, cases[1][0], 1), (None, None, 2), (9, "", 3), (1, filler, 4)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, share int").repartition(3)).collect()
    assert len(got) == len(rows)
    for x in got:
        if x["doc_id"] in cases and x["n_words"] != 200:
            assert (x["base_labels"], x["labels"]) == cases[x["doc_id"]][1:], x
    one = [x for x in got if x["doc_id"] == 1]
    assert sorted(x["labels"] for x in one) == ["", "bsd", "bsd"]
    p = next(x for x in one if x["labels"])["passages"][0]
    assert (p["begin"], p["end"], p["share"]) == (200, 200 + len(re.findall(r"\w+", notice("bsd"))), 1.0)
    two = next(x for x in got if x["doc_id"] == 2)
    assert licenses.VERIFIED <= two["score"] < 1
    assert next(x for x in got if x["doc_id"] == 3)["score"] == pytest.approx(0.5, abs=0.05)
    assert {x["score"] for x in got if x["doc_id"] == 9} == {0.0}
