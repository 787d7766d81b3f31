"""Parts that need no session: chains, segments, cascades, quantisation, forests, windows."""

import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from tidecast.llm import chaining, decontaminate, graph, itq, toxicity, url_filter
from tidecast.llm.common import shingle_hashes, word_hashes, words_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té漢", max_size=30)), max_size=8)


@settings(deadline=None)
@given(TEXTS)
def test_words_are_the_runs_between_blanks(texts):
    w = words_of(pa.array(texts, pa.string()))
    lower = str.maketrans("AB", "ab")
    want = [(t or "").translate(lower).replace("\t", " ").replace("\n", " ").split() for t in texts]
    got = [[bytes(w.data[a:b]).decode() for a, b in zip(w.start[x:y], w.end[x:y])] for x, y in zip(w.first, w.first[1:])]
    assert got == want
    flat = list(itertools.chain(*want))
    h = word_hashes(w)
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


@settings(deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5), st.integers(1, 6))
def test_shingles(texts, k):
    w = words_of(pa.array([" ".join(t) for t in texts], pa.string()))
    h, first = shingle_hashes(w, word_hashes(w), k)
    want = [tuple(t[i : i + k]) for t in texts for i in range(max(len(t) - k + 1, 1 if t else 0))]
    assert len(h) == len(want)
    assert len(set(zip(want, h.tolist()))) == len(set(want)) == len(set(h.tolist()))


def maximal(score, offset=0):
    """All maximal scoring segments by the definition: the best one, then left and right of it."""
    best = max(((sum(score[a:b]), -a, -b) for a in range(len(score)) for b in range(a + 1, len(score) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[1], -best[2]
    a, b = min(((x, y) for x in range(len(score)) for y in range(x + 1, len(score) + 1) if sum(score[x:y]) == best[0]), key=lambda p: (p[1] - p[0], p[0]))
    return maximal(score[:a], offset) + [(a + offset, b + offset, best[0])] + maximal(score[b:], offset + b)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(-97, 89), max_size=14, unique_by=abs))
def test_segments(score):
    got = toxicity.segments(np.array(score, float))
    assert sum(s for *_, s in got) == sum(s for *_, s in maximal(score))
    assert all(s == sum(score[a:b]) > 0 for a, b, s in got)
    assert max((s for *_, s in got), default=0) == max((s for *_, s in maximal(score)), default=0)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=25))
def test_chain_scores_as_all_pairs_do(anchors):
    k, cost = chaining.KMER, chaining.GAP_COST
    got = chaining.chain(anchors)
    xs = sorted(set(anchors))
    assert sorted(p for _, path in got for p in path) == xs
    for _, path in got:
        assert all(a < c and b < d for (a, b), (c, d) in zip(path, path[1:]))
    best = {}
    for a, b in xs:  # predecessor by the same rule, found among all pairs
        before = [(best[c, d] + cost * (c + d), c, d) for c, d in xs if c < a and d < b]
        best[a, b] = float(k)
        if before:
            top = max(before)[0]
            options = [best[c, d] + min(k, a - c, b - d) - cost * (a - c + b - d) for v, c, d in before if abs(v - top) < 1e-9 and max(a - c, b - d) <= chaining.MAX_GAP + k]
            best[a, b] = max([best[a, b], *options])
    if xs:
        assert got[0][0] <= max(best.values()) + 1e-9


def test_minimizers_of_equal_runs_agree():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 62, 300).astype(np.uint64), rng.integers(0, 1 << 62, 200).astype(np.uint64)
    b[50 : 50 + chaining.WINDOW] = a[100 : 100 + chaining.WINDOW]  # one window in common
    both = np.concatenate([a, b])
    at = chaining.minimizers(both, np.array([0, 300, 500]))
    assert set(both[at[at < 300]].tolist()) & set(both[at[at >= 300]].tolist())
    for first, end in ((0, 300), (300, 500)):
        want = {p for i in range(first, end - chaining.WINDOW + 1) for p in [i + int(np.argmin(both[i : i + chaining.WINDOW]))]}
        assert want == {x for x in at.tolist() if first <= x < end}


def test_align_finds_the_edges():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 30, 200), rng.integers(0, 1 << 30, 220)
    b[60:130] = a[40:110]
    b[90] = 1  # a changed word
    path = [(40 + x, 60 + x) for x in (5, 15, 40, 60)]
    assert chaining.align(a, b, path) == (40, 110, 60, 130, 69)
    c = np.concatenate([b[:100], [7, 8], b[100:]])  # two words more
    path = [(45, 65), (60, 80), (85, 107), (100, 122)]
    assert chaining.align(a, c, path) == (40, 110, 60, 132, 69)


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 400), st.integers(0, 400), st.integers(0, 9))
def test_cascade_is_exact(listed, other, seed):
    rng = np.random.default_rng(seed)
    h = rng.integers(0, 1 << 63, (2, listed + other)).astype(np.uint64)
    member = np.arange(listed + other) < listed
    rows = [{"shard": 3, "level": i, "hashes": k, "bits": m, "filter": f.tobytes()} for i, (k, m, f) in enumerate(url_filter.build_levels(h[0], h[1], member))]
    answer = url_filter.Cascade(rows).holds(np.full(listed + other, 3), h[0], h[1])
    assert (answer == member).all()


def test_codes_are_balanced_and_near():
    rng = np.random.default_rng(3)
    x = itq.unit(rng.normal(size=(2000, 32)))
    mean, turn = itq.learn(x)
    code = (x - mean) @ turn > 0
    assert code.shape[1] == 64 and abs(code.mean(axis=0) - 0.5).max() < 0.06
    assert np.allclose(turn[:, :32].T @ turn[:, :32], np.eye(32)) and np.allclose(turn[:, 32:].T @ turn[:, 32:], np.eye(32))
    near = itq.unit(x + rng.normal(size=x.shape) * 0.01)
    assert (((near - mean) @ turn > 0) != code).mean() < 0.05


@settings(deadline=None)
@given(st.integers(1, 12), st.integers(0, 99))
def test_forest(n, seed):
    m = np.random.default_rng(seed).random((n, n)) < 0.15
    m |= m.T
    root = graph.forest(m)
    reach = np.linalg.matrix_power((m | np.eye(n, dtype=bool)).astype(float), n) > 0
    assert (root == reach.argmax(axis=1)).all()


def test_window_prints_and_tables():
    rng = np.random.default_rng(4)
    s = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    got = decontaminate.window_prints(s, np.arange(5, 40), 20)
    for i, start in enumerate(range(5, 40)):
        bits = np.unpackbits(s[start : start + 20].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
        assert (np.unpackbits(got[i]) == (bits * 2 > 20)).all()
    size = decontaminate.Size([7, 9], [s[:20], s[30:50]])
    window, item, distance = size.candidates(got)
    true = np.bitwise_count(got[:, None, :] ^ size.prints[None, :, :]).sum(axis=2)
    assert {(a, b) for a, b in zip(*np.nonzero(true <= decontaminate.RADIUS))} == set(zip(window.tolist(), item.tolist()))
    assert (true[window, item] == distance).all()


def two_texts(sizes, gaps, seed):
    """Words of two random texts that share passages of `sizes`, with `gaps` other words of their own between."""
    rng = np.random.default_rng(seed)
    a, b, at = [], [], []
    for i, n in enumerate(sizes):
        own = gaps[i] if i < len(gaps) else 0
        same = rng.integers(0, 1 << 40, n).tolist()
        at.append((len(a), len(b), n))
        a += same + rng.integers(0, 1 << 40, own).tolist()
        b += same + rng.integers(0, 1 << 40, own).tolist()
    return a, b, at


def seeds_of(words, k=chaining.KMER):
    return {tuple(words[i : i + k]): i for i in range(len(words) - k + 1)}


def test_later_passages_of_a_pair_have_chains():
    for seed, (sizes, gaps) in enumerate(itertools.product([(200, 60), (60, 60), (60, 200, 60)], [(30, 30), (50, 50), (100, 100), (300, 300), (500, 60)])):
        a, b, at = two_texts(sizes, gaps, seed)
        x, y = seeds_of(a), seeds_of(b)
        paths = [path for _, path in chaining.chain([(x[s], y[s]) for s in x if s in y])]
        for i, j, n in at:
            assert any((i, j) in path and (i + n - chaining.KMER, j + n - chaining.KMER) in path for path in paths), (sizes, gaps)


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 200)), max_size=40))
def test_chain_finds_the_best_in_reach(anchors):
    k, cost, reach = chaining.KMER, chaining.GAP_COST, chaining.MAX_GAP + chaining.KMER
    best = {}
    for a, b in sorted(set(anchors)):
        before = [(best[c, d] + cost * (c + d), c, d) for c, d in best if 0 < a - c <= reach and 0 < b - d <= reach]
        gains = [best[c, d] + min(k, a - c, b - d) - cost * (a - c + b - d) for v, c, d in before if abs(v - max(before)[0]) < 1e-9]
        best[a, b] = max([float(k), *gains])
    if best:
        assert chaining.chain(anchors)[0][0] <= max(best.values()) + 1e-9


def test_a_chain_that_fails_is_cut():
    for seed, gap in itertools.product(range(5), (28, 30, 33)):
        a, b, at = two_texts((52, 52), (gap,), seed)
        path = [(i + x, j + x) for i, j, n in at for x in range(0, n - chaining.KMER + 1)]
        got = chaining.passages(np.array(a), np.array(b), path)
        assert [g[:4] for g in got] == [(i, i + n, j, j + n) for i, j, n in at] and all(g[4] == 1 for g in got)


@settings(deadline=None)
@given(st.lists(st.tuples(st.floats(0.1, 1), st.floats(-1, 5)), min_size=1, max_size=12))
def test_longest_stretch(steps):
    gain, loss = (np.array(x) for x in zip(*steps))
    fits = [j - i for i in range(len(gain)) for j in range(i, len(gain)) if gain[i : j + 1].sum() - loss[i + 1 : j + 1].sum() >= 0]
    i, j = chaining._longest(gain, loss)
    assert j - i == max(fits)


def test_passages_are_thinned_after_alignment():
    rows = [(1, 0, 60, 7, 0, 60, 1.0), (1, 5, 58, 8, 5, 58, 1.0), (1, 50, 120, 9, 0, 70, 0.9)]
    group = pa.RecordBatch.from_pylist([dict(zip(("a", "a_start", "a_end", "b", "b_start", "b_end", "similarity"), r)) for r in rows])
    assert [r["b"] for r in chaining._best_of_text(group).to_pylist()] == [9, 7]


def test_seeds_of_changed_passages_meet():
    rng = np.random.default_rng(4)
    for n, edits, least in ((55, 5, 29), (55, 8, 27), (100, 15, 30), (100, 20, 29)):
        found = 0
        for _ in range(30):
            p = rng.integers(0, 1 << 40, n)
            q = p.copy()
            q[((np.arange(edits) + 0.5) * n / edits).astype(int)] = rng.integers(0, 1 << 40, edits)
            texts = [np.concatenate([rng.integers(0, 1 << 40, 80), x, rng.integers(0, 1 << 40, 80)]) for x in (p, q)]
            batch = pa.record_batch({"of": pa.array([0, 1]), "text": pa.array([" ".join(map(str, t)) for t in texts])})
            seeds = [r for b in chaining._seeds(iter([batch])) for r in b.to_pylist()]
            x, y = ({r["seed"]: r["pos"] for r in seeds if r["of"] == i and not r["again"]} for i in (0, 1))
            paths = [path for _, path in chaining.chain([(x[s], y[s]) for s in x if s in y])]
            found += any(chaining.passages(*texts, path) for path in paths if path[-1][0] - path[0][0] + chaining.KMER >= chaining.MIN_CHAIN)
        assert found >= least, (n, edits, found)


@settings(deadline=None)
@given(st.integers(0, 9), st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 1 << 64) | st.sampled_from([5, 9 << 40, (1 << 64) - 1]), st.integers(0, (1 << 31) - 1)), max_size=30))
def test_packed_seeds_come_back(bits, rows):
    of, seed, pos = (np.array([r[i] % (1 << 64) if i == 1 else r[i] for r in rows], t) for i, t in enumerate((np.int64, np.uint64, np.int32)))
    got = []
    for r in chaining.pack(of, seed, pos, bits).to_pylist():
        got += [(r["range"], *x) for x in zip(*(c.tolist() for c in chaining.unpack(r["seeds"], r["texts"], r["packed"])))]
    top = lambda s: s >> (64 - bits)
    assert sorted(got) == sorted((top(s), (s << bits) % (1 << 64) >> 24, o, p) for o, s, p in zip(of.tolist(), seed.tolist(), pos.tolist()))


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-4, 4), st.integers(0, 5)), max_size=40))
def test_links_of_shared_seeds(rows):
    want = set()
    for seed in {r[0] for r in rows}:
        place = {o: min(p for s, q, p in rows if (s, q) == (seed, o)) for s, o, _ in rows if s == seed}
        for end in (min(place), max(place)):
            want |= {(o, end, seed, p, place[end]) for o, p in place.items() if o != end}
    rest, of, pos = (np.array([r[i] for r in rows], t) for i, t in enumerate((np.uint64, np.int64, np.int32)))
    got = list(zip(*(c.tolist() for c in chaining.linked(rest, of, pos))))
    assert sorted(got) == sorted((a, b, p, q) for a, b, _, p, q in want)
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)


@settings(deadline=None)
@given(st.integers(1, 9), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(0, 9)), max_size=40))
def test_reach_is_the_greatest_within_width(width, points):
    tree = chaining.Reach(width)
    points.sort()
    for x, (a, b, _) in enumerate(points):
        there = [v for c, d, v in points[:x] if a - c <= width and 0 < b - d <= width]
        got = tree.best(a, b)
        assert max((v for v, _ in got), default=None) == max(there, default=None)
        assert all(points[y][2] == v and a - points[y][0] <= width and 0 < b - points[y][1] <= width for v, y in got)
        tree.add(a, b, points[x][2], x)


def test_seeds_of_a_slice_take_bounded_memory():
    rng = np.random.default_rng(5)
    words = np.array([f"word{i}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 500)]) for _ in range(900)]
    batch = pa.record_batch({"of": pa.array(range(900)), "text": pa.array(texts)})
    tracemalloc.start()
    got = sum(b.num_rows for b in chaining._seeds(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == 900 * 497 and sum(map(len, texts)) > 3.5e6
    assert peak < 100e6, peak  # words of the whole slice were hashed at once before


def test_steps_see_bounded_rows(monkeypatch):
    monkeypatch.setattr(chaining, "AT_ONCE", 50)
    sizes = [3, 60, 0, 20, 20, 20, 200, 1, 1]
    batch = pa.record_batch({"x": pa.array([list(range(n)) for n in sizes]), "i": pa.array(range(len(sizes)))})
    seen = []
    list(chaining._bounded(lambda b: seen.append(b), "x")(iter([batch, batch.slice(0, 0), batch.slice(3, 2)])))
    assert [i for b in seen for i in b.column("i").to_pylist()] == [*range(len(sizes)), 3, 4]
    assert all(sum(map(len, b.column("x").to_pylist()[1:])) < 50 for b in seen)  # the first may be long


def test_chains_of_many_pairs_are_those_of_each_pair():
    rng = np.random.default_rng(6)
    links, want = [], []
    for pair in range(40):
        a, b, _ = two_texts((30, 25), (20, 60), pair)
        x, y = seeds_of(a), seeds_of(b)
        anchors = [(x[s], y[s]) for s in x if s in y] + [tuple(map(int, rng.integers(0, 150, 2))) for _ in range(pair)]
        links += [(pair // 5, pair % 5, p, q) for p, q in anchors]
        for _, path in chaining.chain(anchors):
            if path[-1][0] - path[0][0] + chaining.KMER >= chaining.MIN_CHAIN:
                want.append((pair // 5, pair % 5, path))
    rng.shuffle(links)
    a, b, pos, other = (np.array(c, t) for c, t in zip(zip(*links), (np.int64, np.int64, np.int32, np.int32)))
    got = [(r["a"], r["b"], list(zip(r["a_pos"], r["b_pos"]))) for r in chaining._pair_chains(a, b, pos, other).to_pylist()]
    assert sorted(got) == sorted(want) and len(want) >= 40


def test_equal_scores_give_the_longer_chain():
    anchors = [(x, x) for x in range(3)] + [(29 + x, 31 + x) for x in range(10)]  # 5.6 for three seeds, 4 for new words, -5.6 for the way
    assert [len(p) for _, p in chaining.chain(anchors)] == [13]


def test_steps_travel_with_what_they_import():
    """A worker need not have imported pyarrow.compute itself: the function names it, in a generator as well."""
    assert b"pyarrow.compute" in cloudpickle.dumps(chaining._bounded(lambda b: b, "x"))


def test_links_of_repeated_seeds_go_to_places_in_order():
    rows = [(7, 1, 10), (7, 1, 20), (7, 1, 30), (7, 1, 30), (7, 2, 5), (7, 2, 6), (7, 3, 9), (8, 1, 40), (8, 1, 50), (9, 1, 60), (9, 2, 70)]
    rows = chaining._by_seed(*(np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int32))))
    a, b, pos, other, n, _, _ = (c.tolist() for c in chaining.repeated_links(*rows))
    assert sorted(zip(a, b, pos, other)) == [(1, 3, 20, 9), (1, 3, 30, 9), (2, 1, 6, 20)]
    assert sorted(zip(a, pos, n)) == [(1, 20, 4), (1, 30, 4), (2, 6, 4)]
    counted = chaining.counted_links(*rows)
    assert {(x, p): m for x, p, m in zip(*(counted[i].tolist() for i in (0, 2, 4))) if m} == {(1, 10): 4, (2, 5): 4, (3, 9): 4, (1, 60): 2, (2, 70): 2}
