"""The pipeline against brute force, stage by stage, and over awkward tables."""

import itertools
import re
from collections import Counter, defaultdict

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from tidecast.llm import toxicity
from tidecast.session import fresh_path

from . import edge
from .test_operators import brute_item, jaccard, split

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{12,}"), re.compile("[0-9a-f]{32,}")


def without_secrets(text):
    found = [m.span() for m in ASSIGN.finditer(text or "") if len(m[1]) >= 8] + [m.span() for p in (ACCESS, HEX) for m in p.finditer(text or "")]
    out, at = "", 0
    for a, b in sorted(found):
        if a > at or not out:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:] if found else text


def size(r):
    return len(split(r["text"]))


def store(spark, df):
    path = fresh_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("kind", ["given", "awkward", "empty"])
def test_stages(spark, sf, tmp_path, kind):
    root = sf
    if kind != "given":
        root = str(tmp_path)
        docs = edge.documents(spark)
        (docs if kind == "awkward" else edge.empty(docs)).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([(0, edge.words(30, 1)), (None, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in cp.STAGES:
        before = docs.collect()
        docs = store(spark, stage(spark, docs, root))
        after = docs.collect()
        assert docs.columns[: len(columns)] == columns
        if name == "toxicity":
            assert not Counter(map(str, after)) - Counter(map(str, before))
            model = toxicity.fit(spark.createDataFrame(before, docs.schema).select("doc_id", "text"), spark.read.parquet(f"{root}/labels.parquet")) if before else None
            assert model is None or len(after) <= len(before)
        elif name == "simhash":
            assert not Counter(map(str, after)) - Counter(map(str, before))
            assert all(jaccard(x["text"], y["text"]) < 0.8 for x, y in itertools.combinations(after, 2))
            ids = {str(r) for r in after}
            assert all(any(jaccard(r["text"], k["text"]) >= 0.6 for k in after) for r in before if str(r) not in ids)
        elif name == "decontamination":
            want = [r for r in before if not any(brute_item(r["text"], b) for b in bench if b)]
            assert Counter(map(str, after)) == Counter(map(str, want))
        elif name == "secrets":
            key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["source"] or "")
            assert [r["text"] for r in sorted(after, key=key)] == [without_secrets(r["text"]) for r in sorted(before, key=key)]
            assert len(after) == len(before)
        else:
            by_source = defaultdict(int)
            for r in before:
                by_source[r["source"]] += size(r)
            names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
            weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
            target, free, left = {}, set(names), 1.5 * sum(by_source.values())
            while free:
                share = left / sum(weight[s] for s in free)
                full = {s for s in free if share * weight[s] > 2 * by_source[s]}
                if not full:
                    target |= {s: share * weight[s] for s in free}
                    break
                target |= {s: 2.0 * by_source[s] for s in full}
                free, left = free - full, left - sum(2 * by_source[s] for s in full)
            times = Counter(str(r[: len(columns)]) for r in after)
            rows = Counter(str(tuple(r)) for r in before)
            for r in before:
                rate = target[r["source"]] / by_source[r["source"]] if by_source[r["source"]] else 0
                n = times[str(tuple(r))] / rows[str(tuple(r))]
                assert int(rate + 1e-9) <= n <= int(rate + 1e-9) + 1 and n <= 2
    if kind == "given":
        assert 0 < len({r["doc_id"] for r in after}) < 200
        again = cp.run(spark, root)
        assert Counter(map(str, again.collect())) == Counter(map(str, after)) and again.agg(F.max("copy")).first()[0] == 2
