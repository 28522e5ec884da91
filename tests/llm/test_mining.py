"""Hard negatives, language profiles and resampling against plain versions."""

import re
import unicodedata
import zlib
from collections import Counter
from hashlib import sha256
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ROWS, rows
from voxlake.llm import hard_negatives, languages, queries, resampling

VECS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("dim, most", [(1, 3), (64, 300), (130, 70_000), (70, 1 << 25), (0, 1)])
def test_exact_products(dim, most):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-most, most + 1, (9, dim)), rng.integers(-most, most + 1, (7, dim))
    assert (hard_negatives.exact_products(a, b) == (a.astype(object) @ b.astype(object).T if dim else 0)).all()


def test_products_of_the_longest_vectors():
    """Scores near the bound, where the last digit passes 64 bits on its way."""
    x = np.array([[(1 << 28) - 1, 0, 3], [1 - (1 << 28), 5, -(1 << 28)]])
    assert (hard_negatives.exact_products(x, x) == x @ x.T).all()


def plain_negatives(table, share=50):
    """(anchor, positive, rank, negative, scores) by comparing all rows."""
    q = {}
    for i, v, label in table:
        if i is not None and v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v):
            q[i, label, tuple(v)] = np.array([floor(256 * c) for c in v], object)
    out = []
    for (i, label, _), a in q.items():
        if i % share:
            continue
        score = lambda b, a=a: int((a * b).sum())
        others = [(-score(b), j, other) for (j, other, _), b in q.items() if j != i and len(b) == len(a)]
        for p, j, _ in sorted(x for x in others if x[2] == label)[:5]:
            hard = sorted(x for x in others if x[2] != label and 50 * -p <= 100 * -x[0] <= 95 * -p)[:3]
            out += [(i, j, k, n, -p, -s) for k, (s, n, _) in enumerate(hard, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((4, 6)) * 0.7
    out = [(k, (centres[k % 4] + rng.standard_normal(6) * 0.4).tolist(), int(k % 3)) for k in range(400)]
    out += [(1000 + k, out[50][1], int(k % 3)) for k in range(40)]  # a hot vector, with ties in score
    out += [out[100], out[100], (100, out[7][1], 2), (101, None, 1), (102, [0.1] * 6, None), (103, [0.1, None] * 3, 1), (None, [0.1] * 6, 1)]
    out += [(104, [float("nan")] * 6, 1), (105, [float("inf")] * 6, 1), (150, [0.5, 0.25], 0), (151, [0.5, 0.25], 0), (152, [0.4, 0.2], 1), (200, [], 0), (201, [], 0), (203, [], 1), (250, [0.0] * 6, 0), (251, [-0.0] * 6, 1)]
    return out


@pytest.mark.parametrize("sizes", [(2048, 1024, 64, 16), (16, 4, 2, 1)])
def test_hard_negatives(spark, vectors, monkeypatch, sizes):
    for name, n in zip(("ROWS", "ANCHORS", "ROW_BLOCKS", "ANCHOR_BLOCKS"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, n)
    df = spark.createDataFrame(vectors, VECS).repartition(3)
    want = plain_negatives(vectors)
    assert len(want) > 50
    assert sorted(map(tuple, hard_negatives.mine(df, F.expr("vec_id % 50 = 0")).collect())) == want


def test_hard_negatives_of_odd_tables(spark, vectors):
    none = spark.createDataFrame([], VECS)
    assert hard_negatives.mine(none, F.lit(True)).collect() == []
    df = spark.createDataFrame(vectors, VECS)
    assert hard_negatives.mine(df, F.lit(None).cast("boolean")).collect() == []
    own = df
    for c in ("v", "h", "ids", "block", "dim", "side", "place", "score", "anchor", "positive_id"):
        own = own.withColumn(c, F.lit("own"))
    named = own.withColumn("label", F.concat(F.lit("label "), "label"))  # labels of any type
    assert sorted(map(tuple, hard_negatives.mine(named, F.expr("vec_id % 50 = 0")).collect())) == plain_negatives(vectors)
    far = spark.createDataFrame([(50, [1e300], 0), (51, [1.0], 0), (52, [0.6], 1)], VECS)  # too long for 64 bits: takes no part
    assert hard_negatives.mine(far, F.expr("vec_id % 50 = 0")).collect() == []


def plain_grams(text):
    kind = lambda c: unicodedata.category(c)[0] in "LM"
    low = "".join(c.lower() if len(c.lower()) == 1 else "i" if c == "İ" else c for c in text or "")
    out = Counter()
    for w in "".join(c if kind(c) else " " for c in low).split(" "):
        if w:
            w = f" {w} "
            out.update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n] != " ")
    return [g for g, _ in sorted(out.items(), key=lambda x: (-x[1], x[0]))], out


def plain_languages(docs, most):
    counts = {}
    for _, text, lang in docs:
        if lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text)[1])
    profiles = {k: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most])} for k, c in counts.items() if c}
    out = []
    for i, text, _ in docs:
        own = plain_grams(text)[0][:most]
        if text is None or not any(c.isalpha() for c in text) or not profiles:
            out.append((i, "und", 0.0))
            continue
        far, name = min((sum(abs(p.get(g, r + most) - r) for r, g in enumerate(own)), k) for k, p in profiles.items())
        out.append((i, name, round(1 - far / (most * len(own)), 9)))
    return sorted(out, key=repr)


def predicted(docs, profiles, size=languages.PROFILE):
    out = languages.predict(docs, profiles, size=size).select("row.doc_id", "lang_pred", "score")
    return sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in out.collect()), key=repr)


@pytest.mark.parametrize("held, at_once", [(2_000_000, 1000), (10, 1)])
def test_languages(spark, docs, monkeypatch, held, at_once):
    monkeypatch.setattr(languages, "HELD", held)
    monkeypatch.setattr(languages, "LANGUAGES", at_once)
    for size in (30, 400):
        want = plain_languages([(r[0], r[1], r[2]) for r in ROWS], size)
        assert {"und", "en", "de"} <= {x for _, x, _ in want}
        assert predicted(docs, languages.fit(docs, size=size), size) == want


def test_languages_of_odd_tables(spark, docs, none, clash):
    assert languages.fit(none).collect() == [] and languages.predict(none, languages.fit(docs)).collect() == []
    assert {r.lang_pred for r in languages.predict(docs, languages.fit(none)).collect()} == {"und"}
    profiles = languages.fit(docs)
    assert predicted(clash, languages.fit(clash)) == predicted(docs, profiles)
    marks = spark.createDataFrame([(1, "́́ 12 ."), (2, "中"), (3, "Ⅷ")], "doc_id long, text string")
    assert [x[1] == "und" for x in predicted(marks, profiles)] == [True, False, True]
    text = spark.createDataFrame([("the one",)], "text string")  # no other column
    assert languages.predict(text, profiles).count() == 1


def test_held_out_languages(spark):
    out = queries.queries()["op12_language_rank_order"](spark, "/root/testdata/sf0.01").filter("held_out")
    out = out.join(queries.read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    assert out.count() > 250 and out.filter("lang = lang_pred").count() >= 0.98 * out.count()


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{x} {y}" for x, y in zip(w, w[1:], strict=False)]], len(w)


def test_features_and_sums():
    texts = [r[1] for r in ROWS] + ["é" * 3000 + " " + "Z" * 70_000 + " \x00one{two}", "ONE"]
    bucket, owner, words = resampling.features(pa.array(texts))
    plain = [plain_features(t) for t in texts]
    assert [sorted(bucket[owner == i].tolist()) for i in range(len(texts))] == [sorted(f) for f, _ in plain]
    assert words.tolist() == [n for _, n in plain]
    assert resampling.features(pa.array(texts).slice(3, 2))[2].tolist() == words[3:5].tolist()
    count = np.stack([np.bincount(f, minlength=10_000) for f, _ in plain])
    for gain in (np.random.default_rng(1).integers(-40_000, 9000, 10_000), np.zeros(10_000, np.int64), np.full(10_000, -(1 << 15))):
        assert (resampling.Gains(gain).sums(count) == count @ gain).all()


def plain_ranks(docs, target, share, least):
    own, goal = [plain_features(t) for _, t in docs], [plain_features(t)[0] for t in target]
    s, t = (np.bincount([b for f in x for b in f] or [0], minlength=10_000) - (0 if any(x) else np.eye(1, 10_000, dtype=int)[0]) for x in ([f for f, _ in own], goal))
    gain = [floor(1000 * log((float(b) + 1) * (s.sum() + 10_000) / ((float(a) + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for (i, _), (f, n) in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296))), n))
    drawn = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1], x[2]))
    rank = [(*x[:4], k if k <= round(100 * share) * len(drawn) // 100 else None) for k, x in enumerate(drawn, 1)]
    return sorted(rank + [(*x[:4], None) for x in out if x[4] < least], key=repr)


@pytest.mark.parametrize("share, least", [(0.25, 20), (0.6, 1), (1.0, 0)])
def test_ranks(spark, docs, clash, share, least):
    target = spark.createDataFrame([("alpha beta gamma",), (None,), (LONG[:500],)], "text string")
    want = plain_ranks([(r[0], r[1]) for r in ROWS], ["alpha beta gamma", None, LONG[:500]], share, least)
    assert rows(resampling.ranks(docs, target, share=share, least=least)) == want
    if share < 1:
        assert rows(resampling.ranks(clash, target, share=share, least=least)) == want
        last = max(x for *_, x in want if x is not None)
        drawn = resampling.resample(clash, target, share=share, least=least)
        assert drawn.columns == clash.columns and drawn.count() >= last
        ids = Counter(x[0] for x in want if x[4] is not None)
        assert all(Counter(r["doc_id"] for r in drawn.collect())[i] >= n for i, n in ids.items())


def test_ranks_of_empty_tables(spark, docs, none):
    target = spark.createDataFrame([], "text string")
    assert resampling.ranks(none, docs).count() == 0 and resampling.resample(none, docs).count() == 0
    assert rows(resampling.ranks(docs, target)) == plain_ranks([(r[0], r[1]) for r in ROWS], [], 0.25, 20)
