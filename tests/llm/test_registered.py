"""The registered queries without SQL, by brute force over the whole smallest tables."""

import zlib
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pytest

from tests.llm.test_pairs import groups, near, plain_fingerprint
from tests.llm.test_tokens import check_packed, plain_targets, tok, whole  # noqa: F401
from voxlake.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()]


def test_simhash(spark, documents):
    out = queries()["op2_simhash_near_dedup"](spark, FOLDER)
    assert out.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    prints = [(i, plain_fingerprint(t)) for i, t, _ in documents]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(prints, groups(prints, near), strict=True))
    assert sorted(tuple(r[:3]) for r in out.collect()) == want and len({c for *_, c in want}) < len(want)


def test_mix(spark, documents):
    got = queries()["op4_mixing_pivotal"](spark, FOLDER).collect()
    size = lambda t: len((t or "").encode().split())
    source, totals, taken = {i: s for i, _, s in documents}, defaultdict(int), Counter()
    for _, t, s in documents:
        totals[s] += size(t)
    target = plain_targets(totals)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, _ in documents)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == totals[s] and r.target == pytest.approx(target[s]) and r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[s] += r.taken
    longest = {s: max(size(t) for _, t, x in documents if x == s) for s in totals}
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in totals)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries()["op4_mixing_pivotal"](spark, FOLDER).collect()))


def test_token_files(spark, documents, tok):  # noqa: F811
    got = sorted(tuple(r[:4]) for r in queries()["op5_token_files_arrow"](spark, FOLDER).collect())
    start, want = 0, []
    for i, t, _ in sorted(documents):
        ids = np.array([*whole(tok, t), 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_packing(spark, documents, tok):  # noqa: F811
    got = queries()["op9_packing_sum_of_squares"](spark, FOLDER).collect()
    used = check_packed(got, [(i, t) for i, t, _ in documents], tok)
    assert used <= 1.02 * ceil(sum(r.length for r in got) / 4096) + 1  # near the least number that the tokens need
