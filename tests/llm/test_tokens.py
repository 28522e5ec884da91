"""Token files, packing, mixing and archives: exact round trips and invariants."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ROWS
from voxlake.llm import mixing, packing, token_files, tokens, warc


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


def whole(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'.,!?ab1é́ßİ\x01\x1c\x85 <|>"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    from tokenizers import Tokenizer

    tok = test_pieces_encode_like_whole_texts.tok = getattr(test_pieces_encode_like_whole_texts, "tok", None) or Tokenizer.from_file(tokens.default_path())
    texts += ["a<|endoftext|>b", "it's. IT'S! word,"]
    assert [x.tolist() for x in tokens.encoder(tokens.default_path())(texts)] == [whole(tok, t) for t in texts]


def test_cache_turns_over(tok, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 50)
    tokens._loaded.clear()
    encode = tokens.encoder(tokens.default_path())
    texts = [f"word{i} other{i % 7}, {'long' * 90} x{i}! word{'e' * i}" for i in range(200)]
    for k in range(0, 200, 10):
        assert [x.tolist() for x in encode(texts[k : k + 10])] == [whole(tok, t) for t in texts[k : k + 10]]
        assert len(encode.known) <= 60 and max(map(len, encode.known)) <= tokens.LONGEST
    tokens._loaded.clear()


def test_round_trip(docs, none, tok):
    manifest = token_files.write_shards(docs, length=128)
    got = token_files.read_documents(manifest).collect()
    rows = sorted(((r[0], r[1] or "") for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, want = 0, []
    for i, t in rows:
        ids = np.array([*whole(tok, t), 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.read_documents(token_files.write_shards(none)).count() == 0
    shard = manifest.orderBy("shard").first()
    seq, index = token_files.sequences(shard.path)
    assert all(len(x) == 128 for x in seq["ids"].to_pylist()) and index.num_rows == shard.n_docs
    mask = np.concatenate([np.array(x) for x in seq["mask"].to_pylist()])
    assert mask.sum() == shard.n_tokens and pa.types.is_fixed_size_list(seq["ids"].type)
    own = docs.selectExpr("doc_id", "text", "'x' as shard", "'y' as path", "1 as start", "2 as n_tokens", "3 as first", "'z' as ids")
    assert sorted(map(tuple, token_files.read_documents(token_files.write_shards(own)).collect()), key=lambda r: r[1]) == want


def test_packing(docs, none, clash, tok):
    got = packing.pack_documents(docs).collect()
    check_packed(got, [(r[0], r[1]) for r in ROWS], tok)
    assert packing.pack_documents(none).count() == 0
    assert packing.pack_documents(clash).count() == len(got)


def check_packed(got, docs, tok):
    want = []
    for i, t in docs:
        ids = np.array([*whole(tok, t), 1], "<u4")
        want += [(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((tuple(r[:5]) for r in got), key=repr) == sorted(want, key=repr)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_packing_in_groups(spark):
    rng = np.random.default_rng(4)
    size = np.concatenate([rng.integers(1, 4097, 3000), np.full(50, 4096)]).tolist()
    df = spark.createDataFrame([(i, 0, 0, s, i) for i, s in enumerate(size)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(df, group=200).collect()
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(len(v) for v in by.values()) == len(size)
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    # as good as packing all pieces in one group, up to what one group leaves open
    rule = packing.SumOfSquares()
    for s in sorted(size, reverse=True):
        rule.place(s)
    assert len(by) <= 1.02 * rule.made


def test_the_rule_is_the_sum_of_squares():
    """Every placement leaves the least sum of squared counts that any placement could."""
    rng, rule, counts = np.random.default_rng(2), packing.SumOfSquares(12), {}
    gap = {}
    for s in rng.integers(1, 13, 400).tolist():
        def total(c):
            return sum(n * n for g, n in c.items() if g)

        options = []
        for g in [g for g, n in counts.items() if g >= s and n > 0] + [12]:
            c = dict(counts)
            if g != 12:
                c[g] -= 1
            c[g - s] = c.get(g - s, 0) + 1
            options.append(total(c))
        seq, offset = rule.place(s)
        old = gap.get(seq, 12)
        assert offset == 12 - old and old >= s
        if seq in gap:
            counts[old] -= 1
        gap[seq] = old - s
        counts[old - s] = counts.get(old - s, 0) + 1
        counts[0] = 0
        assert total(counts) == min(options)


def test_written_sequences(spark, tok, docs, none):
    """Every document's ids, whole and in order, of rows with repeated and null ids too."""
    df = spark.createDataFrame([(i % 3 or None, f"some words of text {i} " * (i * 40), "x") for i in range(12)], "doc_id long, text string, pieces string")
    for rows in (df, docs):
        out = [r.ids for r in spark.read.parquet(packing.write_sequences(rows)).collect()]
        assert max(map(len, out)) <= 4096
        want, got = {}, {}
        for r in rows.collect():
            ids = [*whole(tok, r.text), 1]
            for k in range(0, len(ids), 4096):
                want[tuple(ids[k : k + 4096])] = want.get(tuple(ids[k : k + 4096]), 0) + 1
        for ids in out:  # pieces end with the end id or fill a sequence
            ends = [k + 1 for k, x in enumerate(ids) if x == 1]
            for a, z in zip([0, *ends], ends if ends and ends[-1] == len(ids) else [*ends, len(ids)], strict=False):
                got[tuple(ids[a:z])] = got.get(tuple(ids[a:z]), 0) + 1
        assert got == want
    assert spark.read.parquet(packing.write_sequences(none)).count() == 0


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in sizes if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / free for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(spark, docs, none, clash):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(n), s) for i, (n, s) in enumerate(zip(rng.integers(0, 60, 9000), rng.choice(["b", "a", "Z", "é", "tiny"], 9000, p=[0.5, 0.3, 0.1, 0.098, 0.002]), strict=True))]
    rows += [(20_000 + i, "x y z", None) for i in range(50)] + [(30_000, None, "empty"), (5, "w w", "b"), (5, "w w", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = plain_targets(sizes)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - target[s]) <= 60
    key = lambda rs: sorted((tuple(r) for r in rs), key=repr)
    assert key(got) == key(mixing.mix(df.repartition(7)).collect())
    assert mixing.mix(docs).count() == len(ROWS) and mixing.mix(none).count() == 0
    assert mixing.take(clash).columns == clash.columns
    copies = {}
    for r in got:
        copies[(r.doc_id, r.source)] = copies.get((r.doc_id, r.source), 0) + r.copies
    for r in mixing.take(df).collect():
        copies[(r.doc_id, r.source)] -= 1
    assert set(copies.values()) == {0}


def test_rounding_keeps_expectations():
    """Over many draws every document's share of extra copies is its fraction, whatever its size."""
    rng = np.random.default_rng(8)
    p, size, n = [0.2, 0.7, 0.5, 0.9, 0.4], [3, 10, 1, 7, 4], np.zeros(5)
    for _ in range(3000):
        b = pa.RecordBatch.from_pydict({"source": ["s"] * 5, "block": [0] * 5, "size": size, "p": p, "u": rng.random(5).tolist(), "i": list(range(5))})
        for out in mixing._round(iter([b]), True):
            for i, x in zip(out.column("i").to_pylist(), out.column("p").to_pylist(), strict=True):
                assert x in (0.0, 1.0)
                n[i] += x
    assert np.abs(n / 3000 - p).max() < 0.05


PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 70_000), (6, "u", "WARC/1.1\r\n\r\n\r\n\r\nWARC"), (None, "u", "<p>x</p>"), (None, "u", "only"), (7, "u", "é" * 70_000), (7, "u", "é" * 70_000)]


def test_archives(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    files = warc.write_archives(warc.plan_records(df), archive=1 << 17)
    got = sorted((tuple(r) for r in warc.page_records(files).collect()), key=repr)
    best, want = {}, []
    for i, _, h in PAGES:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    for i, _, h in PAGES:
        b = (h or "").encode()
        last = best[h or ""]
        kind = "response" if i == last or last == -1 else "revisit"
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, last if kind == "revisit" else None))
    assert got == sorted(want, key=repr)
    parts = warc.chunks(files, chunk=1000).filter("page_id = 7").orderBy("path", "record", "chunk").collect()
    one = [r for r in parts if (r.path, r.record) == (parts[0].path, parts[0].record)]
    assert [r.chunk for r in one] == list(range(len(one))) and b"".join(r.data for r in one) == ("é" * 70_000).encode()
    for k in (1, len(one)):
        body = b"".join(r.data for r in one[:k])
        assert one[k - 1].digest_so_far == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert [r.last for r in one].index(True) == len(one) - 1
    assert warc.page_records(warc.write_archives(warc.plan_records(df.limit(0)))).count() == 0


def test_ids_and_names_of_pages(spark):
    """String ids with line ends, integer ids, clashing names; other types are refused when the plan is made."""
    rows = [("a\r\n\r\nWARC/1.1", "p", 1.5), ("", "p", 1.5), (None, "q", 2.5), ("é", "p", 1.5)]
    df = spark.createDataFrame(rows, "page_id string, html string, kind double").selectExpr("*", "'u' as url", "'d' as digest", "7 as bytes", "8 as best", "9 as n", "'x' as refers_to")
    files = warc.write_archives(warc.plan_records(df))
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.page_records(files, df.schema["page_id"].dataType).collect()}
    assert got == {"a\r\n\r\nWARC/1.1": ("revisit", "é"), "": ("revisit", "é"), None: ("response", None), "é": ("response", None)}
    small = df.selectExpr("cast(length(page_id) as int) as page_id", "url", "html")
    assert warc.page_records(warc.write_archives(warc.plan_records(small)), small.schema["page_id"].dataType).schema["page_id"].dataType.simpleString() == "int"
    with pytest.raises(TypeError):
        warc.plan_records(df, id_col="kind")


def test_equal_payloads_below_the_limit_stay(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {(r.page_id, r.kind) for r in warc.plan_records(df, least=100).collect()}
    assert (1, "response") in kinds and (5, "revisit") in kinds and (7, "response") in kinds
