"""Line dedup, classifier, rules and personal data."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LINE
from voxlake.llm import line_dedup, pii, quality_model, queries, rules


def plain_lines(rows, sites=3, words=3):
    where, first = {}, {}
    for r in rows:
        for i, x in enumerate((r.text or "").split("\n")):
            x = x.strip(" \t\n\r\x0b\x0c")
            if len(x.encode().split()) >= words:
                where.setdefault(x, set()).add("" if r.source is None else "s" + r.source)
                at = (r.doc_id is None, r.doc_id or 0, i)
                first[x] = min(first.get(x, at), at)
    out = []
    for r in rows:
        keep = []
        parts = [] if r.text is None else r.text.split("\n")
        for i, x in enumerate(parts):
            y = x.strip(" \t\n\r\x0b\x0c")
            if len(where.get(y, ())) < sites or first[y] == (r.doc_id is None, r.doc_id or 0, i):
                keep.append(x)
        out.append((r.doc_id, None if r.text is None else "\n".join(keep), len(parts), len(parts) - len(keep)))
    return sorted(out, key=repr)


def test_lines(docs, clash, none):
    got = line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(docs.collect())
    assert set(clash.columns) <= set(line_dedup.dedup_lines(clash).columns)
    assert line_dedup.dedup_lines(none).count() == 0


def test_lines_by_estimate(spark):
    """A line far over the threshold is decided by its sketch, one just below by the exact count."""
    rows = [(i, f"a line of {k} sites\nown line number {i} here", f"s{i % k}") for k in (40, 7, 8) for i in range(k * 1000, k * 1000 + 2 * k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = line_dedup.dedup_lines(df, sites=8)
    n = {r.text.split("\n")[0]: r.count for r in out.groupBy("text").count().collect() if r.text.startswith("a line")}
    assert sum(1 for t in out.collect() if t.text.startswith("a line of 40")) == 1
    assert sum(1 for t in out.collect() if t.text.startswith("a line of 8")) == 1
    assert sum(1 for t in out.collect() if t.text.startswith("a line of 7")) == 14, n


def test_a_frequent_line_of_few_sites(spark):
    """A line that 40,000 documents of 3 sites have: before anything is dealt out by line, a task adds up its sites."""
    df = spark.range(40_000, numPartitions=4).selectExpr("id as doc_id", "concat('the same line here\nown line number ', id) as text", "concat('s', id % 3) as source")
    out = line_dedup.dedup_lines(df)
    assert out.agg(F.sum("n_removed")).first()[0] == 39_999
    lines = line_dedup._lines(df, "doc_id", "text", "source", 3).filter("pos = 0")
    plan = line_dedup.spreading(lines)._jdf.queryExecution().executedPlan().toString()
    counted = lines.select("l1", "l2", "site").distinct()
    written = counted.withColumn("part", F.spark_partition_id()).groupBy("part").count().agg(F.max("count")).first()[0]
    assert written <= 3 and "hashpartitioning(l1" in plan
    for exchange in re.finditer(r"Exchange hashpartitioning\(l1#\d+L?, l2#\d+L?, site[^\n]*\n([^\n]*)", plan):
        assert "HashAggregate" in exchange[1]  # rows are combined before they are dealt out


def test_line_survives_once(docs):
    left = line_dedup.dedup_lines(docs).filter(F.contains("text", F.lit(LINE)))
    assert [r.doc_id for r in left.collect()] == [1]


def test_classifier(spark, docs, none, clash):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["haus", "baum", "weg", "licht", "wasser", "stein"], 30)) for _ in range(60)]
    bad = [" ".join(rng.choice(["haus###", "baum$$$", "weg%%%", "BUY!!"], 30)) for _ in range(60)] + ["haus " * 30] * 20
    rows = [(i, t) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 60)) for i, _ in rows] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_model.fit(df, lab, where="doc_id % 5 <> 0")
    got = {r.doc_id: r.score for r in quality_model.score(df, model).collect()}
    held = [i for i in got if i % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i < 60) for i in held]) >= 0.95
    scored = quality_model.score(docs, model)
    assert scored.count() == docs.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality_model.score(clash, model).columns.count("score") == 1
    assert quality_model.score(none, model).count() == 0
    kept = quality_model.score(df, model, keep=0.3)
    assert kept.columns == df.columns and 55 <= kept.count() <= 65
    # no labels of both classes: the prior, for every text
    flat = quality_model.fit(df, lab.filter("quality = 1"))
    assert quality_model.score(df, flat).select("score").distinct().count() == 1


def test_labels_of_held_out_rows_do_not_matter(spark):
    df = spark.createDataFrame([(i, f"text {i} {'x###' if i % 2 else 'y'}") for i in range(100)], "doc_id long, text string")
    lab = [(i, i % 2) for i in range(100)]
    other = [(i, y if i % 5 else 1 - y) for i, y in lab]
    fit = lambda rows: quality_model.fit(df, spark.createDataFrame(rows, "doc_id long, quality int"), where="doc_id % 5 <> 0")
    a, b = fit(lab), fit(other)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_repeated_ids_and_long_texts(spark):
    """Of repeated ids one row is learned from, whichever order they come in; the bound on rows drops whole documents."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["haus", "baum", "weg"] if i % 2 else ["haus###", "weg%%"], 20))) for i in range(80)]
    rows += [(i % 8, "other text") for i in range(40)] + [(200, "wörd and " * 100_000), (201, "x" * 300_000), (202, None)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(i, 1) for i in (0, 2, 200, 201, 202)], "doc_id long, quality int")
    fits = [quality_model.fit(spark.createDataFrame(r, "doc_id long, text string").repartition(k), lab) for r, k in ((rows, 3), (rows[::-1], 5))]
    assert (fits[0][0] == fits[1][0]).all() and fits[0][1] == fits[1][1]
    few = quality_model.fit(spark.createDataFrame(rows, "doc_id long, text string"), lab, entries=2000)
    assert len(few[0]) == quality_model.BUCKETS and not (few[0] == fits[0][0]).all()


def test_scores_are_those_of_the_rows(spark):
    """A text's score is that of the mean of its rows, one by one, whatever is kept from other texts."""
    rng = np.random.default_rng(5)
    model = (rng.standard_normal(quality_model.BUCKETS).astype(np.float32), 0.3)
    texts = ["a b", "", " \n", "das das das Haus", "é 😀 das Haus " * 50, "z" * 500, None, "x\x0by\x0cz", "a b"] * 3
    own = quality_model.Scorer(model)
    for _ in range(2):
        got = own.logits(pa.array(texts, pa.string()))
        for t, x in zip(texts, got, strict=True):
            rows, times = quality_model.document_rows([w.decode() for w in (t or "").encode().split()])
            assert x == pytest.approx(0.3 + (model[0][rows] @ times / max(1, times.sum()) if len(rows) else 0), abs=1e-5)


def test_the_registered_classifier(spark):
    """Held-out labelled documents of the given table: the area under the curve of the query's own scores."""
    d = "/root/testdata/sf0.01"
    out = queries.quality_classifier(spark, d)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    got = out.join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert len(bad) > 3 and (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2 >= 0.95
    assert (got.predicted == (got.score >= 0.3)).all() and out.count() == 1000
    held = {r.doc_id: r.held_out for r in out.select("doc_id", "held_out").collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())


def plain_measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= {i, i + 1, i + 2}
    lines, dup = [], 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in lines
            lines.append(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@pytest.mark.parametrize("text", [None, "", " \n ", "a b c", "a a a a", "a b c a b c", "x # $ | é b\n x\n x\nx # $", "a b c d a b c e b c a b", "w1 w2 w3 " * 30 + "é 😀 *"])
def test_measure(text):
    assert rules.measure(text)[:5] == plain_measure(text)


def test_rules(spark, docs, none, clash):
    st = rules.statistics(docs)
    want = sorted(((r.doc_id, *plain_measure(r.text)) for r in docs.collect() if len(r.text or "") < 100_000), key=repr)
    got = sorted((tuple(r) for r in st.select("doc_id", *rules.BASE).collect() if r.word_chars < 100_000), key=repr)
    assert [g for g in got if g in want] == want
    assert rules.statistics(none).count() == 0 and rules.statistics(clash).count() == docs.count()
    x = {"a": np.arange(100.0), "b": np.tile([0.0, 1.0], 50)}
    bad = (x["a"] > 60) & (x["b"] == 1)
    learned = rules.learn(x, bad)
    found = np.zeros(100, bool)
    for r in learned:
        found |= rules.covers(r, x)
    assert (found == bad).mean() >= 0.97
    assert rules.learn(x, np.zeros(100, bool)) == []


def test_the_registered_rules(spark):
    """Every verdict of the query, against measures of the texts and the learned list applied to them one by one."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    learned = rules.fit(rules.statistics(docs), labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.quality_rules(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, symbols, dup, again = plain_measure(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
        failed = n < 50 or 100 * again > 50 * n
        names = dict(zip([*rules.BASE, *rules.MORE], rules.measure(texts[r.doc_id]), strict=True))
        share = {k: np.array([eval(e, {"greatest": max}, names)]) for k, e in rules.SHARES.items()}
        assert r.base_failed == failed and r.kept == (not failed and not any(rules.covers(x, share)[0] for x in learned))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.kept, quality[r.doc_id]) for r in got if not r.base_failed and quality.get(r.doc_id) is not None]
    assert np.mean([k == (q == 1) for k, q in judged]) >= 0.95


def test_rules_of_repeated_ids(spark):
    """Repeated ids are one row of the sample, the same whatever order they come in."""
    rng = np.random.default_rng(6)
    rows = [(i % 60, " ".join(f"w{k}{'#' * (i % 2)}" for k in rng.integers(0, 900, 60))) for i in range(600)]
    lab = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] * 2, "doc_id long, quality int")
    found = [rules.fit(rules.statistics(spark.createDataFrame(r, "doc_id long, text string").repartition(k)), lab) for r, k in ((rows, 2), (rows[::-1], 5))]
    assert found[0] == found[1] != []
    assert rules.fit(rules.statistics(spark.createDataFrame([], "doc_id long, text string")), lab) == []


def test_verdict_is_ordered(spark):
    st = rules.statistics(spark.createDataFrame([(1, "a # b " * 30), (2, "abcd efgh " * 30)], "doc_id long, text string"))
    out = rules.judge(st, [[("symbol_share", ">", 0.1)]]).orderBy("doc_id").collect()
    assert [r.kept for r in out] == [False, False] and all(r.base_failed for r in out)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(w - 9 if w > 9 else w for w in worth) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def plain_spans(text):
    out = [(m.start(), r, m.end()) for r, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(k, m[0])]
    return sorted(out)


TEXTS = ["a@b.c_x@y.z 1.2.3.4.5.6.7.8", "1.2.3.999 0255.0.0.1", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (988) 555-2485 +33.1.22.33.44.55", "9" * 20_000, "a" * 5_000, "é😀 x@y.zz é 10.0.0.1", "@@ a@b a@b.c. x@y.z@w.q.r", None, "", "1 " * 5_000, "+1" + "(" * 3000, "x" * 3000 + "@", "a.b@" * 2000]


def test_spans(spark, docs, none):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find(df)).collect()}
    for i, t in enumerate(TEXTS):
        base = plain_spans(t)
        text = ",".join(f"{list(PATTERNS)[k]}:{a}:{z}" for a, k, z in base)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (i, got[i].spans)
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(x[1] == r for x in base) for r in range(4)]
    assert pii.find(docs).count() == docs.count()
    assert pii.find(none).count() == 0


def test_bootstrapping(spark):
    seeds = [f"contact: user{i}@mail.example.com please, and member {i}.7 of 9" for i in range(20)]
    more = ["Contact: XK-44-7781 please", "member 12345678 of the club", "see contact: XK-44-7781."]
    df = spark.createDataFrame(list(enumerate(seeds + more)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(pii.find(df)).collect()}
    assert got[20] == "id:9:19" and got[22] == "id:13:23"
    assert got[21] == ""  # `member` is not followed by personal data
    assert pii.redact(df).filter("doc_id = 20").first().text == "Contact: [id] please"


def test_words_behind_and_shapes(spark, monkeypatch):
    """Patterns of the word behind an instance; keys in the shape of a digest are found through their context only."""
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    texts = [f"10.1.2.{i} (gateway) is up" for i in range(9)] + ["ask node-17-b (gateway) or node-17-c", f"build {key(1)} done", f"build {key(2)}"]
    texts += [f'secret = "{key(i)}", then' for i in range(10, 15)] + ["SECRET = 'hunter2-99'!", "a build of 20240101 and build 4, the build", f"again {key(12)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {9: "id:4:13", 17: "id:10:20", 19: "id:6:46"} | {i: "id:10:50" for i in range(12, 17)}
    for bound in (pii.CONTEXTS, 0):
        monkeypatch.setattr(pii, "CONTEXTS", bound)
        got = {r.doc_id: r.spans for r in pii.digest(pii.find(df)).collect()}
        assert {i: s for i, s in got.items() if "id:" in s} == want


def test_redaction_goes_by_row(spark, clash):
    """Rows of one id, of none, and of clashing names are cut each by its own spans."""
    df = spark.createDataFrame([(1, "a x@y.zz b"), (1, "a long 10.0.0.1 b"), (None, "mail x@y.zz"), (None, None), (2, "")], "doc_id long, text string")
    got = sorted((tuple(r) for r in pii.redact(df).collect()), key=repr)
    assert got == sorted([(1, "a [email] b"), (1, "a long [ip] b"), (None, "mail [email]"), (None, None), (2, "")], key=repr)
    out = pii.redact(clash)
    assert out.columns == clash.columns and out.count() == clash.count()
    assert out.filter("doc_id = 1").first().text.endswith("mail [email] or [ip] now")


def test_identifiers_in_the_documents(spark):
    """The method finds the access keys of the given table, and hardly anything else."""
    out = pii.digest(pii.find(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).filter("n_id > 0")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = right = 0
    for r in out.join(docs, "doc_id").collect():
        for kind, a, z in (x.split(":") for x in r.spans.split(",")):
            if kind == "id":
                found += 1
                right += re.fullmatch("[0-9a-fA-F]{40}", r.text[int(a) : int(z)]) is not None
    keys = sum(len(re.findall(r"(?i)\btoken = \"[0-9a-f]{40}", r.text or "")) for r in docs.collect())
    assert found >= 10 and right >= 0.95 * found and right == keys


def keys_found(docs, shape=None):
    """(share of the keys in quotes behind `token =` that come out as identifiers, share of identifiers that are keys)."""
    spans = pii.digest(pii.find(docs, shape=shape)).select("doc_id", "spans")
    found = right = keys = 0
    for r in docs.join(spans, "doc_id").collect():
        want = {m.span(1) for m in re.finditer(r"(?i)\btoken = \"([0-9a-fA-F]+)", r.text or "")}
        got = {tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("id:")}
        found, right, keys = found + len(got), right + len(got & want), keys + len(want)
    assert keys > 10
    return right / keys, right / max(found, 1)


def test_keys_of_another_shape(spark):
    """Half of the keys are cut to 24 digits, which is no seed: the context that they share with the others finds them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    cut = F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", r"(?i)(token = \"[0-9a-f]{24})[0-9a-f]{16}", "$1")).otherwise(F.col("text"))
    recall, precision = keys_found(docs.withColumn("text", cut))
    assert recall >= 0.9 and precision >= 0.95


def test_keys_that_are_no_seeds(spark):
    """Half of the keys, by a hash, are seeds no longer."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    recall, precision = keys_found(docs, F.rlike("value", F.lit(pii.SHAPE)) & (F.xxhash64("value") % 2 == 0))
    assert recall >= 0.9 and precision >= 0.95


def test_long_contexts(spark):
    """Words beside an identifier may be of any length; only equal ones are one context."""
    word = "w" * 5000
    texts = [f"{word} = user{i}@mail.example.com" for i in range(5)] + [f"{word} = XK-44-77812", f"{word}x = XK-44-99999", f"{word[:64]} = XK-44-11111"]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert got[5] == "id:5003:5014" and got[6] == got[7] == ""


def test_texts_with_marks(spark):
    """The characters that mark matches may stand in a text."""
    texts = ["\u0001a@b.cc\u0002 \u00024111\u00011111 x 10.0.0.1\u0002", "\u0001\u0002"]
    got = {r.doc_id: r.base_sha256 for r in pii.digest(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == hashlib.sha256(",".join(f"{list(PATTERNS)[k]}:{a}:{z}" for a, k, z in plain_spans(t)).encode()).hexdigest()
