"""The pipeline's stages on small tables, and the registered queries."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import ROWS
from tests.llm.test_texts import plain_lines
from tests.llm.test_tokens import check_packed, plain_targets
from tests.test_queries import FOLDER, TABLES, plain
from voxlake.llm import near_text, quality_model
from voxlake.llm.queries import HELD_OUT, oracle_sql, queries


def test_stages_keep_the_columns(spark, docs, tmp_path):
    d = f"file://{tmp_path}"
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 0), (7, 0, 0), (8, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "source_mix", "packing"]
    cur = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        cur = stage(spark, cur, d)
        assert cur.columns == docs.columns
        path = f"{d}/{_}"
        cur.write.parquet(path)
        cur = spark.read.parquet(path)
    assert cur.count() <= 3 * len(ROWS)
    out = corpus_pipeline.run(spark, d)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_empty_documents(spark, none, tmp_path):
    d = f"file://{tmp_path}"
    none.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_names():
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_against_its_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = queries()[name](spark, FOLDER).toPandas(), duck.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and plain(got.astype({c: "float64" for c in got if got[c].dtype.kind in "iu"})) == plain(want.astype({c: "float64" for c in want if want[c].dtype.kind in "iu"}))


def near_groups(texts):
    """Smallest place of the group of each text, by Jaccard similarity of all pairs."""
    sets, label = [set(near_text.shingles(t).tolist()) for t in texts], list(range(len(texts)))
    near = lambda a, b: a == b or (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if near(sets[i], sets[j])]
    while True:
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return label


def test_every_stage_against_brute_force(spark):
    """Each stage's rows on the given table, from the rows of the one before."""
    folder = "/root/testdata/sf0.01"
    docs, key = spark.read.parquet(f"{folder}/documents.parquet"), lambda rows: Counter(map(tuple, rows))
    stages = dict(corpus_pipeline.STAGES)
    model = quality_model.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), where=f"not ({HELD_OUT})")
    scored = []
    for r in docs.collect():
        rows, times = quality_model.document_rows([w.decode() for w in r.text.encode().split()])
        if model[1] + (model[0][rows] @ times / times.sum() if len(rows) else 0) >= -0.8472978603872037:  # log(0.3 / 0.7)
            scored.append(r)
    one = stages["quality_classifier"](spark, docs, folder)
    assert key(one.collect()) == key(scored) and 0 < len(scored) < docs.count()
    two = stages["line_dedup"](spark, one, folder)
    assert Counter((r.doc_id, r.text) for r in two.collect()) == Counter((i, t) for i, t, *_ in plain_lines(scored))
    rows = sorted(two.collect(), key=lambda r: r.doc_id)
    label = near_groups([r.text for r in rows])
    three = stages["near_dedup"](spark, two, folder)
    assert key(three.collect()) == key(r for k, r in enumerate(rows) if label[k] == k) and len(set(label)) < len(rows)
    kept = three.collect()
    four = stages["source_mix"](spark, three, folder)
    times, size, taken = key(four.collect()), Counter(), Counter()
    for r in kept:
        size[r.source] += len(r.text.encode().split())
        taken[r.source] += times[tuple(r)] * len(r.text.encode().split())
    assert set(times) <= set(map(tuple, kept)) and max(times.values()) <= 3
    longest = max(len(r.text.encode().split()) for r in kept)
    for s, t in plain_targets(dict(size)).items():
        assert abs(taken[s] - t) < longest
    from tokenizers import Tokenizer

    from voxlake.llm import tokens

    tok, five = Tokenizer.from_file(tokens.default_path()), stages["packing"](spark, four, folder).collect()
    n = check_packed(five, [(r.doc_id, r.text) for r in four.collect()], tok)
    assert n <= 1.1 * sum(r.length for r in five) / 4096 + 1
    assert four.filter(F.col("text").isNull()).count() == 0
