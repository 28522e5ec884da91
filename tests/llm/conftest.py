import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wörd{i % 977} and" for i in range(30_000))
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LINE = "this line is found on very many sites."
ROWS = [
    (1, f"{BASE}\n{LINE}\nmail bob.1@mail.example.com or 10.0.0.1 now", "en", "a", 10),
    (2, f"{BASE}\n{LINE}\nmail bob.1@mail.example.com or 10.0.0.1 now", "en", "b", 10),
    (2, f"{BASE}\n{LINE}\nmail bob.1@mail.example.com or 10.0.0.1 now", "en", "b", 10),  # repeated in full
    (2, f"another text with the id of the one before\n{LINE}", "en", "c", 10),  # repeated id
    (3, None, None, None, None),
    (4, "", "en", "", 0),
    (5, " \t\n\r\x0b\x0c", "en", "a", 6),
    (None, f"{BASE} psi omega\n{LINE}", "en", "d", 10),
    (None, None, None, "a", None),
    (6, LONG, "de", "a", len(LONG)),
    (7, "x" * 50_000, "de", "a", 50_000),
    (8, "one", "en", None, 3),
    (9, "é ß \U0001f600 中文 İ ǆ", "xx", "é", 9),
    (10, "Zeile\n\n\nZeile\nZeile", "de", "z", 5),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clash(docs):
    """docs with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    out = docs
    for c in ("size", "score", "fp", "root", "t1", "t2", "copies", "target", "n_lines", "pos", "site", "row", "spans", "grp", "piece", "start", "length", "sequence_id", "offset", "fill", "label", "y", "first", "h", "u", "p", "block"):
        out = out.withColumn(c, F.lit(f"own {c}"))
    return out


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)
