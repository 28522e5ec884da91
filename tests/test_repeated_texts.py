"""Work of the functions that run in Python, counted."""

import pandas as pd

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.functions import numbers
from voxlake.functions.models import apply_model


def test_equal_texts_of_a_batch_are_spelled_and_read_once(monkeypatch):
    calls = []
    monkeypatch.setattr(numbers, "digits", lambda t, own=numbers.digits: calls.append(t) or own(t))
    monkeypatch.setattr(numbers, "expand", lambda t, g, own=numbers.expand: calls.append(t) or own(t, g))
    texts = pd.Series(["twenty one", None, "3 cats"] * 100)
    assert numbers.number_digits.func(texts).tolist() == ["21", None, "3 cats"] * 100
    assert numbers._expand.func(texts, pd.Series(["en", "en", "de"] * 100)).tolist() == ["twenty one", None, "drei cats"] * 100
    assert len(calls) == 4


def test_phrases_are_tried_at_words_of_numbers_only(monkeypatch):
    tried = []

    class Counting:
        def match(self, letters, *at, own=numbers.PHRASE):
            tried.append(at)
            return own.match(letters, *at)

    monkeypatch.setattr(numbers, "PHRASE", Counting())
    assert numbers.digits("the cat ate twenty one mice and slept") == "the cat ate 21 mice and slept"
    assert len(tried) == 2


def test_rules_of_the_english_form_are_worked_out_once(spark):
    plan = spark.createDataFrame([("I won't",)], "text string").select(numbers.english_normalize(F.col("text")).alias("norm"))
    said = plan._jdf.queryExecution().executedPlan().toString()
    assert said.count("won't") == 2  # where it is looked for, and where it is replaced
    assert plan.first().norm == "i will not"


def test_a_failed_batch_of_a_model_stays_one_batch():
    class Rows:
        schema = T.StructType([T.StructField("x", T.LongType())])

        def mapInPandas(self, run, schema):
            return run

    def load():
        def model(rows):
            if (rows["x"] == 2).any():
                raise ValueError("two")
            return pd.DataFrame({"y": rows["x"] + 1})

        return model

    run = apply_model(Rows(), load, T.StructType([T.StructField("y", T.LongType())]))
    out = list(run(iter([pd.DataFrame({"x": [1, 2, 3]}), pd.DataFrame({"x": [5]})])))
    assert [len(b) for b in out] == [3, 1]
    assert out[0]["y"].tolist() == [2, None, 4] and out[0]["error"].tolist() == [None, "ValueError: two", None] and out[0]["success"].tolist() == [True, False, True]
