"""Functions over texts hand on what they have made in slices, so a task never holds a whole batch of it."""

from types import SimpleNamespace

import pyarrow as pa

from voxlake.functions import text
from voxlake.operators import dictionary


def test_chunks_come_in_slices():
    texts, limits = pa.array(["One. Two.", None] * 600), pa.array([5] * 1200)
    for f in (text.pack_sentences, text._smart):
        run = f.__closure__[0].cell_contents if not hasattr(f, "func") else f.func
        out = list(run(iter([(texts, limits)])))
        assert max(map(len, out)) <= text.SLICE and sum(map(len, out)) == 1200
        assert out[0][1].as_py() is None and out[-1][-2].as_py() == out[0][0].as_py()


def test_ratios_are_made_without_a_list_of_the_texts():
    out = list(text.compression_ratio.func(iter([pa.array(["aaaa" * 50, None, ""])])))
    assert len(out) == 1 and out[0][0].as_py() > 2.4 and out[0][1].as_py() is None and out[0][2].as_py() == 0


def test_dictionary_words_come_in_slices():
    b = pa.RecordBatch.from_arrays([pa.array([["a", "b"], None, []] * 900)], ["words"])
    out = list(dictionary._by_lookup("words", SimpleNamespace(value={"a": "<a>"}))(iter([b])))
    assert max(x.num_rows for x in out) <= dictionary.SLICE
    assert [w for x in out for w in x.column(0).to_pylist()] == [["<a>", "b"], None, []] * 900
