"""Token ids of whole texts by a public tokenizer, with a bounded cache of the ids of repeated words."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units (words, or their letters and their punctuation apart) whose ids are kept between calls.
KEPT = 600_000
#: Longest unit, in bytes, that is kept.
LONGEST = 256
#: Units encoded in one call.
CALL = 2000
#: Punctuation that may follow a word; the tokenizer never joins it to a letter before it.
AFTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Ends the last token of every run of letters in this kind of vocabulary.
ENDS = "</w>"

_loaded: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; one a process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... (size of them) of every row, one row after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _rest(word: pa.Array, stem: pa.Array) -> pa.Array:
    """What follows the stem in each word."""
    _, offsets, data = word.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(word.type) else np.int32)[word.offset : word.offset + len(word) + 1][1:].astype(np.int64)
    size = (pc.binary_length(word).to_numpy() - pc.binary_length(stem).to_numpy()).astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[_ragged(ends - size, size)] if data else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(word), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(flat))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of texts, which ASCII white space separates; their number in each text); null texts are empty."""
    words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, count = words.flatten(), pc.list_value_length(words).to_numpy().astype(np.int64)
    some = pc.not_equal(flat, "")  # white space at an end splits off an empty word
    owner = np.repeat(np.arange(len(count)), count)[some.to_numpy(zero_copy_only=False)]
    return flat.filter(some), np.bincount(owner, minlength=len(count))


class Encoder:
    """texts -> their ids (uint16 if the vocabulary fits, else uint32), without special tokens.

    Texts are cut at ASCII white space, where this kind of tokenizer (white space dropped before its word
    merges) never joins anything, and words of letters also before ASCII punctuation that ends them, so the
    ids of the units in order are the ids of the text. Arrow splits texts and finds the different words of a
    call; the tokenizer sees only units that are not kept from before. Null texts are empty, texts may be of
    any length. tests/llm compare with encoding whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.kind = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for w, i in vocab.items() if w.endswith(ENDS)]] = True
        self._forget()

    def _forget(self) -> None:
        """Start with the empty unit alone."""
        self.known: dict[str, int] = {"": 0}
        self.start, self.size, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, self.kind)

    def _plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number in each unit) of any units."""
        got = [e.ids for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), self.kind), np.fromiter(map(len, got), np.int64, len(got))

    def _letters(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units of letters alone, each one run: encoded as one text and cut behind every run's last token."""
        ids = np.asarray(self.tok.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(units) or ends[-1] != len(ids):
            return self._plain(units)
        return ids, np.diff(ends, prepend=0)

    def _rows(self, units: pa.Array) -> np.ndarray:
        """Row of each unit (all different) in start and size; new units are encoded."""
        names, known = units.to_numpy(zero_copy_only=False).tolist(), self.known
        row = np.fromiter(map(known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(row < 0)
        if len(new):
            alpha = pc.utf8_is_alpha(units.take(pa.array(new))).to_numpy(zero_copy_only=False)
            ids, sizes = [self.ids], [self.size]
            for own, encode in ((new[alpha], self._letters), (new[~alpha], self._plain)):
                for at in range(0, len(own), CALL):
                    part = own[at : at + CALL].tolist()
                    for x, to in zip(encode([names[i] for i in part]), (ids, sizes), strict=True):
                        to.append(x)
            order = np.concatenate([new[alpha], new[~alpha]])
            row[order] = np.arange(len(self.size), len(self.size) + len(order))
            known.update(zip([names[i] for i in order.tolist()], row[order].tolist(), strict=True))
            self.ids, self.size = np.concatenate(ids), np.concatenate(sizes)
            self.start = np.cumsum(self.size) - self.size
        return row

    def flat(self, texts: Iterable[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their number in each text)."""
        texts = texts if isinstance(texts, pa.Array | pa.ChunkedArray) else pa.array(texts, pa.string())
        words, per_text = split_words(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
        coded = words.dictionary_encode()
        word = coded.dictionary
        stem = pc.utf8_rtrim(word, AFTER)
        stem = pc.if_else(pc.utf8_is_alpha(stem), stem, word)
        tail = _rest(word, stem)
        stem = pc.if_else(pc.string_is_ascii(stem), pc.ascii_lower(stem), stem)
        units = pa.concat_arrays([stem, tail]).dictionary_encode()
        row = self._rows(units.dictionary)[units.indices.to_numpy()].reshape(2, -1)
        row = row.T[coded.indices.to_numpy()].reshape(-1)  # of each word in order: its stem's row, its tail's row
        size = self.size[row]
        ids = self.ids[_ragged(self.start[row], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], 2 * np.cumsum(per_text)])]
        self._tidy(units.dictionary)
        return ids, np.diff(ends)

    def _tidy(self, units: pa.Array) -> None:
        """Keep no long units, and once there are too many only those of the last call."""
        long = pc.greater(pc.binary_length(units), LONGEST)
        for u in units.filter(long).to_pylist():
            del self.known[u]
        if len(self.size) > KEPT or len(self.ids) > 16 * KEPT:
            names = units.filter(pc.invert(long)).to_pylist()
            if len(names) > KEPT:
                return self._forget()
            names = [u for u in names if u]
            row = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
            ids, size = self.ids[_ragged(self.start[row], self.size[row])], self.size[row]
            self._forget()
            self.known.update(zip(names, range(1, len(names) + 1), strict=True))
            self.ids, self.size = ids, np.concatenate([self.size, size])
            self.start = np.cumsum(self.size) - self.size

    def __call__(self, texts: Iterable[str | None] | pa.Array) -> list[np.ndarray]:
        """ids of each text."""
        ids, size = self.flat(texts)
        return np.split(ids, np.cumsum(size)[:-1]) if len(size) else []


def in_parts(texts: pa.Array, size: int = 1 << 22) -> Iterable[pa.Array]:
    """Consecutive texts in slices of about so many bytes, a single longer text at most beyond it."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, to - at)
        at = to


def with_end(ids: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id behind each text's ids."""
    return np.insert(ids, np.cumsum(size), end), size + 1


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
