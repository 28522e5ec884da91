"""Turn merging with state, on a state store that counts its calls."""

import random

import pandas as pd
import pytest

from voxlake.streaming import turns


class Store(dict):
    """A value or a map of one key."""

    def __init__(self, calls):
        super().__init__()
        self.calls = calls

    def counted(name, do):  # noqa: N805
        def call(self, *args):
            self.calls.append(name)
            return do(self, *args)

        return call

    exists = counted("exists", lambda self: bool(self))
    get = counted("get", lambda self: self["v"])
    update = counted("update", lambda self, v: self.__setitem__("v", v))
    clear = counted("clear", dict.clear)
    keys = counted("keys", dict.keys)
    containsKey = counted("containsKey", dict.__contains__)
    getValue = counted("getValue", dict.__getitem__)
    updateValue = counted("updateValue", dict.__setitem__)
    removeKey = counted("removeKey", dict.__delitem__)


class Run:
    """One recording's processor, its timers, what it has given out and the calls of its states."""

    def __init__(self, gap):
        self.timers, self.calls, self.out, self.mark = set(), [], [], 0
        self.merger = turns.TurnMerger(gap)
        self.merger.init(self)

    def getValueState(self, *_):
        return Store(self.calls)

    getMapState = getValueState

    def registerTimer(self, t):
        self.timers.add(t)

    def getCurrentWatermarkInMs(self):
        return self.mark

    def give(self, rows):
        frame = pd.DataFrame(rows, columns=["start_time", "seq", "speaker", "end_time"])
        cut = len(frame) // 2
        self.out += self.merger.handleInputRows((1,), iter([x for x in (frame[:cut], frame[cut:]) if len(x)]), self)

    def advance(self, mark):
        self.mark = mark
        while due := [t for t in self.timers if t <= mark]:
            self.timers.remove(min(due))
            self.out += self.merger.handleExpiredTimer((1,), self, None)

    def rows(self):
        return [(s, a, z, n, late) for x in self.out for _, s, a, z, n, late in x[turns.NAMES].itertuples(index=False)]


def whole(rows, gap):
    out = []
    for start, _, speaker, end in sorted(rows, key=lambda r: r[:2]):
        if out and speaker is not None and out[-1][0] == speaker and start - out[-1][2] <= gap:
            out[-1] = (speaker, out[-1][1], end, out[-1][3] + 1, False)
        else:
            out.append((speaker, start, end, 1, False))
    return out


@pytest.mark.parametrize("rows, most", [(66, 10), (5000, 100)])
def test_slots_of_few_rows_need_few_calls(rows, most):
    """Rows far apart, each in a slot of its own: the store is not called for each of them."""
    data = [(650.0 * i, i, "AB"[i // 2 % 2], 650.0 * i + 100) for i in range(rows)]
    run = Run(600.0)
    run.give(random.Random(1).sample(data, rows))
    run.advance(10**12)
    assert run.rows() == whole(data, 600.0) and len(run.calls) <= most and not run.merger.slots and not run.timers


@pytest.mark.parametrize("entry", [1, 5, 40, 256])
@pytest.mark.parametrize("step", [2.0, 30.0, 400.0])
def test_entries_of_any_size_give_the_same_turns(monkeypatch, entry, step):
    """Rows that come out of order, within the watermark, in many batches: the turns of the whole; rows after that, late."""
    monkeypatch.setattr(turns, "ENTRY", entry, raising=False)
    for seed in range(3):
        rng, delay, at, data = random.Random(seed), 20 * step, 0.0, []
        for i in range(600):
            at += rng.choice([0.0, rng.random() * step, 2 * step])
            data.append((at, i, rng.choice(["A", "A", "B", None]), at + rng.random() * step))
        order, run, k, top = sorted(data, key=lambda r: r[0] + rng.random() * delay), Run(step), 0, 0.0
        while k < len(order):
            part = order[k : k + rng.choice([1, 7, 100])]
            run.give(part)
            k, top = k + len(part), max([top, *(r[0] for r in part)])
            run.advance(int((top - delay) * 1000))
        run.give([(top + 10**6, 600, "C", top + 10**6)])
        run.advance(int((top + 10**5) * 1000))
        assert run.rows() == whole(data, step)
        run.give([(data[5][0], 601, "D", 0.0), (data[5][0] - step, 602, None, 0.0)])
        assert run.rows()[len(whole(data, step)) :] == [("D", data[5][0], 0.0, 1, True), (None, data[5][0] - step, 0.0, 1, True)]
        run.advance(10**13)
        assert run.rows()[-1][:2] == ("C", top + 10**6) and not run.merger.slots and not run.timers
