"""How often a run's state is read and written: once for its polls of a batch, with timers that may be early but never late."""

from types import SimpleNamespace

from lotgraph.streaming import polls

HOUR = 3600 * polls.SECOND


class State:
    def __init__(self):
        self.kept, self.calls = None, []

    def exists(self):
        self.calls.append("exists")
        return self.kept is not None

    def get(self):
        self.calls.append("get")
        return self.kept

    def update(self, kept):
        self.calls.append("update")
        self.kept = kept

    def clear(self):
        self.kept = None


class Handle(State):
    def __init__(self):
        super().__init__()
        self.run, self.timers = State(), set()

    def getValueState(self, *_):  # noqa: N802
        return self.run

    def registerTimer(self, at):  # noqa: N802
        self.calls.append("register")
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls.append("delete")
        self.timers.discard(at)


def poll(k, at):
    return SimpleNamespace(at=at, poll_id=k, cancel=False, ok=True, phase="RUNNING", nodes=1, begun=True, terminal=False, fingerprint=str(k))


def fire(runs, handle, mark):
    at = min(handle.timers)
    handle.timers.discard(at)
    return list(runs.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), SimpleNamespace(getExpiryTimeInMs=lambda: at)))


def test_a_batch_of_polls_is_one_read_and_one_write():
    runs, handle = polls.Runs(polls.Limits(hard=100 * 3600, silence=10 * 3600)), Handle()
    runs.init(handle)
    assert list(runs.handleInputRows((1,), [poll(k, k * HOUR) for k in range(6)], None)) == []
    assert list(runs.handleInputRows((1,), [poll(k, k * HOUR) for k in range(6, 9)], None)) == []
    assert handle.run.calls == ["get", "update"] * 2 and handle.calls == ["register"]
    assert fire(runs, handle, 16 * 3_600_000) == [] and handle.timers == {18 * 3_600_000}  # too early: armed again for the silence after the last poll
    (ended,) = fire(runs, handle, 18 * 3_600_000)
    assert (ended.reason, ended.polls, ended.ended_at) == ("silent", 9, polls.instant(18 * HOUR))
    assert list(runs.handleInputRows((1,), [poll(9, 19 * HOUR)], None)) == []
    assert fire(runs, handle, 10**12) == [] and handle.run.kept is None
