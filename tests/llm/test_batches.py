"""What a Python worker keeps between the tasks of operators."""

import pyarrow as pa
import pytest

llm = pytest.importorskip("lakevec.llm")
from pyspark import cloudpickle  # noqa: E402

from lakevec.llm import batches  # noqa: E402


def shipped(make):
    """``map_texts`` as a worker gets it."""
    return cloudpickle.loads(cloudpickle.dumps(batches.map_texts(make)))


def with_memo(key):
    def make():
        memo = batches.process_memo((key,), lambda: batches.Memo(lambda words: [len(w) for w in words]))

        def step(part):
            memo.learn(set(part.column("text").to_pylist()))
            return part

        return step

    return make


def test_a_worker_keeps_only_the_memo_of_the_operator_at_work():
    rows = pa.RecordBatch.from_pydict({"text": ["a", "bb"]})
    assert [b.num_rows for b in shipped(with_memo("one"))([rows])] == [2]
    kept = batches._memo[("one",)]
    list(shipped(with_memo("one"))([rows]))
    assert batches._memo[("one",)] is kept and kept.known == {"a": 1, "bb": 2}
    list(shipped(with_memo("two"))([rows]))
    assert list(batches._memo) == [("two",)]
    assert list(shipped(lambda: lambda part: part)([])) == []
    assert batches._memo == {}


def test_a_task_that_is_given_up_or_fails_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(batches, "give_back", lambda: calls.append(1))
    rows = pa.RecordBatch.from_pydict({"text": ["a"]})
    run = batches.map_texts(lambda: lambda part: part)([rows, rows])
    next(run)
    run.close()
    with pytest.raises(ZeroDivisionError):
        list(batches.map_texts(lambda: lambda part: 1 / 0)([rows]))
    assert len(calls) == 2
