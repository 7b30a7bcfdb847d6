"""Tasks of the pipeline's later stages give back what their arrays took, as those of the first two do."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tallyvault.llm import chaining, decontamination, packing, shared

NONE = np.zeros(0, np.uint64)
TASKS = {
    "seeds": chaining._seeds(NONE),
    "firsts": chaining._firsts(NONE, NONE),
    "chained": chaining._chained,
    "slices": chaining._slices,
    "untouched": chaining._untouched,
    "cut": chaining._cut,
    "search": decontamination._search(None),
    "pieces": packing._cut("", 4, False),
    "placed": packing._placed(None),
}


@pytest.mark.parametrize("name", TASKS)
def test_a_task_gives_memory_back_when_it_ends(monkeypatch, name):
    released = []

    class Pool:
        def release_unused(self):
            released.append(name)

    monkeypatch.setattr(shared.pa, "default_memory_pool", Pool)
    assert list(TASKS[name](iter([]))) == [] and released == [name]


def test_memory_is_given_back_when_a_task_fails(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(shared.pa, "default_memory_pool", Pool)
    with pytest.raises(KeyError):
        list(chaining._untouched(iter([pa.RecordBatch.from_pydict({"doc_id": [1]})])))
    assert released == [1]
