"""Helpers shared by the operators."""

import pyarrow as pa

from airlake.llm import tables


def test_a_long_task_gives_memory_back_as_it_goes(monkeypatch):
    """Not only when it ends: what a task frees meanwhile would stay with its Python worker."""
    events = []
    monkeypatch.setattr(tables, "give_back", lambda: events.append("given back"))
    big = pa.RecordBatch.from_arrays([pa.array(["x" * tables.GIVE_BACK])], names=["text"])
    small = pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])

    def run(batches):
        for batch in batches:
            events.append(batch.num_rows)
            yield batch

    given = [big, small, small, big, small]
    assert list(tables.tidy(run)(iter(given))) == given
    assert events == [1, "given back", 1, 1, 1, "given back", 1, "given back"]


def test_a_freed_tool_is_given_back_before_the_next_operator_takes_memory(monkeypatch):
    events = []
    monkeypatch.setattr(tables, "give_back", lambda: events.append("given back"))
    monkeypatch.setattr(tables, "_resident", {})
    tables.resident("tool", lambda: "tool of an operator")

    def run(batches):
        events.append(dict(tables._resident))
        yield from batches

    assert list(tables.tidy(run)(iter([]))) == []
    assert events == ["given back", {}, "given back"]
    events.clear()
    tables.resident("tool", lambda: "tool of an operator")
    assert list(tables.tidy(run, keep=True)(iter([]))) == []
    assert events == [{"tool": "tool of an operator"}, "given back"]
