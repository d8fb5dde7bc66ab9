import random

import pyarrow as pa

from textloom.llm import blocks as bl


def test_blocks_of_a_column_are_those_of_its_texts():
    rng = random.Random(1)
    texts = [rng.choice([None, "", "a", "日本語", "🤖é"]) if rng.random() < 0.3 else "xé" * rng.randrange(40) for _ in range(300)]
    column = pa.array(["cut off", *texts], pa.string()).slice(1)
    for limit in (1, 7, 50, 10_000):
        assert list(bl.text_blocks(column, limit)) == list(bl.blocks([t or "" for t in texts], limit))
    assert list(bl.text_blocks(pa.array([], pa.string()))) == [] == list(bl.blocks([]))
    assert list(bl.text_blocks(pa.array([None, None], pa.string()))) == [(0, ["", ""])]


def test_a_column_is_not_turned_into_strings_at_once(monkeypatch):
    held = []
    real = bl.texts_of
    monkeypatch.setattr(bl, "texts_of", lambda column: held.append(len(column)) or real(column))
    assert sum(len(part) for _, part in bl.text_blocks(pa.array(["x" * 10] * 1000), 100)) == 1000
    assert max(held) == 10


def test_memory_is_returned_after_the_last_batch_is_dropped(monkeypatch):
    order = []

    class Pool:
        def release_unused(self):
            order.append("returned")

    monkeypatch.setattr(pa, "default_memory_pool", Pool)

    @bl.give_back
    def run(batches):
        try:
            for batch in batches:
                yield batch
        finally:
            order.append("ended")

    assert list(run(iter([1, 2]))) == [1, 2] and order == ["ended", "returned"]
