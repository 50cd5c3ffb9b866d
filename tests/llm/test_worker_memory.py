"""What one operator leaves in a reused Python worker is gone when another's tasks run there."""

from __future__ import annotations

from functools import lru_cache

import pytest

pytest.importorskip("fleetquarry.llm.common")
from fleetquarry.llm import byte_bpe, common  # noqa: E402


def test_caches_go_with_their_operator():
    made = []

    @lru_cache(2)
    def model(path):
        made.append(path)
        return bytearray(1000)

    for operator, caches, count in (("a", (model,), 1), ("a", (model,), 1), ("b", (), 1), ("a", (model,), 2), ("b", (), 2)):
        common.enter(operator, *caches)
        if caches:
            model("x")
        assert len(made) == count
    assert model.cache_info().currsize == 0


def test_the_vocabulary_goes_when_another_stage_starts(spark):
    from fleetquarry.llm.queries import pattern, vocabulary

    path, rule = vocabulary("byte_bpe_multi_50k.tiktoken"), pattern()
    common.enter("byte_bpe", byte_bpe._codec)
    byte_bpe._codec(path, rule)
    common.enter("language_id")
    assert byte_bpe._codec.cache_info().currsize == 0
