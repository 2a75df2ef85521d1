"""Decontamination by items that are too short for edits."""

import pytest

from rillframe.llm import decontamination

ITEMS = [(1, "Who wrote Emma?"), (2, "法国的首都是哪里？"), (3, "is it so"), (4, "the"), (5, "2 + 2")]


@pytest.mark.parametrize(("text", "found"), [
    ("Q: who wrote  EMMA? Jane Austen", [1]), ("who wrote Emmas", []), ("somewho wrote emma", []), ("who wrote Emma", [1]), ("who wrote em ma", []),
    ("问题：法国的首都是哪里？巴黎", [2]), ("请问法国的首都是哪里呢", [2]), ("法国的首都是那里", []), ("this is it so they say", [3]), ("this it so", []), ("the the", []), ("12 21 and 2-2", [5]),
    ("this it so, but is it so", [3]), ("", []),
])
def test_short_items_match_whole_and_unchanged(text, found):
    matcher = decontamination.Matcher(ITEMS, decontamination.Config())
    assert [(item, distance) for item, distance, _ in matcher.matches(text)] == [(i, 0) for i in found]
