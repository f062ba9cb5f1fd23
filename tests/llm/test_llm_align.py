"""Alignment of pages: one exact rule for short and long sequences."""

import random

from sheetloom.llm import wrapper as W


def _plain(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _nodes(names: list[str]) -> list[W.Node]:
    return [W.Node(n, []) for n in names]


def _found(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    return W._pairs(_nodes(a), _nodes(b))


def test_short_and_long_sequences_follow_one_rule():
    dice = random.Random(5)
    for size in [*range(12), 200, 1200]:
        a, b = (["<", *dice.choices("abcdef", k=size), *own] for own in ("x", "y"))
        assert _found(a, b) == _plain(a, b)


def test_what_stands_far_ahead_is_found_on_long_pages():
    """Of 2,000 common elements none is lost behind 200 that only one page has."""
    common = [f"c{i}" for i in range(2000)]
    a, b = ["x", *common, "y"], [*(f"d{i}" for i in range(200)), *common, "z"]
    assert _found(a, b) == [(i + 1, i + 200) for i in range(2000)]


def test_groups_are_alike_if_they_begin_alike():
    def group(*names):
        return W.Node("()", _nodes(list(names)), repeated=True)

    assert W._pairs([group("p", "ul"), *_nodes(["h2"])], [group("p", "dl"), group("p", "ul"), *_nodes(["p"])]) == [(0, 1)]
