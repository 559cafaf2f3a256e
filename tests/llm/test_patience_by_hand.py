"""Patience alignment against the definition, written as a recursion."""

import itertools
import random

from gridspark.llm import linededup


def longest(pairs):
    """Length of a longest increasing choice, by trying all."""
    return max((len(c) for n in range(len(pairs) + 1) for c in itertools.combinations(pairs, n) if all(x[1] < y[1] for x, y in itertools.pairwise(c))), default=0)


def by_hand(a, b):
    """Whether unique lines split the range: the number of anchors of a longest choice."""
    unique = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
    return longest([(a.index(x), b.index(x)) for x in unique])


def test_anchors_are_a_longest_run():
    rng = random.Random(9)
    for _ in range(300):
        a, b = rng.sample(range(9), rng.randint(0, 8)), rng.sample(range(9), rng.randint(0, 8))
        m = linededup.patience(a, b)
        # all lines are unique, so that the alignment is a longest common subsequence
        assert len(m) == by_hand(a, b), (a, b)
        assert all(a[x] == b[y] for x, y in m)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(m))
