import math

import numpy as np
import pytest

from chronoweave.operators import search
from chronoweave.operators.search import Range


def test_designs():
    space = {"a": Range(0.01, 100, log=True), "k": Range(1, 5, integer=True), "x": Range(-1, 1)}
    regular = search.design("regular", space, 3)
    assert len(regular) == 27 and {round(s["a"], 9) for s in regular} == {0.01, 1.0, 100.0} and {s["k"] for s in regular} == {1, 3, 5}
    for kind in ("random", "latin_hypercube", "max_entropy"):
        sets = search.design(kind, space, 12)
        assert sets == search.design(kind, space, 12) and len(sets) == 12
        assert all(0.01 <= s["a"] <= 100 and s["k"] in range(1, 6) and isinstance(s["k"], int) and -1 <= s["x"] <= 1 for s in sets)
    strata = sorted(int((math.log10(s["a"]) + 2) / 4 * 12) for s in search.design("latin_hypercube", space, 12))
    assert strata == list(range(12))
    with pytest.raises(ValueError):
        search.design("none", space, 3)


def test_max_entropy_spreads():
    """The chosen sets' correlation determinant beats that of random ones, and each step is the greedy choice."""
    space = {"u": Range(0, 1), "v": Range(0, 1)}

    def volume(kind, seed):
        x = np.array([[s["u"], s["v"]] for s in search.design(kind, space, 8, seed)])
        return np.linalg.slogdet(np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 0.25 ** 2)))[1]
    assert volume("max_entropy", 1) > max(volume("random", s) for s in range(50))


def test_integers_that_round_together_are_one():
    assert len(search.design("random", {"k": Range(1, 3, integer=True)}, 50)) == 3
