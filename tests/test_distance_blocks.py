"""Shortest paths by length over a graph in several blocks."""

import math
import random

import numpy as np
import pytest
from test_distances import check

from wayword.operators import distances, skew
from wayword.operators.reach import CUT, EDGE, EDGE_BITS, FOUND, OUT, Ways, explore


def test_a_round_is_no_edge(spark, monkeypatch):
    """A way of 40 edges within a block is found in the first round."""
    rounds, add = [], distances._Labels.add
    monkeypatch.setattr(distances._Labels, "add", lambda self, rows, *at: rounds.append(1) or add(self, rows, *at))
    check(spark, [(i, 50.0 + 0.001 * i, 8.0) for i in range(41)], [(i, i + 1) for i in range(40)], [(0, 40), (3, 9)])
    assert len(rounds) == 1


@pytest.mark.parametrize("hubs, width_m, max_m", [(False, 100.0, None), (True, None, 300.0)])
def test_blocks_of_few_edges(spark, monkeypatch, hubs, width_m, max_m):
    monkeypatch.setattr(distances, "BLOCK_EDGES", 12)
    if hubs:
        monkeypatch.setattr(skew, "HOT_ROWS", 3)
        monkeypatch.setattr(skew, "HOT_SHARE", 0.05)
    rnd = random.Random(11)
    points = [(i, rnd.choice([50.0, 50.001, 50.002]), 8.0 + 0.001 * (i // 6)) for i in range(30)]
    edges = [(i, (i + rnd.choice([-3, -2, -1, 1, 2, 3])) % 30) for i in range(30) for _ in range(3)]
    edges += [(i, 4) for i in range(5, 25, 3)]
    requests = [(rnd.randrange(30), rnd.choice([4, 7, rnd.randrange(30)])) for _ in range(12)] + [(5, 5), (0, 99)]
    check(spark, points, edges, requests, max_m, width_m)


def ways(block, *edges):
    return Ways({c: np.array([e[k] for e in edges], dtype=np.int64) for k, c in enumerate(EDGE)}, block, 0)


def test_a_search_within_a_block():
    # Backward: from 1 over 2 or 3 to 4, all of block 0; 9 is of block 5. The edge 1 - 4 is as long, and of fewer edges.
    edges = ways(0, (1, 2, 5, 0, 1), (1, 3, 5, 0, 1), (2, 4, 5, 0, 1), (3, 4, 5, 0, 1), (1, 4, 10, 0, 1), (2, 9, 7, 5, 1), (4, 9, 1, 5, 1))
    start = {1: (0, None, None, None, 1)}

    def rows(limit, targets, n_open, first):
        found = {}
        for kind, _, node, length, hops, after, block, _, via, most, piece in explore(
            edges, 1, start, targets, n_open, limit, math.inf, first
        ):
            found[kind, node] = (length, hops, after, block, via, most, piece)
        return found

    # All targets are here: the limit does not count, and the search is bounded by what it has found.
    assert rows(3, [4], 1, True) == {(FOUND, 4): (10, 1, None, None, None, None, [4, 1])}
    # Another target is elsewhere: up to the limit, with what leaves the block and the mark that there is more.
    assert rows(11, [4], 2, True) == {
        (FOUND, 4): (10, 1, None, None, None, None, [4, 1]),
        (OUT, 9): (11, 2, 4, 5, None, None, None),
        (CUT, None): (12, None, None, None, None, None, None),
    }
    assert rows(6, [4], 2, True) == {(CUT, None): (10, None, None, None, None, None, None)}
    # From a door, the piece ends at the door.
    (found,) = explore(edges, 1, {2: ((3 << EDGE_BITS) + 7, 8, 6, None, 1)}, [4], 1, None, math.inf, False)
    assert found == (FOUND, 1, 4, 8, 8, 8, None, None, 6, None, [4, 2])
