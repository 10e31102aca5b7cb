"""A search by length within one block of a graph: Dijkstra's algorithm over Arrow tables.

Searches go backward, from the end of a path. Labels of a search enter a block at some of its vertices (doors); from there
all vertices of the block up to a length are settled. What leaves the block is a label for a door of another one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa

# A label is one number: its length in millimetres, then its edges in so many bits.
EDGE_BITS = 32
EDGE_MASK = (1 << EDGE_BITS) - 1

# Labels of so many targets are looked at with every vertex.
WATCHED = 4

# What a row is: a label for another block, a label of a vertex that was asked for, or a search that was cut at the limit.
OUT, FOUND, CUT = 0, 1, 2

NUMBERS = ["search", "node", "length", "hops", "next", "block", "parts", "via", "most"]
EDGE = ["node", "to", "length", "to_block", "to_parts"]
SCHEMA = ", ".join(["kind int", *(f"{c} bigint" for c in NUMBERS), "piece array<bigint>"])


def last_of(length: int | float) -> int | float:
    """The largest label of so many millimetres."""
    return length if length == math.inf else length << EDGE_BITS | EDGE_MASK


class Ways(dict):
    """For a vertex the edges into it by length: ``(label, from)`` in the block, ``(label, from, block, parts)`` out of it.

    Lists are made when a search first asks for them.
    """

    def __init__(self, edges: dict[str, np.ndarray], block: int, salt: int):
        super().__init__()
        order = np.lexsort((edges["length"], edges["node"]))
        self.columns = {name: values[order] for name, values in edges.items()}
        # The rest of a hub's edges lies apart from its block, and a hub itself is entered by a door only.
        self.inside = (self.columns["to_block"] == block) & (self.columns["to_parts"] == 1) & (salt == 0)
        nodes, first = np.unique(self.columns["node"], return_index=True)
        ends = np.append(first[1:], len(order))
        self.places = dict(zip(nodes.tolist(), zip(first.tolist(), ends.tolist())))

    def __missing__(self, node: int) -> tuple[list, list]:
        inside, out = [], []
        if node in self.places:
            at = slice(*self.places[node])
            rows = zip(*(self.columns[c][at].tolist() for c in ("length", "to", "to_block", "to_parts")))
            for (length, to, block, parts), near in zip(rows, self.inside[at].tolist()):
                label = (length << EDGE_BITS) + 1
                inside.append((label, to)) if near else out.append((label, to, block, parts))
        self[node] = inside, out
        return self[node]


def explore(
    ways: Ways, search: int, doors: dict[int, tuple], targets: list[int], n_open: int,
    limit: int | None, cap: int | float, first: bool,
) -> list[tuple]:
    """Settle a search in a block; its rows of ``SCHEMA`` without ``via`` of what leaves.

    ``doors`` has ``label, next, via, most, parts`` by vertex, ``targets`` are the vertices asked for, of ``n_open`` that
    the search has in all blocks. Labels may not be longer than ``limit``, or than ``most`` where doors have that: then no
    vertex asked for is farther away. Without a limit only the targets count. Nothing beyond ``cap`` does.
    """
    tracing = limit is None
    if tracing and not targets:
        return []
    whole = len(targets) == n_open
    most = min((door[3] for door in doors.values() if door[3] is not None), default=None)
    # In the first round, a search with all its targets in the block where it begins runs until it has them, whatever the
    # limit. How far that was bounds the search from then on in all blocks, as its labels there come from this one.
    alone = first and not tracing and whole and search in doors and doors[search][4] == 1
    last = last_of(cap)
    if most is not None:
        last = min(last, last_of(most))
    elif not tracing and not alone:
        last = min(last, last_of(limit))
    best = {node: door[0] for node, door in doors.items()}
    nexts = {node: door[1] for node, door in doors.items()}
    heap = [(label, node) for node, label in best.items()]
    heapify(heap)
    left, outs, cut = set(targets), {}, math.inf
    # With a label for every target, none that is longer is of use, even before they are final.
    watched = targets if whole and len(targets) <= WATCHED else ()
    while heap:
        label, node = heappop(heap)
        if label > last:
            cut = min(cut, label)
            break
        if label > best[node]:
            continue
        if node in left:
            left.remove(node)
            if whole and not left:
                # Equal lengths are settled too, as a path of fewer edges may come with them.
                last = label | EDGE_MASK
        elif watched:
            far = max([best.get(to, math.inf) for to in watched])
            if far < last:
                last = far | EDGE_MASK
        inside, out = ways[node]
        for edge, to in inside:
            further = label + edge
            if further > last:
                cut = min(cut, further)
                break
            known = best.get(to)
            if known is None or further < known:
                best[to], nexts[to] = further, node
                heappush(heap, (further, to))
            elif further == known and node < nexts[to]:
                nexts[to] = node
        for edge, to, block, parts in out:
            further = label + edge
            if further > last:
                cut = min(cut, further)
                break
            if to not in outs or (further, node) < outs[to][:2]:
                outs[to] = further, node, block, parts
    done = whole and not left
    if alone and done:
        most = last >> EDGE_BITS
    elif alone:
        # It has to leave the block for the others, up to the limit like any search.
        last = min(last, last_of(limit))
    rows = []
    for node in targets:
        if node in left:
            continue
        label = best[node]
        if label > last:
            cut = min(cut, label)
            continue
        piece = [node]
        while (after := nexts[piece[-1]]) is not None and after in best:
            piece.append(after)
        via = None if after is None else doors[piece[-1]][2]
        rows.append((FOUND, search, node, label >> EDGE_BITS, label & EDGE_MASK, after, None, None, via, None, piece))
    if tracing:
        return rows
    for to, (label, node, block, parts) in outs.items():
        if label <= last:
            rows.append((OUT, search, to, label >> EDGE_BITS, label & EDGE_MASK, node, block, parts, None, most, None))
        else:
            cut = min(cut, label)
    if most is None and not done and cut < math.inf:
        rows.append((CUT, search, None, cut >> EDGE_BITS, None, None, None, None, None, None, None))
    return rows


def explorer(limit: int | None, cap: int | float, first: bool) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """A function for the labels and targets of a block and its edges."""
    names = ["kind", *NUMBERS, "piece"]
    types = [pa.int32(), *(pa.int64() for _ in NUMBERS), pa.list_(pa.int64())]

    def work(key: tuple, front: pa.Table, edges: pa.Table) -> pa.Table:
        block, salt, _ = (k.as_py() for k in key)
        flat = {c: edges.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in EDGE}
        searches: dict[int, tuple[dict, list, int]] = {}
        taken = ("search", "node", "length", "hops", "next", "via", "most", "parts", "open")
        for search, node, length, hops, after, via, most, parts, n_open in zip(*(front.column(c).to_pylist() for c in taken)):
            doors, targets, _ = searches.setdefault(search, ({}, [], n_open))
            if length is None:
                targets.append(node)
            else:
                doors[node] = (length << EDGE_BITS) + hops, after, via, most, parts
        ways, rows = Ways(flat, block, salt), []
        for search, (doors, targets, n_open) in searches.items():
            rows += explore(ways, search, doors, targets, n_open, limit, cap, first)
        made = dict(zip(names, zip(*rows))) if rows else {c: () for c in names}
        made["via"] = [block if kind == OUT else via for kind, via in zip(made["kind"], made["via"])]
        made["block"] = [block if kind == CUT else to for kind, to in zip(made["kind"], made["block"])]
        return pa.table([pa.array(made[c], kind) for c, kind in zip(names, types)], names=names)

    return work
