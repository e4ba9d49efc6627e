"""Build order of objects that depend on each other."""

from __future__ import annotations

from collections.abc import Iterable
from graphlib import CycleError, TopologicalSorter


def topo_levels(nodes: Iterable[str], edges: Iterable[tuple[str, str]]) -> list[list[str]]:
    """Nodes in levels, each sorted by name and after all its parents; edges with an unknown end are ignored."""
    sorter: TopologicalSorter = TopologicalSorter({n: set() for n in nodes})
    known = set(nodes)
    for parent, child in edges:
        if parent in known and child in known:
            sorter.add(child, parent)
    try:
        sorter.prepare()
    except CycleError as e:
        raise ValueError(f"the objects depend on each other in a circle: {e.args[1]}") from e
    levels = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        levels.append(ready)
        sorter.done(*ready)
    return levels
