"""Edit scripts between nested schemas: the cheapest adds, deletes, renames and moves that turn one tree into the other.

A schema is a tree; its inner nodes are structs, its leaves columns. Siblings have no order. Trees are matched from the
root down: nodes of one name below matched parents match, and what is left over is matched by a minimum-cost
assignment. Renaming costs 1 and needs evidence: leaves with equal values (their ``mark``), or structs whose contents are
cheaper to edit than to build anew. Deleting or adding a subtree costs its number of nodes; a change of type costs
nothing, as it keeps the column.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

INFINITE = 1e9


@dataclass
class Node:
    path: str
    kind: str | None = None
    mark: object = None
    children: dict[str, Node] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.path.rpartition(".")[2]

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children.values())

    def leaves(self) -> Iterable[Node]:
        if not self.children:
            yield self
        for c in self.children.values():
            yield from c.leaves()


def build(columns: Iterable[tuple[str, str | None, object]], nested: bool = True) -> Node:
    """Tree of (path, type, mark); dots in a path separate levels if ``nested``."""
    root = Node("")
    for path, kind, mark in columns:
        at, done = root, []
        for part in path.split(".") if nested else [path]:
            done.append(part)
            at = at.children.setdefault(part, Node(".".join(done)))
        at.kind, at.mark = kind, mark
    return root


def assign(cost: list[list[float]]) -> list[int]:
    """Column of each row in the cheapest perfect assignment of a square matrix (shortest augmenting paths)."""
    n = len(cost)
    u, v, row_of, way = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        row_of[0], j0 = i, 0
        least, used = [float("inf")] * (n + 1), [False] * (n + 1)
        while row_of[j0]:
            used[j0] = True
            i0, delta, j1 = row_of[j0], float("inf"), 0
            for j in range(1, n + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[row_of[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            row_of[j0] = row_of[way[j0]]
            j0 = way[j0]
    out = [0] * n
    for j in range(1, n + 1):
        out[row_of[j] - 1] = j - 1
    return out


Step = tuple[str, str, str]


def _edit(old: Node, new: Node) -> tuple[float, list[Step]]:
    """Cost and steps for what is below two matched nodes."""
    cost, steps = 0.0, []
    for name in sorted(old.children.keys() & new.children.keys()):
        a, b = old.children[name], new.children[name]
        if a.kind != b.kind and not a.children and not b.children:
            steps.append(("TYPE_CHANGED", b.path, ""))
        c, s = _edit(a, b)
        cost, steps = cost + c, steps + s
    gone = [old.children[k] for k in sorted(old.children.keys() - new.children.keys())]
    come = [new.children[k] for k in sorted(new.children.keys() - old.children.keys())]
    pairs: dict[tuple[int, int], tuple[float, list[Step]]] = {}
    for i, a in enumerate(gone):
        for j, b in enumerate(come):
            if a.children and b.children:
                c, s = _edit(a, b)
                pairs[i, j] = (1 + c, s)
            elif not a.children and not b.children and a.mark is not None and a.mark == b.mark:
                pairs[i, j] = (1.0, [])
    n, m = len(gone), len(come)
    kept: dict[int, int] = {}
    if pairs:
        # rows: gone nodes, then one dummy per come node; columns: come nodes, then one dummy per gone node
        matrix = [[pairs[i, j][0] if (i, j) in pairs else INFINITE for j in range(m)] + [float(gone[i].size()) if k == i else INFINITE for k in range(n)] for i in range(n)]
        matrix += [[float(come[j].size()) if k == j else INFINITE for j in range(m)] + [0.0] * n for k in range(m)]
        kept = {i: j for i, j in enumerate(assign(matrix)[:n]) if j < m}
    for i, j in kept.items():
        c, s = pairs[i, j]
        cost, steps = cost + c, [*steps, ("COLUMN_RENAMED", come[j].path, gone[i].path), *s]
    for i, a in enumerate(gone):
        if i not in kept:
            cost += a.size()
            steps += [("COLUMN_REMOVED", leaf.path, "") for leaf in a.leaves()]
    for j, b in enumerate(come):
        if j not in kept.values():
            cost += b.size()
            steps += [("COLUMN_ADDED", leaf.path, "") for leaf in b.leaves()]
    return cost, steps


def edit_script(old: Node, new: Node) -> tuple[float, list[Step]]:
    """(cost, steps); a step is (type, path, old path or '').

    A leaf that is deleted in one place and added in another with the same name and values is one move at cost 1.
    """
    cost, steps = _edit(old, new)
    marks_old, marks_new = {x.path: x.mark for x in old.leaves()}, {x.path: x.mark for x in new.leaves()}
    added: dict[tuple[str, object], list[str]] = {}
    for kind, path, _ in steps:
        if kind == "COLUMN_ADDED" and marks_new[path] is not None:
            added.setdefault((path.rpartition(".")[2], marks_new[path]), []).append(path)
    out, moved = [], set()
    for kind, path, before in steps:
        target = added.get((path.rpartition(".")[2], marks_old.get(path))) if kind == "COLUMN_REMOVED" else None
        if target:
            to = target.pop(0)
            moved.add(to)
            out.append(("COLUMN_MOVED", to, path))
            cost -= 1
        else:
            out.append((kind, path, before))
    return cost, [s for s in out if not (s[0] == "COLUMN_ADDED" and s[1] in moved)]
