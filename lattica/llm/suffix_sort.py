"""Deep-shallow sorting of strings with their common-prefix lengths.

Multikey quicksort orders the strings to a shallow depth. A group that is still
equal there shares long prefixes, where comparing byte by byte is wasteful: it is
ordered by a blind trie, which finds a string's place by branching bytes alone and
then compares it with one string found there, once.
"""

from __future__ import annotations

#: Bytes that multikey quicksort looks at.
SHALLOW = 24


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Branch:
    """A branching depth and the children by the byte there; -1 where a string ends."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int, children: dict):
        self.depth, self.children = depth, children


def blind_trie(strings: list[bytes], group: list[int]) -> tuple[list[int], list[int]]:
    """Order of the group's strings, and of each the common prefix with the one before it (0 for the first).

    Leaves are lists of equal strings.
    """
    root: _Branch | list[int] = [group[0]]
    for i in group[1:]:
        x = strings[i]
        n = len(x)
        node = root
        while type(node) is _Branch:  # blind: branching bytes only
            d = node.depth
            child = node.children.get(x[d] if d < n else -1)
            node = next(iter(node.children.values())) if child is None else child
        y = strings[node[0]]
        same = common_prefix(x, y)
        if same == n == len(y):
            node.append(i)
            continue
        a, b = (x[same] if same < n else -1), (y[same] if same < len(y) else -1)
        above, node = None, root
        while type(node) is _Branch and node.depth < same:
            above, node = node, node.children[x[node.depth]]
        if type(node) is _Branch and node.depth == same:
            node.children[a] = [i]
            continue
        new = _Branch(same, {b: node, a: [i]})
        if above is None:
            root = new
        else:
            above.children[x[above.depth]] = new
    order: list[int] = []
    shared: list[int] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if type(node) is _Branch:
            kids = [node.children[c] for c in sorted(node.children)]
            todo += [(k, node.depth) for k in reversed(kids[1:])]
            todo.append((kids[0], before))
        else:
            for j, i in enumerate(node):
                order.append(i)
                shared.append(len(strings[i]) if j else before)
    return order, shared


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The sorted order of the strings, and of each the length of its common prefix with the one before (0 for the first)."""
    order: list[int] = []
    shared: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if not group:
            continue
        if len(group) == 1 or depth >= shallow:
            own, inner = blind_trie(strings, group) if len(group) > 1 else (group, [0])
            inner[0] = common_prefix(strings[order[-1]], strings[own[0]]) if order else 0
            order += own
            shared += inner
            continue
        keys = [s[depth] if depth < len(s) else -1 for s in map(strings.__getitem__, group)]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less = [i for i, k in zip(group, keys, strict=True) if k < pivot]
        same = [i for i, k in zip(group, keys, strict=True) if k == pivot]
        more = [i for i, k in zip(group, keys, strict=True) if k > pivot]
        todo.append((more, depth))
        todo.append((same, depth + 1 if pivot >= 0 else shallow))
        todo.append((less, depth))
    return order, shared
