"""Deep-shallow sorting of byte strings with longest common prefixes.

Multikey quicksort down to a shallow depth; groups that are still equal there are
ordered by a blind trie (a Patricia trie that knows branching depths and bytes
only: an insertion walks down blindly, compares once with the leaf it comes to,
and branches where they differ).
"""

from __future__ import annotations

SHALLOW = 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def _at(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def _blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """Order of ``group`` (equal strings keep their order)."""
    # node: (branching depth, {byte: node}); leaf: list of equal strings
    root = [group[0]]
    for i in group[1:]:
        s, node = strings[i], root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(_at(s, depth)) or next(iter(children.values()))
        leaf = strings[node[0]]
        if leaf == s:
            node.append(i)
            continue
        at = common_prefix(leaf, s)
        parent, node = None, root
        while isinstance(node, tuple) and node[0] < at:
            parent = node
            node = node[1][_at(s, node[0])]
        if isinstance(node, tuple) and node[0] == at:
            node[1][_at(s, at)] = [i]
            continue
        branch = (at, {_at(leaf, at): node, _at(s, at): [i]})
        if parent is None:
            root = branch
        else:
            parent[1][_at(s, parent[0])] = branch
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            order += node
    return order


def sort_strings(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, lcp): lcp[i] is the common prefix of the strings at order[i - 1], order[i]."""
    order: list[int] = []
    if strings:
        base = min(common_prefix(strings[0], s) for s in strings)  # all share it: nothing to sort on
        stack = [(list(range(len(strings))), base)]
        while stack:
            group, depth = stack.pop()
            if len(group) == 1:
                order += group
            elif depth >= base + shallow:
                order += _blind_trie(strings, group)
            else:
                pivot = _at(strings[group[len(group) // 2]], depth)
                less = [i for i in group if _at(strings[i], depth) < pivot]
                same = [i for i in group if _at(strings[i], depth) == pivot]
                more = [i for i in group if _at(strings[i], depth) > pivot]
                if more:
                    stack.append((more, depth))
                if pivot < 0:  # ended strings: equal
                    stack += [([i], depth) for i in reversed(same)]
                else:
                    stack.append((same, depth + 1))
                if less:
                    stack.append((less, depth))
    return order, [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
