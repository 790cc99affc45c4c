"""Deep-shallow suffix sorting.

Suffixes are sorted by multikey quicksort, eight bytes as one symbol, down to
a shallow depth: in each round every open group is split into three by a pivot
of its own, the median of three of its symbols, and the part that equals the
pivot moves on to the next symbol. What then still agrees has a long common
prefix; each such group goes into a blind trie, which looks at single branching
bytes on the way down and compares a suffix with one other only. Groups too
large for a trie are split further until they are small, or equal to the end.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16
#: A trie of more suffixes than this would cost more than it saves.
LARGEST_TRIE = 512


def _symbols(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as one big-endian number."""
    view = np.lib.stride_tricks.as_strided(flat, shape=(len(flat) - 7, 8), strides=(1, 1))
    return np.ascontiguousarray(view[at]).view(">u8").ravel().astype(np.uint64)


def _open_groups(group: np.ndarray) -> np.ndarray:
    """Mask of the members of groups that have more than one."""
    if len(group) < 2:
        return np.zeros(len(group), dtype=bool)
    same = group[1:] == group[:-1]
    return np.concatenate(([False], same)) | np.concatenate((same, [False]))


class BlindTrie:
    """Sorts strings of one length. An inner node is (depth, {byte: child}); a leaf is the list of the positions of equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: tuple[int, dict] | list[int] | None = None
        for i in range(len(strings)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node, path = self.root, []
        while type(node) is tuple:  # blindly: only the branching byte is looked at
            path.append(node)
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if other == s:
            node.append(i)
            return
        differ = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        common = len(s) - (differ.bit_length() + 7) // 8
        # The branch belongs above the first node on the path that is as deep.
        above, node = None, self.root
        for inner in path:
            if inner[0] >= common:
                node = inner
                break
            above, node = inner, inner[1].get(s[inner[0]])
        if type(node) is tuple and node[0] == common:
            node[1][s[common]] = [i]
            return
        joint = common, {s[common]: [i], other[common]: node}
        if above is None:
            self.root = joint
        else:
            above[1][s[above[0]]] = joint

    def in_order(self) -> list[list[int]]:
        out, stack = [], [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def sort_suffixes(flat: np.ndarray, at: np.ndarray, depth: int, first_group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): ``at[order]`` sorted by their first ``depth`` bytes, and for each, in that order, the number of its group of equal prefixes.

    Bytes past ``depth`` are not compared; all suffixes must have that many. With ``first_group``, suffixes are sorted within these groups.
    """
    flat = np.concatenate((flat, np.zeros(8, np.uint8)))
    order = np.arange(len(at)) if first_group is None else np.argsort(first_group, kind="stable")
    group = np.zeros(len(at), dtype=np.int64) if first_group is None else _renumber(first_group[order])
    known = np.zeros(len(at), dtype=np.int64)  # bytes in which the group of a position agrees
    live = np.flatnonzero(_open_groups(group))
    while len(live):
        starts = np.flatnonzero(np.concatenate(([True], group[live][1:] != group[live][:-1])))
        sizes = np.diff(np.append(starts, len(live)))
        deep = (known[live[starts]] >= SHALLOW) & (sizes <= LARGEST_TRIE)
        if deep.any():
            mask = np.repeat(deep, sizes)
            _deep(flat, at, order, group, live[mask], SHALLOW, depth)
            live, sizes = live[~mask], sizes[~deep]
            starts = np.cumsum(sizes) - sizes
            if not len(live):
                break
        # One round of multikey quicksort in all open groups: less than, equal to and greater than a pivot.
        agree = known[live]
        back = np.maximum(agree + 8 - depth, 0)  # the last symbol may begin earlier: what it repeats is equal anyway
        key = _symbols(flat, at[order[live]] + agree - back)
        low, middle, high = key[starts], key[starts + sizes // 2], key[starts + sizes - 1]
        pivot = np.repeat(np.maximum(np.minimum(low, middle), np.minimum(np.maximum(low, middle), high)), sizes)
        side = np.repeat(np.arange(len(starts)) * 3 + 1, sizes) + (key > pivot) - (key < pivot)
        sorted_live = np.argsort(side, kind="stable")
        order[live], side = order[live][sorted_live], side[sorted_live]
        # Numbers may skip: a member's group is the position of its first member.
        group[live] = live[np.maximum.accumulate(np.where(np.concatenate(([True], side[1:] != side[:-1])), np.arange(len(live)), 0))]
        known[live] = agree + np.where(side % 3 == 1, 8, 0)  # the equal ones move on to their next symbol
        live = live[_open_groups(side) & (known[live] < depth)]
    return order, _renumber(group)


def _renumber(group: np.ndarray) -> np.ndarray:
    """The position of the first member, for a sorted array of group marks."""
    if not len(group):
        return group.astype(np.int64)
    new = np.concatenate(([True], group[1:] != group[:-1]))
    return np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))


def _deep(flat: np.ndarray, at: np.ndarray, order: np.ndarray, group: np.ndarray, live: np.ndarray, level: int, depth: int) -> None:
    """Finish the groups at positions ``live`` by blind tries, in place."""
    if not len(live):
        return
    width = depth - level
    rest = np.lib.stride_tricks.as_strided(flat, shape=(len(flat) - width + 1, width), strides=(1, 1))[at[order[live]] + level]
    raw = np.ascontiguousarray(rest).tobytes()
    members = order[live].tolist()
    ends = np.append(np.flatnonzero(group[live][1:] != group[live][:-1]) + 1, len(live)).tolist()
    begin, new_order, new_group, base = 0, [], [], live.tolist()
    for end in ends:
        strings = [raw[i * width : (i + 1) * width] for i in range(begin, end)]
        if strings.count(strings[0]) == len(strings):
            new_order += members[begin:end]
            new_group += [base[begin]] * (end - begin)
        else:
            for equal in BlindTrie(strings).in_order():
                new_group += [base[len(new_order)]] * len(equal)
                new_order += [members[begin + i] for i in equal]
        begin = end
    order[live] = new_order
    group[live] = new_group
