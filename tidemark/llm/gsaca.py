"""Linear grouping suffix sorting: suffixes are first sorted into groups by their longest Lyndon prefix, from the highest
group down, by previous-smaller pointers; then each group's order falls out of one ascending sweep. No renaming, no
recursion."""

from __future__ import annotations

import numpy as np


def suffix_array(text: bytes) -> np.ndarray:
    """Starts of all suffixes of text in ascending order (the empty suffix is left out)."""
    n = len(text)
    chars = sorted(set(text))
    rank = {c: i + 1 for i, c in enumerate(chars)}
    group = [rank[c] for c in text]
    top = len(chars)
    members: list[list[int]] = [[] for _ in range(top + 2)]  # 0: the empty suffix; top + 1: above all
    for i, g in enumerate(group):
        members[g].append(i)
    below, above, done = list(range(-1, top + 1)), list(range(1, top + 3)), [False] * (top + 2)
    smaller = [-1] * n  # the nearest earlier suffix in a lower group
    at, top_down = top, []
    while at > 0:
        done[at] = True
        top_down.append(at)
        reach: dict[int, int] = {}
        for s in sorted(i for i in members[at] if group[i] == at):
            j = s - 1
            while j >= 0 and done[group[j]]:
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                reach[j] = reach.get(j, 0) + 1
        # A suffix that this group extends moves to a new group right above its old one; the more copies follow, the higher.
        order = reach.items() if not reach or max(reach.values()) == 1 else sorted(reach.items(), key=lambda x: -x[1])
        fresh: dict[tuple[int, int], int] = {}
        for j, times in order:
            old = group[j]
            new = fresh.get((times, old))
            if new is None:
                new = fresh[times, old] = len(members)
                members.append([])
                done.append(False)
                up = above[old]
                below.append(old)
                above.append(up)
                below[up] = above[old] = new
            members[new].append(j)
            group[j] = new
        members[at] = []
        at = below[at]
    starts, total = {}, 0
    sizes: dict[int, int] = {}
    for g in group:
        sizes[g] = sizes.get(g, 0) + 1
    for g in reversed(top_down):
        starts[g] = total
        total += sizes.get(g, 0)
    out, placed = [-1] * n, [False] * n
    x = n
    for i in range(-1, n):
        if i >= 0:
            x = out[i]
        j = x - 1
        while j >= 0 and not placed[j]:
            out[starts[group[j]]] = j
            starts[group[j]] += 1
            placed[j] = True
            j = smaller[j]
    return np.array(out, np.int64)


def suffix_arrays(buf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of many texts, text by text, each text's in ascending order.

    Text t is buf[first[t]:first[t + 1]] and its suffixes end there. The same construction as above, with every text at
    its own group in each pass: a pass takes the highest group left of every text, so its operations are on arrays.
    """
    n, m = len(buf), len(first) - 1
    if not n:
        return np.zeros(0, np.int64)
    lens = np.diff(first)
    text = np.repeat(np.arange(m), lens)
    place = np.arange(n) + text + 1  # a wall before each text; its group is 0, which is never done
    size = n + m + 1
    alphabet = np.zeros(256, np.int64)
    alphabet[buf] = 1
    width = int(alphabet.sum())
    own = text * width + (np.cumsum(alphabet) - 1)[buf]
    times = np.bincount(own, minlength=m * width)
    there = times > 0
    group_of = (np.cumsum(there) - 1)[own]
    n_groups = int(there.sum())
    owner = np.flatnonzero(there) // width
    room = n_groups + n + 2
    group = np.zeros(size, np.int64)
    group[place] = group_of + 1
    below, above = np.zeros(room, np.int64), np.zeros(room, np.int64)
    first_of = np.ones(n_groups, bool)
    first_of[1:] = owner[1:] != owner[:-1]
    ids = np.arange(1, n_groups + 1)
    below[ids] = np.where(first_of, 0, ids - 1)
    above[ids] = np.where(np.append(first_of[1:], True), 0, ids + 1)
    held = np.zeros(room, np.int64)  # members left
    held[ids] = times[there]
    pool = np.empty(2 * n + 1, np.int64)  # members of each group when it was made, group by group
    pool[:n] = place[np.argsort(group_of, kind="stable")]
    begin, made = np.zeros(room, np.int64), np.zeros(room, np.int64)
    made[ids] = held[ids]
    begin[ids] = np.cumsum(made[ids]) - made[ids]
    used, top = n, n_groups + 1
    done, smaller = np.zeros(room, bool), np.zeros(size, np.int64)
    mark, extends = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = ids[np.append(first_of[1:], True)]
    order: list[np.ndarray] = []
    while len(at):
        order.append(at)
        done[at] = True
        count = made[at]
        which = np.repeat(begin[at] - np.cumsum(count) + count, count) + np.arange(count.sum())
        s = pool[which]
        s = s[group[s] == np.repeat(at, count)]
        smaller[s] = s - 1
        todo = s
        while len(todo):  # over what is done, from pointer to pointer
            j = smaller[todo]
            go = done[group[j]]
            todo, j = todo[go], j[go]
            smaller[todo] = smaller[j]
        j = smaller[s]
        j = j[group[j] > 0]
        if len(j):
            # A suffix that this group extends moves to a new group right above its old one; the more copies follow, the higher.
            nth = np.arange(len(j))
            mark[j] = nth
            times = None
            once = mark[j] == nth
            if not once.all():
                np.add.at(extends, j, 1)
                j = j[once]
                times = extends[j]
                extends[j] = 0
            old = group[j]
            key = old if times is None else old * (int(times.max()) + 1) + times
            by = np.argsort(key, kind="stable")
            j, old, key = j[by], old[by], key[by]
            new = np.ones(len(j), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.flatnonzero(new)
            fresh = np.arange(top, top + len(head))
            group[j] = np.repeat(fresh, many := np.diff(np.append(head, len(j))))
            made[fresh] = held[fresh] = many
            begin[fresh] = used + head
            pool[used : used + len(j)] = j
            used, top = used + len(j), top + len(head)
            from_ = old[head]
            if times is None:
                held[from_] -= many
                up = above[from_]
                below[fresh], above[fresh] = from_, up
                below[up] = above[from_] = fresh
            else:
                np.subtract.at(held, from_, many)
                low, high = np.ones(len(head), bool), np.ones(len(head), bool)
                low[1:] = from_[1:] != from_[:-1]
                high[:-1] = low[1:]
                up = above[from_[high]]
                below[fresh] = np.where(low, from_, fresh - 1)
                above[fresh] = fresh + 1
                above[fresh[high]] = up
                below[up] = fresh[high]
                above[from_[low]] = fresh[low]
        at = below[at]
        gone = np.flatnonzero((held[at] == 0) & (at > 0))
        while len(gone):  # groups whose members have all moved
            at[gone] = next_ = below[at[gone]]
            gone = gone[(held[next_] == 0) & (next_ > 0)]
        at = at[at > 0]
    # Ascending sweep of every text at once: the suffix before each found one is the next of its group, then along the pointers.
    groups = np.concatenate(order[::-1])
    whose = np.zeros(room, np.int64)
    whose[group[place]] = text
    groups = groups[np.argsort(whose[groups], kind="stable")]
    starts = np.zeros(room, np.int64)
    starts[groups] = np.cumsum(held[groups]) - held[groups]
    out, placed = np.zeros(n, np.int64), np.zeros(size + 1, bool)
    placed[first + np.arange(m + 1)] = True  # the walls
    by = np.argsort(-lens, kind="stable")
    x, left = first[:-1][by], lens[by]
    j = place[np.maximum(first[1:][by] - 1, 0)]
    for step in range(int(lens.max()) + 1):
        if step:
            on = int(np.searchsorted(-left, -step, "right"))  # texts with a suffix of this rank
            j = out[x[:on] + (step - 1)] - 1
        else:
            j = j[left > 0]
        j = j[~placed[j]]
        while len(j):
            g = group[j]
            a = starts[g]
            out[a] = j
            starts[g] = a + 1
            placed[j] = True
            j = smaller[j]
            j = j[~placed[j]]
    return out - np.repeat(np.arange(m), lens) - 1
