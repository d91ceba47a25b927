"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are of type S if smaller than the next suffix, else L; leftmost S suffixes (LMS) of each run are sorted,
and all others follow from their order: one pass upwards over the buckets of first symbols places the L suffixes, one
pass downwards the S suffixes. A pass handles a whole bucket at a time, so its work is linear and vectorised.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128 << 10  # places compared at once


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS positions in order (of suffixes, or of LMS substrings in the first round)."""
    n, alphabet = len(text), len(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    array = np.full(n, -1, dtype=np.int32)
    head, tail = starts[:-1].copy(), starts[1:].copy()
    by_symbol = lms[np.argsort(text[lms], kind="stable")]
    seeds = np.concatenate([[0], np.cumsum(np.bincount(text[lms], minlength=alphabet))])

    def put(found: np.ndarray, forward: bool) -> None:
        """Append ``found`` to the buckets of their first symbols, in order."""
        symbols = text[found]
        order = np.argsort(symbols, kind="stable")
        counts = np.bincount(symbols, minlength=alphabet)
        first = np.cumsum(counts) - counts
        rank = np.arange(len(found)) - np.repeat(first, counts)
        symbols = symbols[order]
        if forward:
            array[head[symbols] + rank] = found[order]
            head[:] += counts
        else:
            array[tail[symbols] - 1 - rank] = found[order]
            tail[:] -= counts

    def before(found: np.ndarray, s_type: bool) -> np.ndarray:
        previous = found[found > 0] - 1
        return previous[is_s[previous] == s_type]

    if not is_s[n - 1]:  # the empty suffix behind the text comes first and induces the last one
        put(np.array([n - 1], dtype=np.int32), True)
    used = np.flatnonzero(sizes)
    for c in used:
        done = starts[c]
        while done < head[c]:  # runs of one symbol add to the bucket in hand
            part = array[done : head[c]].copy()
            done = head[c]
            put(before(part, False), True)
        put(before(by_symbol[seeds[c] : seeds[c + 1]], False), True)
    for c in used[::-1]:
        done = starts[c + 1]
        while done > tail[c]:
            part = array[tail[c] : done][::-1].copy()
            done = tail[c]
            put(before(part, True), False)
        put(before(array[starts[c] : head[c]][::-1], True), False)
    return array


def _names(text: np.ndarray, ordered: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of LMS substrings in their order; equal substrings get one name. end: last position of the one at a place."""
    a, b = ordered[:-1], ordered[1:]
    same = (end[a] - a) == (end[b] - b)
    pairs = np.flatnonzero(same)
    offset = 0
    while len(pairs):
        equal = text[a[pairs] + offset] == text[b[pairs] + offset]
        same[pairs[~equal]] = False
        offset += 1
        pairs = pairs[equal]
        pairs = pairs[a[pairs] + offset <= end[a[pairs]]]
    return np.concatenate([[0], np.cumsum(~same)])


def _recursive(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced text: its alphabet is as large as the text, so ranks are refined by doubling."""
    n = len(names)
    rank = names.astype(np.int64)
    width = 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_ = rank[order]
        fresh = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
        place = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order] = place  # a rank is the first place of its group, so that single ones stay as they are
        alone = fresh & np.concatenate([fresh[1:], [True]])
        todo = np.flatnonzero(~alone)
        if not len(todo):
            return order
        which = order[todo]
        following = which + width
        key = np.where(following < n, rank[np.minimum(following, n - 1)] + 1, 0)
        again = np.argsort(place[todo] * (n + 1) + key)  # equal ones are told apart later
        order[todo] = which[again]
        # new ranks within groups: a change of the key starts one
        keys, group = key[again], place[todo]
        split = np.concatenate([[True], (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])])
        rank[order[todo]] = todo[np.maximum.accumulate(np.where(split, np.arange(len(todo)), 0))]
        width *= 2


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers below ``alphabet``) in order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    # types: compare with the next symbol; equal ones take the type of the end of their run
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.zeros(n, dtype=bool)
    if len(change):
        until = np.concatenate([change + 1, [n]])
        value = np.concatenate([text[change] < text[change + 1], [False]])  # the last run falls to the end
        rises = np.repeat(value, np.diff(np.concatenate([[0], until])))
    lms = np.flatnonzero(rises[1:] & ~rises[:-1]).astype(np.int32) + 1
    sizes = np.bincount(text, minlength=alphabet)
    if not len(lms):
        return _induce(text, rises, lms, sizes)
    first = _induce(text, rises, lms, sizes)
    mark = np.zeros(n, dtype=bool)
    mark[lms] = True
    ordered = first[mark[first]]
    end = np.zeros(n, dtype=np.int32)
    end[lms] = np.concatenate([lms[1:], [n - 1]])
    name = _names(text, ordered, end)
    # the last LMS substring runs to the end of the text, where it is smaller than any that goes on
    reduced = np.zeros(n, dtype=np.int64)
    reduced[ordered] = name
    if name[-1] + 1 < len(lms):
        ordered = lms[_recursive(reduced[lms])]
    return _induce(text, rises, ordered, sizes)


def capped_prefixes(text: np.ndarray, array: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: per place, how far its suffix agrees with the one before it in order, ``cap`` at most."""
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    step = 63 // bits  # symbols compared at once
    words = np.zeros(n + cap + step, dtype=np.int64)  # a place and those behind it, the first symbol in the lowest bits
    for at in range(0, n, BLOCK):
        for k in range(step):
            part = text[at + k : at + k + BLOCK]
            words[at : at + len(part)] |= part.astype(np.int64) << (bits * k)
    out = np.zeros(n, dtype=np.int32)
    for at in range(0, n - 1, BLOCK):
        part = array[at : at + BLOCK + 1]
        room = np.minimum(n - np.maximum(part[1:], part[:-1]), cap).astype(np.int32)  # what stands behind the text doesn't count
        found, live, wanted, held = room.copy(), np.arange(len(room)), slice(None), np.empty(len(part), dtype=np.int64)
        for length in range(0, cap, step):
            held[wanted] = words[part[wanted] + length]  # a suffix is read once, for both its neighbours
            differ = held[live + 1] ^ held[live]
            ended = np.flatnonzero(differ)
            lowest = np.frexp((differ[ended] & -differ[ended]).astype(np.float64))[1] - 1
            found[live[ended]] = np.minimum(length + lowest // bits, room[live[ended]])
            live = live[(differ == 0) & (room[live] > length + step)]
            if not len(live):
                break
            mark = np.zeros(len(part), dtype=bool)
            mark[live] = mark[live + 1] = True
            wanted = np.flatnonzero(mark)
        out[part[1:]] = found
    return out
