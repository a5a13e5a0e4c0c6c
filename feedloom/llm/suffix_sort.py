"""Order of substrings by deep-shallow sorting, in numpy.

Shallow: multikey quicksort on symbols of eight bytes.  One round sorts the suffixes of every open group by
its next symbol; suffixes alone with their symbols are done, equal ones stay a group and go on to the next
symbol.  Deep: the groups left share a long prefix, where symbol after symbol would be wasted.  They are
ordered by blind tries, which hold nothing but the places where members part: the first place at which any
member differs from the group's first one branches the group by that byte, and so on down to leaves of equal
strings.  All groups are worked on together, level by level.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8
SHALLOW = 16
ROWS = 1 << 15  # compared at a time


def _symbols(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers in the order of the bytes; the buffer is padded."""
    view = np.ndarray(len(buffer) - SYMBOL + 1, ">u8", buffer, strides=(1,))
    return view[at].astype(np.uint64)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where any of the sorted keys changes; the first row is a head."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _parting(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, low: int, depth: int) -> np.ndarray:
    """First place from ``low`` on at which the strings at a and b differ; ``depth`` if they don't."""
    found = np.empty(len(a), np.int64)
    span = np.arange(low, depth)
    for i in range(0, len(a), ROWS):
        differ = buffer[a[i:i + ROWS, None] + span] != buffer[b[i:i + ROWS, None] + span]
        first = differ.argmax(1)
        found[i:i + ROWS] = np.where(differ[np.arange(len(first)), first], first + low, depth)
    return found


def deep_shallow(text: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the ``depth`` bytes from each start, and which of the ordered ones differ from the one before.

    Every string has to lie inside ``text``.
    """
    buffer = np.concatenate([text, np.zeros(depth + SYMBOL, np.uint8)])
    order, new = np.arange(len(starts)), np.zeros(len(starts), bool)
    new[:1] = True
    shallow = min(shallow, depth)
    open_rows = np.arange(len(starts))  # places in the order that belong to groups of two or more
    for at in range(0, shallow, SYMBOL):
        if not len(open_rows):
            break
        members = order[open_rows]
        symbols = _symbols(buffer, starts[members] + at)
        if at + SYMBOL > depth:
            symbols &= ~np.uint64((1 << 8 * (at + SYMBOL - depth)) - 1)
        group = np.cumsum(new[open_rows])
        by = np.lexsort((symbols, group)) if at else np.argsort(symbols, kind="stable")
        order[open_rows] = members[by]
        new[open_rows] |= _heads(group[by], symbols[by])
        open_rows = _open(new, open_rows)
    done = -(-shallow // SYMBOL) * SYMBOL
    while len(open_rows) and done < depth:
        members, heads = order[open_rows], np.flatnonzero(new[open_rows])
        sizes = np.diff(np.r_[heads, len(open_rows)])
        group = np.repeat(np.arange(len(heads)), sizes)
        branch = np.minimum.reduceat(_parting(buffer, starts[members], starts[members[heads]][group], done, depth), heads)
        parted = branch[group] < depth
        open_rows, members, group = open_rows[parted], members[parted], group[parted]
        byte = buffer[starts[members] + branch[group]]
        by = np.lexsort((byte, group))
        order[open_rows] = members[by]
        new[open_rows] |= _heads(group[by], byte[by])
        open_rows = _open(new, open_rows)
    return order, new


def _open(new: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of the rows, those whose group has another member.  Rows hold whole groups, in order."""
    if not len(rows):
        return rows
    head = new[rows]
    alone = head & np.r_[head[1:], True]
    return rows[~alone]
