"""Suffix arrays by induced sorting, and permuted longest common prefixes, on numpy arrays.

Suffixes are classified as rising or falling. The substrings between leftmost rising positions are
sorted by inducing, named, and sorted as suffixes of the shorter text of their names; a second
inducing pass puts all suffixes in order. For small alphabets a pass works on whole buckets: what a
bucket induces is appended to the other buckets in one step, and only what it induces in itself
takes another. The shorter texts have as many letters as names and are passed over one by one, as
are texts with long runs of one letter.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024
LONG_RUN = 4096


def _rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last letter must be the only smallest."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    decided = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return np.append(np.append(step, 1)[following] > 0, True)


def _starts(text: np.ndarray, letters: int) -> np.ndarray:
    """Where each letter's bucket begins, and the length at the end."""
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=letters))])


def _dealt(found: np.ndarray, text: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions by letter in their order, the place of each within its letter, and the counts."""
    letter = text[found]
    order = np.argsort(letter, kind="stable")
    counts = np.bincount(letter, minlength=letters)
    within = np.arange(len(found)) - (np.cumsum(counts) - counts)[letter[order]]
    return found[order], within, counts


def _induced_by_bucket(text: np.ndarray, rising: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in the order that the sorted ``seeds`` (leftmost rising positions) induce."""
    starts, order = _starts(text, letters), np.full(len(text), -1, np.int64)
    head = starts[:-1].copy()
    seeds_by_letter, _, counts = _dealt(seeds, text, letters)
    seed_ends = np.cumsum(counts)
    for letter in np.flatnonzero(np.diff(starts)):
        scanned, begin = [], starts[letter]
        while begin < head[letter]:
            wave = order[begin : head[letter]]
            begin = head[letter]
            before = wave[wave > 0] - 1
            before = before[~rising[before]]
            same = text[before] == letter
            own = before[same]
            order[head[letter] : head[letter] + len(own)] = own
            head[letter] += len(own)
            scanned.append(before[~same])
        last = seeds_by_letter[seed_ends[letter] - counts[letter] : seed_ends[letter]]
        scanned.append(last[last > 0] - 1)
        found, within, added = _dealt(np.concatenate(scanned), text, letters)
        order[head[text[found]] + within] = found
        head += added
    falling_end, tail = head, starts[1:].copy()
    order[0] = len(text) - 1
    for letter in np.flatnonzero(np.diff(starts))[::-1]:
        scanned, end = [], starts[letter + 1]
        while end > tail[letter]:
            wave = order[tail[letter] : end][::-1]
            end = tail[letter]
            before = wave[wave > 0] - 1
            before = before[rising[before]]
            same = text[before] == letter
            own = before[same]
            order[tail[letter] - len(own) : tail[letter]] = own[::-1]
            tail[letter] -= len(own)
            scanned.append(before[~same])
        wave = order[starts[letter] : falling_end[letter]][::-1]
        before = wave[wave > 0] - 1
        scanned.append(before[rising[before]])
        found, within, added = _dealt(np.concatenate(scanned), text, letters)
        order[tail[text[found]] - 1 - within] = found
        tail -= added
    return order


def _induced_one_by_one(text: np.ndarray, rising: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """The same for many letters: one position after the other."""
    starts, n = _starts(text, letters), len(text)
    # The letter ahead of each position if that falls (or rises), else -1; n stands for no position.
    ahead = np.concatenate([[-1], text[:-1], [-1]])
    rises = np.concatenate([[False], rising[:-1], [False]])
    falling_letter = np.where(rises, -1, ahead).tolist()
    rising_letter = np.where(rises, ahead, -1).tolist()
    order, tail = [n] * n, starts[1:].tolist()
    for position, letter in zip(seeds[::-1].tolist(), text[seeds[::-1]].tolist()):
        place = tail[letter] - 1
        order[place] = position
        tail[letter] = place
    head = starts[:-1].tolist()
    for position in order:
        letter = falling_letter[position]
        if letter >= 0:
            place = head[letter]
            order[place] = position - 1
            head[letter] = place + 1
    tail = starts[1:].tolist()
    for i in range(n - 1, -1, -1):
        position = order[i]
        letter = rising_letter[position]
        if letter >= 0:
            place = tail[letter] - 1
            order[place] = position - 1
            tail[letter] = place
    order[0] = n - 1
    return np.array(order, np.int64)


def _names(text: np.ndarray, by_order: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Numbers of the substrings from each seed to the next one, equal for equal substrings."""
    length = np.zeros(len(text), np.int64)
    length[seeds[:-1]] = np.diff(seeds) + 1
    length[seeds[-1]] = 1
    left, right = by_order[:-1], by_order[1:]
    differs = length[left] != length[right]
    open_pairs, k = np.flatnonzero(~differs), 0
    while len(open_pairs):
        unlike = text[left[open_pairs] + k] != text[right[open_pairs] + k]
        differs[open_pairs[unlike]] = True
        k += 1
        open_pairs = open_pairs[~unlike & (length[left[open_pairs]] > k)]
    return np.concatenate([[0], np.cumsum(differs)])


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Positions of all suffixes in order; ``text`` ends with its only 0, its letters are below
    ``letters``."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    changes = np.flatnonzero(np.diff(text))
    by_bucket = letters <= SMALL_ALPHABET and np.diff(changes, prepend=-1, append=len(text)).max() < LONG_RUN
    induced = _induced_by_bucket if by_bucket else _induced_one_by_one
    rising = _rising(text)
    seeds = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds] = True
    roughly = induced(text, rising, seeds, letters)
    by_order = roughly[is_seed[roughly]]
    names = _names(text, by_order, seeds)
    if names[-1] + 1 == len(seeds):
        in_order = by_order
    else:
        shorter = np.empty(len(text), np.int64)
        shorter[by_order] = names
        in_order = seeds[suffix_array(shorter[seeds], int(names[-1]) + 1)]
    return induced(text, rising, in_order, letters)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position, in the order of the text, the suffix before its own in ``order`` (-1 for
    the first) and the length of their common prefix, at most ``left`` (letters left in its piece).

    Where the letters ahead of both agree, the length is one less than that of the position before;
    only the other positions are compared, as are those that begin a piece.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    compared = np.ones(n, bool)
    compared[1:] = (before[1:] <= 0) | (text[:-1] != text[before[1:] - 1]) | (left[1:] != left[:-1] - 1)
    at = np.flatnonzero(compared & (before >= 0))
    length = np.zeros(n, np.int64)
    # Eight letters at a time; behind the end is a letter that is nowhere else.
    wide = np.concatenate([text.astype("<u2"), np.full(8, 0xFFFF, "<u2")])
    fours = np.ndarray((n + 5,), "<u8", wide, 0, (2,))
    other, done = before[at], np.zeros(len(at), np.int64)
    while len(at):
        same = (fours[at + done] == fours[other + done]) & (done + 4 <= left[at])
        ended = np.flatnonzero(~same)
        for k in range(3):
            more = (wide[at[ended] + done[ended]] == wide[other[ended] + done[ended]]) & (
                done[ended] < left[at[ended]]
            )
            length[at[ended[~more]]] = done[ended[~more]]
            ended = ended[more]
            done[ended] += 1
        length[at[ended]] = done[ended]
        at, other, done = at[same], other[same], done[same] + 4
    last = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    return before, length[last] - (np.arange(n) - last)
