"""Suffix arrays by two-stage sorting, and the common prefixes of neighbours, in numpy.

Stage one sorts directly only the suffixes that are smaller than their
successors; stage two finds the place of every other suffix by scanning the
buckets (suffixes by first symbol) in ascending order: a scanned suffix's
predecessor, if larger, is next in its own bucket.  Comparisons end at a given
depth, beyond which the order of equal suffixes is left open.  If only some
places are wanted, a suffix that no wanted one is induced from is left out.
"""

from __future__ import annotations

import numpy as np

#: Symbols have nine bits (a separator and 256 byte values), so a 64-bit word holds seven.
SYMBOL_BITS, WORD = 9, 7


def words(symbols: np.ndarray) -> np.ndarray:
    """The seven symbols from each place on as one number; beyond the end stands symbol 0.  Longer by WORD than the text."""
    one = np.concatenate([symbols.astype(np.uint64), np.zeros(2 * WORD, np.uint64)])
    two = (one[:-1] << np.uint64(9)) | one[1:]
    three = (two[:-1] << np.uint64(9)) | one[2:]
    four = (two[:-2] << np.uint64(18)) | two[2:]
    return ((four[:-4][:len(symbols) + WORD] << np.uint64(27)) | three[4:][:len(symbols) + WORD])


def smaller_than_successor(symbols: np.ndarray) -> np.ndarray:
    """For each suffix whether it sorts before the suffix one further on (the empty suffix sorts first)."""
    n = len(symbols)
    step = np.empty(n, np.int32)
    step[:-1] = np.sign(symbols[1:].astype(np.int32) - symbols[:-1])
    step[-1] = -1
    # equal symbols decide as the next unequal ones do
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def sort_directly(word: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the suffixes there, compared over ``depth`` symbols, a word at a time."""
    places = places[np.argsort(word[places])]
    run = np.concatenate([[0], np.cumsum(word[places[1:]] != word[places[:-1]])]) if len(places) else np.empty(0, np.int64)
    active = _tied(run)
    done = WORD
    last = len(word) - 1
    while done < depth and len(active):
        here, key = places[active], word[np.minimum(places[active] + done, last)]
        begins = np.concatenate([[True], run[active[1:]] != run[active[:-1]]])
        group = np.cumsum(begins) - 1
        # a group whose next words are all equal stays as it is
        mixed = np.zeros(int(group[-1]) + 1, bool)
        mixed[group[key != key[np.flatnonzero(begins)][group]]] = True
        sort = np.flatnonzero(mixed[group])
        if len(sort):
            order = sort[np.lexsort((key[sort], group[sort]))]
            here[sort], key[sort] = here[order], key[order]
            places[active] = here
            begins[1:] |= key[1:] != key[:-1]
            # run numbers only have to tell groups apart: the first place of each will do
            run[active] = np.maximum.accumulate(np.where(begins, active, 0)) + len(run)
            active = active[~(begins & np.append(begins[1:], True))]
        done += WORD
    return places


def _tied(run: np.ndarray) -> np.ndarray:
    if len(run) < 2:
        return np.empty(0, np.int64)
    same = run[1:] == run[:-1]
    return np.flatnonzero(np.append(same, False) | np.concatenate([[False], same]))


def suffix_array(symbols: np.ndarray, word: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Places of the wanted suffixes (all by default), and of those that they are induced from, in
    ascending order over at least ``depth`` symbols."""
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    direct = smaller_than_successor(symbols)
    live = np.ones(n, bool)
    if wanted is not None:
        # a place is live if a wanted one lies between the directly sorted place before it and itself
        run = np.cumsum(direct) - direct
        places = np.flatnonzero(wanted)
        begin = np.full(int(run[-1]) + 1, n)
        np.minimum.at(begin, run[places], places)
        live = np.arange(n) >= begin[run]
    ordered = sort_directly(word, np.flatnonzero(direct & live), depth)
    first = symbols[ordered]
    begins = np.searchsorted(first, np.arange(int(symbols.max()) + 2))
    larger: list[list[np.ndarray]] = [[] for _ in range(int(symbols.max()) + 1)]
    if live[-1]:
        larger[symbols[-1]].append(np.array([n - 1]))  # what the empty suffix, scanned first, induces
    out = []

    def induce(scanned: np.ndarray, bucket: int) -> list[np.ndarray]:
        """Deals out the predecessors that are larger; returns those of this very bucket."""
        before = scanned[scanned > 0] - 1
        before = before[~direct[before] & live[before]]
        symbol = symbols[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        own = []
        for part in np.split(before, cuts):
            if len(part):
                (own if symbols[part[0]] == bucket else larger[symbols[part[0]]]).append(part)
        return own

    for bucket in range(len(larger)):
        front = larger[bucket]
        while front:
            scanned = np.concatenate(front)
            out.append(scanned)
            front = induce(scanned, bucket)
        scanned = ordered[begins[bucket]:begins[bucket + 1]]
        out.append(scanned)
        induce(scanned, bucket)
    return np.concatenate(out)


def common_prefixes(word: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each but the first of ``order`` the length of the prefix that its suffix shares with the one before, at most ``limit``."""
    lengths = np.zeros(max(len(order) - 1, 0), np.int64)
    alive, done, last = np.arange(len(lengths)), 0, len(word) - 1
    while done < limit and len(alive):
        differ = word[np.minimum(order[alive] + done, last)] ^ word[np.minimum(order[alive + 1] + done, last)]
        same = differ == 0
        ended, rest = alive[~same], differ[~same]
        lengths[ended] = done + sum((rest >> np.uint64(SYMBOL_BITS * (WORD - k))) == 0 for k in range(1, WORD))
        alive = alive[same]
        done += WORD
    lengths[alive] = limit
    return np.minimum(lengths, limit)
