"""Merging sorted, front-coded runs of byte strings without re-comparing prefixes.

A run is a sorted list of strings, each given as the length of the prefix it
shares with the one before it and the rest. The loser tree keeps, beside
every loser, how long a prefix it shares with the string that beat it. When
two strings meet, their shared lengths with the last output decide; only if
these are equal are bytes compared, from there on. So no byte of a known
prefix is looked at twice (Ng and Kakehi, "Merging String Sequences by Longest
Common Prefixes", 2008).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, which is known to be at least ``start``."""
    end = min(len(a), len(b))
    step = 64
    while start < end and a[start : start + step] == b[start : start + step]:
        start += step
    if start >= end:
        return end
    stop = min(start + step, end)
    while start < stop and a[start] == b[start]:
        start += 1
    return start


def front_code(strings: Sequence[bytes]) -> Iterator[tuple[int, bytes]]:
    """(shared length, rest) of each string of a sorted run."""
    before = b""
    for s in strings:
        n = shared(before, s)
        yield n, s[n:]
        before = s


def unpack(run: Sequence[tuple[int, bytes]]) -> list[bytes]:
    out, before = [], b""
    for n, rest in run:
        before = before[:n] + rest
        out.append(before)
    return out


def merge(runs: Sequence[Sequence[tuple[int, bytes]]]) -> Iterator[tuple[int, int, int, bytes]]:
    """``(run, place in it, length shared with the last output, string)`` in order.

    Equal strings come in the order of their runs.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings = [unpack(r) for r in runs]
    sizes = [len(s) for s in strings] + [0] * (k - len(strings))
    lengths = [[n for n, _ in r] for r in runs]
    at = [0] * k
    #: the string each stream offers; None when it has ended
    now: list[bytes | None] = [strings[i][0] if i < len(strings) and sizes[i] else None for i in range(k)]
    loser, known = [0] * k, [0] * k

    def meet(x: int, hx: int, y: int, hy: int) -> tuple[int, int, int, int]:
        """Winner and loser of two streams, with their shared lengths: the
        winner's with the last output, the loser's with the winner."""
        a, b = now[x], now[y]
        if a is None or b is None:
            return (y, hy, x, hx) if a is None else (x, hx, y, hy)
        if hx != hy:
            return (x, hx, y, hy) if hx > hy else (y, hy, x, hx)
        h = shared(a, b, hx)
        if a[h:] == b[h:]:
            first = x < y
        elif h == len(a) or h == len(b):
            first = h == len(a)
        else:
            first = a[h] < b[h]
        return (x, hx, y, h) if first else (y, hx, x, h)

    def play(node: int) -> tuple[int, int]:
        if node >= k:
            return node - k, 0
        (x, hx), (y, hy) = play(2 * node), play(2 * node + 1)
        w, hw, l, hl = meet(x, hx, y, hy)
        loser[node], known[node] = l, hl
        return w, hw

    winner, h = play(1) if k > 1 else (0, 0)
    while runs and now[winner] is not None:
        yield winner, at[winner], h, now[winner]
        at[winner] += 1
        if at[winner] < sizes[winner]:
            now[winner], h = strings[winner][at[winner]], lengths[winner][at[winner]]
        else:
            now[winner], h = None, -1
        node, best = (winner + k) // 2, winner
        while node:
            best, h, loser[node], known[node] = meet(best, h, loser[node], known[node])
            node //= 2
        winner = best
