"""Split planning: plain arithmetic on bounds and shard lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate


@dataclass(frozen=True)
class Split:
    """One unit of parallel reading: some shards, and a key range or none."""

    shards: tuple
    lower: int | None = None
    upper: int | None = None


def range_bounds(lower: int, upper: int, n: int) -> tuple[int, int, int]:
    """``(number of ranges, larger size, how many have it)`` for ``[lower, upper]``."""
    if upper < lower:
        raise ValueError("upper must not be below lower")
    if n < 1:
        raise ValueError("the number of ranges must be positive")
    elements = upper - lower + 1
    n = min(n, elements)
    small, extra = divmod(elements, n)
    return (n, small + 1, extra) if extra else (n, small, n)


def split_range(lower: int, upper: int, n: int) -> list[tuple[int, int]]:
    """Cut an inclusive range into ``n`` inclusive ranges, the larger ones first."""
    n, size, big = range_bounds(lower, upper, n)
    sizes = [size] * big + [size - 1] * (n - big)
    starts = [lower, *accumulate(sizes, initial=lower)][1:]
    return [(start, start + s - 1) for start, s in zip(starts, sizes)]


def share(items: int, groups: int) -> list[int]:
    """Group sizes that differ by at most one, the smaller ones first."""
    small, extra = divmod(items, groups)
    return [small] * (groups - extra) + [small + 1] * extra


def plan_splits(shards: Sequence = (), n: int | None = None, lower: int | None = None,
                upper: int | None = None) -> list[Split]:
    """Splits of a table on ``shards`` (none: one plain table), with or without bounds.

    With bounds and at least as many splits as shards, each shard gets its own
    cut of the whole range; with fewer, shards are grouped and each group reads
    the whole range.
    """
    if n is not None and n < 1:
        raise ValueError("the number of splits must be positive")
    bounded = lower is not None and upper is not None
    shards = tuple(shards)
    if not shards:
        if not bounded:
            return [Split(())]
        return [Split((), a, b) for a, b in split_range(lower, upper, n or 1)]
    count = len(shards)
    n = n or count
    if bounded and n >= count:
        return [Split((shard,), a, b)
                for shard, pieces in zip(shards, share(n, count))
                for a, b in split_range(lower, upper, pieces)]
    if bounded:
        range_bounds(lower, upper, 1)
    ends = list(accumulate(share(count, min(n, count))))
    return [Split(shards[start:end], lower if bounded else None, upper if bounded else None)
            for start, end in zip([0, *ends], ends)]
