"""Spans found in texts: how the span operators compare them and write them down."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]


def joined(spans: Iterable[Span], order: dict[str, int]) -> str:
    """``kind:start:end`` by start, then kind in the order given, then end; comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], order[s[0]], s[2])))


def rendered(kinds: Sequence[str], *columns: str) -> Column:
    """The same as :func:`joined` over columns that hold arrays of (kind, start, end); null counts as empty."""
    rank = F.create_map(*[F.lit(x) for kv in zip(kinds, range(len(kinds)), strict=True) for x in kv])
    keyed = [F.coalesce(F.transform(c, lambda s: F.struct(s.start.alias("start"), rank[s.kind].alias("rank"), s.end.alias("end"), s.kind.alias("kind"))), F.array()) for c in columns]
    return F.array_join(F.transform(F.array_sort(F.array_distinct(F.concat(*keyed))), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def outside(spans: Iterable[Span]) -> Callable[[int, int], bool]:
    """Whether a stretch overlaps none of ``spans``."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, a) - 1
        return (i < 0 or ends[i] <= a) and (i + 1 == len(starts) or starts[i + 1] >= b)

    return free
