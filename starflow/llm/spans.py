"""Spans of text as (start, end), end exclusive."""

from __future__ import annotations

Span = tuple[int, int]


def covered(spans: list[Span]) -> list[Span]:
    """What the spans cover: sorted, those that overlap or touch joined."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def outside(spans: list[Span], base: list[Span]) -> list[Span]:
    """The parts of ``spans`` that ``base`` does not cover; each is sorted and free of overlaps."""
    out, k = [], 0
    for a, b in spans:
        while k < len(base) and base[k][1] <= a:
            k += 1
        at = k
        while at < len(base) and base[at][0] < b:
            out.append((a, base[at][0]))
            a = max(a, base[at][1])
            at += 1
        out.append((a, b))
    return [(a, b) for a, b in out if a < b]
