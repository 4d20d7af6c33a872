"""Spans found in texts: kind, start, end (code points, end exclusive)."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def ordered(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By start, then kind as listed, then end; each span once."""
    place = {k: i for i, k in enumerate(kinds)}
    return sorted(set(spans), key=lambda s: (s[1], place[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def merged(spans: list[Span]) -> list[Span]:
    """Disjoint spans that cover the same characters; a merged span has the
    kind of its longest part."""
    out: list[tuple[str, int, int, int]] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if out and s < out[-1][2]:
            k0, s0, e0, n0 = out[-1]
            out[-1] = (k0 if n0 >= e - s else k, s0, max(e0, e), max(n0, e - s))
        elif e > s:
            out.append((k, s, e, e - s))
    return [x[:3] for x in out]


def replaced(text: str, spans: list[Span], name) -> str:
    """The text with each covered stretch replaced by ``name(kind)``."""
    out, at = [], 0
    for k, s, e in merged(spans):
        out += [text[at:s], name(k)]
        at = e
    return "".join([*out, text[at:]])
