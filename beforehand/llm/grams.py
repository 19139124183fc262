"""Trigram queries of regular expressions, for rules that an index narrows down."""

from __future__ import annotations

import re
from itertools import product

# sre's own parser: what compiles a pattern is what this reads
from re import _constants as op  # type: ignore[attr-defined]
from re import _parser as sre  # type: ignore[attr-defined]

MOST_STRINGS = 64
MOST_CLASS = 4

# A query is a set of alternatives, each a set of trigrams that must all occur. ANY holds for every text.
Query = frozenset
ANY: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x, y in product(a, b)))


def _least(q: Query) -> Query:
    """Without alternatives that ask for more than another."""
    return frozenset(x for x in q if not any(y < x for y in q))


def _of_strings(strings: set[str]) -> Query:
    out = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return _least(frozenset(out))


def _char_class(items) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_CLASS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
        if len(found) > MOST_CLASS:
            return None
    return found


def _walk(items) -> tuple[set[str] | None, Query]:
    """All strings a sequence can match, if few, and what every match must contain."""
    strings: set[str] | None = {""}
    whole, query = True, ANY
    for kind, value in items:
        own, need = _one(kind, value)
        if own is None or len(strings) * len(own) > MOST_STRINGS:
            # what came before is known; go on from here
            query, whole = _both(query, _of_strings(strings)), False
            strings = {""} if own is None else own
            if own is None:
                query = _both(query, need)
        else:
            strings = {a + b for a in strings for b in own}
    if whole:
        return strings, _of_strings(strings)
    return None, _both(query, _of_strings(strings))


def _one(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is op.IN:
        return _char_class(value), ANY
    if kind is op.SUBPATTERN:
        return _walk(value[-1])
    if kind is op.BRANCH:
        ways = [_walk(x) for x in value[1]]
        if all(s is not None for s, _ in ways) and sum(len(s) for s, _ in ways) <= MOST_STRINGS:
            return set().union(*(s for s, _ in ways)), ANY
        return None, _least(frozenset().union(*(q for _, q in ways)))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, body = value
        own, need = _walk(body)
        if high == 1 and own is not None:
            return (own | {""} if low == 0 else own), ANY
        if low == high and own is not None and low <= 3 and len(own) ** low <= MOST_STRINGS:
            return {"".join(x) for x in product(own, repeat=low)}, ANY
        return None, need if low else ANY
    if kind is op.AT:
        return {""}, ANY
    return None, ANY


def query(pattern: str) -> Query:
    """What the lower-case form of every text that ``pattern`` matches must contain.

    Alternatives of trigram sets; ``ANY`` where the pattern asks for none, and every text
    has to be searched.
    """
    strings, need = _walk(sre.parse(pattern))
    return ANY if frozenset() in need else need


