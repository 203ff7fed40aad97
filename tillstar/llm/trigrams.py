"""Boolean trigram queries: which byte trigrams any match of a regex must contain.

A query is a set of alternatives, each a set of trigrams that all have to occur:
``{{"tok", "oke", "ken"}, {"api", "pik"}}``. The query ``{{}}`` holds for every text.
Trigrams are over UTF-8 bytes with ASCII letters in lower case.
"""

from __future__ import annotations

import re
from re import _constants as kind
from re import _parser

ALWAYS = frozenset({frozenset()})
_MOST_STRINGS = 64
_MOST_ALTERNATIVES = 256


def _absorb(alternatives) -> frozenset:
    """Drop an alternative that asks for more than another one does."""
    kept: list[frozenset] = []
    for one in sorted(alternatives, key=len):
        if not any(other <= one for other in kept):
            kept.append(one)
    return frozenset(kept)


def either(a: frozenset, b: frozenset) -> frozenset:
    return _absorb(a | b)


def both(a: frozenset, b: frozenset) -> frozenset:
    if len(a) * len(b) > _MOST_ALTERNATIVES:  # one of them alone is still necessary
        return min(a, b, key=len)
    return _absorb({x | y for x in a for y in b})


def _of_strings(strings) -> frozenset:
    return _absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


# Of a part of a regex: the strings it matches (None: too many or unknown) and a query.
_UNKNOWN = (None, ALWAYS)
_NOTHING = (frozenset({b""}), ALWAYS)


def _full(part) -> frozenset:
    strings, query = part
    return query if strings is None else both(query, _of_strings(strings))


def _sequence(parts) -> tuple:
    current, query, exact = frozenset({b""}), ALWAYS, True
    for strings, needs in parts:
        if strings is not None and len(current) * len(strings) <= _MOST_STRINGS:
            current = frozenset(a + b for a in current for b in strings)
        else:
            query = both(both(query, _of_strings(current)), needs)
            current, exact = strings or frozenset({b""}), False
            if strings is not None and len(strings) > _MOST_STRINGS:
                query, current = both(query, _of_strings(strings)), frozenset({b""})
    if exact:
        return current, query
    return None, both(query, _of_strings(current))


def _choice(parts) -> tuple:
    parts = list(parts)
    if all(strings is not None for strings, _ in parts):
        strings = frozenset().union(*(s for s, _ in parts))
        if len(strings) <= _MOST_STRINGS:
            return strings, ALWAYS
    query = _full(parts[0])
    for part in parts[1:]:
        query = either(query, _full(part))
    return None, query


def _letter(code: int) -> tuple:
    return frozenset({chr(code).encode("utf-8", "surrogatepass").lower()}), ALWAYS


def _members(items) -> tuple:
    strings = set()
    for op, value in items:
        if op is kind.LITERAL:
            codes = [value]
        elif op is kind.RANGE and value[1] - value[0] < _MOST_STRINGS:
            codes = range(value[0], value[1] + 1)
        else:
            return _UNKNOWN
        strings |= {s for code in codes for s in _letter(code)[0]}
    return (frozenset(strings), ALWAYS) if len(strings) <= 8 else _UNKNOWN


def _repeat(least: int, most: int, part) -> tuple:
    if least == 0:
        return _choice([_NOTHING, part]) if most == 1 else _UNKNOWN
    strings, query = _sequence([part] * min(least, 32))
    if strings is not None and least == most <= 32:
        return strings, query
    return None, _full((strings, query))


def _node(op, value) -> tuple:
    if op is kind.LITERAL:
        return _letter(value)
    if op is kind.IN:
        return _members(value)
    if op is kind.BRANCH:
        return _choice(_nodes(branch) for branch in value[1])
    if op is kind.SUBPATTERN:
        return _nodes(value[-1])
    if op in (kind.MAX_REPEAT, kind.MIN_REPEAT, kind.POSSESSIVE_REPEAT):
        return _repeat(int(value[0]), int(value[1]), _nodes(value[2]))
    if op in (kind.AT, kind.ASSERT, kind.ASSERT_NOT):
        return _NOTHING
    return _UNKNOWN


def _nodes(nodes) -> tuple:
    return _sequence([_node(op, value) for op, value in nodes])


def trigram_query(pattern: re.Pattern) -> frozenset:
    """The query that every text with a match of the pattern fulfils.

    Case may be ignored only together with re.ASCII, as the index folds ASCII only.
    """
    tree = _parser.parse(pattern.pattern, pattern.flags)
    if tree.state.flags & re.IGNORECASE and not tree.state.flags & re.ASCII:
        raise ValueError("use re.ASCII with re.IGNORECASE")
    return _full(_nodes(tree))
