"""Literals that any match of a regular expression holds, worked out from the expression itself.

``literals`` walks the parsed pattern. Each part has the finite set of texts it can be, if there is one, and a set of texts of which any match
of it holds at least one. In a sequence neighbouring finite sets are multiplied and the rarest set is taken; alternatives are united. A text without any
of the literals therefore can't match: the search for them is a necessary condition, not a list of guesses.
"""

from __future__ import annotations

import re
from re import _constants as c
from re import _parser

LIMIT = 400  # texts in a finite set
EMPTY = frozenset({""})
# Literals that prose is full of, where a part of equal length is not: they are taken last. Speed only.
COMMON = frozenset("metin baslik ozet bilgi icerik sayfa video bolum yayin dosya adres site sistem bir bu hata yazi and here alan kisim ses gorsel tanitim aciklama gelecek gelecektir gerek sart acin acip aktif need allow without support".split()) | {"at "}

Texts = frozenset[str] | None


def _cost(s: frozenset[str]) -> float:
    return sum(0.5 if x in COMMON else 12.0 ** -min(len(x), 9) for x in s)


def _rarest(sets: list[Texts]) -> Texts:
    return min((s for s in sets if s and "" not in s), key=_cost, default=None)


def _times(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    return frozenset(x + y for x in a for y in b)


def _sequence(items) -> tuple[Texts, Texts]:  # noqa: ANN001
    run, sets, whole = EMPTY, [], True
    for op, av in items:
        exact, need = _part(op, av)
        if exact is not None and len(run) * len(exact) <= LIMIT:
            run = _times(run, exact)
            continue
        sets.append(run)
        whole, run = False, EMPTY
        if exact is not None:
            run = exact
        else:
            sets.append(need)
    return (run if whole else None), _rarest([*sets, run])


def _part(op, av) -> tuple[Texts, Texts]:  # noqa: ANN001
    """(all texts it can be or None, texts of which a match holds one or None)"""
    if op is c.LITERAL:
        exact = frozenset({chr(av)})
    elif op in (c.AT, c.ASSERT, c.ASSERT_NOT):
        exact = EMPTY
    elif op is c.IN and all(o in (c.LITERAL, c.RANGE) for o, _ in av):
        some = [chr(x) for o, v in av for x in ([v] if o is c.LITERAL else range(v[0], v[1] + 1))]
        exact = frozenset(some) if len(some) <= 40 else None
        return exact, exact
    elif op is c.SUBPATTERN:
        return _sequence(av[3])
    elif op is c.BRANCH:
        parts = [_sequence(x) for x in av[1]]
        need = None if any(n is None for _, n in parts) else frozenset().union(*(n for _, n in parts))
        exact = None if any(e is None for e, _ in parts) else frozenset().union(*(e for e, _ in parts))
        return (exact if exact is not None and len(exact) <= LIMIT else None), need
    elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
        lo, hi, sub = av
        one, need = _sequence(sub)
        if one is not None and hi <= 2:
            powers = [EMPTY, one, _times(one, one) if len(one) ** 2 <= LIMIT or hi < 2 else None][lo : hi + 1]
            if None not in powers and sum(map(len, powers)) <= LIMIT:
                exact = frozenset().union(*powers)
                return exact, _rarest([exact])
        return None, need if lo else None
    else:  # any character, classes, negations, back references
        return None, None
    return exact, _rarest([exact])


def literals(pattern: re.Pattern) -> frozenset[str]:
    """Texts of which each match of ``pattern`` holds at least one; raises ValueError where an alternative has none."""
    need = _sequence(_parser.parse(pattern.pattern, pattern.flags & ~re.UNICODE))[1]
    if need is None or pattern.flags & re.IGNORECASE:
        raise ValueError(f"no literal in each match of {pattern.pattern[:60]}")
    return frozenset(x for x in need if not any(x != y and y in x for y in need))
