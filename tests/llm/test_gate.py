"""The gate before the residue patterns is a necessary condition: what has evidence is never passed over."""

import random
import re
from re import _constants as c
from re import _parser

import pytest

from dokuma.llm import gate, residue

CHARS = "abcxyz ,.:019'-"


def sample(items, r):
    """A text that the parsed pattern matches, look-arounds and anchors aside."""
    out = ""
    for op, av in items:
        if op is c.LITERAL:
            out += chr(av)
        elif op is c.IN:
            out += next(x for x in r.sample(CHARS * 3 + "defghijklmnoprstuvw_45%{}<>[]()", len(CHARS) * 3 + 31) + [chr(v) if o is c.LITERAL else chr(v[0]) for o, v in av if o in (c.LITERAL, c.RANGE)] if re.fullmatch(_class(av), x))
        elif op in (c.ANY, c.NOT_LITERAL):
            out += r.choice([x for x in CHARS if op is c.ANY or ord(x) != av])
        elif op is c.SUBPATTERN:
            out += sample(av[3], r)
        elif op is c.BRANCH:
            out += sample(r.choice(av[1]), r)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            lo, hi, sub = av
            out += "".join(sample(sub, r) for _ in range(r.randint(lo, min(hi, lo + 3))))
    return out


def _class(av):
    names = {c.CATEGORY_WORD: r"\w", c.CATEGORY_NOT_WORD: r"\W", c.CATEGORY_DIGIT: r"\d", c.CATEGORY_SPACE: r"\s"}
    one = lambda o, v: re.escape(chr(v)) if o is c.LITERAL else f"{re.escape(chr(v[0]))}-{re.escape(chr(v[1]))}" if o is c.RANGE else names[v]
    return "[" + "^" * (av[0][0] is c.NEGATE) + "".join(one(o, v) for o, v in av if o is not c.NEGATE) + "]"


@pytest.mark.parametrize("name", ["SLOT", "ASKING", "BRACE", "ANGLE", "BARE_SLOT", "UNFILLED", "MESSAGE", "NOTICE", "FRAGMENT"])
def test_evidence_is_hinted(name):
    judge, r, pattern, n = residue.Judge(), random.Random(5), getattr(residue, name), 0
    tree = _parser.parse(pattern.pattern)
    for _ in range(4000):
        s = residue.SPACES.sub(" ", sample(tree, r)).strip()
        for x in (s, s + " anlayisiniz icin cok tesekkur ederiz efendim", "12:30" + s):
            if residue.judge(x) > residue.NONE:
                n += 1
                assert judge.hinted(x), x
    assert n > 1000


def test_filler_is_hinted():
    judge, r, n = residue.Judge(), random.Random(6), 0
    words = [*sorted(residue.FILL), "xx", "xxxx", "kuslar", "bugun", "denizde"]
    for _ in range(4000):
        few = r.sample(words, r.choice([1, 2, 3, 8]))
        s = r.choice(["", "00:10 ", "00:10"]) + r.choice([" ", ". ", ", "]).join(r.choice(few) for _ in range(r.randint(3, 12)))
        if residue.judge(s) > residue.NONE:
            n += 1
            assert judge.hinted(s), s
    assert n > 500


@pytest.mark.parametrize(
    "line",
    [
        "sayfamiz gecici olarak kapalidir, anlayisiniz icin tesekkur ederiz.",
        "web sitesi gecici olarak kapalidir, anlayisiniz icin tesekkur ederiz.",
        "the server could not complete the operation, we are working on it.",
        "bu icerigi gormek icin js'i etkinlestirmeniz gerekiyor.",
    ],
)
def test_long_lines_are_judged(line):
    assert residue.Judge().line(line) == residue.STRONG


def test_literals():
    assert gate.literals(re.compile(r"^(?:a )?(?:kapi|pencere)\w* acil(?:di|iyor)\b")) == {" acildi", " aciliyor"}
    assert gate.literals(re.compile(r"x?[ab]c*d{2,}|ee+")) == {"d", "e"}
    with pytest.raises(ValueError):
        gate.literals(re.compile(r"kapi|\d+"))


@pytest.mark.parametrize(
    "line",
    [
        "sayfamiz kapalidir, anlayisiniz icin hepinize tesekkur ederiz.",
        "server could not find what it was looking for at this time",
        "deneme yazi deneme yazi deneme yazi ve bugun hava guzel",
        "deneme. deneme. deneme. deneme. deneme. deneme. deneme.",
        "deneme metin deneme metin deneme metin deneme metin",
    ],
)
def test_hints_cover_what_was_narrowed(line):
    """Long lines that the hints once let through, and then no more, are judged as without a gate."""
    assert len(line) >= 40 and residue.Judge().hinted(line)
    parts = [residue.judge(x) for x in residue.SENTENCE.split(line)]
    assert (residue.STRONG in parts or residue.judge(line) == residue.STRONG) == (residue.Judge().line(line) == residue.STRONG) is True
