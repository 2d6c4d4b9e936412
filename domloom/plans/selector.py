"""Selector text -> small driver-side description -> Columns.

Only a thin translation: no matching happens here.  A ``Selector`` is compiled once and can be
applied to any node table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from domloom.errors import SelectorParseError, UnsupportedSelector
from domloom.functions.props import has_word
from domloom.schema import ELEMENT

_IDENT = r"(?:--|-?(?:[A-Za-z_]|[^\x00-\x7f]|\\.))(?:[\w-]|[^\x00-\x7f]|\\.)*"
_STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'"
_SPACE = r"[ \t\n\f\r]*"
_TYPE = re.compile(rf"\*|{_IDENT}", re.A)
_HASH = re.compile(rf"#((?:[\w-]|[^\x00-\x7f]|\\.)+)", re.A)
_CLASS = re.compile(rf"\.({_IDENT})", re.A)
_ATTRIB = re.compile(
    rf"\[{_SPACE}({_IDENT}){_SPACE}(?:([~|^$*]?=){_SPACE}({_IDENT}|{_STRING}){_SPACE}([iIsS])?{_SPACE})?\]", re.A
)
_PSEUDO = re.compile(rf":({_IDENT})(\()?", re.A)
_NTH = re.compile(r"(?:([+-]?\d*)n(?:\s*([+-])\s*(\d+))?|([+-]?\d+))", re.I)
_NTH_OF = re.compile(r"\s*([^()]*?)\s+of\s+", re.I)
_LANGUAGE = re.compile(rf"{_SPACE}({_IDENT}|{_STRING}){_SPACE}([,)])", re.A)
_COMBINATOR = re.compile(r"[ \t\n\f\r]*([>+~])[ \t\n\f\r]*|[ \t\n\f\r]+")
_ESCAPE = re.compile(r"\\(?:([0-9a-fA-F]{1,6})[ \t\n\f\r]?|(.))", re.S)

# index column and the (a, b) of an+b for pseudo-classes that take no argument
_FIXED_POSITION = {
    "first-child": [("el_idx", 0, 1)],
    "last-child": [("el_rev", 0, 1)],
    "only-child": [("el_idx", 0, 1), ("el_rev", 0, 1)],
    "first-of-type": [("ty_idx", 0, 1)],
    "last-of-type": [("ty_rev", 0, 1)],
    "only-of-type": [("ty_idx", 0, 1), ("ty_rev", 0, 1)],
}
_NTH_COLUMN = {
    "nth-child": "el_idx",
    "nth-last-child": "el_rev",
    "nth-of-type": "ty_idx",
    "nth-last-of-type": "ty_rev",
}


@dataclass
class Compound:
    """Conditions on one element.  ``tests`` are tuples of a test name and its arguments."""

    tag: str | None = None
    tests: list[tuple] = field(default_factory=list)

    def alone(self) -> bool:
        """The element's own row decides: nothing inside looks at other nodes."""
        return all(
            test[0] not in ("has", "lang", "nth_of") and (test[0] not in ("not", "is") or all(len(c.steps) == 1 and c.steps[0].alone() for c in test[1]))
            for test in self.tests
        )

    def column(self, flags=None) -> Column:
        """Boolean, never-NULL Column; ``flags`` gives the Column of an argument that other nodes decide (see plans.flags)."""
        cond = F.col("kind") == ELEMENT
        if self.tag:
            cond = cond & (F.col("tag") == self.tag)
        for test in self.tests:
            cond = cond & _TESTS[test[0]](flags, *test[1:])
        return cond


@dataclass
class Complex:
    """Compounds joined by combinators; ``combinators[i]`` stands before ``steps[i]`` (the first is None)."""

    steps: list[Compound]
    combinators: list[str | None]


@dataclass
class Relative:
    """What ``:has()`` looks for: a combinator and a compound, which may look for what follows it in the same way."""

    combinator: str
    step: Compound


@dataclass
class Selector:
    text: str
    parts: list[Complex]

    @property
    def is_flat(self) -> bool:
        """No combinators anywhere: one filter decides a match."""
        return all(len(p.steps) == 1 and p.steps[0].alone() for p in self.parts)

    def column(self) -> Column:
        """The match condition of a flat selector."""
        if not self.is_flat:
            raise ValueError(f"{self.text!r} needs more than one node to decide")
        return any_of(p.steps[0].column() for p in self.parts)



def any_of(columns) -> Column:
    out = None
    for c in columns:
        out = c if out is None else out | c
    return F.lit(False) if out is None else out


# -- tests -> Columns


def _test_id(_flags, value):
    return F.col("id").isNotNull() & (F.col("id") == value)


def _test_class(_flags, name):
    return F.col("class").isNotNull() & has_word(F.col("class"), name)


def _test_attr(_flags, name, op, value, fold):
    if op is None:
        return F.exists("attrs", lambda a: a["name"] == name)
    if value == "" and op in ("^=", "$=", "*="):
        return F.lit(False)
    wanted = value.lower() if fold else value

    def hit(a):
        have = F.coalesce(a["value"], F.lit(""))
        have = F.lower(have) if fold else have
        match = {
            "=": lambda: have == wanted,
            "^=": lambda: have.startswith(wanted),
            "$=": lambda: have.endswith(wanted),
            "*=": lambda: have.contains(wanted),
            "~=": lambda: has_word(have, wanted),
            "|=": lambda: (have == wanted) | have.startswith(wanted + "-"),
        }[op]()
        return (a["name"] == name) & match

    return F.exists("attrs", hit)


def _test_position(_flags, column, a, b):
    # A parentless element (a detached clone) has no siblings; :nth-* still counts it as the first.
    col = F.col(column)
    if a == 0:
        return F.coalesce(col == b, F.lit(False))
    steps = (col - b) if a > 0 else (F.lit(b) - col)
    return F.coalesce((steps >= 0) & (steps % abs(a) == 0), F.lit(False))


def _test_root(_flags):
    return F.col("depth") == 1


def _test_empty(_flags):
    return F.col("hollow")


def _test_is(flags, parts):
    return any_of(part.steps[0].column(flags) if len(part.steps) == 1 else flags(part) for part in parts)


def _test_not(flags, parts):
    return ~_test_is(flags, parts)


def _test_has(flags, parts):
    return any_of(flags(part) for part in parts)


def _test_lang(flags, ranges):
    have = F.lower(flags("lang"))
    return any_of(F.coalesce((have == r) | have.startswith(r + "-"), F.lit(False)) for r in ranges)


def _test_nth_of(flags, _reverse, _a, _b, parts):
    return flags(parts)


def _test_state(_flags, name):
    """Form and link states as the attributes alone decide them; a disabled fieldset does not reach its controls."""

    def has(attribute):
        return F.exists("attrs", lambda a: a["name"] == attribute)

    tag = F.col("tag")
    if name in ("link", "any-link"):
        return tag.isin("a", "area") & has("href")
    if name == "checked":
        box = F.exists("attrs", lambda a: (a["name"] == "type") & F.lower(a["value"]).isin("checkbox", "radio"))
        return ((tag == "input") & box & has("checked")) | ((tag == "option") & has("selected"))
    control = tag.isin("button", "input", "select", "textarea", "optgroup", "option", "fieldset")
    return control & (has("disabled") if name == "disabled" else ~has("disabled"))


_TESTS = {
    "id": _test_id,
    "class": _test_class,
    "attr": _test_attr,
    "position": _test_position,
    "root": _test_root,
    "empty": _test_empty,
    "not": _test_not,
    "is": _test_is,
    "has": _test_has,
    "state": _test_state,
    "lang": _test_lang,
    "nth_of": _test_nth_of,
}

_STATES = ("link", "any-link", "checked", "disabled", "enabled")
# Fixed names: pseudo-classes of CSS that need what the node table lacks, or are not built.
_UNSUPPORTED = (
    "active autofill blank current default defined dir focus focus-visible focus-within fullscreen future host hover in-range "
    "indeterminate invalid local-link modal muted nth-col nth-last-col open optional out-of-range past paused picture-in-picture "
    "placeholder-shown playing popover-open read-only read-write required scope target target-within user-invalid user-valid valid visited"
).split()

# -- text -> description


def _plain(token: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] and 0 < int(m[1], 16) < 0x110000 else m[2] or "�", token)


def _an_plus_b(text: str):
    text = text.strip().lower()
    if text in ("odd", "even"):
        return 2, int(text == "odd")
    m = _NTH.fullmatch(text)
    if m is None:
        return None
    if m[4] is not None:
        return 0, int(m[4])
    a = int(m[1] + "1") if m[1] in ("", "+", "-") else int(m[1])
    return a, int(f"{m[2]}{m[3]}") if m[3] else 0


def _has_inside(compound: Compound) -> bool:
    inner = [step for test in compound.tests if test[0] in ("not", "is", "nth_of") for part in test[-1] for step in part.steps]
    return any(test[0] == "has" for test in compound.tests) or any(map(_has_inside, inner))


class _Reader:
    def __init__(self, text):
        self.text, self.pos = text, 0

    def take(self, pattern):
        m = pattern.match(self.text, self.pos)
        if m:
            self.pos = m.end()
        return m

    def fail(self):
        raise SelectorParseError(f"bad selector {self.text!r} at {self.pos}")

    def selector_list(self, closing=None):
        parts = [self.complex(closing)]
        while self.pos < len(self.text) and self.text[self.pos] == ",":
            self.pos += 1
            parts.append(self.complex(closing))
        if closing:
            if not self.text.startswith(closing, self.pos):
                self.fail()
            self.pos += 1
        elif self.pos < len(self.text):
            self.fail()
        return parts

    def complex(self, closing):
        self.take(re.compile(_SPACE))
        steps, combinators = [self.compound()], [None]
        while True:
            m = self.take(_COMBINATOR)
            if self.pos >= len(self.text) or self.text[self.pos] in (",", closing):
                if m and m[1]:
                    self.fail()
                return Complex(steps, combinators)
            if m is None:
                self.fail()
            combinators.append(m[1] or " ")
            steps.append(self.compound())

    def relative_list(self):
        """Arguments of ``:has()``: complex selectors, with or without a combinator before them.

        What stands right of a compound is looked for from there: ``:has(> a b)`` asks for ``> a`` that has a ``b``.
        """
        out = []
        while True:
            self.take(re.compile(_SPACE))
            m = self.take(_COMBINATOR)
            part = self.complex(")")
            if any(_has_inside(step) for step in part.steps):
                self.fail()
            for i in range(len(part.steps) - 1, 0, -1):
                part.steps[i - 1].tests.append(("has", [Relative(part.combinators[i], part.steps[i])]))
            out.append(Relative(m[1] if m else " ", part.steps[0]))
            closing = self.text[self.pos : self.pos + 1]
            self.pos += 1
            if closing == ")":
                return out
            if closing != ",":
                self.fail()

    def compound(self):
        start, out = self.pos, Compound()
        m = self.take(_TYPE)
        if m and m[0] != "*":
            out.tag = _plain(m[0]).lower()
        while True:
            if m := self.take(_HASH):
                out.tests.append(("id", _plain(m[1])))
            elif m := self.take(_CLASS):
                out.tests.append(("class", _plain(m[1])))
            elif m := self.take(_ATTRIB):
                value = m[3] and _plain(m[3][1:-1] if m[3][0] in "\"'" else m[3])
                out.tests.append(("attr", _plain(m[1]).lower(), m[2], value, (m[4] or "").lower() == "i"))
            elif m := self.take(_PSEUDO):
                self.pseudo(m[1].lower(), bool(m[2]), out)
            else:
                break
        if self.pos == start:
            self.fail()
        return out

    def languages(self):
        """Arguments of ``:lang()``: names or strings, lower-cased; an empty one matches nothing."""
        out = []
        while m := self.take(_LANGUAGE):
            out.append(_plain(m[1][1:-1] if m[1][0] in "\"'" else m[1]).lower())
            if m[2] == ")":
                return tuple(r for r in out if r)
        self.fail()

    def pseudo(self, name, call, out):
        if call and name in ("not", "is", "where", "matches"):
            out.tests.append(("not" if name == "not" else "is", self.selector_list(")")))
        elif call and name == "has":
            out.tests.append(("has", self.relative_list()))
        elif not call and name in _STATES:
            out.tests.append(("state", name))
        elif call and name == "lang":
            out.tests.append(("lang", self.languages()))
        elif call and name in ("nth-child", "nth-last-child") and (m := _NTH_OF.match(self.text, self.pos)) and _an_plus_b(m[1]):
            self.pos = m.end()
            out.tests.append(("nth_of", name == "nth-last-child", *_an_plus_b(m[1]), self.selector_list(")")))
        elif name in _UNSUPPORTED:
            raise UnsupportedSelector(f":{name} in {self.text!r}")
        elif call and name in _NTH_COLUMN:
            stop = self.text.find(")", self.pos)
            nth = _an_plus_b(self.text[self.pos : stop]) if stop >= 0 else None
            if nth is None:
                self.fail()
            self.pos = stop + 1
            out.tests.append(("position", _NTH_COLUMN[name], *nth))
        elif not call and name in _FIXED_POSITION:
            out.tests.extend(("position", *p) for p in _FIXED_POSITION[name])
        elif not call and name in ("root", "empty"):
            out.tests.append((name,))
        else:
            self.fail()


def compile_selector(text: str) -> Selector:
    """Compile selector text; raises :class:`SelectorParseError` when it is not valid."""
    if not text or not text.strip():
        raise SelectorParseError("empty selector")
    return Selector(text, _Reader(text).selector_list())
