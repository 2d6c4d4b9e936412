"""What other nodes decide about a node, as flag columns: ``:has()``, ``:not()`` and ``:is()`` with combinators inside,
``:lang()`` and ``:nth-child(... of S)``.

Every flag is a window or two over all nodes of a page, computed from the inside out, so that a flag's own conditions may
use flags; there is no join.  Where a node and its parent (or the element before it) have to meet, the sender is listed
a second time in the group of the other's label for that one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.plans.selector import Complex, Compound, Relative, any_of

_PAGE, _FAMILY = "partition by page_id order by pre", "partition by page_id, parent order by pre"
_BEFORE, _AFTER = "rows between unbounded preceding and 1 preceding", "rows between 1 following and unbounded following"
_LANG = "get(filter(attrs, a -> a.name = 'lang'), 0)"


class Flags:
    """Node rows with one more column for each flag that ``settle`` was asked for."""

    def __init__(self, nodes: DataFrame):
        self.rows = nodes
        self.columns = list(nodes.columns)
        self.names: dict = {}

    def __call__(self, asked) -> Column:
        return F.col(self.names[self._key(asked)])

    @staticmethod
    def _key(asked):
        """A selector's part goes by its identity, as do its steps (part, number); a name by itself."""
        return asked if isinstance(asked, str) else (id(asked[0]), asked[1]) if isinstance(asked, tuple) else id(asked)

    def settle(self, compound: Compound) -> None:
        """Add the flags that the compound's conditions read."""
        for test in compound.tests:
            if test[0] == "lang" and "lang" not in self.names:
                self._languages()
            elif test[0] == "has":
                for relative in test[1]:
                    self.settle(relative.step)
                    self._has(relative)
            elif test[0] in ("not", "is", "nth_of"):
                for part in test[-1]:
                    for step in part.steps:
                        self.settle(step)
                    if len(part.steps) > 1:
                        self._chain(part)
                if test[0] == "nth_of":
                    self._nth_of(*test[1:])

    def _known(self, asked) -> bool:
        return self._key(asked) in self.names

    def _add(self, asked, expression: str) -> None:
        name = f"_flag{len(self.names)}"
        self.rows = self.rows.selectExpr(*self.columns, f"coalesce({expression}, false) as {name}")
        self.names[self._key(asked)] = name
        self.columns.append(name)

    def _meet(self, here: str, there: str, sends: str) -> str:
        """Rows listed at ``here``, senders also at ``there``; SQL for "some sender is listed at my place".

        The senders' second rows go when the flag is added, by :meth:`_add_met`."""
        own, sent = f"struct({here} as _at, false as _sent)", f"struct({there} as _at, true as _sent)"
        self.rows = self.rows.selectExpr("*", f"inline(if(({sends}) and {there} is not null, array({own}, {sent}), array({own})))")
        return "max(_sent) over (partition by page_id, _at)"

    def _add_met(self, asked, here: str, there: str, sends: str, also: str = "true") -> None:
        found = self._meet(here, there, sends)
        self.rows = self.rows.selectExpr("*", f"({found}) and ({also}) as _met").filter("not _sent")
        self._add(asked, "_met")

    def _has(self, relative: Relative) -> None:
        """Does the node have such another one?  The least hit after it lies in its subtree, and so on for the siblings."""
        if self._known(relative):
            return
        self.rows = self.rows.withColumn("_hit", relative.step.column(self))
        if relative.combinator == " ":
            self._add(relative, f"min(if(_hit, pre, null)) over ({_PAGE} {_AFTER}) <= last")
        elif relative.combinator == "~":
            self._add(relative, f"max(_hit) over ({_FAMILY} {_AFTER})")
        else:
            self._add_met(relative, "pre", "parent" if relative.combinator == ">" else "prev_el", "_hit")

    def _chain(self, part: Complex) -> None:
        """Does the node match a complex selector?  Decided from left to right, each step over all nodes."""
        if self._known(part):
            return
        flag = part.steps[0].column(self)
        for i, step in enumerate(part.steps[1:], 1):
            asked = part if i == len(part.steps) - 1 else (part, i)
            self.rows = self.rows.withColumns({"_hit": flag, "_here": step.column(self)})
            combinator = part.combinators[i]
            if combinator == " ":
                self._add(asked, f"_here and max(if(_hit, last, null)) over ({_PAGE} {_BEFORE}) >= pre")
            elif combinator == "~":
                self._add(asked, f"_here and max(_hit) over ({_FAMILY} {_BEFORE})")
            else:
                self._add_met(asked, "parent" if combinator == ">" else "prev_el", "pre", "_hit", "_here")
            flag = self(asked)

    def _nth_of(self, reverse: bool, a: int, b: int, parts: list[Complex]) -> None:
        """Is the node, of the siblings that match the parts, in a place an + b?"""
        if self._known(parts):
            return
        matched = any_of(p.steps[0].column(self) if len(p.steps) == 1 else self(p) for p in parts)
        self.rows = self.rows.withColumn("_hit", matched)
        place = f"count(if(_hit, 1, null)) over ({_FAMILY} {'desc ' if reverse else ''}rows between unbounded preceding and current row)"
        steps = f"_place - ({b})" if a > 0 else f"({b}) - _place"
        self.rows = self.rows.selectExpr("*", f"{place} as _place")
        self._add(parts, f"_hit and _place = {b}" if a == 0 else f"_hit and {steps} >= 0 and ({steps}) % {abs(a)} = 0")

    def _languages(self) -> None:
        """The value of ``lang`` on the node or on the nearest ancestor that has one.

        Annotated subtrees nest: the running count of those open gives each node a level, and the latest annotated node of
        that level is the one that is open.
        """
        rows = self.rows.selectExpr("*", f"{_LANG} as _own")
        opened, closed = "struct(pre as _pos, 0 as _phase, if(_own is null, 0, 1) as _edge)", "struct(last as _pos, 1 as _phase, -1 as _edge)"
        rows = rows.selectExpr("*", f"inline(if(_own is null, array({opened}), array({opened}, {closed})))")
        level = "sum(_edge) over (partition by page_id order by _pos, _phase rows between unbounded preceding and current row)"
        rows = rows.selectExpr("*", f"{level} as _level").filter("_phase = 0")
        nearest = "last(if(_own is null, null, coalesce(_own.value, '')), true) over (partition by page_id, _level order by pre)"
        self.rows = rows.selectExpr(*self.columns, f"if(_level > 0, {nearest}, null) as _lang")
        self.names["lang"] = "_lang"
        self.columns.append("_lang")
