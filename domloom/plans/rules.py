"""Many selectors as tables: a rule index that is joined with the nodes, so the plan does not grow with the rules.

Three tables are made of the rules' text:

* ``compounds``: the distinct compounds (``p.lead``, ``a[href]``), each with the conditions it consists of and one *key*, the
  rarest of id, class, attribute name and tag that it asks for;
* ``states``: the distinct beginnings of the rules' complex selectors (``nav``, ``nav a``, ``nav a > b``); a state is a
  compound reached over a combinator from the state before, so rules that begin alike share the work;
* ``ends``: the states in which a rule is done.

Nodes list their own keys and meet the compounds by hash join; only such candidates have their conditions checked, by
one expression that reads the conditions from the row.  Then the states are settled step by step with the windows of
:mod:`domloom.plans.match`, all rules at once, inside (page, state before).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domloom.errors import SelectorParseError, UnsupportedSelector
from domloom.functions.props import classes
from domloom.operators.index import with_index
from domloom.plans.match import match_parts, scope_filter
from domloom.plans.selector import _TESTS, Complex, Compound, compile_selector
from domloom.schema import ELEMENT
from domloom.session import shared_dir

#: Rows of an index table up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST = 200_000
#: Rules up to which their expressions go into the plan; more of them are joined as a table.
FEW = 16
#: Rules that need other nodes inside a compound (``:has()``, ``:not()`` with combinators): expressions of the plan, so few.
WIDER = 100

_ATOM = "struct<test: string, name: string, op: string, value: string, a: int, b: int>"
_CLAUSES = f"array<struct<negated: boolean, options: array<array<{_ATOM}>>>>"
_STEPS = f"rule string, error string, wider boolean, state long, above long, combinator string, step int, compound long, key string, clauses {_CLAUSES}, ends boolean"
_COMBINATORS = (" ", ">", "+", "~")


def _atom(test: str, name: str = "", op: str = "", value: str = "", a: int = 0, b: int = 0) -> dict:
    return {"test": test, "name": name, "op": op, "value": value, "a": a, "b": b}


def _plain(compound: Compound) -> list[dict] | None:
    """A compound without ``:is()``, ``:not()`` and ``:has()`` as conditions that all hold; else None."""
    out = [_atom("tag", compound.tag)] if compound.tag else []
    for test, *args in compound.tests:
        if test in ("id", "class"):
            out.append(_atom(test, value=args[0]))
        elif test == "attr":
            name, op, value, fold = args
            out.append(_atom("attr", name, (op or "") + ("i" if fold else ""), (value or "").lower() if fold else value or ""))
        elif test == "position":
            out.append(_atom("position", args[0], a=args[1], b=args[2]))
        elif test in ("root", "empty"):
            out.append(_atom(test))
        elif test == "state":
            out.append(_atom("state", args[0]))
        else:
            return None
    return out


def _clauses(compound: Compound) -> list[dict] | None:
    """Clauses that all hold; each has options, of which one holds, or none where it is negated.  None: needs other nodes."""
    own = Compound(compound.tag, [t for t in compound.tests if t[0] not in ("is", "not")])
    base = _plain(own)
    if base is None:
        return None
    out = [{"negated": False, "options": [base]}]
    for test, *args in compound.tests:
        if test in ("is", "not"):
            options = [_plain(p.steps[0]) if len(p.steps) == 1 else None for p in args[0]]
            if None in options:
                return None
            out.append({"negated": test == "not", "options": options})
    return out


def _key(clauses: list[dict]) -> str:
    """What a node must have to be a candidate: ``#id``, ``.class``, ``[attribute=value``, ``[attribute``, ``tag`` or, for any element, ``*``."""
    atoms = clauses[0]["options"][0]
    for test, mark, field in (("id", "#", "value"), ("class", ".", "value"), ("attr", "[", "name"), ("tag", "", "name")):
        found = [f"[{a['name']}={a['value']}" for a in atoms if a["test"] == test and a["op"] == "="]
        if found := found or [mark + a[field] for a in atoms if a["test"] == test]:
            return max(found, key=lambda k: (len(k), k))
    return "*"


def _code(value) -> int:
    return xxhash.xxh64_intdigest(json.dumps(value)) - (1 << 63)


def steps_of(rule: str, selector: str) -> list[dict]:
    """The rows of one rule: a step of a complex selector each, or one row with the error of a selector that does not parse."""
    blank = dict.fromkeys(("error", "state", "above", "combinator", "step", "compound", "key", "clauses")) | {"rule": rule, "wider": False, "ends": False}
    try:
        parts = compile_selector(selector).parts
    except (SelectorParseError, UnsupportedSelector) as e:
        return [blank | {"error": f"{type(e).__name__}: {e}"}]
    out = []
    for part in parts:
        described = [_clauses(step) for step in part.steps]
        if None in described:
            return [blank | {"wider": True}]
        out += [blank | row for row in _states(part, described)]
    return out


def _states(part: Complex, described: list[list[dict]]) -> list[dict]:
    out, path, above = [], [], None
    for i, clauses in enumerate(described):
        path.append([part.combinators[i], clauses])
        state = _code(path)
        out.append({"state": state, "above": above, "combinator": part.combinators[i], "step": i, "compound": _code(clauses), "key": _key(clauses),
                    "clauses": clauses, "ends": i == len(described) - 1})
        above = state
    return out


def _parsed(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            rows = [row for rule, selector in zip(*(c.to_pylist() for c in part.columns)) for row in steps_of(rule, selector or "")]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _arrow() -> pa.Schema:
    atom = pa.struct([(n, pa.int32() if n in "ab" else pa.string()) for n in ("test", "name", "op", "value", "a", "b")])
    clause = pa.struct([("negated", pa.bool_()), ("options", pa.list_(pa.list_(atom)))])
    kinds = {"wider": pa.bool_(), "ends": pa.bool_(), "state": pa.int64(), "above": pa.int64(), "compound": pa.int64(), "step": pa.int32(), "clauses": pa.list_(clause)}
    names = ("rule", "error", "wider", "state", "above", "combinator", "step", "compound", "key", "clauses", "ends")
    return pa.schema([(n, kinds.get(n, pa.string())) for n in names])


_ARROW = _arrow()


@dataclass
class RuleIndex:
    """The written index of a rule table; see :func:`rule_index`."""

    compounds: DataFrame
    states: DataFrame
    ends: DataFrame
    errors: DataFrame
    #: The combinators that lead to each step, from the second on; what the plan has windows for.
    combinators: list[tuple[str, ...]]
    #: Rules (rule -> selector) that go through the plan's own expressions.
    wider: dict[str, str]
    #: Some rule has several complex selectors, so a node may match it twice.
    lists: bool
    small: bool

    def _joined(self, rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
        return rows.join(F.broadcast(table) if self.small else table, on)


def rule_index(spark: SparkSession, rules: DataFrame | dict) -> RuleIndex:
    """The index of ``rules``: a dict, or a table with columns ``rule`` and ``selector`` of any number of rows.

    Rows of one rule count as a list of selectors.  It is parsed in parallel and written to the shared folder once.
    Rules that do not parse are in ``errors`` (rule, error).
    """
    if isinstance(rules, dict):
        rules = spark.createDataFrame([(str(r), str(s)) for r, s in rules.items()], "rule string, selector string")
    table = rules.select(F.col("rule").cast("string").alias("rule"), F.col("selector").cast("string").alias("selector")).where("rule IS NOT NULL")
    path = f"{shared_dir(spark)}/rules"
    table.mapInArrow(_parsed, _STEPS).write.parquet(path)
    steps = spark.read.schema(_STEPS).parquet(path)
    good = steps.where("error IS NULL AND NOT wider")
    shape = good.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("step") > 0, F.struct("step", "combinator"))).alias("used")).first()  # at most 4 a step
    deepest = max((u.step for u in shape.used), default=0)
    combinators = [tuple(c for c in _COMBINATORS if any(u.step == s and u.combinator == c for u in shape.used)) for s in range(1, deepest + 1)]
    names = steps.where("wider").select("rule").distinct()
    wider = names.join(table, "rule").groupBy("rule").agg(F.array_join(F.collect_list("selector"), ", ").alias("selector")).limit(WIDER + 1).collect()
    if len(wider) > WIDER:
        raise UnsupportedSelector(f"more than {WIDER} rules with :has() or with combinators inside :not() and :is()")
    above = good.where("above IS NOT NULL").select(F.col("above").alias("state"), F.lit(True).alias("goes_on")).distinct()
    states = good.groupBy("state", "above", "combinator", "step", "compound").agg(F.max("ends").alias("ends")).join(above, "state", "left")
    ends = good.where("ends").select("state", "rule").distinct()
    return RuleIndex(
        good.select("compound", "key", "clauses").dropDuplicates(["compound"]),
        states.withColumn("goes_on", F.coalesce("goes_on", F.lit(False))),
        ends,
        steps.where("error IS NOT NULL").select("rule", "error"),
        combinators,
        {r.rule: r.selector for r in wider},
        not ends.groupBy("rule").count().where("count > 1").isEmpty(),
        shape.n <= BROADCAST,
    )


# -- checking the conditions of a candidate


def _attribute(x: Column) -> Column:
    folded = F.endswith(x["op"], F.lit("i"))
    op = F.when(folded, F.substr(x["op"], F.lit(1), F.length(x["op"]) - 1)).otherwise(x["op"])

    def hit(a):
        raw = F.coalesce(a["value"], F.lit(""))
        have, want = F.when(folded, F.lower(raw)).otherwise(raw), x["value"]
        some = want != ""
        word = F.array_contains(F.filter(F.split(have, r"[ \t\n\f\r]+"), lambda w: w != ""), want)
        dash = (have == want) | F.startswith(have, F.concat(want, F.lit("-")))
        return (a["name"] == x["name"]) & (
            F.when(op == "", F.lit(True)).when(op == "=", have == want).when(op == "^=", some & F.startswith(have, want))
            .when(op == "$=", some & F.endswith(have, want)).when(op == "*=", some & F.contains(have, want)).when(op == "~=", word).when(op == "|=", dash)
        )

    return F.exists("attrs", hit)


def _position(x: Column) -> Column:
    at = F.lit(None).cast("long")
    for name in ("el_idx", "el_rev", "ty_idx", "ty_rev"):
        at = F.when(x["name"] == name, F.col(name)).otherwise(at)
    steps = F.when(x["a"] > 0, at - x["b"]).otherwise(x["b"] - at)
    return F.when(x["a"] == 0, at == x["b"]).otherwise((steps >= 0) & (steps % F.abs(x["a"]) == 0))


def _holds(x: Column) -> Column:
    state = F.lit(False)
    for name in ("link", "any-link", "checked", "enabled", "disabled"):
        state = F.when(x["name"] == name, _TESTS["state"](None, name)).otherwise(state)
    tests = {
        "tag": F.col("tag") == x["name"], "id": F.col("id") == x["value"], "class": F.array_contains("_words", x["value"]), "attr": _attribute(x),
        "position": _position(x), "root": F.col("depth") == 1, "empty": F.col("hollow"), "state": state,
    }
    out = F.lit(False)
    for name, test in tests.items():
        out = F.when(x["test"] == name, test).otherwise(out)
    return F.coalesce(out, F.lit(False))


def _all_hold() -> Column:
    def clause(c):
        return F.exists(c["options"], lambda option: F.forall(option, _holds)) != c["negated"]

    return F.forall("clauses", clause)


# -- matching


def match_index(nodes: DataFrame, index: RuleIndex, scope: str = "body", include_root: bool = False) -> DataFrame:
    """Rows ``rule`` + node columns for every (rule, node) match, each once; ``rule`` is a string."""
    nodes = with_index(nodes)
    columns = nodes.columns
    elements = nodes.where(F.col("kind") == ELEMENT).withColumn("_words", classes(F.col("class")))
    names = F.transform("attrs", lambda a: F.concat(F.lit("["), a["name"]))
    values = F.transform("attrs", lambda a: F.concat(F.lit("["), a["name"], F.lit("="), F.coalesce(a["value"], F.lit(""))))
    own = F.concat(F.transform("_words", lambda w: F.concat(F.lit("."), w)), names, values, F.array(F.col("tag"), F.lit("*"), F.concat(F.lit("#"), "id")))
    keyed = elements.withColumn("key", F.explode(F.array_distinct(F.array_compact(own))))
    candidates = index._joined(keyed, index.compounds, "key").where(_all_hold()).select(*columns, "compound")
    rows = index._joined(candidates, index.states, "compound").drop("compound").selectExpr("*", "step = 0 as _ok")
    for step, combinators in enumerate(index.combinators, 1):
        rows = _settle(rows, step, combinators)
    done = rows.where("ends AND _ok").where(scope_filter(scope, include_root))
    matched = index._joined(done, index.ends, "state").select("rule", *columns)
    if index.lists:
        matched = matched.dropDuplicates(["page_id", "pre", "rule"])
    if index.wider:
        parts = {rule: compile_selector(s).parts for rule, s in index.wider.items()}
        more = match_parts(nodes, parts, scope, include_root).withColumn("rule", F.col("rule").cast("string"))
        matched = matched.unionByName(more.dropDuplicates(["page_id", "pre", "rule"]))
    return matched


def _settle(rows: DataFrame, step: int, combinators: tuple[str, ...]) -> DataFrame:
    """Settle the candidates of ``step`` against the nodes matched in the states before."""
    left = f"(_ok and step = {step - 1} and goes_on)"
    rows = rows.selectExpr("*", f"case when step = {step} then above when {left} then state end as _group")
    group = "page_id, _group"
    # A candidate stands before a matched row of the same node, which is no ancestor or sibling of itself.
    before = "order by pre, step desc rows between unbounded preceding and 1 preceding"

    def meet(link):
        return f"max({left}) over (partition by {group}, if(step = {step}, {link}, pre))"

    found = {
        " ": f"max(if({left}, last, null)) over (partition by {group} {before}) >= pre",
        ">": meet("parent"),
        "+": meet("prev_el"),
        "~": f"max({left}) over (partition by {group}, parent {before})",
    }
    whens = " ".join(f"when combinator = '{c}' then {found[c]}" for c in combinators)
    rows = rows.selectExpr("* except (_ok, _group)", f"if(step = {step}, coalesce(case {whens} end, false), _ok) as _ok")
    # Settled rows stay only while they matter: as matched nodes of this step, or as results.
    return rows.where(f"step > {step} or (_ok and (step = {step} or ends))")
