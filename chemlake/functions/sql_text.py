"""Expressions written as SQL text, under the names and operators of pyspark.sql.functions.

A feature of a molecule is made of hundreds of calls; written as text they cost nothing until F.expr(str(...)) hands
the whole over at once.  Only what such expressions need is here.
"""

from __future__ import annotations

import inspect
import sys
from collections.abc import Callable
from itertools import count

from pyspark.sql import functions

_NUMBERS = count()


class Text:
    """An expression; fields by [], conditions by == < & | ~, arithmetic by + - * /."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text

    def __str__(self) -> str:
        return self.text

    def __hash__(self) -> int:
        return hash(self.text)

    def __getitem__(self, field: str) -> Text:
        return Text(f"{self}.{field}")

    def _with(self, sign: str, other, turned: bool = False) -> Text:
        a, b = (lit(other), self) if turned else (self, lit(other))
        return Text(f"({a} {sign} {b})")

    def __eq__(self, other) -> Text:  # type: ignore[override]
        return self._with("=", other)

    def __ne__(self, other) -> Text:  # type: ignore[override]
        return self._with("<>", other)

    def __lt__(self, other) -> Text:
        return self._with("<", other)

    def __le__(self, other) -> Text:
        return self._with("<=", other)

    def __gt__(self, other) -> Text:
        return self._with(">", other)

    def __ge__(self, other) -> Text:
        return self._with(">=", other)

    def __and__(self, other) -> Text:
        return self._with("AND", other)

    def __or__(self, other) -> Text:
        return self._with("OR", other)

    def __invert__(self) -> Text:
        return Text(f"(NOT {self})")

    def __neg__(self) -> Text:
        return Text(f"(- {self})")

    def __add__(self, other) -> Text:
        return self._with("+", other)

    def __radd__(self, other) -> Text:
        return self._with("+", other, True)

    def __rsub__(self, other) -> Text:
        return self._with("-", other, True)

    def __rmul__(self, other) -> Text:
        return self._with("*", other, True)

    def __sub__(self, other) -> Text:
        return self._with("-", other)

    def __mul__(self, other) -> Text:
        return self._with("*", other)

    def __truediv__(self, other) -> Text:
        return self._with("/", other)

    def isin(self, *values) -> Text:
        return Text(f"({self} IN ({', '.join(str(lit(v)) for v in values)}))")

    def between(self, low, high) -> Text:
        return Text(f"({self} BETWEEN {lit(low)} AND {lit(high)})")

    def isNotNull(self) -> Text:  # noqa: N802  as in pyspark
        return Text(f"({self} IS NOT NULL)")

    def isNull(self) -> Text:  # noqa: N802
        return Text(f"({self} IS NULL)")

    def cast(self, kind: str) -> Text:
        return Text(f"CAST({self} AS {kind})")

    def contains(self, other) -> Text:
        return Text(f"contains({self}, {lit(other)})")

    def alias(self, name: str) -> Text:
        return Text(f"{self} AS {name}")


class Case(Text):
    """when(...).when(...).otherwise(...)"""

    __slots__ = ("branches",)

    def __init__(self, branches: tuple[str, ...]):
        self.branches = branches
        super().__init__(f"(CASE {' '.join(branches)} END)")

    def when(self, condition: Text, value) -> Case:
        return Case((*self.branches, f"WHEN {condition} THEN {lit(value)}"))

    def otherwise(self, value) -> Text:
        return Text(f"(CASE {' '.join(self.branches)} ELSE {lit(value)} END)")


def lit(value) -> Text:
    if isinstance(value, Text):
        return value
    if value is None or isinstance(value, bool):
        return Text("NULL" if value is None else str(value).lower())
    if isinstance(value, str):
        return Text("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'")
    return Text(f"{value!r}D" if isinstance(value, float) else str(value))


def col(name: str) -> Text:
    return Text(name)


def when(condition: Text, value) -> Case:
    return Case((f"WHEN {condition} THEN {lit(value)}",))


def _lambda(f: Callable) -> str:
    """f as SQL, under variables of its own."""
    names = [f"x{next(_NUMBERS)}" for p in inspect.signature(f).parameters.values() if p.default is p.empty]
    shown = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{shown} -> {f(*map(Text, names))}"


def _over(name: str) -> Callable[[Text, Callable], Text]:
    return lambda values, f: Text(f"{name}({values}, {_lambda(f)})")


def _plain(name: str) -> Callable[..., Text]:
    return lambda *parts: Text(f"{name}({', '.join(str(lit(p)) for p in parts)})")


filter, transform, exists, forall = map(_over, ("filter", "transform", "exists", "forall"))  # noqa: A001
# as pyspark.sql.functions has them, but that a plain str is a text, never a column's name
_SAME = (
    "array", "array_compact", "array_contains", "array_distinct", "array_intersect", "array_join", "array_min", "array_position", "array_sort", "ascii", "coalesce", "concat", "concat_ws", "flatten", "format_string", "get", "greatest", "least", "length",
    "lower", "lpad", "nullif", "pmod", "regexp_extract", "regexp_replace", "replace", "reverse", "right", "rlike", "sequence", "size", "slice", "split", "struct", "substring", "translate", "trim", "try_element_at", "upper",
)
globals().update({name: _plain(name) for name in _SAME})
create_map = _plain("map")


def api(value):
    """This module for Text, pyspark.sql.functions for a Column: what is written by either is the same."""
    return sys.modules[__name__] if isinstance(value, Text) else functions


def aggregate(values: Text, start, merge: Callable) -> Text:
    return Text(f"aggregate({values}, {lit(start)}, {_lambda(merge)})")
