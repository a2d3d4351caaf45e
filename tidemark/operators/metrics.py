"""Metrics by written formulas over readings: `sum_4q(cash - capex) / sum_4q(revenue)`, `seats_t / seats_{t-4q} - 1`.

A formula is arithmetic over names of concepts. A name or a bracket may be dated (_t, _{t-4q}, _{t-1y}); sum_, avg_, max_ and
min_ followed by a number of quarters or years take adjacent periods ending now, also as sum(x, 4q); yoy(x) is growth
against the same quarter of the year before, avg_bal(x) and avg(x) the mean of opening and closing balance; abs(x), max(a, b)
and min(a, b) are taken within a period. All formulas become columns of one plan: readings are pivoted to a row for each
entity and period, and every dated part is a window over the same partitioning, sorted once.

A value is undetermined (null) where any period or concept it needs is missing, or a divisor is zero (reason missing), or the text
is no formula (reason unreadable).
"""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SIGNS = str.maketrans({"×": "*", "÷": "/", "−": "-", "–": "-"})
DATED = re.compile(r"_\{\s*[tq]\s*(?:-\s*(\d+)\s*([qy]?)\s*)?\}|(?<=\w)_t\b|(?<=\))_t\b")
SPAN = re.compile(r"\b(\d+)([qy])\b")
OVER = re.compile(r"(sum|avg|max|min)_(\d+)([qy])$")
WHOLE = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}
LONGEST = 2000  # characters of a formula


class Unreadable(ValueError):
    pass


def parsed(formula: str, per_year: int = 4) -> ast.expr:
    """The formula as an expression tree: dates of parts are subscripts, in periods back."""
    if len(formula) > LONGEST:
        raise Unreadable("too long")
    periods = lambda n, unit: str(int(n or 0) * (per_year if unit == "y" else 1))
    text = DATED.sub(lambda m: f"[{periods(m[1], m[2])}]", formula.translate(SIGNS))
    text = SPAN.sub(lambda m: periods(m[1], m[2]), text)
    try:
        return ast.parse(text.strip(), mode="eval").body
    except (SyntaxError, ValueError, RecursionError, MemoryError) as error:
        raise Unreadable(formula) from error


class Compiler:
    """Expression trees to columns. Windows over expressions that hold windows need a stage each: stages[k] are columns that may
    use those of stages before."""

    def __init__(self, entity: list[str], period: str, per_year: int = 4):
        self.entity, self.period, self.per_year = entity, period, per_year
        self.names: dict[str, str] = {}  # concept: its column
        self.stages: list[dict[str, Column]] = []
        self.known: dict[str, tuple[Column, int]] = {}

    def column(self, node: ast.expr) -> tuple[Column, int]:
        """The value of a node, and the stage from which on it can be used."""
        name = ast.dump(node)
        if name not in self.known:
            self.known[name] = self._column(node)
        return self.known[name]

    def _column(self, node: ast.expr) -> tuple[Column, int]:
        match node:
            case ast.Constant(value=int() | float()) if not isinstance(node.value, bool):
                return F.lit(float(node.value)), 0
            case ast.Name(id=concept):
                return F.col(self.names.setdefault(concept, f"__x{len(self.names)}")), 0
            case ast.UnaryOp(op=ast.USub() | ast.UAdd(), operand=part):
                value, stage = self.column(part)
                return (-value if isinstance(node.op, ast.USub) else value), stage
            case ast.BinOp(left=left, op=ast.Add() | ast.Sub() | ast.Mult() | ast.Div() as op, right=right):
                (a, i), (b, j) = self.column(left), self.column(right)
                value = a + b if isinstance(op, ast.Add) else a - b if isinstance(op, ast.Sub) else a * b if isinstance(op, ast.Mult) else F.try_divide(a, b)
                return value, max(i, j)
            case ast.Subscript(value=part, slice=ast.Constant(value=int(back))):
                return self.column(part) if not back else self.over(part, "max", back, back)
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if args:
                return self.call(name, args)
        raise Unreadable(ast.dump(node))

    def call(self, name: str, args: list[ast.expr]) -> tuple[Column, int]:
        if m := OVER.match(name):
            name, args = m[1], [args[0], ast.Constant(int(m[2]) * (self.per_year if m[3] == "y" else 1)), *args[1:]]
        match name, args:
            case ("sum" | "avg" | "max" | "min"), [part, ast.Constant(value=int(periods))] if periods > 0 and not isinstance(part, ast.Constant):
                return self.over(part, name, periods - 1, 0)
            case ("avg" | "avg_bal"), [part]:
                return self.over(part, "avg", 1, 0)
            case "yoy", [part]:
                return self.column(ast.BinOp(ast.BinOp(part, ast.Div(), ast.Subscript(part, ast.Constant(self.per_year))), ast.Sub(), ast.Constant(1)))
            case "abs", [part]:
                value, stage = self.column(part)
                return F.abs(value), stage
            case ("max" | "min"), [_, _, *_]:
                values = [self.column(a) for a in args]
                pick = F.greatest if name == "max" else F.least
                known = [v.isNotNull() for v, _ in values]
                whole = known[0]
                for k in known[1:]:
                    whole = whole & k
                return F.when(whole, pick(*(v for v, _ in values))), max(s for _, s in values)
        raise Unreadable(name)

    def over(self, part: ast.expr, how: str, first: int, last: int) -> tuple[Column, int]:
        """An aggregate over the periods from `first` to `last` back, all of which must be there."""
        value, stage = self.column(part)
        rows = Window.partitionBy(*self.entity).orderBy(self.period).rangeBetween(-first, -last)
        while len(self.stages) <= stage:
            self.stages.append({})
        name = f"__w{sum(map(len, self.stages))}"
        self.stages[stage][name] = F.when(F.count(value).over(rows) == first - last + 1, WHOLE[how](value).over(rows))
        return F.col(name), stage + 1


def by_formulas(readings: DataFrame, formulas: list[tuple[str, str]], entity: list[str], period: str, concept: str, value: str, per_year: int = 4) -> DataFrame:
    """entity, period, metric, value and reason, for each formula (metric, text) in every period in which the entity has a reading.

    period: whole numbers, adjacent periods differ by one. Of several readings of one key the largest counts: choose before.
    Formulas are written by hand, so they are few; readings of concepts that no formula names never leave the scan.
    """
    compiler, values = Compiler(entity, period, per_year), []
    for metric, text in formulas:
        try:
            values.append((metric, compiler.column(parsed(text, per_year))[0], "missing"))
        except Unreadable:
            values.append((metric, F.lit(None).cast("double"), "unreadable"))
    names = compiler.names
    wide = readings.where(F.col(concept).isin(list(names))) if names else readings.limit(0)
    wide = wide.groupBy(*entity, period).agg(*(F.max(F.when(F.col(concept) == n, F.col(value).cast("double"))).alias(c) for n, c in names.items()), F.lit(1).alias("__one"))
    for stage in compiler.stages:
        wide = wide.withColumns(stage)
    told = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"), F.when(v.isNull(), why).alias("reason")) for m, v, why in values)) if values else F.array().cast(T.ArrayType(T.StructType().add("metric", "string").add("value", "double").add("reason", "string")))
    return wide.select(*entity, period, F.explode(told).alias("__m")).select(*entity, period, "__m.*")
