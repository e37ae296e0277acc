"""Scoring formulas over a graph.

A formula is a small expression tree. It is compiled to Spark columns: edge aggregates become one
aggregation over the edges, vertex aggregates one over the vertices, and the rest is arithmetic on
their results. Optimisation is Catalyst's.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.functions.scalar import clamp01


class Formula:
    """Base of all nodes; Python operators build larger formulas, numbers become constants."""

    def __add__(self, other): return Binary("add", self, wrap(other))
    def __sub__(self, other): return Binary("sub", self, wrap(other))
    def __mul__(self, other): return Binary("mul", self, wrap(other))
    def __truediv__(self, other): return Binary("div", self, wrap(other))
    def __radd__(self, other): return Binary("add", wrap(other), self)
    def __rsub__(self, other): return Binary("sub", wrap(other), self)
    def __rmul__(self, other): return Binary("mul", wrap(other), self)
    def __rtruediv__(self, other): return Binary("div", wrap(other), self)
    def __gt__(self, other): return Binary("gt", self, wrap(other))
    def __lt__(self, other): return Binary("lt", self, wrap(other))
    def __ge__(self, other): return Binary("ge", self, wrap(other))
    def __le__(self, other): return Binary("le", self, wrap(other))
    def eq(self, other): return Binary("eq", self, wrap(other))
    def ne(self, other): return Binary("ne", self, wrap(other))


@dataclass(frozen=True)
class Const(Formula):
    value: float


@dataclass(frozen=True)
class VertexField(Formula):
    name: str


@dataclass(frozen=True)
class EdgeField(Formula):
    name: str


@dataclass(frozen=True)
class Binary(Formula):
    op: str
    left: Formula
    right: Formula


@dataclass(frozen=True)
class Aggregate(Formula):
    """`over` is edges or vertices, `how` sum, avg or max."""

    over: str
    how: str
    expr: Formula


@dataclass(frozen=True)
class Unary(Formula):
    op: str
    expr: Formula


@dataclass(frozen=True)
class If(Formula):
    cond: Formula
    yes: Formula
    no: Formula


def wrap(value) -> Formula:
    return value if isinstance(value, Formula) else Const(float(value))


def sum_edges(expr): return Aggregate("edges", "sum", wrap(expr))
def avg_edges(expr): return Aggregate("edges", "avg", wrap(expr))
def sum_vertices(expr): return Aggregate("vertices", "sum", wrap(expr))
def avg_vertices(expr): return Aggregate("vertices", "avg", wrap(expr))
def max_vertices(expr): return Aggregate("vertices", "max", wrap(expr))
def log(expr): return Unary("log", wrap(expr))
def normalize(expr): return Unary("normalize", wrap(expr))


_COMPARE = {"gt": operator.gt, "lt": operator.lt, "ge": operator.ge, "le": operator.le, "eq": operator.eq, "ne": operator.ne}
_ARITH = {"add": operator.add, "sub": operator.sub, "mul": operator.mul}


def _children(node: Formula) -> tuple[Formula, ...]:
    if isinstance(node, Binary):
        return node.left, node.right
    if isinstance(node, (Aggregate, Unary)):
        return (node.expr,)
    if isinstance(node, If):
        return node.cond, node.yes, node.no
    return ()


def _aggregates(node: Formula) -> list[Aggregate]:
    if isinstance(node, Aggregate):
        return [node]
    return list(dict.fromkeys(a for child in _children(node) for a in _aggregates(child)))


def to_column(node: Formula, leaf: Callable[[Formula], Column]) -> Column:
    """Compile a tree; `leaf` resolves fields and aggregates."""
    if isinstance(node, Const):
        return F.lit(float(node.value))
    if isinstance(node, Binary):
        a, b = to_column(node.left, leaf), to_column(node.right, leaf)
        if node.op == "div":
            return F.try_divide(a, b)
        if node.op in _ARITH:
            return _ARITH[node.op](a, b)
        return _COMPARE[node.op](a, b).cast("double")
    if isinstance(node, Unary):
        inner = to_column(node.expr, leaf)
        return F.ln(inner) if node.op == "log" else clamp01(inner)
    if isinstance(node, If):
        return F.when(to_column(node.cond, leaf) > 0, to_column(node.yes, leaf)).otherwise(to_column(node.no, leaf))
    return leaf(node)


def _row_column(aggregate: Aggregate) -> Column:
    """The expression below an aggregate, over the columns of its own table."""
    wanted = EdgeField if aggregate.over == "edges" else VertexField

    def field(node: Formula) -> Column:
        if isinstance(node, wanted):
            return F.col(node.name).cast("double")
        raise ValueError(f"{node} cannot be used inside an aggregate over {aggregate.over}")

    return to_column(aggregate.expr, field)


def _measure(aggregate: Aggregate) -> Column:
    inner = _row_column(aggregate)
    if aggregate.how == "max":
        return F.max(inner)
    if aggregate.how == "sum":
        return F.coalesce(F.sum(inner), F.lit(0.0))
    return F.coalesce(F.avg(inner), F.lit(0.0))


def evaluate(formula: Formula, vertices: DataFrame, edges: DataFrame, by: str | None = None) -> DataFrame:
    """Value of a formula: one row (value), or (id, value) per vertex.

    With `by` ('src' or 'dst') edge aggregates run over the edges of each vertex; vertex
    aggregates stay global and bare vertex fields refer to the vertex itself.
    """
    aggregates = _aggregates(formula)
    frames = {"edges": edges, "vertices": vertices}
    names = {a: f"_agg{i}" for i, a in enumerate(aggregates)}
    packed = {}
    for over, frame in frames.items():
        mine = [a for a in aggregates if a.over == over and not (by and over == "edges")]
        if mine:
            one = frame.agg(F.struct(*[_measure(a).alias(names[a]) for a in mine]).alias("s"))
            packed.update({a: one.scalar()[names[a]] for a in mine})

    if by is None:
        def leaf(node: Formula) -> Column:
            if isinstance(node, Aggregate):
                return packed[node]
            raise ValueError(f"{node} needs an aggregate or by=")

        return vertices.sparkSession.range(1).select(to_column(formula, leaf).alias("value"))

    local = [a for a in aggregates if a.over == "edges"]
    base = vertices
    if local:
        per = edges.groupBy(F.col(by).alias("id")).agg(*[_measure(a).alias(names[a]) for a in local])
        base = vertices.join(per, "id", "left")

    def leaf(node: Formula) -> Column:
        if isinstance(node, VertexField):
            return F.col(node.name).cast("double")
        if node in packed:
            return packed[node]
        if isinstance(node, Aggregate):
            return F.coalesce(F.col(names[node]), F.lit(0.0))
        raise ValueError(f"{node} must be inside an edge aggregate")

    return base.select("id", to_column(formula, leaf).alias("value"))


def formula_literal_eval(formula: Formula) -> float:
    """Value of a formula made of constants only; anything else is an error."""
    if isinstance(formula, Const):
        return float(formula.value)
    if isinstance(formula, Binary):
        a, b = formula_literal_eval(formula.left), formula_literal_eval(formula.right)
        if formula.op == "div":
            return a / b
        return _ARITH[formula.op](a, b) if formula.op in _ARITH else float(_COMPARE[formula.op](a, b))
    raise ValueError(f"not a constant formula: {formula}")


def model_risk() -> Formula:
    """Mean edge weight times the greatest vertex value."""
    return avg_edges(EdgeField("weight")) * max_vertices(VertexField("value"))


def model_influence() -> Formula:
    """Clamped sum of edge weights; with `by='src'` the outgoing weight of each vertex."""
    return normalize(sum_edges(EdgeField("weight")))
