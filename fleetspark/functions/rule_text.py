"""Rules over settings as short texts, e.g. ``max_connections * 2 > open_files_limit``.

A rule compares sums, differences, products and quotients of settings and
numbers (``<``, ``<=``, ``=``, ``!=``, ``>=``, ``>``, chains such as ``1 < a < 5``)
and joins comparisons by ``and``, ``or``, ``not``.  Python's own grammar reads the
text; nothing of it is run: its nodes become a Spark Column.  A quotient with
denominator 0 is NULL, and so is arithmetic with a missing setting.
"""

from __future__ import annotations

import ast
import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LENGTH = 1000
_ARITHMETIC = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: F.try_divide}
_COMPARE = {ast.Lt: operator.lt, ast.LtE: operator.le, ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.GtE: operator.ge,
            ast.Gt: operator.gt}


class RuleError(ValueError):
    """What is wrong with a rule's text."""


def parsed(text: str) -> ast.expr:
    """The rule's tree; RuleError if it is not a comparison of settings."""
    if not text or not text.strip():
        raise RuleError("empty rule")
    if len(text) > MAX_LENGTH:
        raise RuleError(f"longer than {MAX_LENGTH} characters")
    plain = re.sub(r"(?<![<>=!])=(?!=)", "==", text.lower())
    try:
        tree = ast.parse(plain.strip(), mode="eval").body
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        raise RuleError("not an expression") from e
    _check(tree, True)
    if not settings(tree):
        raise RuleError("names no setting")
    return tree


def _check(node: ast.expr, truth: bool) -> None:
    """The node must give a truth value (``truth``) or a number."""
    match node:
        case ast.BoolOp(values=values) if truth:
            for v in values:
                _check(v, True)
        case ast.UnaryOp(op=ast.Not(), operand=x) if truth:
            _check(x, True)
        case ast.Compare(left=left, ops=ops, comparators=rest) if truth and all(type(o) in _COMPARE for o in ops):
            for v in (left, *rest):
                _check(v, False)
        case ast.BinOp(left=left, op=op, right=right) if not truth and type(op) in _ARITHMETIC:
            _check(left, False)
            _check(right, False)
        case ast.UnaryOp(op=ast.USub() | ast.UAdd(), operand=x) if not truth:
            _check(x, False)
        case ast.Name() if not truth:
            pass
        case ast.Constant(value=int() | float() as v) if not truth and not isinstance(v, bool):
            pass
        case _:
            raise RuleError(f"{'a comparison' if truth else 'a setting or number'} expected, not {ast.unparse(node)}")


def settings(tree: ast.expr) -> list[str]:
    """The settings that the rule names, sorted."""
    return sorted({n.id for n in ast.walk(tree) if isinstance(n, ast.Name)})


def column(node: ast.expr) -> Column:
    """The checked tree as a Column over columns named like its settings (lower case, DOUBLE)."""
    match node:
        case ast.BoolOp(op=op, values=values):
            return reduce(operator.and_ if isinstance(op, ast.And) else operator.or_, map(column, values))
        case ast.UnaryOp(op=ast.Not(), operand=x):
            return ~column(x)
        case ast.Compare(left=left, ops=ops, comparators=rest):
            sides = [column(v) for v in (left, *rest)]
            return reduce(operator.and_, [_COMPARE[type(o)](a, b) for o, a, b in zip(ops, sides, sides[1:])])
        case ast.BinOp(left=left, op=op, right=right):
            return _ARITHMETIC[type(op)](column(left), column(right))
        case ast.UnaryOp(op=op, operand=x):
            return -column(x) if isinstance(op, ast.USub) else column(x)
        case ast.Name(id=name):
            return F.col(f"`{name}`")
        case ast.Constant(value=v):
            return F.lit(float(v))
