"""Indicator expressions: numbers, + - * /, parentheses, items #{element[.option[.attribute]]} and constants C{id}.

An expression is parsed on the driver and becomes a column. Missing items count as 0 unless all items are
missing; an unknown constant, a division by 0 or a value that is not finite makes the whole null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|#\{([^}]*)\}|C\{([^}]*)\}|([-+*/()])|(\S+))")


@dataclass(frozen=True)
class Item:
    element: str
    option: str | None = None
    attribute: str | None = None


def parse_item(text: str) -> Item:
    parts = text.split(".")
    if not 1 <= len(parts) <= 3 or not all(parts):
        raise ValueError(f"not an item: {text}")
    return Item(parts[0], *(None if p == "*" else p for p in parts[1:]))


def parse(text: str) -> tuple:
    """The expression as nested tuples: ("num", x), ("item", Item), ("const", id), ("neg", e), (operator, left, right)."""
    tokens: list[tuple[str, object]] = []
    for number, item, constant, sign, other in _TOKEN.findall(text):
        if other:
            raise ValueError(f"not supported in an expression: {other}")
        tokens.append(("num", float(number)) if number else ("item", parse_item(item)) if item else ("const", constant) if constant else ("sign", sign))
    place = 0

    def peek() -> object:
        return tokens[place][1] if place < len(tokens) and tokens[place][0] == "sign" else None

    def take() -> tuple[str, object]:
        nonlocal place
        if place == len(tokens):
            raise ValueError(f"the expression ends too early: {text}")
        place += 1
        return tokens[place - 1]

    def level(signs: str, below) -> tuple:
        left = below()
        while peek() and str(peek()) in signs:
            sign = take()[1]
            left = (sign, left, below())
        return left

    def atom() -> tuple:
        kind, value = take()
        if kind != "sign":
            return (kind, value)
        if value in "+-":
            inner = atom()
            return ("neg", inner) if value == "-" else inner
        if value != "(":
            raise ValueError(f"unexpected {value} in {text}")
        inner = total()
        if take() != ("sign", ")"):
            raise ValueError(f"a parenthesis stays open in {text}")
        return inner

    def total() -> tuple:
        return level("+-", lambda: level("*/", atom))

    out = total()
    if place < len(tokens):
        raise ValueError(f"cannot be read to its end: {text}")
    return out


def items(tree: tuple) -> list[Item]:
    """The distinct items of an expression in the order in which they occur."""
    if tree[0] == "item":
        return [tree[1]]
    return list(dict.fromkeys(i for part in tree[1:] if isinstance(part, tuple) for i in items(part)))


def evaluate(tree: tuple, values: dict[Item, Column], constants: dict[str, float] | None = None) -> Column:
    """The expression as a column over the items' columns (null where an item is missing)."""

    def finite(x: Column) -> Column:
        return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)

    def calc(node: tuple) -> Column:
        if node[0] == "num":
            return F.lit(node[1])
        if node[0] == "item":
            return finite(F.coalesce(values[node[1]].cast("double"), F.lit(0.0)))
        if node[0] == "const":
            return F.lit((constants or {}).get(node[1])).cast("double")
        if node[0] == "neg":
            return -calc(node[1])
        a, b = calc(node[1]), calc(node[2])
        return finite({"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b)}[node[0]]())

    own = items(tree)
    result = calc(tree)
    return F.when(F.coalesce(*[values[i] for i in own]).isNotNull(), result) if own else result
