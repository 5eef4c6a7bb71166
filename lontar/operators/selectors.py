"""A small selector language over the page tree: ``tag.class#id[attr][attr=v][attr*=v]``, descendants by spaces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from lontar.operators.html import Node

_PART = re.compile(r"""\.([\w-]+)|\#([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$~]?=)\s*["']?([^"'\]]*)["']?\s*)?\]|([A-Za-z][\w-]*|\*)""")


def _compound(text: str) -> Callable[[Node], bool]:
    tests: list[Callable[[Node], bool]] = []
    at = 0
    for m in _PART.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        name, ident, attr, how, value, tag = m.groups()
        if name:
            tests.append(lambda n, v=name: v in n.attrs.get("class", "").split())
        elif ident:
            tests.append(lambda n, v=ident: n.attrs.get("id") == v)
        elif attr:
            tests.append(_attribute(attr, how, value))
        elif tag != "*":
            tests.append(lambda n, v=tag.lower(): n.tag == v)
    if at != len(text):
        raise ValueError(f"selector not understood: {text}")
    if len(tests) == 1:
        return tests[0]
    return lambda n: all(t(n) for t in tests)


def _attribute(name: str, how: str | None, value: str) -> Callable[[Node], bool]:
    checks = {
        None: lambda own: True, "=": lambda own: own == value, "*=": lambda own: value != "" and value in own, "^=": lambda own: value != "" and own.startswith(value), "$=": lambda own: value != "" and own.endswith(value), "~=": lambda own: value in own.split(),
    }
    return lambda n: name in n.attrs and checks[how](n.attrs[name])


@lru_cache(maxsize=512)
def _steps(selector: str) -> tuple[Callable[[Node], bool], ...]:
    return tuple(_compound(part) for part in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", selector))


@lru_cache(maxsize=512)
def one(selector: str) -> Callable[[Node], bool]:
    """The test of a selector without descendants, for an element at hand."""
    (test,) = _steps(selector)
    return test


def select(root: Node, selector: str) -> Iterator[Node]:
    """Elements below ``root`` in order, each once; a comma is not understood, use several selectors."""
    steps = _steps(selector)
    stack = [(c, 0) for c in reversed(root.children) if not isinstance(c, str)]
    while stack:
        n, met = stack.pop()
        if met == len(steps) - 1 and steps[-1](n):
            yield n
        # The earliest ancestors are taken for the steps before the last, which loses no descendant.
        below = met + 1 if met < len(steps) - 1 and steps[met](n) else met
        stack.extend((c, below) for c in reversed(n.children) if not isinstance(c, str))


def first(root: Node, *selectors: str) -> Node | None:
    """The first element of the first selector that has any."""
    for s in selectors:
        n = next(select(root, s), None)
        if n is not None:
            return n
    return None
