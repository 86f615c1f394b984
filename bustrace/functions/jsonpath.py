"""JSONPath over VARIANT columns: child, quoted child, index, ``[*]``, ``.*`` and ``..``.

A path becomes a column expression that gives all matches as an array; ``..`` folds over the levels of the document.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from bustrace.functions.text import leaf_sql, quote

_STEP = re.compile(
    r"""(?P<deep>\.\.)?(?:
        \.?(?P<name>[A-Za-z_@][\w@-]*)
      | \.?\[\s*(?P<index>-?\d+)\s*\]
      | \.?\[\s*(?P<items>\*)\s*\]
      | \.?(?P<members>\*)
      | \.?\[?\s*(?:'(?P<single>[^']+)'|"(?P<double>[^"]+)")\s*\]?
    )""",
    re.VERBOSE,
)

_UNESCAPED = re.compile(r"[\w@. -]+", re.ASCII)

Step = tuple[str, object]


def compile_path(path: str) -> list[Step] | None:
    """Steps ``(kind, argument)`` of a path, None when it is empty or not supported."""
    rest = path.strip()
    rooted = rest.startswith("$")
    rest = rest[1:] if rooted else rest
    steps: list[Step] = []
    while rest:
        found = _STEP.match(rest)
        if not found or not found.group():
            return None
        bare = found.group("name") or found.group("members")
        if bare and (rooted or steps) and not rest.startswith("."):
            return None
        if found.group("deep"):
            steps.append(("deep", None))
        if found.group("index"):
            steps.append(("index", int(found.group("index"))))
        elif found.group("items"):
            steps.append(("items", None))
        elif found.group("members"):
            steps.append(("members", None))
        else:
            steps.append(("child", found.group("name") or found.group("single") or found.group("double")))
        rest = rest[found.end() :]
    return steps or None


def _items(value: str) -> str:
    """Elements of a list; a lone object, text or whole number counts as a list of one."""
    kind = f"schema_of_variant({value})"
    alone = f"not (startswith({kind}, 'DECIMAL') or {kind} in ('DOUBLE', 'VOID'))"
    return f"coalesce(try_variant_get({value}, '$', 'array<variant>'), if({alone}, array({value}), null))"


def _members(value: str) -> str:
    return f"map_values(try_variant_get({value}, '$', 'map<string,variant>'))"


def _child(value: str, name: str) -> str:
    """A member by name, null where there is none. Read as a struct: ``try_variant_get`` leaves a path that leads nowhere
    by an exception, which costs more than the rest of a small payload's decode."""
    field = "`" + name.replace("`", "``") + "`"
    return f"try_variant_get({value}, '$', {quote(f'struct<{field}: variant>')}).{field}"


def _element(value: str, index: int) -> str:
    if index >= 0:
        return f"try_variant_get({value}, '$[{index}]', 'variant')"
    return f"try_element_at(try_variant_get({value}, '$', 'array<variant>'), {index})"


def _with_descendants(nodes: str) -> str:
    """The nodes and everything below them, of any depth.

    A fold that goes one level down at each step. A document has at most as many levels as opening brackets; steps behind
    the last level leave the result as it is.
    """
    children = f"""coalesce(try_variant_get(n, '$', 'array<variant>'), {_members('n')}, cast(array() as array<variant>))"""
    below = f"flatten(transform(acc.level, n -> {children}))"
    brackets = "transform(array(to_json(n)), t -> length(t) - length(translate(t, '{[', '')))[0]"
    levels = f"coalesce(array_max(transform(_found, n -> {brackets})), 0)"
    # A lambda is not searched for equal parts: what is read twice is named in one of its own.
    step = f"transform(array({below}), b -> named_struct('level', b, 'every', concat(acc.every, b)))[0]"
    fold = f"""aggregate(array_repeat(0, {levels}), named_struct('level', _found, 'every', _found), (acc, i) ->
      if(size(acc.level) = 0, acc, {step}), acc -> acc.every)"""
    # The nodes are named once, in a lambda, since the fold reads them several times.
    return f"transform(array({nodes}), _found -> if(_found is null, null, {fold}))[0]"


def _may_match(text: str, steps: list[Step]) -> str:
    """Cheap necessary test on a document's JSON text: it names every member that the path names.

    Names that JSON could write in another way are left out.
    """
    names = dict.fromkeys(arg for kind, arg in steps if kind == "child" and _UNESCAPED.fullmatch(arg))
    return " and ".join(f"contains({text}, {quote(json.dumps(name))})" for name in names)


def matches(value: str, steps: list[Step], text: str | None = None) -> Column:
    """All matches in a VARIANT column as text, ``array<string>``; an empty array when there are none.

    With ``text``, the column of the document's JSON text, a path is only walked where that names its members.
    """
    empty = "cast(array() as array<string>)"
    found = f"if({value} is null, null, array({value}))"
    for kind, arg in steps:
        if kind == "deep":
            found = _with_descendants(found)
        elif kind in ("items", "members"):
            inner = _items("v") if kind == "items" else _members("v")
            found = f"flatten(filter(transform({found}, v -> {inner}), a -> a is not null))"
        else:
            inner = _child("v", arg) if kind == "child" else _element("v", arg)
            found = f"filter(transform({found}, v -> {inner}), w -> w is not null)"
    texts = f"coalesce(transform({found}, v -> {leaf_sql('v')}), {empty})"
    test = _may_match(text, steps) if text else ""
    return F.expr(f"if({test}, {texts}, {empty})" if test else texts)
