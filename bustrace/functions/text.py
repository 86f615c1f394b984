"""Text forms of binary and JSON values, as Spark SQL expressions over a column or lambda variable."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN_SEGMENT = re.compile(r'[^"]+')


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(texts: list[str]) -> str:
    return ", ".join(map(quote, texts))


def utf8_sql(binary: str) -> str:
    """Bytes as UTF-8 text, bad bytes replaced by U+FFFD."""
    return f"make_valid_utf8(cast({binary} as string))"


def utf8_text(binary: str) -> Column:
    return F.expr(utf8_sql(binary))


def iso_text(ts: str) -> Column:
    """ISO-8601 in UTC; the fraction appears only when there is one."""
    return F.expr(
        f"if(unix_micros({ts}) % 1000000 = 0, date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\"),"
        f" date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\"))"
    )


def float_sql(number: str) -> str:
    """A double written the way Python's ``str`` writes it."""
    java = f"cast({number} as string)"
    plain = f"trim(trailing '0' from cast(cast({java} as decimal(38,21)) as string))"
    power = f"cast(substring_index({java}, 'E', -1) as int)"
    return f"""case
      when isnan({number}) then 'nan'
      when abs({number}) = double('Infinity') then if({number} > 0, 'inf', '-inf')
      when not contains({java}, 'E') then {java}
      when abs({number}) >= 1e-4 and abs({number}) < 1e16 then concat({plain}, if(endswith({plain}, '.'), '0', ''))
      else concat(regexp_replace(substring_index({java}, 'E', 1), '[.]0$', ''), if({power} < 0, 'e-', 'e+'),
        if(abs({power}) < 10, '0', ''), abs({power})) end"""


def _rare_leaf_sql(value: str) -> str:
    # A JSON number with a fraction arrives as a decimal without trailing zeros; an integer beyond 64 bits does too.
    text, number = f"try_variant_get({value}, '$', 'string')", f"try_variant_get({value}, '$', 'double')"
    whole = f"not contains({text}, '.')"
    return f"""case schema_of_variant({value})
      when 'BOOLEAN' then initcap({text})
      when 'VOID' then 'None'
      when 'DOUBLE' then {float_sql(number)}
      else case
        when not startswith(schema_of_variant({value}), 'DECIMAL') then to_json({value})
        when {whole} and abs({number}) >= 9.223372036854775807e18 then {text}
        when length({text}) <= 15 and (abs({number}) >= 1e-4 or {number} = 0) then concat({text}, if({whole}, '.0', ''))
        else {float_sql(number)} end
      end"""


def leaf_sql(value: str) -> str:
    """Text of a VARIANT as Python's ``str`` gives it; objects and lists become JSON text.

    Texts and whole numbers are the hot case. The other kinds sit in a lambda, which keeps them out of the generated
    code of the stage (a method that grows too long is never compiled by the JVM).
    """
    text = f"try_variant_get({value}, '$', 'string')"
    rare = f"transform(array({value}), rare -> {_rare_leaf_sql('rare')})[0]"
    return f"case schema_of_variant({value}) when 'STRING' then {text} when 'BIGINT' then {text} else {rare} end"


def leaf_text(value: str) -> Column:
    return F.expr(leaf_sql(value))


def child_sql(value: str, segments: list[str]) -> str:
    """Walk object members by name; anything that is not an object on the way gives null."""
    path = ""
    for name in segments:
        if _PLAIN_SEGMENT.fullmatch(name):
            path += f'["{name}"]'
            continue
        if path:
            value, path = f"try_variant_get({value}, {quote('$' + path)}, 'variant')", ""
        value = f"try_element_at(try_variant_get({value}, '$', 'map<string,variant>'), {quote(name)})"
    return f"try_variant_get({value}, {quote('$' + path)}, 'variant')" if path else value


def is_plain_text(key: str) -> bool:
    """True when only a JSON string can have this text: not a number, boolean, null, list or object."""
    if not key or key in ("True", "False", "None", "nan", "inf", "-inf"):
        return False
    return key[0] not in "{[" and not re.fullmatch(r"[-+]?[0-9][0-9.eE+-]*", key)


def _kinds_with_text(leaf: str, key: str) -> list[str]:
    """Conditions under which a leaf that is not a string reads ``key``."""
    text = f"try_variant_get({leaf}, '$', 'string') = {quote(key)}"
    kind = f"schema_of_variant({leaf})"
    if key in ("True", "False"):
        return [f"{kind} = 'BOOLEAN' and try_variant_get({leaf}, '$', 'boolean') = {key}"]
    if key == "None":
        return [f"{kind} = 'VOID'"]
    if key[:1] in ("{", "["):
        return [f"startswith({kind}, {quote('OBJECT' if key[0] == '{' else 'ARRAY')}) and {text}"]
    if re.fullmatch(r"-?[0-9]+", key) and str(int(key)) == key:
        whole = "BIGINT" if -(2**63) <= int(key) < 2**63 else "DECIMAL"
        return [f"startswith({kind}, '{whole}') and {text}"]
    try:
        number = float(key)
    except ValueError:
        return []
    if str(number) != key or key in ("nan", "inf", "-inf"):
        return []
    is_float = f"({kind} = 'DOUBLE' or startswith({kind}, 'DECIMAL'))"
    return [f"{is_float} and try_variant_get({leaf}, '$', 'double') = double({quote(key)})"]


def path_equals(value: str, path: str, key: str) -> Column:
    """``str(leaf at dotted path) == key``; false when the path leads nowhere."""
    leaf = child_sql(value, path.split("."))
    text = f"try_variant_get({leaf}, '$', 'string')"
    if path and all(_PLAIN_SEGMENT.fullmatch(s) for s in path.split(".")):
        text = leaf.removesuffix("'variant')") + "'string')"
    same = f"{text} = {quote(key)}"
    if is_plain_text(key):
        # A boolean also casts to a text, but one that Python writes differently.
        same += "" if key not in ("true", "false") else f" and schema_of_variant({leaf}) = 'STRING'"
    else:
        same = " or ".join([f"schema_of_variant({leaf}) = 'STRING' and {same}", *_kinds_with_text(leaf, key)])
    return F.expr(f"coalesce({same}, false)")


def _needles(key: str) -> list[str] | None:
    """Texts of which a JSON payload without escapes holds at least one when a leaf reads ``key``; None if unknown."""
    if is_plain_text(key):
        return [f'"{key}"']
    word = {"True": "true", "False": "false", "None": "null"}.get(key)
    if word:
        return [f'"{key}"', word]
    # A whole number is written with just these digits; a float has many spellings.
    return [key] if re.fullmatch(r"-?[0-9]+", key) else None


def payload_may_hold(payload: str, *keys: str) -> Column:
    """Cheap necessary test on the raw bytes for a JSON leaf that reads one of ``keys``.

    A JSON string holds its characters as they are unless the text has a backslash, so a payload with neither the
    quoted key nor a backslash cannot match and need not be parsed.
    """
    needles = [_needles(key) for key in keys]
    if None in needles:
        return F.lit(True)
    text = f"cast({payload} as string)"
    return F.expr(" or ".join(f"contains({text}, {quote(n)})" for n in [*sum(needles, []), "\\"]))


def payload_may_name(payload: str, path: str) -> Column:
    """Cheap necessary test on the raw bytes for a JSON object with the members of a dotted path.

    As for values: without a backslash, a member's name stands in the payload as it is, in quotes.
    """
    text = f"cast({payload} as string)"
    named = " and ".join(f"contains({text}, {quote(json.dumps(n, ensure_ascii=False))})" for n in dict.fromkeys(path.split(".")))
    escaped = f"contains({text}, {quote(chr(92))})"
    return F.expr(f"coalesce({named} or {escaped}, false)")
