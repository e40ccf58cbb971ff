"""A JSON Schema compiled to one SQL expression over JSON text.

Documents are read as VARIANT, so types, nulls, missing and unknown keys stay apart, whatever the shape of the
rows. ``faults`` gives every fault with the path of the value it is about. Keywords work as in draft
2020-12, each on the types it is for: type, enum, const, required, properties, additionalProperties, items,
minItems, maxItems, uniqueItems (of scalars), minLength, maxLength, pattern, minimum, maximum,
exclusiveMinimum, exclusiveMaximum, format (uri, date, date-time), $ref into the document, allOf, anyOf,
oneOf, not, if / then / else. Any other keyword but a comment is an error when the schema is compiled; so is a
reference that leads back to itself, which no expression can unroll. Patterns are Java's.

Defined results: null text or text that does not begin with a JSON value has one fault at the root; a document without faults has
an empty array; faults are sorted by path and message, equal ones once.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

FAULT = "struct<path: string, message: string>"
_COMMENTS = {"$schema", "$id", "$comment", "$defs", "title", "description", "default", "examples", "deprecated", "then", "else"}
#: What an absolute address, a date and a time with its zone look like.
_URI = "^(?i)(https?|ftp|s3)://[^/?#]"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?(Z|[+-]([01]\d|2[0-3]):?[0-5]\d)$"
_NONE = f"cast(array() AS array<{FAULT}>)"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fault(path: str, *message: str) -> str:
    return f"named_struct('path', if({path} = '', '<root>', {path}), 'message', concat({', '.join(message)}))"


def _below(path: str, step: str) -> str:
    return f"if({path} = '', {step}, concat({path}, '/', {step}))"


def _get(v: str, kind: str = "variant", key: str = "$") -> str:
    return f"try_variant_get({v}, {_lit(key)}, '{kind}')"


def _key(name: str) -> str:
    if "'" in name and '"' in name:
        raise ValueError(f"a key with both quotes: {name!r}")
    return f'$["{name}"]' if '"' not in name else f"$['{name}']"


def _number(t: str) -> str:
    return f"({t} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({t}, 'DECIMAL'))"


def _is(kind: str, v: str, t: str) -> str:
    simple = {"string": "STRING", "null": "VOID", "boolean": "BOOLEAN"}
    if kind in simple:
        return f"{t} = '{simple[kind]}'"
    if kind == "number":
        return _number(t)
    if kind == "integer":
        return f"({t} = 'BIGINT' OR coalesce({_number(t)} AND {_get(v, 'double')} = rint({_get(v, 'double')}), false))"
    if kind in ("object", "array"):
        return f"startswith({t}, '{kind.upper()}')"
    raise ValueError(f"unknown type {kind!r}")


def _equals(v: str, t: str, value: Any) -> str:
    if value is None:
        return f"{t} = 'VOID'"
    if isinstance(value, bool):
        return f"coalesce({t} = 'BOOLEAN' AND {_get(v, 'boolean')} = {str(value).lower()}, false)"
    if isinstance(value, str):
        return f"coalesce({t} = 'STRING' AND {_get(v, 'string')} = {_lit(value)}, false)"
    if isinstance(value, (int, float)):
        return f"coalesce({_number(t)} AND {_get(v, 'double')} = {float(value)!r}D, false)"
    raise ValueError("enum and const take scalars")


def _shown(v: str, t: str) -> str:
    return f"if({t} = 'STRING', concat('\\'', {_get(v, 'string')}, '\\''), to_json({v}))"


def _some(conditions: list[str]) -> str:
    return "(" + " OR ".join(conditions) + ")" if conditions else "false"


class _Compiler:
    """Builds the expression as text; ``v`` and ``t`` are the value and its type, ``path`` where it stands."""

    def __init__(self, root: dict[str, Any]):
        self.root = root
        self.names = 0

    def fresh(self, stem: str) -> str:
        self.names += 1
        return f"{stem}{self.names}"

    def resolve(self, ref: str) -> Any:
        if not ref.startswith("#"):
            raise ValueError(f"only references into the document: {ref}")
        node = self.root
        for part in filter(None, ref[1:].split("/")):
            node = node[part.replace("~1", "/").replace("~0", "~")]
        return node

    def node(self, schema: Any, value: str, path: str, refs: tuple[str, ...] = ()) -> str:
        """Faults of a value that may be missing; value, type and path are computed once."""
        if schema is True or schema == {}:
            return _NONE
        b = self.fresh("b")
        bound = f"named_struct('v', {value}, 't', schema_of_variant({value}), 'p', {path})"
        return f"coalesce(transform(array({bound}), {b} -> {self.faults(schema, f'{b}.v', f'{b}.t', f'{b}.p', refs)})[0], {_NONE})"

    def faults(self, schema: Any, v: str, t: str, path: str, refs: tuple[str, ...]) -> str:
        """Faults of a value that is there; a missing one has the type null and fits everything."""
        if schema is True or schema == {}:
            return _NONE
        if schema is False:
            no_value = "'no value is allowed here'"
            return f"if({t} IS NULL, {_NONE}, array({_fault(path, no_value)}))"
        own: list[str] = []
        parts: list[str] = []
        say = lambda condition, *text: own.append(f"if({condition}, {_fault(path, *text)}, NULL)")
        text, number, items, shown = _get(v, "string"), _get(v, "double"), _get(v, "array<variant>"), _shown(v, t)
        is_text, is_list, is_object = f"{t} = 'STRING'", _is("array", v, t), _is("object", v, t)
        for word, arg in schema.items():
            if word in _COMMENTS:
                continue
            elif word == "type":
                kinds = [arg] if isinstance(arg, str) else list(arg)
                say(f"NOT {_some([_is(k, v, t) for k in kinds])}", shown, _lit(" is not of type " + ", ".join(kinds)))
            elif word == "enum":
                say(f"NOT {_some([_equals(v, t, x) for x in arg])}", shown, _lit(" is not one of the values " + ", ".join(map(json.dumps, arg))))
            elif word == "const":
                say(f"NOT {_equals(v, t, arg)}", shown, _lit(f" is not {json.dumps(arg)}"))
            elif word == "pattern":
                say(f"{is_text} AND NOT {text} RLIKE {_lit(arg)}", shown, _lit(f" does not match {arg}"))
            elif word in ("minLength", "maxLength"):
                sign, name = ("<", "shorter") if word == "minLength" else (">", "longer")
                say(f"{is_text} AND char_length({text}) {sign} {arg}", _lit(f"is {name} than {arg} characters"))
            elif word in ("minItems", "maxItems"):
                sign, name = ("<", "fewer") if word == "minItems" else (">", "more")
                say(f"{is_list} AND size({items}) {sign} {arg}", _lit(f"has {name} than {arg} items"))
            elif word == "uniqueItems":
                if arg:
                    x = self.fresh("x")
                    say(f"{is_list} AND size(array_distinct(transform({items}, {x} -> to_json({x})))) < size({items})", "'has equal items'")
            elif word in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                signs = {"minimum": "<", "maximum": ">", "exclusiveMinimum": "<=", "exclusiveMaximum": ">="}
                names = {"minimum": "less than", "maximum": "greater than", "exclusiveMinimum": "not greater than", "exclusiveMaximum": "not less than"}
                say(f"{_number(t)} AND {number} {signs[word]} {float(arg)!r}D", shown, _lit(f" is {names[word]} {arg}"))
            elif word == "format":
                say(f"{is_text} AND NOT {self.format(arg, text)}", shown, _lit(f" is not a {arg}"))
            elif word == "required":
                for name in arg:
                    say(f"{is_object} AND {_get(v, key=_key(name))} IS NULL", _lit(f"'{name}' is missing"))
            elif word == "properties":
                parts += [self.node(node, _get(v, key=_key(name)), _below(path, _lit(name)), refs) for name, node in arg.items()]
            elif word == "additionalProperties":
                parts.append(self.others(schema, arg, v, is_object, path, refs))
            elif word == "items":
                x, i = self.fresh("x"), self.fresh("i")
                below = self.node(arg, x, _below(path, f"cast({i} AS string)"), refs)
                parts.append(f"if({is_list}, flatten(transform({items}, ({x}, {i}) -> {below})), {_NONE})")
            elif word == "$ref":
                if arg in refs:
                    raise ValueError(f"{arg} leads back to itself")
                parts.append(self.faults(self.resolve(arg), v, t, path, (*refs, arg)))
            elif word == "allOf":
                parts += [self.faults(s, v, t, path, refs) for s in arg]
            elif word in ("anyOf", "oneOf"):
                fits = " + ".join(f"if(size({self.faults(s, v, t, path, refs)}) = 0, 1, 0)" for s in arg)
                if word == "anyOf":
                    say(f"{fits} = 0", "'fits none of the choices'")
                else:
                    say(f"{fits} <> 1", "'does not fit exactly one of the choices'")
            elif word == "not":
                say(f"size({self.faults(arg, v, t, path, refs)}) = 0", "'fits what it must not'")
            elif word == "if":
                then, other = (self.faults(schema.get(k, True), v, t, path, refs) for k in ("then", "else"))
                parts.append(f"if(size({self.faults(arg, v, t, path, refs)}) = 0, {then}, {other})")
            else:
                raise ValueError(f"keyword not supported: {word}")
        if own:
            f = self.fresh("f")
            parts.insert(0, f"filter(array({', '.join(own)}), {f} -> {f} IS NOT NULL)")
        parts = [p for p in parts if p != _NONE]
        if not parts:
            return _NONE
        return f"if({t} IS NULL, {_NONE}, concat({', '.join(parts)}))"

    def others(self, schema: dict[str, Any], node: Any, v: str, is_object: str, path: str, refs: tuple[str, ...]) -> str:
        """Faults of the keys that ``properties`` does not name."""
        if node is True or node == {}:
            return _NONE
        known = ", ".join(map(_lit, schema.get("properties", {})))
        entries, e, k = f"map_entries({_get(v, 'map<string,variant>')})", self.fresh("e"), self.fresh("k")
        rest = f"filter({entries}, {k} -> {k}.key NOT IN ({known}))" if known else entries
        unknown = (f"concat('\\'', {e}.key, '\\' is not known')",)
        if node is False:
            made = f"transform({rest}, {e} -> {_fault(path, *unknown)})"
        else:
            made = f"flatten(transform({rest}, {e} -> {self.node(node, f'{e}.value', _below(path, f'{e}.key'), refs)}))"
        return f"if({is_object}, {made}, {_NONE})"

    def format(self, name: str, text: str) -> str:
        day = f"try_to_date(left({text}, 10), 'yyyy-MM-dd') IS NOT NULL"
        if name == "uri":
            return f"({text} RLIKE {_lit(_URI)})"
        if name in ("date", "date-time"):
            return f"({text} RLIKE {_lit(_DATE if name == 'date' else _TIME)} AND {day})"
        raise ValueError(f"unknown format {name!r}")


def faults_sql(document: str, schema: dict[str, Any]) -> str:
    """The SQL expression of ``faults`` over the column ``document``."""
    d = "d0"
    found = _Compiler(schema).node(schema, d, "''")
    unreadable = "array(named_struct('path', '<root>', 'message', 'is not JSON'))"
    body = f"if({d} IS NULL, {unreadable}, array_sort(array_distinct({found})))"
    return f"transform(array(try_parse_json({document})), {d} -> {body})[0]"


def faults(document: str, schema: dict[str, Any]) -> Column:
    """array<struct<path, message>>: what is wrong with the JSON text in the column ``document``."""
    return F.expr(faults_sql(document, schema))
