"""Whether a JSON value fits a JSON schema: yes, no, or not to be told."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from fractions import Fraction

# Keywords that describe and don't restrict
NOTES = frozenset("title description default examples example format deprecated readOnly writeOnly $schema $id id $comment".split())


def every(answers: Iterable[bool | None]) -> bool | None:
    """No if any is no, else unknown if any is unknown."""
    found = set(answers)
    return False if False in found else None if None in found else True


def some(answers: Iterable[bool | None]) -> bool | None:
    found = set(answers)
    return True if True in found else None if None in found else False


def opposite(answer: bool | None) -> bool | None:
    return None if answer is None else not answer


def is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def same(left: object, right: object) -> bool:
    """Equal as JSON: 1 is 1.0, and neither is true."""
    if isinstance(left, bool) or isinstance(right, bool):
        return left is right
    if isinstance(left, list) and isinstance(right, list):
        return len(left) == len(right) and all(map(same, left, right))
    if isinstance(left, dict) and isinstance(right, dict):
        return left.keys() == right.keys() and all(same(left[name], right[name]) for name in left)
    return left == right


def has_type(value: object, kind: object) -> bool:
    if kind == "integer":
        return is_number(value) and (isinstance(value, int) or value.is_integer())
    if kind == "number":
        return is_number(value)
    kinds = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
    return isinstance(value, kinds.get(kind, ()))


def found_in(text: str, pattern: str) -> bool | None:
    try:
        return re.search(pattern, text) is not None
    except re.error:
        return None  # a pattern of another dialect


def distinct(values: list) -> bool:
    seen: dict[object, list] = {}
    for value in values:
        alike = seen.setdefault(value if is_number(value) or isinstance(value, str) else type(value), [])
        if any(same(value, other) for other in alike):
            return False
        alike.append(value)
    return True


def of_numbers(value: float, schema: Mapping) -> Iterable[bool | None]:
    low, high = schema.get("exclusiveMinimum"), schema.get("exclusiveMaximum")
    if "minimum" in schema:
        yield value > schema["minimum"] if low is True else value >= schema["minimum"]
    if "maximum" in schema:
        yield value < schema["maximum"] if high is True else value <= schema["maximum"]
    if is_number(low):
        yield value > low
    if is_number(high):
        yield value < high
    if "multipleOf" in schema:
        yield Fraction(str(value)) % Fraction(str(schema["multipleOf"])) == 0


def of_texts(value: str, schema: Mapping) -> Iterable[bool | None]:
    yield schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if "pattern" in schema:
        yield found_in(value, schema["pattern"])


def of_lists(value: list, schema: Mapping) -> Iterable[bool | None]:
    yield schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value))
    items = schema.get("items", True)
    first, rest = (items, schema.get("additionalItems", True)) if isinstance(items, list) else (schema.get("prefixItems", []), items)
    for part, own in zip(value, first):
        yield fits(part, own)
    for part in value[len(first) :]:
        yield fits(part, rest)
    if schema.get("uniqueItems"):
        yield distinct(value)
    if "contains" in schema:
        held = [fits(part, schema["contains"]) for part in value]
        least, most = schema.get("minContains", 1), schema.get("maxContains", len(value))
        sure, maybe = held.count(True), held.count(None)
        yield True if least <= sure and sure + maybe <= most else False if sure > most or sure + maybe < least else None


def of_objects(value: Mapping, schema: Mapping) -> Iterable[bool | None]:
    yield schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value))
    yield all(name in value for name in schema.get("required", ()))
    known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
    for name, part in value.items():
        if name in known:
            yield fits(part, known[name])
        hits = [(found_in(name, pattern), own) for pattern, own in patterns.items()]
        yield from (fits(part, own) if hit else None for hit, own in hits if hit is not False)
        if name not in known and not any(hit is not False for hit, _ in hits):
            yield fits(part, schema.get("additionalProperties", True))
        if "propertyNames" in schema:
            yield fits(name, schema["propertyNames"])
    for name, own in schema.get("dependentSchemas", {}).items():
        if name in value:
            yield fits(value, own)
    for name, others in schema.get("dependentRequired", {}).items():
        if name in value:
            yield all(other in value for other in others)


def of_parts(value: object, schema: Mapping) -> Iterable[bool | None]:
    """Schemas put together from others."""
    if "allOf" in schema:
        yield every(fits(value, part) for part in schema["allOf"])
    if "anyOf" in schema:
        yield some(fits(value, part) for part in schema["anyOf"])
    if "oneOf" in schema:
        held = [fits(value, part) for part in schema["oneOf"]]
        yield False if held.count(True) > 1 else None if None in held else held.count(True) == 1
    if "not" in schema:
        yield opposite(fits(value, schema["not"]))
    if "if" in schema:
        case = fits(value, schema["if"])
        ways = [fits(value, schema.get(name, True)) for name in ("then", "else")]
        yield ways[0] if case is True else ways[1] if case is False else every(ways) if ways[0] == ways[1] else None


# the keywords that each check reads, and the values it is for
KEYWORDS: list[tuple[frozenset[str], Callable[[object], bool], Callable]] = [
    (frozenset("minimum maximum exclusiveMinimum exclusiveMaximum multipleOf".split()), is_number, of_numbers),
    (frozenset("minLength maxLength pattern".split()), lambda value: isinstance(value, str), of_texts),
    (
        frozenset("items prefixItems additionalItems minItems maxItems uniqueItems contains minContains maxContains".split()),
        lambda value: isinstance(value, list),
        of_lists,
    ),
    (
        frozenset("properties patternProperties additionalProperties required propertyNames minProperties maxProperties "
                  "dependentSchemas dependentRequired".split()),
        lambda value: isinstance(value, dict),
        of_objects,
    ),
    (frozenset("allOf anyOf oneOf not if then else".split()), lambda value: True, of_parts),
]
READ = NOTES.union(("type", "enum", "const"), *(names for names, _, _ in KEYWORDS))


def fits(value: object, schema: Mapping | bool) -> bool | None:
    """Whether a value fits a schema; None where a keyword that isn't read here would decide.

    ``format`` is a note, as in the standard. A type that JSON does not have fits nothing.
    What is neither an object nor a boolean is no schema: TypeError.
    """
    if isinstance(schema, bool):
        return schema
    if not isinstance(schema, Mapping):
        raise TypeError("not a schema")
    answers: list[bool | None] = [None] if not schema.keys() <= READ else []
    if "type" in schema:
        kinds = schema["type"]
        answers.append(any(has_type(value, kind) for kind in ([kinds] if isinstance(kinds, str) else kinds)))
    if "enum" in schema:
        answers.append(any(same(value, choice) for choice in schema["enum"]))
    if "const" in schema:
        answers.append(same(value, schema["const"]))
    for names, meant, check in KEYWORDS:
        if meant(value) and not names.isdisjoint(schema):
            answers += check(value, schema)
    return every(answers)


def judged(value: object, schema: Mapping | bool) -> bool | None:
    """:func:`fits`; something that is no schema, or is nested too deep to be followed, fits nothing."""
    try:
        return fits(value, schema)
    except (TypeError, AttributeError, ValueError, ZeroDivisionError, RecursionError):
        return False
