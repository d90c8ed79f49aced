"""JSON helpers over Spark's VARIANT type and ``from_json``.

Text is parsed once into a VARIANT (binary, self-describing); typed fields are
read from it with ``try_variant_get``, which coerces numbers to text the way the
reference's ``getString`` does and yields NULL instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, expr: Column, name: str, keep: list[str]) -> DataFrame:
    """``df`` with ``expr`` computed once per row as column ``name``.

    Predicate pushdown substitutes aliases into filters, so a filter on a field of
    a parsed column would re-run the parse inside the filter (once per reference).
    A generator output cannot be pushed below its generator, so producing the
    value through a one-element ``explode`` pins the parse to a single evaluation;
    fields read from it stay cheap to re-evaluate.
    """
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


# White space that JSON allows around a document.
JSON_BLANKS = " \t\n\r"


def opens_object(text: Column) -> Column:
    """True iff the first character other than JSON white space is ``{``."""
    return F.ltrim(text, F.lit(JSON_BLANKS)).startswith("{")


def parse_object(text: Column) -> Column:
    """VARIANT of ``text`` if it is a well-formed JSON object, else NULL.

    ``try_parse_json`` is NULL for malformed or empty text; a valid document whose
    first character after white space is ``{`` is an object, so ``null``, arrays and
    bare scalars are rejected too (quirk Q15). An object that repeats a key is read
    with its last value where the session allows duplicate keys (the engine's own
    sessions do, like a map-based parser); elsewhere it is NULL.
    """
    v = F.try_parse_json(text)
    return F.when(opens_object(text), v)


def get(v: Column, path: str, type_: str = "string") -> Column:
    """Typed field at a JSON path, NULL when absent or not convertible."""
    return F.try_variant_get(v, path, type_)


def as_object_map(v: Column) -> Column:
    """VARIANT object -> MAP<STRING, VARIANT> (NULL if not an object)."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def put(obj_map: Column, key: str, value: Column) -> Column:
    """Set ``key`` in a MAP, replacing an existing entry.

    ``map_concat`` raises on duplicate keys, so the key is removed first.
    """
    return F.map_concat(F.map_filter(obj_map, lambda k, _: k != F.lit(key)),
                        F.create_map(F.lit(key), value))


def drop_null_values(m: Column) -> Column:
    """Remove entries whose value is NULL (quirk Q12: nulls vanish on output)."""
    return F.map_filter(m, lambda _, x: x.isNotNull())


def last_wins(m: Column) -> Column:
    """A MAP read from text with a repeated key: the last value stays."""
    keys, values = F.map_keys(m), F.map_values(m)
    once = F.array_distinct(keys)
    last = F.transform(once, lambda k: F.element_at(
        values, (F.size(keys) + 1 - F.array_position(F.reverse(keys), k)).cast("int")))
    return F.when(F.size(once) < F.size(keys), F.map_from_arrays(once, last)).otherwise(m)


def variant_text(s: Column) -> Column:
    """A string as a VARIANT string scalar."""
    return s.cast("variant")


def object_to_json(obj_map: Column) -> Column:
    """MAP<STRING, VARIANT> -> JSON object text."""
    return F.to_json(F.to_variant_object(obj_map))


_STRING = r'"(?:[^"\\]++|\\.)*+"'


def without_nulls(text: Column) -> Column:
    """JSON text, as ``object_to_json`` writes it, without the null fields of its objects
    at any depth; nulls in arrays stay (quirk Q12). Every string is matched whole, so
    that nothing inside one is taken for a field."""
    dropped = F.regexp_replace(text, f"{_STRING}:null(?:,|(?=}}))|({_STRING})", "$1")
    return F.regexp_replace(dropped, f"({_STRING})|,(?=}})", "$1")
