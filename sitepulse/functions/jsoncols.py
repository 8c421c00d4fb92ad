"""Typed reads from JSON text columns.

Many members of one document are read with a single ``from_json`` whose schema names only those
members, so the document is tokenised once however many members a report needs, and everything
else in it is skipped. A member of the wrong JSON type reads as NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

Path = tuple[str, ...]

# Without it a member of over 20 million characters that is read makes the whole document NULL.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}
NUMBER = T.DoubleType()
ANY = T.VariantType()
NAMED_SCORES = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())])
)


def schema_for(paths: Iterable[tuple[Path, T.DataType]]) -> T.StructType:
    """The nested schema that holds exactly the given member paths."""
    tree: dict = {}
    for path, dtype in paths:
        node = tree
        for key in path[:-1]:
            node = node.setdefault(key, {})
        node[path[-1]] = dtype

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(key, build(value) if isinstance(value, dict) else value)
                for key, value in node.items()
            ]
        )

    return build(tree)


def parse(doc: Column, paths: Iterable[tuple[Path, T.DataType]]) -> Column:
    """Parse only ``paths`` of a JSON text column into a struct."""
    return F.from_json(doc, schema_for(paths), ANY_LENGTH)


def member(parsed: Column, path: Path) -> Column:
    """Follow a path inside a parsed struct; keys may hold dots and dashes."""
    for key in path:
        parsed = parsed.getField(key)
    return parsed


def as_integer(number: Column) -> Column:
    """A JSON number read as an integer: NULL when it has a fraction."""
    return F.when(number == F.floor(number), number.cast("bigint"))


def lax_string(value: Column) -> Column:
    """A JSON boolean, number or string as text; ``1.0`` reads as ``1``."""
    return F.try_variant_get(value, "$", "string")


def lax_float(value: Column) -> Column:
    """A JSON number, numeric string or boolean as a double."""
    return F.try_variant_get(value, "$", "double")


def float64(doc: Column, *path: str) -> Column:
    """One JSON number as a double; NULL for anything else."""
    return member(parse(doc, [(path, NUMBER)]), path)


def int64(doc: Column, *path: str) -> Column:
    """One JSON integer; NULL for anything else."""
    return as_integer(float64(doc, *path))


def string_at(doc: Column, *path: str) -> Column:
    """One JSON scalar, leniently, as text."""
    return lax_string(member(parse(doc, [(path, ANY)]), path))


def array_at(doc: Column, *path: str) -> Column:
    """A JSON array as an array of element texts; NULL when the member is not an array."""
    return member(parse(doc, [(path, T.ArrayType(T.StringType()))]), path)


def named_score(scores: Column, name: str) -> Column:
    """Score of the first ``{name, score}`` element with this name; NULL when there is none."""
    return F.try_element_at(F.filter(scores, lambda s: s["name"] == name), F.lit(1))["score"]


def is_present(doc: Column) -> Column:
    """The document is there and is not the empty object, however much white space that holds."""
    # Possessive blanks: the pattern fails at the first other character and never steps back.
    return doc.isNotNull() & ~doc.rlike(r"^\s*+\{\s*+\}\s*+$")
