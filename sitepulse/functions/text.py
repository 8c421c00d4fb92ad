"""Cuts in JSON text: one member out, or a prefix within a budget of bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Strings of any length; without it a document with one of over 20 million characters reads as NULL.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}

# Possessive throughout: Java then walks a text of any length in a loop, and never goes back.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_PLAIN = r"[-+.0-9A-Za-z]++"
# Objects and lists this deep are stepped over by the pattern.
_DEPTH = 3


def _value(depth: int = _DEPTH) -> str:
    """A pattern of one compact JSON value."""
    if not depth:
        return f"(?:{_STRING}|{_PLAIN})"
    inner = _value(depth - 1)
    return rf"(?:{_STRING}|{_PLAIN}|\[(?:{inner},?+)*+\]|\{{(?:{_STRING}:{inner},?+)*+\}})"


def _without(parent: Column, member: str) -> Column:
    """Compact text of an object without its first member of that name, found by walking over those before."""
    own, other = f'"{member}":', f"{_STRING}:{_value()}"
    before = rf"^(\{{(?:(?!{own}){other}(?:,(?!{own}))?+)*+)"
    return F.regexp_replace(parent, f"{before}(?:,{own}{_value()}(?=[,}}])|{own}{_value()},?+)", "$1")


def _rebuilt(doc: Column, path: tuple[str, ...]) -> Column:
    """The document put together from its members, for what the pattern does not reach."""
    members = F.from_json(doc, "map<string, variant>", ANY_LENGTH)
    if len(path) == 1:
        return F.to_json(F.map_filter(members, lambda name, _: name != path[0]))

    def changed(name: Column, value: Column) -> Column:
        text = F.to_json(value)
        return F.when((name == path[0]) & text.startswith("{"), F.parse_json(_rebuilt(text, path[1:]))).otherwise(value)

    return F.to_json(F.transform_values(members, changed))


def drop_json_member(
    rows: DataFrame, into: str, doc: Column, *path: str, require_parent: bool = False, parent: Column | None = None
) -> DataFrame:
    """Add a column ``into``: JSON text ``doc`` without one nested member, other text as it was.

    NULL when the text is not a non-empty object, or, with ``require_parent``, when the object that would hold the member
    is missing. ``parent`` is the text of that object, if it is at hand. The text is cut where that object stands
    in it. Only where it stands more than once, or holds the member twice or behind deeply nested ones, the document
    is put together anew from its members; members of objects inside them may then change places.
    """
    member, key = path[-1], path[-2]
    if parent is None:
        kind = T.StringType()
        for name in reversed(path[:-1]):
            kind = T.StructType([T.StructField(name, kind)])
        parent = F.from_json(doc, kind, ANY_LENGTH)
        for name in path[:-1]:
            parent = parent[name]
    given = rows.withColumns({"_given": doc, "_parent": parent})
    needle = F.concat(F.lit(f'"{key}":'), F.col("_parent"))
    compact = F.coalesce(F.get_json_object("_given", "$"), F.col("_given"))
    given = given.withColumn("_doc", F.when(F.contains(F.col("_given"), needle), F.col("_given")).otherwise(compact))
    given = given.withColumn("_cut", F.when(F.col("_parent").startswith("{"), _without(F.col("_parent"), member)))
    doc, parent, cut = F.col("_doc"), F.col("_parent"), F.col("_cut")
    swapped = F.replace(doc, needle, F.concat(F.lit(f'"{key}":'), cut))
    given = given.withColumn("_swapped", F.when(cut.isNotNull() & (cut != parent), swapped))
    swapped, label = F.col("_swapped"), F.lit(f'"{member}":')
    once = F.length(doc) - F.length(swapped) == F.length(parent) - F.length(cut)
    is_document = F.from_json(doc, "map<string, string>", ANY_LENGTH).isNotNull()
    # A text that looks like an object reads the same as one; in the document it has quotes before it.
    place = "$" + "".join(f"['{name}']" for name in path[:-1])
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), place, "variant"))
    is_object = parent.startswith("{") & (F.contains(doc, needle) | F.coalesce(kind.startswith("OBJECT"), F.lit(False)))
    result = (
        F.when(doc.isNull() | ~doc.startswith("{") | (doc == "{}"), F.lit(None))
        .when(parent.isNull() | ~is_object, F.lit(None) if require_parent else F.when(is_document, doc))
        .when(~parent.contains(label), doc)
        .when(once & ~cut.contains(label), swapped)
        .otherwise(_rebuilt(doc, path))
    )
    return given.withColumn(into, result).select(*(c for c in rows.columns if c != into), into)


# Extra bytes a character costs when written inside a JSON string.
JSON_ESCAPE_COST = {"\\": 2, '"': 2, "/": 2, "\b": 1, "\t": 1, "\n": 1, "\f": 1, "\r": 1}
# Most bytes one code point can cost (a two-digit control character).
MAX_CHAR_COST = 9


def fit_json_bytes(text: Column, budget: Column) -> Column:
    """The longest prefix whose UTF-8 bytes, JSON escapes included, stay within ``budget``.

    Texts that fit at the highest cost per character never leave the JVM.
    """

    # Costs of the ASCII characters; beyond them only the width in UTF-8 counts.
    ascii_cost = np.ones(128, np.int64)
    for code in range(0x20):
        # Counted with three padding zeros before the hexadecimal digits.
        ascii_cost[code] += 3 + 3 + len(format(code, "x"))
    for char, extra in JSON_ESCAPE_COST.items():
        ascii_cost[ord(char)] = 1 + extra

    # Everything the function needs travels with it; workers need no copy of this module.
    @F.pandas_udf("string")
    def cut(texts: pd.Series, budgets: pd.Series) -> pd.Series:
        out = []
        for value, limit in zip(texts, budgets):
            if value is None:
                out.append(None)
                continue
            points = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            wide = 2 + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
            used = np.cumsum(np.where(points < 128, ascii_cost[np.minimum(points, 127)], wide))
            out.append(value[: int(np.searchsorted(used, limit, side="right"))])
        return pd.Series(out, dtype=object)

    risky = F.length(text) * F.lit(MAX_CHAR_COST) > budget
    return F.when(risky, cut(F.when(risky, text), budget.cast("bigint"))).otherwise(text)
