"""Typed metadata predicates: a nested dict becomes one Column on named fields.

``{"document_id": "d1"}``, ``{"chunk_index": {"$gte": 2, "$lt": 9}}``,
``{"$or": [{"lang": {"$in": ["en", "de"]}}, {"$not": {"source": "web"}}]}``.
Several entries of one dict hold together.  Fields and the types of values are checked
against a schema before anything runs.  The Column consists of comparisons
with literals only, so Parquet readers take it into the scan, also on struct fields.

A field without a value (null) matches ``$ne``, ``$nin`` and ``{"$exists": False}`` only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    T.StringType: str, T.IntegerType: int, T.LongType: int, T.ShortType: int, T.ByteType: int,
    T.DoubleType: (int, float), T.FloatType: (int, float), T.BooleanType: bool,
    T.TimestampType: dt.datetime, T.DateType: dt.date,
}


def _field(schema: T.StructType, name: str) -> T.DataType:
    kind: T.DataType = schema
    for part in name.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            raise ValueError(f"no field {name!r}; there are {', '.join(schema.names)}")
        kind = kind[part].dataType
    return kind


def _value(kind: T.DataType, name: str, value) -> Column:
    wanted = _KINDS.get(type(kind))
    if wanted is None:
        raise TypeError(f"field {name!r} of type {kind.simpleString()} cannot be compared")
    if not isinstance(value, wanted) or (isinstance(value, bool) and wanted is not bool):
        raise TypeError(f"field {name!r} is of type {kind.simpleString()}, not {type(value).__name__}")
    # a whole number stays as it is: a cast to a narrower type could overflow
    return F.lit(value)


def _test(column: Column, kind: T.DataType, name: str, op: str, value) -> Column:
    if op == "$exists":
        if not isinstance(value, bool):
            raise TypeError("$exists takes true or false")
        return column.isNotNull() if value else column.isNull()
    if op in ("$in", "$nin"):
        if not isinstance(value, (list, tuple, set)) or not value:
            raise TypeError(f"{op} takes a list with at least one value")
        listed = column.isin(*[_value(kind, name, v) for v in value])
        return listed if op == "$in" else column.isNull() | ~listed
    v = _value(kind, name, value)
    tests = {"$eq": lambda: column == v, "$ne": lambda: column.isNull() | (column != v),
             "$gt": lambda: column > v, "$gte": lambda: column >= v,
             "$lt": lambda: column < v, "$lte": lambda: column <= v}
    if op not in tests:
        raise ValueError(f"unknown operator {op!r}")
    return tests[op]()


def _all(parts: list[Column], both=lambda a, b: a & b) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = both(out, p)
    return out


def predicate(spec: Mapping, schema: T.StructType, root: str = "") -> Column:
    """The Column of a predicate; ``root`` (such as ``metadata``) is the struct that holds the fields."""
    if not isinstance(spec, Mapping):
        raise TypeError("a predicate is a dict")
    if not spec:
        return F.lit(True)
    parts = []
    for name, test in spec.items():
        if name in ("$and", "$or"):
            if not isinstance(test, (list, tuple)) or not test:
                raise TypeError(f"{name} takes a list with at least one predicate")
            inner = [predicate(s, schema, root) for s in test]
            parts.append(_all(inner) if name == "$and" else _all(inner, lambda a, b: a | b))
        elif name == "$not":
            # null-safe: what does not match, matches its negation
            parts.append(~F.coalesce(predicate(test, schema, root), F.lit(False)))
        elif name.startswith("$"):
            raise ValueError(f"unknown operator {name!r}")
        else:
            path = f"{root}.{name}" if root else name
            kind, column = _field(schema, path), F.col(path)
            ops = test if isinstance(test, Mapping) else {"$eq": test}
            if not ops:
                raise ValueError(f"no test for field {name!r}")
            parts += [_test(column, kind, name, op, v) for op, v in ops.items()]
    return _all(parts)


def pinned(spec: Mapping, field: str) -> list | None:
    """The only values the predicate allows for ``field``, or None where it allows others:
    what a partitioned table needs to read some partitions only."""
    found = None
    for name, test in spec.items():
        here = None
        if name == "$and":
            for s in test:
                here = _both(here, pinned(s, field))
        elif name == "$or":
            each = [pinned(s, field) for s in test]
            here = sorted({v for e in each for v in e}) if all(e is not None for e in each) else None
        elif name == field and not isinstance(test, Mapping):
            here = [test]
        elif name == field:
            here = _both([test["$eq"]] if "$eq" in test else None, list(test["$in"]) if "$in" in test else None)
        found = _both(found, here)
    return found


def _both(a: list | None, b: list | None) -> list | None:
    if a is None or b is None:
        return a if b is None else b
    return [v for v in a if v in b]
