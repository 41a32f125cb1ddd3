"""Deeply nested records into related flat tables.

A record's text is parsed as a stream: fields go straight into (path, ordinals, value) triples as they are met, and no tree of
the record is built. A path belongs to the table of its closest repeated (or declared) ancestor; the triples of one such
ancestor are neighbours in the stream, so pivoting them into a row needs no shuffle: every record becomes its child rows in one
pass, each with its own path and its parent's path as keys. Records held as nested columns enter as JSON text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from json.decoder import scanstring
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: Tables of an analysis record: path patterns, * for a list place or map key. "" is the record itself.
ANALYSIS_TABLES = {
    "record": [""],
    "comparison": ["comparisons/*"],
    "side": ["comparisons/*/before", "comparisons/*/after"],
    "scene": ["comparisons/*/before/sceneIds/*", "comparisons/*/after/sceneIds/*"],
    "year": ["comparisons/*/before/years/*", "comparisons/*/after/years/*"],
    "month": ["comparisons/*/before/months/*", "comparisons/*/after/months/*"],
    "platform": ["comparisons/*/before/platforms/*", "comparisons/*/after/platforms/*"],
    "scene_date": ["comparisons/*/before/sceneDates/*", "comparisons/*/after/sceneDates/*"],
    "footprint": ["footprint"],
    "forest_loss": ["forest/box", "forest/footprint"],
    "loss_year": ["forest/box/lossByYear/*", "forest/footprint/lossByYear/*"],
    "protected_area": ["protectedAreas/*"],
    "area_change": ["protectedAreas/*/change/*"],
}

ROW_DDL = "child STRING, path STRING, parent STRING, ordinal INT, label STRING, fields MAP<STRING,STRING>"


def _no_constant(name: str) -> Any:
    raise ValueError(f"{name} is not JSON")


class _Scanner:
    """The library's scanner of one value, made anew where the module's functions travel to."""

    def __init__(self):
        self.once = json.JSONDecoder(parse_constant=_no_constant).scan_once

    def __reduce__(self):
        return _Scanner, ()


_SCAN = _Scanner()
_space = re.compile(r"[ \t\n\r]*").match
_DAMAGE = (ValueError, IndexError, StopIteration, RecursionError)


def shape(dtype: DataType) -> Any:
    """A plain description of a Spark type that travels to the workers: ("list", x), ("map", x), ("object", {field name as
    written, camel or snake case: (name, whether written so, x)}) or ("value", None)."""
    if isinstance(dtype, ArrayType):
        return "list", shape(dtype.elementType)
    if isinstance(dtype, MapType):
        return "map", shape(dtype.valueType)
    if isinstance(dtype, StructType):
        fields = {}
        for f in dtype:
            kind = shape(f.dataType)
            fields[re.sub("([A-Z])", lambda m: "_" + m[1].lower(), f.name)] = (f.name, False, kind)
            fields[f.name] = (f.name, True, kind)
        return "object", fields
    return "value", None


class _Object:
    """The fields of an object met so far: where their triples lie, so that a field given again can take their place."""

    def __init__(self, out: list):
        self.out, self.held = out, {}

    def add(self, name: str, as_named: bool, null: bool, start: int) -> None:
        """The last value of a name counts; of two spellings the schema's own, unless it is null."""
        out, was = self.out, self.held.get(name)
        if was is not None:
            named, empty, a, b = was
            if as_named == named or (not null if as_named else empty):
                del out[a:b]
                for other, (n, e, x, y) in self.held.items():
                    if x >= b:
                        self.held[other] = (n, e, x - (b - a), y - (b - a))
                start -= b - a
            else:
                del out[start:]
                return
        self.held[name] = (as_named, null, start, len(out))


def _members(s: str, i: int, each: Any) -> int:
    """Goes through the object that begins at i: each(key, where its value begins) gives where the value ends."""
    i = _space(s, i + 1).end()
    if s[i] == "}":
        return i + 1
    while True:
        if s[i] != '"':
            raise ValueError("no name")
        key, i = scanstring(s, i + 1)
        i = _space(s, i).end()
        if s[i] != ":":
            raise ValueError("no value")
        i = _space(s, each(key, _space(s, i + 1).end())).end()
        if s[i] == "}":
            return i + 1
        if s[i] != ",":
            raise ValueError("no end")
        i = _space(s, i + 1).end()


def _object(s: str, i: int, fields: dict, path: str, ordinals: tuple, out: list) -> int:
    out.append((path, ordinals, ...))
    own = _Object(out)

    def each(key: str, at: int) -> int:
        if (known := fields.get(key)) is None:
            return _SCAN.once(s, at)[1]
        name, as_named, kind = known
        start = len(out)
        end = _read(s, at, kind, f"{path}/{name}" if path else name, ordinals, out)
        own.add(name, as_named, s.startswith("null", at), start)
        return end

    return _members(s, i, each)


def _map(s: str, i: int, inner: Any, path: str, ordinals: tuple, out: list) -> int:
    own = _Object(out)

    def each(key: str, at: int) -> int:
        start = len(out)
        end = _read(s, at, inner, path, (*ordinals, key), out)
        own.add(key, True, False, start)
        return end

    return _members(s, i, each)


def _list(s: str, i: int, inner: Any, path: str, ordinals: tuple, out: list) -> int:
    i = _space(s, i + 1).end()
    if s[i] == "]":
        return i + 1
    place = 0
    while True:
        i = _space(s, _read(s, i, inner, path, (*ordinals, place), out)).end()
        if s[i] == "]":
            return i + 1
        if s[i] != ",":
            raise ValueError("no end")
        i, place = _space(s, i + 1).end(), place + 1


def _read(s: str, i: int, kind: Any, path: str, ordinals: tuple, out: list) -> int:
    """Appends the triples of the value that begins at i, read as `kind`, and gives its end."""
    tag, inner = kind
    if tag == "value":
        value, end = _SCAN.once(s, i)
        if value is not None:
            out.append((path, ordinals, value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)))
        return end
    begin = s[i]
    if begin == '"':  # text that holds JSON is that JSON
        text, end = scanstring(s, i + 1)
        start = len(out)
        try:
            _whole(text, kind, path, ordinals, out)
        except _DAMAGE:
            del out[start:]
            if tag == "list" and inner[0] == "value":
                out.append((f"{path}/*", (*ordinals, 0), text))
        return end
    if tag == "list":
        if begin == "[":
            return _list(s, i, inner, f"{path}/*", ordinals, out)
        return _SCAN.once(s, i)[1] if s.startswith("null", i) else _read(s, i, inner, f"{path}/*", (*ordinals, 0), out)
    if begin != "{":
        return _SCAN.once(s, i)[1]
    return _object(s, i, inner, path, ordinals, out) if tag == "object" else _map(s, i, inner, f"{path}/*", ordinals, out)


def _whole(s: str, kind: Any, path: str, ordinals: tuple, out: list) -> None:
    if _space(s, _read(s, _space(s, 0).end(), kind, path, ordinals, out)).end() != len(s):
        raise ValueError("more than one value")


def triples(body: str | None, kind: Any) -> list[tuple[str, tuple, Any]]:
    """Depth-first (path, ordinals, value) triples of a body read as an object of `kind` (see `shape`); none unless the text,
    without a leading byte-order mark, is one whole JSON object.

    path has * for list places and map keys, ordinals has those places and keys in order. An object that is present gives a
    triple with value `...` before its content, so empty ones are kept; null values give none. A body whose only field is an
    object stands for that object. Objects nested too deep for the parser count as damaged.
    """
    if not body:
        return []
    s = body.removeprefix("\ufeff")
    out: list = [("", (), ...)]
    fields, own, keys, last = kind[1], _Object(out), set(), 0

    def each(key: str, at: int) -> int:
        nonlocal last
        keys.add(key)
        last = at
        if (known := fields.get(key)) is None:
            return _SCAN.once(s, at)[1]
        start = len(out)
        end = _read(s, at, known[2], known[0], (), out)
        own.add(known[0], known[1], s.startswith("null", at), start)
        return end

    try:
        begin = _space(s, 0).end()
        if s[begin] != "{" or _space(s, _members(s, begin, each)).end() != len(s):
            return []
        if len(keys) == 1 and s[last] == "{":
            out.clear()
            _object(s, last, fields, "", (), out)
    except _DAMAGE:
        return []
    return out


def _fill(pattern: str, ordinals: tuple) -> str:
    left = iter(ordinals)
    return "/".join(str(next(left)) if p == "*" else p for p in pattern.split("/"))


def rows_of(stream: Iterable[tuple[str, tuple, Any]], tables: dict[str, list[str]]) -> Iterator[tuple]:
    """Pivots a triple stream: one (child, path, parent, ordinal, label, fields) per instance of a table's path."""
    owner = {pattern: table for table, patterns in tables.items() for pattern in patterns}
    nearest: dict[str, tuple[str, str, int]] = {}

    def home(pattern: str) -> tuple[str, str, int]:
        """The closest path at or above this one that is a table, the rest of the path, and the table's ordinals."""
        if pattern not in nearest:
            at = pattern
            while at and at not in owner:
                at = at.rpartition("/")[0]
            rest = pattern[len(at) :].lstrip("/")
            nearest[pattern] = (at, rest, at.split("/").count("*")) if at in owner else ("?", rest, 0)
        return nearest[pattern]

    open_rows: list[tuple[str, tuple, dict]] = []  # a row closes when the stream leaves its ancestor

    def close(row: tuple[str, tuple, dict]) -> tuple:
        at, ordinals, fields = row
        up = at.rpartition("/")[0]
        while up and up not in owner:
            up = up.rpartition("/")[0]
        last, end = at.rpartition("/")[2], ordinals[-1] if ordinals else None
        ordinal = end if last == "*" and isinstance(end, int) else None
        label = end if last == "*" and isinstance(end, str) else last if last != "*" else None
        return owner[at], _fill(at, ordinals), _fill(up, ordinals), ordinal, label or None, fields

    for pattern, ordinals, value in stream:
        at, rest, depth = home(pattern)
        if at == "?":
            continue
        key = ordinals[:depth]
        while open_rows and (open_rows[-1][0], open_rows[-1][1]) != (at, key) and not (
            at.startswith(f"{open_rows[-1][0]}/" if open_rows[-1][0] else "") and key[: len(open_rows[-1][1])] == open_rows[-1][1]
        ):
            yield close(open_rows.pop())
        if not open_rows or (open_rows[-1][0], open_rows[-1][1]) != (at, key):
            open_rows.append((at, key, {}))
        if value is not ...:
            places = iter(ordinals[depth:])
            name = "/".join(str(next(places)) if p == "*" else p for p in rest.split("/")) if rest else ""
            open_rows[-1][2][name] = value
    while open_rows:
        yield close(open_rows.pop())


def _clean(text: str | None) -> str | None:
    """Lone surrogates, which JSON can hold and Arrow can't, become question marks."""
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def child_rows(df: DataFrame, key: str, body: str, schema: StructType, tables: dict[str, list[str]] = ANALYSIS_TABLES, fields: bool = True) -> DataFrame:
    """Child rows of records held as JSON text: key plus ROW_DDL; without `fields` only key, child and path.

    A body that isn't one whole JSON object (null, empty, damaged, a list) gives no rows. One value where the schema has a
    list is a list of one, text holding JSON where it has a list or an object is that JSON, snake_case names are the
    schema's names; what can't be read as its type counts as null. Null children give no rows but keep their place.
    Equal records give equal rows. Other columns of df are ignored.
    """
    kind, key_type = shape(schema), df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("_key"), F.col(body).alias("_body"))
    width = 6 if fields else 2

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(width + 1)]
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in rows_of(triples(text, kind), tables):
                    out[0].append(k)
                    for i in range(width):
                        out[i + 1].append([(_clean(n), _clean(v)) for n, v in row[i].items()] if i == 5 else _clean(row[i]) if isinstance(row[i], str) else row[i])
            kinds = [batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string())]
            names = ["_key", "child", "path", "parent", "ordinal", "label", "fields"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names[: width + 1])

    ddl = ROW_DDL if fields else "child STRING, path STRING"
    return source.mapInArrow(read, f"_key {key_type}, {ddl}").withColumnRenamed("_key", key)


def as_bodies(df: DataFrame, key: str, tables: dict[str, list[str]] = ANALYSIS_TABLES) -> DataFrame:
    """(key, body): records held as nested columns as JSON text, nulls kept. Only the columns in which a table's path begins are
    read; where there is but one, an empty second field keeps the record from standing for its only field."""
    names = {p.split("/")[0] for ps in tables.values() for p in ps} - {""}
    take = [f.name for f in df.schema if f.name != key and (f.name in names or (not names))]
    return df.select(key, F.to_json(F.struct(*(F.col(f"`{c}`").alias(c) for c in take), F.lit(None).cast("string").alias("_")), {"ignoreNullFields": "false"}).alias("body"))


def scalar_columns(schema: StructType, child: str, tables: dict[str, list[str]] = ANALYSIS_TABLES) -> dict[str, str]:
    """Name and type of every scalar field of a table's rows, in the schema's order; "" for a row that is a scalar itself."""
    pattern, owned = tables[child][0], {p for ps in tables.values() for p in ps}

    def walk(t: DataType, at: str, name: str) -> dict[str, str]:
        if name and at in owned or isinstance(t, (ArrayType, MapType)):
            return {}
        if isinstance(t, StructType):
            return {k: v for f in t for k, v in walk(f.dataType, f"{at}/{f.name}", f"{name}/{f.name}" if name else f.name).items()}
        return {name: t.simpleString()}

    kind: DataType = schema
    for part in pattern.split("/"):
        kind = kind[part].dataType if isinstance(kind, StructType) else kind.elementType if isinstance(kind, ArrayType) else kind.valueType
    return walk(kind, pattern, "")


def flat_table(rows: DataFrame, key: str, child: str, columns: dict[str, str]) -> DataFrame:
    """One flat table out of child rows: key, path, parent, ordinal, label and the named fields cast to their types.
    Text that doesn't fit its type becomes null."""
    fields = [F.col("fields").getItem(name).try_cast(kind).alias(re.sub(r"\W", "_", name) or "value") for name, kind in columns.items()]
    return rows.where(F.col("child") == child).select(key, "path", "parent", "ordinal", "label", *fields)
