"""The same child rows as the stream's, for records held as nested columns, by Catalyst expressions: what tests compare with."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from landchange.operators.nested import ANALYSIS_TABLES


def child_rows_of_columns(df: DataFrame, key: str, tables: dict[str, list[str]] = ANALYSIS_TABLES, fields: bool = True) -> DataFrame:
    """`child_rows` for records held as nested columns of df: the same rows, by Catalyst expressions, in one scan.

    Only columns that a table's path begins with are read, unless the record itself ("") is a table with fields.
    """
    names = {p.split("/")[0] for ps in tables.values() for p in ps}
    take = [f for f in df.schema if f.name != key and (f.name in names or (fields and "" in names))]
    owner = {pattern: table for table, patterns in tables.items() for pattern in patterns}

    def row(pattern: str, path: Column, parent: Column, end: Column | None, value: Column, dtype: DataType) -> Column:
        last = pattern.rpartition("/")[2]
        parts = [F.lit(owner[pattern]).alias("child"), path.alias("path")]
        if fields:
            is_place = last == "*" and end is not None and dict(end=end) and _is_place[pattern]
            parts += [
                parent.alias("parent"),
                (end if is_place else F.lit(None)).cast("int").alias("ordinal"),
                (F.lit(last or None) if last != "*" else F.lit(None) if is_place else end).cast("string").alias("label"),
                leaves(value, dtype, pattern).alias("fields"),
            ]
        return F.struct(*parts)

    def leaves(value: Column, dtype: DataType, pattern: str) -> Column:
        """Field map of a row: the scalars below it that no deeper table owns; list places are part of the name."""

        def walk(v: Column, t: DataType, at: str, name: Column | None) -> list[Column]:
            if at != pattern and at in owner:
                return []
            if isinstance(t, StructType):
                out = []
                for f in t:
                    sub = F.lit(f.name) if name is None else F.concat(name, F.lit(f"/{f.name}"))
                    out += walk(v[f.name], f.dataType, f"{at}/{f.name}" if at else f.name, sub)
                return out
            if isinstance(t, ArrayType) and f"{at}/*" not in owner:
                def each(x: Column, i: Column) -> Column:
                    parts = walk(x, t.elementType, f"{at}/*", F.concat(name, F.lit("/"), i.cast("string")))
                    return F.concat(*parts) if parts else F.array().cast("array<struct<key:string,value:string>>")
                return [F.coalesce(F.flatten(F.transform(v, each)), F.array().cast("array<struct<key:string,value:string>>"))]
            if isinstance(t, (ArrayType, MapType)):
                return []
            text = F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if t.typeName() == "timestamp" else v.cast("string")
            entry = F.struct(F.lit("") .alias("key") if name is None else name.alias("key"), text.alias("value"))
            return [F.when(v.isNotNull(), F.array(entry)).otherwise(F.array().cast("array<struct<key:string,value:string>>"))]

        parts = walk(value, dtype, pattern, None)
        return F.map_from_entries(F.concat(*parts)) if parts else F.create_map().cast("map<string,string>")

    _is_place: dict[str, bool] = {}

    def below(value: Column, dtype: DataType, pattern: str, path: Column, parent: Column, end: Column | None) -> list[Column]:
        """Row arrays of this value and all under it."""
        if not any(p == pattern or p.startswith(f"{pattern}/" if pattern else "") for p in owner):
            return []
        out, up = [], parent
        if pattern in owner:
            out.append(F.when(value.isNotNull(), F.array(row(pattern, path, parent, end, value, dtype))))
            up = path
        if isinstance(dtype, StructType):
            for f in dtype:
                sub = f"{pattern}/{f.name}" if pattern else f.name
                out += below(value[f.name], f.dataType, sub, F.concat(path, F.lit(f"/{f.name}")) if pattern else F.lit(f.name), up, end)
        elif isinstance(dtype, (ArrayType, MapType)):
            sub, inner = f"{pattern}/*", dtype.elementType if isinstance(dtype, ArrayType) else dtype.valueType
            _is_place[sub] = isinstance(dtype, ArrayType)
            if isinstance(dtype, ArrayType):
                made = F.transform(value, lambda x, i: _joined(below(x, inner, sub, F.concat(path, F.lit("/"), i.cast("string")), up, i)))
            else:
                made = F.transform(F.map_entries(value), lambda e: _joined(below(e["value"], inner, sub, F.concat(path, F.lit("/"), e["key"]), up, e["key"])))
            out.append(F.flatten(F.filter(made, lambda x: x.isNotNull())))
        return out

    def _joined(parts: list[Column]) -> Column:
        """Concatenation that skips null arrays."""
        if len(parts) == 1:
            return parts[0]
        return F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull()))

    root = F.lit("")
    parts: list[Column] = []
    if "" in owner:
        record = F.struct(*(F.col(f"`{f.name}`").alias(f.name) for f in take)) if take else None
        body = StructType(take)
        parts.append(F.array(row("", root, root, None, record, body) if fields else F.struct(F.lit(owner[""]).alias("child"), root.alias("path"))))
    for f in take:
        parts += below(F.col(f"`{f.name}`"), f.dataType, f.name, F.lit(f.name), root, None)
    if not parts:
        raise ValueError("no table's path is in the frame")
    return df.select(F.col(key), F.explode(_joined(parts)).alias("_row")).select(key, "_row.*")
