"""Problem 2: deeply nested records as related flat tables.

Method: shared inlining. The schema is read as a graph of element types. A struct that occurs once within its holder is
inlined into the holder's columns; an element of an array, or a type that several holders share, gets a table of its
own, and each of its rows carries its path and its holder's, which serve as key and foreign key. Types are shared when
field name and shape agree, wherever they occur, so `spans` of paragraphs, tables, cells and lines are one table.

All objects of a record come out of one expression over its arrays and one explode: no shuffle, one scan, and a very
large record costs what it holds. Only the parts of the schema that a table needs are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Element:
    """A node of the schema graph: the type of the objects that arrays called `name` hold."""

    name: str
    type: T.StructType
    table: str = ""
    holders: set[str] = field(default_factory=set)

    @property
    def inlined(self) -> list[tuple[str, tuple[str, ...], T.DataType]]:
        """(column, path of fields, type): scalars and scalar arrays, those of singleton structs with their prefix."""
        out: list[tuple[str, tuple[str, ...], T.DataType]] = []

        def walk(t: T.StructType, at: tuple[str, ...]) -> None:
            for f in t.fields:
                if isinstance(f.dataType, T.StructType):
                    walk(f.dataType, (*at, f.name))
                elif not _objects(f.dataType):
                    out.append(("_".join((*at, f.name)), (*at, f.name), f.dataType))

        walk(self.type, ())
        return out

    @property
    def repeated(self) -> list[tuple[tuple[str, ...], T.StructType]]:
        """(path of fields, element type) of the arrays of objects within, those of singleton structs included."""
        return _repeated(self.type)


def _objects(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def _repeated(t: T.StructType, at: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.StructType]]:
    out = []
    for f in t.fields:
        if isinstance(f.dataType, T.StructType):
            out += _repeated(f.dataType, (*at, f.name))
        elif _objects(f.dataType):
            out.append(((*at, f.name), f.dataType.elementType))
    return out


def _shape(t: T.StructType) -> str:
    return t.simpleString()


def schema_graph(roots: dict[str, T.StructType]) -> dict[tuple[str, str], Element]:
    """Elements by (name, shape). roots: the arrays of objects of a record, by field name.

    A table is called after its field; fields of one name but different shapes get their first holder's name before it.
    """
    graph: dict[tuple[str, str], Element] = {}

    def visit(name: str, t: T.StructType, holder: str) -> None:
        key = (name, _shape(t))
        known = key in graph
        e = graph.setdefault(key, Element(name, t))
        e.holders.add(holder)
        if not known:
            for path, et in e.repeated:
                visit(path[-1], et, name)

    for name, t in roots.items():
        visit(name, t, "")
    names: dict[str, int] = {}
    for (name, _), e in graph.items():
        names[name] = names.get(name, 0) + 1
        e.table = name if names[name] == 1 else f"{min(e.holders)}_{name}"
    return graph


def record_arrays(df: DataFrame, wrapper: str | None, roots: list[str]) -> tuple[DataFrame, dict[str, T.StructType]]:
    """df with columns _r_<root>: each root array, from the wrapper struct where that has it, else from the top level."""
    types: dict[str, T.StructType] = {}
    columns = {}
    inner = df.schema[wrapper].dataType if wrapper and wrapper in df.columns else None
    for r in roots:
        found = [F.col(f"`{wrapper}`.`{r}`")] if isinstance(inner, T.StructType) and r in inner.names else []
        found += [F.col(f"`{r}`")] if r in df.columns else []
        if found:
            t = (inner[r].dataType if isinstance(inner, T.StructType) and r in inner.names else df.schema[r].dataType).elementType
            types[r] = t
            columns[f"_r_{r}"] = F.coalesce(*found)
    return df.withColumns(columns), types


def _get(x: Column, path: tuple[str, ...]) -> Column:
    for p in path:
        x = x.getField(p)
    return x


def object_rows(df: DataFrame, key: str, roots: list[str], wrapper: str | None = None, payload: bool = True) -> DataFrame:
    """One row for each non-null object: (key, table, parent_table, parent_path, path, pos, <table> struct for each table).

    Of the structs only the one of the row's own table is non-null; payload=False leaves them out. path is that of the
    object, as in `tables[0].cells[3].spans[0]`, parent_path that of its holder, empty at the top. Positions count null
    elements; null and empty arrays and null records give no row; a null key stays null. Two records of one key keep
    their rows apart only as far as the caller's key does.
    """
    wide, types = record_arrays(df, wrapper, roots)
    graph = schema_graph(types)
    tables = list(graph.values())
    one = T.StructType([T.StructField("table", T.StringType()), T.StructField("parent_table", T.StringType()), T.StructField("parent_path", T.StringType()), T.StructField("path", T.StringType()), T.StructField("pos", T.IntegerType())])
    if payload:
        for e in tables:
            one.add(e.table, T.StructType([T.StructField(c, t) for c, _, t in e.inlined] or [T.StructField("_none", T.BooleanType())]))
    empty = F.from_json(F.lit("[]"), T.ArrayType(one))

    def rows(array: Column, et: T.StructType, label: Column, name: str, holder: str, holder_path: Column) -> Column:
        e = graph[(name, _shape(et))]

        def each(x: Column, i: Column) -> Column:
            path = F.concat(label, F.lit("["), i.cast("string"), F.lit("]"))
            fields = [F.lit(e.table).alias("table"), F.lit(holder).cast("string").alias("parent_table"), holder_path.alias("parent_path"), path.alias("path"), i.cast("int").alias("pos")]
            if payload:
                for o in tables:
                    st = one[o.table].dataType
                    if o is e:
                        body = F.struct(*[_get(x, p).cast(t).alias(c) for c, p, t in o.inlined]) if o.inlined else F.struct(F.lit(None).cast("boolean").alias("_none"))
                        fields.append(body.cast(st).alias(o.table))
                    else:
                        fields.append(F.lit(None).cast(st).alias(o.table))
            own = F.array(F.struct(*fields).cast(one))
            within = [rows(_get(x, p), t, F.concat(path, F.lit("." + ".".join(p))), p[-1], e.table, path) for p, t in e.repeated]
            return F.when(x.isNull(), empty).otherwise(F.concat(own, *within) if within else own)

        return F.coalesce(F.flatten(F.transform(array, each)), empty)

    parts = [rows(F.col(f"_r_{r}"), t, F.lit(r), r, "", F.lit("")) for r, t in types.items()]
    if not parts:
        raise ValueError(f"none of {roots} is an array of objects")
    alls = F.concat(*parts) if len(parts) > 1 else parts[0]
    return wide.select(F.col(key), F.explode(alls).alias("_o")).select(F.col(key), "_o.*")


def flat_tables(df: DataFrame, key: str, roots: list[str], wrapper: str | None = None) -> dict[str, DataFrame]:
    """The related tables: (key, path, parent_table, parent_path, pos, inlined columns) of each element type.

    (key, path) is the primary key, (key, parent_path) the foreign key into parent_table. Each is a view on one scan;
    to write all of them at once, write object_rows partitioned by `table`. A column of a record that is called like
    the key's or a path's column gets the prefix `f_`.
    """
    alls = object_rows(df, key, roots, wrapper)
    _, types = record_arrays(df, wrapper, roots)
    own = {key.lower(), "path", "parent_table", "parent_path", "pos"}
    out = {}
    for e in schema_graph(types).values():
        cols = [F.col(f"`{e.table}`.`{c}`").alias(f"f_{c}" if c.lower() in own else c) for c, _, _ in e.inlined]
        out[e.table] = alls.where(F.col("table") == e.table).select(key, "path", "parent_table", "parent_path", "pos", *cols)
    return out


def object_links(df: DataFrame, key: str, roots: list[str], wrapper: str | None = None) -> DataFrame:
    """(key, parent_path, child_path) of every object; reads no more than the arrays themselves."""
    return object_rows(df, key, roots, wrapper, payload=False).select(key, "parent_path", F.col("path").alias("child_path"))
