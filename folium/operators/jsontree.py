"""JSON documents as trees: a row for each object and array of structures, relations between keys, schemas, cleaning.

The traversal keeps the order of a document's keys and the spelling of its values, which no built-in does, so it is one
Arrow kernel over (source, json). Documents are independent of one another; nothing is shuffled before the rows exist.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE = "id string, parent_id string, label string, name string, source string, type string, path string, depth int, length int, ord long, props map<string,string>"
_SAFE = str.maketrans({".": "_", "[": "_", "]": None, " ": "_", "-": "_", "/": "_"})


def safe(path: str) -> str:
    return path.translate(_SAFE).strip("_")


def _is_structure(v: object) -> bool:
    return isinstance(v, (dict, list))


def walk(doc: object, source: str, max_depth: int = 50, seed_root: bool = True) -> Iterator[dict]:
    """Structures of a document in order: objects, and arrays that hold a structure. Deeper than max_depth is cut off.

    seed_root puts the document's own root first, which takes the place of a top-level object's id and so its values.
    """
    stack: list[tuple[object, str | None, str, int]] = [(doc, f"{source}_root" if seed_root else None, "", 0)]
    if seed_root:
        yield {"id": f"{source}_root", "parent_id": None, "label": "DocumentRoot", "name": source, "type": "root", "path": "", "depth": 0, "length": None, "props": {}}
    while stack:
        v, parent, path, depth = stack.pop()
        if depth > max_depth:
            continue
        below: list[tuple[object, str | None, str, int]] = []
        name = path.split(".")[-1]
        if isinstance(v, dict):
            me = f"{source}_{safe(path) if path else 'root'}"
            props = {}
            for k, x in v.items():
                if not _is_structure(x):
                    props[f"prop_{safe(k)}"] = str(x)
                elif isinstance(x, list) and x and not any(map(_is_structure, x)):
                    props[f"prop_{safe(k)}"] = "; ".join(map(str, x))
                if _is_structure(x):
                    below.append((x, me, f"{path}.{k}" if path else k, depth + 1))
            yield {"id": me, "parent_id": parent, "label": "ObjectNode", "name": name or source, "type": "dict", "path": path, "depth": depth, "length": None, "props": props}
        elif isinstance(v, list) and any(map(_is_structure, v)):
            me = f"{source}_{safe(path)}"
            yield {"id": me, "parent_id": parent, "label": "ArrayNode", "name": name or "array", "type": "list", "path": path, "depth": depth, "length": len(v), "props": {}}
            below = [(x, me, f"{path}[{i}]", depth + 1) for i, x in enumerate(v) if _is_structure(x)]
        stack.extend(reversed(below))


def _parsed(text: str | None) -> object:
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def tree_rows(docs: DataFrame, source: str = "source", text: str = "json", max_depth: int = 50, seed_root: bool = True) -> DataFrame:
    """NODE rows of every document, each id at its first visit; ord is the order of visits within a document.

    Different paths may share an id, as ids are simplified paths; what lies below a path whose id is taken still comes.

    Null, unreadable and empty documents (and a top-level array without structures) give no row but the seeded root's,
    and that only if there is something. Of a key given twice the last value counts.
    """
    names = [x.split()[0] for x in NODE.split(", ")[:-1]] + ["props"]
    kinds = [pa.string()] * 7 + [pa.int32(), pa.int32(), pa.int64(), pa.map_(pa.string(), pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []

            def pack() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)
                rows.clear()
                return out

            for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                doc = _parsed(t)
                if not doc or s is None:
                    continue
                seen: set[str] = set()
                for n, r in enumerate(walk(doc, s, max_depth, seed_root)):
                    if r["id"] in seen:
                        continue
                    seen.add(r["id"])
                    rows.append((r["id"], r["parent_id"], r["label"], r["name"], s, r["type"], r["path"], r["depth"], r["length"], n, list(r["props"].items())))
                    if len(rows) >= 20_000:
                        yield pack()
            yield pack()

    return docs.select(F.col(source).cast("string"), F.col(text).cast("string")).mapInArrow(run, NODE)


def relations(docs: DataFrame, source: str = "source", text: str = "json") -> DataFrame:
    """(source, ord, parent_node, child_node, json_path): for each occurrence of a key that holds a list of objects only.

    An empty list counts as one. An object within an object gives no relation but passes on its key as parent; paths
    carry no positions.
    """

    def visit(doc: object) -> Iterator[tuple[str, str, str]]:
        stack: list[tuple[object, str | None, str | None]] = [(doc, None, None)]
        while stack:
            v, key, path = stack.pop()
            if isinstance(v, tuple):
                yield v
                continue
            if not isinstance(v, dict):
                continue
            below: list[tuple[object, str | None, str | None]] = []
            for k, x in v.items():
                at = f"{path}.{k}" if path else k
                if isinstance(x, list) and all(isinstance(i, dict) for i in x):
                    below.append(((key or "ROOT", k, at), None, None))
                    below += [(i, k, at) for i in x]
                elif isinstance(x, dict):
                    below.append((x, k, at))
            stack.extend(reversed(below))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out += [(s, n, *r) for n, r in enumerate(visit(_parsed(t)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=["source", "ord", "parent_node", "child_node", "json_path"])

    return docs.select(F.col(source).cast("string"), F.col(text).cast("string")).mapInArrow(run, "source string, ord long, parent_node string, child_node string, json_path string")


def key_types(docs: DataFrame, source: str = "source", text: str = "json") -> DataFrame:
    """(json_path, type, documents, required): the types at each path, [] for elements, and whether every object has it.

    This is the content of an inferred JSON Schema as rows; counts combine before the shuffle, so it covers any number
    of documents. required: no object at the holder's path lacks the key.
    """

    def kind(v: object) -> str:
        return "null" if v is None else "boolean" if isinstance(v, bool) else "integer" if isinstance(v, int) else "number" if isinstance(v, float) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: dict[tuple[str, str, str], list[int]] = {}
            for t in b.column(0).to_pylist():
                if t is None or (doc := _parsed(t)) is None:
                    continue
                seen = set()
                stack = [("$", "", doc)]
                while stack:
                    path, holder, v = stack.pop()
                    key = (path, holder, kind(v))
                    row = n.setdefault(key, [0, 0])
                    row[1] += 1
                    if key not in seen:
                        seen.add(key)
                        row[0] += 1
                    if isinstance(v, dict):
                        stack += [(f"{path}.{k}", path, x) for k, x in v.items()]
                    elif isinstance(v, list):
                        stack += [(f"{path}[]", "", x) for x in v]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.string()), pa.array([k[2] for k in n], pa.string()), pa.array([x[0] for x in n.values()], pa.int64()), pa.array([x[1] for x in n.values()], pa.int64())], names=["json_path", "holder", "type", "documents", "values"])

    got = docs.select(F.col(text).cast("string")).mapInArrow(run, "json_path string, holder string, type string, documents long, values long").groupBy("json_path", "holder", "type").agg(F.sum("documents").alias("documents"), F.sum("values").alias("values"))
    objects = got.where("type = 'object'").groupBy(F.col("json_path").alias("holder")).agg(F.sum("values").alias("objects"))
    values = got.groupBy("json_path").agg(F.sum("values").alias("n"))
    return got.join(objects, "holder", "left").join(values, "json_path").select("json_path", "type", "documents", F.coalesce(F.col("n") == F.col("objects"), F.lit(False)).alias("required"))


def clean_json(docs: DataFrame, source: str = "source", text: str = "json", keys: tuple[str, ...] | None = None, replace: dict[str, str] | None = None, keep_controls: tuple[str, ...] = ()) -> DataFrame:
    """(source, json, strings_total, strings_changed, chars_removed, chars_mapped): documents with their strings cleaned.

    Keys are never cleaned. With keys, only strings directly under one of them are, so none within a list; objects
    below are visited all the same. Unreadable documents give null and zero counts. replace adds single characters to
    map (longer ones never match), keep_controls control characters to keep.
    """
    import re
    import unicodedata

    from folium.functions import lexicon as lx

    glyphs = str.maketrans({**dict.fromkeys(lx.TO_BLANK, " "), **dict.fromkeys(lx.TO_NOTHING, ""), **lx.QUOTES, lx.ELLIPSIS: "...", **{k: v for k, v in (replace or {}).items() if len(k) == 1}})
    controls = frozenset("\n\t").union(keep_controls)
    blanks, runs = re.compile("[ \t\u00a0\u2000-\u200b\u202f\u2060\ufeff]+"), re.compile(" {2,}")

    def one(s: str) -> tuple[str, int, int]:
        x = unicodedata.normalize("NFC", s)
        mapped = sum(ord(c) in glyphs for c in x)
        x = x.translate(glyphs)
        kept = "".join(c for c in x if c in controls or unicodedata.category(c) not in ("Cc", "Cs", "Cn", "Co"))
        return runs.sub(" ", blanks.sub(" ", kept)), len(x) - len(kept), mapped

    def visit(v: object, n: list[int], take: bool) -> object:
        if isinstance(v, dict):
            return {k: visit(x, n, keys is None or isinstance(x, str) and k in keys) for k, x in v.items()}
        if isinstance(v, list):
            return [visit(x, n, keys is None) for x in v]
        if isinstance(v, str):
            n[0] += 1
            if take:
                out, gone, mapped = one(v)
                n[1] += out != v
                n[2] += gone
                n[3] += mapped
                return out
        return v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t in b.column(1).to_pylist():
                n = [0, 0, 0, 0]
                doc = _parsed(t)
                texts.append(None if doc is None else json.dumps(visit(doc, n, keys is None), ensure_ascii=False, indent=2))
                counts.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]], names=["source", "json", "strings_total", "strings_changed", "chars_removed", "chars_mapped"])

    return docs.select(F.col(source).cast("string"), F.col(text).cast("string")).mapInArrow(run, "source string, json string, strings_total long, strings_changed long, chars_removed long, chars_mapped long")
