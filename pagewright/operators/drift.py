"""Schemas that drift between the files of a stream.

Every JSON record is reduced to its paths and their types, every file to a *fingerprint* (the sorted path-type pairs of its
records). Fingerprints of a stream are versioned in order of writing; each version has explicit migration steps against
the one before it (add, remove, rename, retype). Records are then routed through the chained rules of their file into one
consistent table: rename rules give a field its first name, cast rules the widest type that it has anywhere, and default
rules a value (null unless one is given) where a file or record lacks it. A name that comes back while its old field goes on
under another is another field and gets a name of its own (``a#2``).

Records that are not JSON objects are left out. Null has no type, so a path that is only ever null in a file exists there
without a type and can't be retyped. An empty array counts as an array of unknown elements.
"""

from __future__ import annotations

import functools
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators import nested
from pagewright.operators.deliveries import once
from pagewright.session import keep

#: Marks of types that give no evidence by themselves.
NULL, EMPTY = "null", "array<>"


def _type(value: object) -> str:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, float):
        return "fraction"
    if isinstance(value, str):
        return "string"
    inner = {_type(x) for x in value} - {NULL}
    return f"array<{merge_types(inner) or ''}>"


def merge_types(types: set[str]) -> str:
    """One name for the types of a path: '' if nothing is known, integer with fraction is fraction, other mixtures are joined."""
    types = types - {NULL, ""}
    if len(types) > 1:
        types = types - {EMPTY} if any(t.startswith("array<") and t != EMPTY for t in types) else types
    if {"integer", "fraction"} <= types:
        types = types - {"integer"}
    arrays = {t for t in types if t.startswith("array<")}
    if len(arrays) > 1:
        types = (types - arrays) | {f"array<{merge_types({t[6:-1] for t in arrays})}>"}
    return "|".join(sorted(types))


def paths_of(value: object, path: str = "", out: dict | None = None) -> dict[str, set[str]]:
    """Path -> types of one parsed record."""
    out = defaultdict(set) if out is None else out
    if isinstance(value, dict) and (value or not path):
        for k, v in value.items():
            paths_of(v, f"{path}.{k}" if path else str(k), out)
    elif isinstance(value, list) and any(isinstance(x, dict) for x in value):
        for x in value:
            if x is not None:
                paths_of(x, f"{path}[]", out)
    elif isinstance(value, dict):
        out[path].add(NULL)
    else:
        out[path].add(_type(value))
    return out


def parse(payload: str | None) -> dict | None:
    """The record, or None for what is not a JSON object."""
    if not payload:
        return None
    try:
        value = json.loads(payload, parse_constant=lambda _: None)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def settle(types: dict[str, set[str]], neighbour: dict[str, object] = {}) -> dict[str, str]:
    """Path -> type of a file. A null or empty array in the place of an object (array) that others have is no path."""
    known = set(types) | set(neighbour)
    stems = set()
    for p in known:
        for i, ch in enumerate(p):
            if ch in ".[":
                stems.add(p[:i])
    return {p: merge_types(t) for p, t in types.items() if not (p in stems and t <= {NULL, EMPTY})}


def fingerprints(records: DataFrame, stream: str = "stream_key", file: str = "file_name", written: str = "written_at", payload: str = "payload") -> DataFrame:
    """One row per file: stream, file, written, paths (array of struct<path,type>), sorted by path.

    Profiles are reduced within each batch before the shuffle; a file's row is as wide as its schema, not its records.
    """
    source = records.select(F.col(stream).alias("stream"), F.col(file).alias("file"), F.col(written).alias("written"), F.col(payload).alias("payload"))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[tuple, set[str]] = defaultdict(set)
            s, f, w, p = (batch.column(i).to_pylist() if i != 2 else batch.column(i).cast(pa.int64()).to_pylist() for i in range(4))
            for stream_, file_, at, text in zip(s, f, w, p):
                if (record := parse(text)) is not None:
                    for path, types in paths_of(record).items():
                        out[stream_, file_, at, path] |= types
            rows = [(*k, t) for k, types in out.items() for t in sorted(types)]
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], names=["stream", "file", "us", "path", "type"])

    seen = source.mapInArrow(profile, "stream string, file string, us bigint, path string, type string")
    by_path = seen.groupBy("stream", "file", "path").agg(F.min("us").alias("us"), F.collect_set("type").alias("types"))
    return by_path.groupBy("stream", "file").agg(F.timestamp_micros(F.min("us")).alias("written"), F.array_sort(F.collect_list(F.struct("path", "types"))).alias("paths"))


def parent(path: str) -> str:
    return path.rpartition(".")[0]


def compare(before: dict[str, set[str]], after: dict[str, set[str]]) -> list[tuple[str, str, str]]:
    """Migration steps (kind, old path, new path) from one file's paths to the next file's.

    A path that goes is paired with one that comes under the same parent: first those of equal type, then the rest, in
    order of name; what stays unpaired is removed or added.
    """
    a, b = settle(before, after), settle(after, before)
    gone, new = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    steps: list[tuple[str, str, str]] = []
    for same in (True, False):
        for old in list(gone):
            match = [n for n in new if parent(n) == parent(old) and (not same or (a[old] and a[old] == b[n]))]
            if match:
                steps.append(("renamed", old, match[0]))
                gone.remove(old)
                new.remove(match[0])
    steps += [("removed", p, "") for p in gone] + [("added", "", p) for p in new]
    for p in sorted(set(a) & set(b)):
        x, y = a[p], b[p]
        if x and y and x != y and EMPTY not in (x, y):
            steps.append(("retyped", p, p))
    return steps


def changes(records: DataFrame, **columns: str) -> DataFrame:
    """Every change of each file against the file of the same stream written before it.

    Columns: stream, file, written, version (0-based place in the stream), change_kind, old_path, new_path. Files of
    equal time are ordered by name. An empty table gives no rows; a first file has no changes; repeated records change
    nothing.
    """
    prints = fingerprints(records, **columns)
    order = Window.partitionBy("stream").orderBy("written", "file")
    versions = prints.withColumn("before", F.lag("paths").over(order)).withColumn("version", F.row_number().over(order) - 1)

    @F.pandas_udf("array<struct<change_kind:string,old_path:string,new_path:string>>")
    def steps(before: pd.Series, after: pd.Series) -> pd.Series:
        to = lambda x: {r["path"]: set(r["types"]) for r in x}
        return pd.Series([compare(to(x), to(y)) if x is not None else [] for x, y in zip(before, after)], dtype=object)

    return versions.select("stream", "file", "written", "version", F.explode(steps("before", "paths")).alias("s")).select("stream", "file", "written", "version", "s.*")


def _cast(value: object, to: str) -> object:
    """A leaf in the type of the consistent table; what can't be cast stays as it is."""
    if value is None or not to or "|" in to:
        return value
    if to.startswith("array<"):
        return [_cast(x, to[6:-1]) for x in value] if isinstance(value, list) else [_cast(value, to[6:-1])]
    try:
        if to == "string":
            return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
        if to == "fraction":
            return float(value)
        if to == "integer":
            return int(value)
    except (TypeError, ValueError):
        return value
    return value


def leaves(value: object, path: str = "", at: tuple[int, ...] = ()) -> Iterator[tuple[str, tuple[int, ...], object]]:
    """(path, ordinals, value) of every leaf of a parsed record."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, f"{path}.{k}" if path else str(k), at)
    elif isinstance(value, list) and any(isinstance(x, dict) for x in value):
        for i, x in enumerate(value):
            yield from leaves(x, f"{path}[]", (*at, i))
    else:
        yield path, at, value


#: From weak to strong; a path's consistent type is the strongest it ever had.
STRENGTH = ("", "boolean", "integer", "fraction", "string")


def widest(a: str, b: str) -> str:
    if a == b or not b:
        return a
    if not a:
        return b
    if a.startswith("array<") or b.startswith("array<"):
        inner = lambda t: t[6:-1] if t.startswith("array<") else t
        return f"array<{widest(inner(a), inner(b))}>"
    rank = lambda t: STRENGTH.index(t) if t in STRENGTH else len(STRENGTH) - 1
    return a if rank(a) >= rank(b) else b


class Names:
    """The canonical name of each path of a stream, carried from file to file."""

    def __init__(self) -> None:
        self.now: dict[str, str] = {}  # path -> canonical, of the fields that are there
        self.last: dict[str, str] = {}  # canonical -> the name that it has or had last

    def rename(self, old: str, new: str) -> None:
        own = self.now.pop(old, old)
        self.now[new], self.last[own] = own, new

    def remove(self, path: str) -> None:
        self.now.pop(path, None)

    def of(self, path: str) -> str:
        """The name of a path; one that comes back under its last name is the same field, if that isn't there by another name."""
        if path not in self.now:
            here = set(self.now.values())
            back = [c for c, name in self.last.items() if name == path and c not in here]
            own, n = back[0] if back else path, 2
            while not back and own in self.last:
                own, n = f"{path}#{n}", n + 1
            self.now[path], self.last[own] = own, path
        return self.now[path]


def migrations(records: DataFrame, **columns: str) -> DataFrame:
    """Per file the chained rename rules: stream, file, version, path, canonical, own (the type of the path in the file).

    The chain of a stream is folded over its fingerprints (one small row per file) in order of writing, row by row as they
    stream by, so that a stream of any length needs the memory of one schema.
    """
    prints = fingerprints(records, **columns)
    ordered = prints.repartition("stream").sortWithinPartitions("stream", "written", "file")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, names, before, version = None, Names(), None, 0
        for pdf in frames:
            rows = []
            for row in pdf.itertuples():
                if before is None or row.stream != stream:
                    stream, names, before, version = row.stream, Names(), None, 0
                now = {r["path"]: set(r["types"]) for r in row.paths}
                if before is not None:
                    version += 1
                    steps = compare(before, now)
                    for kind, old, new in steps:
                        if kind == "renamed":
                            names.rename(old, new)
                    # what stands for an object or array that others have is no field
                    for path in set(before) - set(now):
                        names.remove(path)
                rows += [(row.stream, row.file, version, p, names.of(p), merge_types(t)) for p, t in sorted(now.items())]
                before = now
            yield pd.DataFrame(rows, columns=["stream", "file", "version", "path", "canonical", "own"])

    return ordered.mapInPandas(fold, "stream string, file string, version bigint, path string, canonical string, own string")


def aliases(chained: DataFrame) -> dict[str, str]:
    """First names that are later names of a field in other streams -> that field's name, for one table of all streams.

    A name is only taken over if its streams are fewer than those that have the field, and no file has both. The driver gets
    pairs of field names, whose number is that of the renames that ever occur, not of files or records.
    """
    pairs = chained.filter("path <> canonical and canonical not like '%#%'").select("canonical", "path").distinct()
    streams = chained.groupBy("canonical").agg(F.count_distinct("stream").alias("n"))
    own = chained.select("stream", "canonical").distinct()
    a, b = own.withColumnRenamed("canonical", "a"), own.withColumnRenamed("canonical", "b")
    asked = pairs.join(streams.withColumnsRenamed({"canonical": "path", "n": "n_path"}), "path").join(streams, "canonical").filter("n_path < n")
    both = asked.join(a, F.col("canonical") == F.col("a")).join(b, ["stream"]).filter("b = path").select("canonical", "path").distinct()
    rows = asked.join(both, ["canonical", "path"], "left_anti").groupBy("path").agg(F.max_by("canonical", F.struct("n", "canonical")).alias("to")).collect()
    to = {r.path: r.to for r in rows}
    # names that are taken over themselves are followed to the end
    return {p: end for p in to if (end := _follow(p, to)) != p}


def _follow(name: str, to: dict[str, str]) -> str:
    seen = {name}
    while name in to and to[name] not in seen:
        name = to[name]
        seen.add(name)
    return name


def _kind(own: str) -> T.DataType:
    if own.startswith("array<"):
        return T.ArrayType(_kind(own[6:-1]))
    return {"integer": T.LongType(), "fraction": T.DoubleType(), "boolean": T.BooleanType()}.get(own, T.StringType())


def layout(types: dict[str, str]) -> tuple[T.StructType, dict[str, list[str]]]:
    """(the table's nested schema, canonical path -> its steps) of canonical paths with their types.

    A path that has a value in one file and fields below it in others keeps its value in a field ``_value``.
    """
    tree: dict = {}
    steps: dict[str, list[str]] = {}
    for path, own in sorted(types.items()):
        below = any(p.startswith((f"{path}.", f"{path}[]")) for p in types)
        if below and own in ("", EMPTY):
            continue
        path_ = f"{path}._value" if below or path.endswith("[]") else path
        parts = [x for x in re.split(r"(\[\])?\.", path_) if x is not None and x != ""]
        way = []
        for x in parts:
            if x == "[]":
                way[-1] += "[]"
            else:
                way.append(x)
        node = tree
        for x in way[:-1]:
            node = node.setdefault(x, {})
            if not isinstance(node, dict):
                break
        if isinstance(node, dict) and not isinstance(node.get(way[-1]), dict):
            node[way[-1]] = own
            steps[path] = way

    def struct(node: dict) -> T.StructType:
        fields = []
        for name, inner in node.items():
            kind = struct(inner) if isinstance(inner, dict) else _kind(inner)
            fields.append(T.StructField(name.removesuffix("[]"), T.ArrayType(kind) if name.endswith("[]") else kind))
        return T.StructType(fields)

    return struct(tree), steps


def _put(record: dict, way: list[str], at: tuple[int, ...], value: object) -> None:
    node, at = record, list(at)
    for name in way[:-1]:
        if name.endswith("[]"):
            items, i = node.setdefault(name[:-2], []), at.pop(0) if at else 0
            items.extend({} for _ in range(i + 1 - len(items)))
            node = items[i]
        else:
            node = node.setdefault(name, {})
    node[way[-1]] = value


def consistent(records: DataFrame, stream: str = "stream_key", file: str = "file_name", written: str = "written_at", payload: str = "payload", line: str = "line_no", defaults: dict[str, object] | None = None) -> DataFrame:
    """All valid records of all streams in one consistent table: stream, file, version, line, then a typed column for each
    top-level field, with nested fields as structs and arrays of structs.

    ``defaults`` gives values for canonical paths (outside arrays) that a record lacks or has as null; all others are null
    there. A record delivered twice counts once; if ``row`` names a key of the rows, only keys are shuffled for that. Records
    of an empty table give an empty table without fields. The schema and the renames reach the driver: as wide as the
    distinct field names of the whole input, whatever the number of files.
    """
    chained = keep(migrations(records, stream=stream, file=file, written=written, payload=payload))
    to = aliases(chained)
    renamed = F.coalesce(F.create_map(*[F.lit(x) for p in to.items() for x in p])[F.col("canonical")], F.col("canonical")) if to else F.col("canonical")
    chained = chained.withColumn("canonical", renamed)
    seen = chained.groupBy("canonical").agg(F.collect_set("own").alias("t")).collect()
    types = {r.canonical: functools.reduce(widest, sorted(r.t), "") for r in seen}
    schema, steps = layout(types)
    default = {p: v for p, v in (defaults or {}).items() if p in steps and not any(x.endswith("[]") for x in steps[p])}
    rules = chained.groupBy("stream", "file", "version").agg(F.collect_list(F.struct("path", "canonical")).alias("rules"))

    # empty arrays of objects stay empty arrays
    arrays: dict[str, list[str]] = {}
    for way in steps.values():
        for i, x in enumerate(way):
            if x.endswith("[]"):
                arrays[".".join(way[: i + 1])] = [*way[:i], x[:-2]]
    rows = records.select(F.col(stream).alias("stream"), F.col(file).alias("file"), F.col(line).cast("bigint").alias("line"), F.col(payload).alias("payload"))
    rows = once(rows, ["stream", "file", "line"], "payload")

    @F.pandas_udf("string")
    def route(payloads: pd.Series, rule: pd.Series) -> pd.Series:
        out = []
        for text, rs in zip(payloads, rule):
            record = parse(text)
            if record is None:
                out.append(None)
                continue
            names = {r["path"]: r["canonical"] for r in rs}
            new: dict = {}
            for p, at, v in leaves(record):
                own = names.get(p, p)
                if v is None:
                    continue
                if own in steps:
                    _put(new, steps[own], at, _cast(v, types[own]))
                elif v == [] and f"{own}[]" in arrays:
                    _put(new, arrays[f"{own}[]"], at, [])
            for p, v in default.items():
                node = new
                for x in steps[p][:-1]:
                    node = node.setdefault(x, {})
                if node.get(steps[p][-1]) is None:
                    node[steps[p][-1]] = v
            out.append(json.dumps(new, ensure_ascii=False))
        return pd.Series(out, dtype=object)

    routed = rows.join(rules, ["stream", "file"]).select("stream", "file", "version", "line", route("payload", "rules").alias("r")).filter("r is not null")
    return routed.select("stream", "file", "version", "line", F.from_json("r", schema).alias("r")).select("stream", "file", "version", "line", "r.*")


def field_values(table: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The consistent table as one row per record and top-level field: keys, field, value (JSON text, null where it is missing)."""
    keys = keys or ["stream", "file", "version", "line"]
    fields = [c for c in table.columns if c not in keys]
    if not fields:
        return table.select(*keys, F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")).limit(0)
    text = lambda c: F.to_json(F.col(f"`{c}`")) if isinstance(table.schema[c].dataType, (T.StructType, T.ArrayType)) else F.col(f"`{c}`").cast("string")
    return table.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), text(c).alias("value")) for c in fields])).alias("x")).select(*keys, "x.*")


def path_counts(table: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Values of each path of the consistent table over all records: path (as in the migration rules), n_values (not null)."""
    keys = keys or ["stream", "file", "version", "line"]

    def walk(kind: T.DataType, path: str) -> Iterator[tuple[str, int]]:
        if isinstance(kind, T.StructType):
            for f in kind:
                yield from walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            yield from walk(kind.elementType, f"{path}[]")
        else:
            yield path, path.count("[]")

    found = list(walk(T.StructType([f for f in table.schema if f.name not in keys]), ""))
    counts = []
    for path, depth in found:
        column = nested.values_of(path)
        for _ in range(depth - 1):
            column = F.flatten(F.filter(column, lambda v: v.isNotNull()))
        n = F.coalesce(F.size(F.filter(column, lambda v: v.isNotNull())), F.lit(0)) if depth else column.isNotNull().cast("int")
        counts.append(F.sum(F.when(column.isNotNull(), n).otherwise(0)).alias(path.replace(".", "/")))
    if not found:
        return table.sparkSession.createDataFrame([], "path string, n_values bigint")
    one = table.agg(*counts)
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.coalesce(F.col(f"`{p.replace('.', '/')}`"), F.lit(0)).cast("bigint").alias("n_values")) for p, _ in found])
    return one.select(F.explode(rows).alias("x")).select("x.*")
