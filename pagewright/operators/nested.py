"""Deeply nested records as related flat tables.

Each record is shredded into path-value-ordinal triples: a *path* is the chain of field names, an *ordinal vector* holds
one 0-based position per repeated ancestor, and the value is the leaf. Paths of one repeated ancestor form one group, which
the schema tells (``related``); parallel arrays whose positions correspond can be put into one group. Each group is pivoted
into one table whose rows carry the record key and the ordinals (the parent links).

Shredding walks Arrow list offsets, so a whole batch is turned into triples by array arithmetic. A record never leaves
its batch, hence neither shredding nor pivoting shuffles; tables of any size stream through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Triples:
    """Triples of one path: ``record`` is the row in the batch, ``ordinals`` one column per repeated ancestor."""

    path: str
    record: np.ndarray
    ordinals: list[np.ndarray]
    values: pa.Array


def _explode(array: pa.Array, record: np.ndarray, ordinals: list[np.ndarray]):
    """One list level down; null lists have no elements."""
    lengths = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    at = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(at)) - starts[at]
    return array.flatten(), record[at], [o[at] for o in ordinals] + [position]


def shred(array: pa.Array, path: str, record: np.ndarray | None = None, ordinals: list[np.ndarray] | None = None, leaf_depth: int | None = None) -> Iterator[Triples]:
    """All triples below ``array``. At ``leaf_depth`` repeated ancestors, a list is itself the value."""
    record = np.arange(len(array)) if record is None else record
    ordinals = ordinals or []
    if pa.types.is_list(array.type) or pa.types.is_large_list(array.type):
        if leaf_depth is not None and len(ordinals) >= leaf_depth:
            yield Triples(path, record, ordinals, array)
            return
        values, record, ordinals = _explode(array, record, ordinals)
        yield from shred(values, path, record, ordinals, leaf_depth)
    elif pa.types.is_struct(array.type):
        present = array.is_valid()
        for i, field in enumerate(array.type):
            child = pc.if_else(present, array.field(i), pa.scalar(None, field.type)) if array.null_count else array.field(i)
            yield from shred(child, f"{path}.{field.name}", record, ordinals, leaf_depth)
    else:
        yield Triples(path, record, ordinals, array)


def pivot(triples: Sequence[Triples], depth: int) -> tuple[np.ndarray, list[np.ndarray], dict[str, pa.Array]]:
    """Triples that share ``depth`` repeated ancestors as one table: records, ordinals and one value column per path.

    A position that occurs under any of the paths is a row; a path without a value there is null.
    """
    keys = [np.stack([t.record, *t.ordinals[:depth]], axis=1).astype(np.int64) for t in triples]
    both = np.concatenate(keys) if keys else np.zeros((0, depth + 1), np.int64)
    rows, where = np.unique(both, axis=0, return_inverse=True)
    where, columns, begin = where.reshape(-1), {}, 0
    for t, k in zip(triples, keys):
        take = np.full(len(rows), -1, np.int64)
        take[where[begin : begin + len(k)]] = np.arange(len(k))
        begin += len(k)
        columns[t.path] = t.values.take(pa.array(take, pa.int64(), mask=take < 0))
    return rows[:, 0], [rows[:, 1 + i] for i in range(depth)], columns


def has_value(values: pa.Array) -> np.ndarray:
    """Whether each value counts: not null and, for lists, with at least one element that is not null."""
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        found = np.zeros(len(values), bool)
        flat, at, _ = _explode(values, np.arange(len(values)), [])
        found[at[flat.is_valid().to_numpy(zero_copy_only=False)]] = True
        return found
    return values.is_valid().to_numpy(zero_copy_only=False)


def _free(name: str, taken: set[str]) -> str:
    """The name, or the name with a number that no other column has (whatever the case)."""
    own, n = name, 2
    while own.lower() in taken:
        own, n = f"{name}_{n}", n + 1
    taken.add(own.lower())
    return own


def _leaf_fields(kind: T.DataType, name: str) -> list[tuple[str, T.DataType]]:
    """Columns of a value: the fields of a struct, however deep, or the value itself."""
    if isinstance(kind, T.StructType):
        return [x for f in kind for x in _leaf_fields(f.dataType, f"{name}_{f.name}")]
    return [(name, kind)]


def _flatten(df: DataFrame, key: Sequence[str], columns: dict[str, tuple[Column, T.DataType]], depth: int, ordinal_names: Sequence[str], flags: bool) -> DataFrame:
    names = list(columns)
    # key and ordinals may have the names of paths; renamed by position
    source = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], *[c.alias(f"p{i}") for i, (c, _) in enumerate(columns.values())])
    taken = {k.lower() for k in (*key, *ordinal_names)}
    fields = [T.StructField(k, df.schema[k].dataType) for k in key] + [T.StructField(o, T.LongType()) for o in ordinal_names]
    widths = []
    for p, (_, kind) in columns.items():
        for _ in range(depth):
            if not isinstance(kind, T.ArrayType):
                raise ValueError(f"{p} has fewer than {depth} array levels")
            kind = kind.elementType
        own = _leaf_fields(kind, p)
        widths.append(len(own))
        fields += [T.StructField(_free(n, taken), t) for n, t in own]
        if flags:
            fields.append(T.StructField(_free(f"has_{p}", taken), T.BooleanType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            triples, of = [], []
            for i in range(len(names)):
                array = batch.column(len(key) + i)
                array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
                own = [Triples(f"{i}:{j}", t.record, t.ordinals, t.values) for j, t in enumerate(shred(array, str(i), leaf_depth=depth))]
                triples += own
                of.append([t.path for t in own])
            record, ordinals, values = pivot(triples, depth)
            if not len(record):
                continue
            arrays = [batch.column(i).take(pa.array(record)) for i in range(len(key))] + [pa.array(o, pa.int64()) for o in ordinals]
            for paths, width in zip(of, widths):
                if len(paths) != width:
                    raise ValueError(f"{len(paths)} paths where the schema has {width}")
                arrays += [values[p] for p in paths]
                if flags:
                    arrays.append(pa.array(np.logical_or.reduce([has_value(values[p]) for p in paths])))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return source.mapInArrow(run, schema)


def flatten(df: DataFrame, key: Sequence[str], paths: Sequence[str], depth: int, ordinal_names: Sequence[str]) -> DataFrame:
    """The flat table of the group that ``paths`` (array columns with at least ``depth`` levels) form at ``depth``.

    Columns: the key columns, one bigint per ordinal, then per path its value and ``has_<path>``. Objects give a column for
    each of their fields (``<path>_<field>``), and count as a value if one of them has one; lists below ``depth`` are values.
    Records without any position give no row (their parents are in the record's own table). Null keys stay null, extra
    columns are ignored, repeated records give repeated rows; a name that is taken gets a number.
    """
    return _flatten(df, key, {p: (F.col(p), df.schema[p].dataType) for p in paths}, depth, ordinal_names, True)


@dataclass(frozen=True)
class Aligned:
    """Array columns whose positions correspond: their paths and, for each level, the name of its table and of its ordinal."""

    paths: Sequence[str]
    tables: Sequence[str]
    ordinals: Sequence[str]


def values_of(path: str) -> Column:
    """A path as nested arrays: ``a[].b`` is the array of the b of each a."""
    steps = path.split(".")

    def down(value: Column, rest: list[str]) -> Column:
        if not rest:
            return value
        name, levels = rest[0].rstrip("[]"), rest[0].count("[]")
        own = value[name] if value is not None else F.col(f"`{name}`")
        return each(own, levels, rest[1:])

    def each(value: Column, levels: int, rest: list[str]) -> Column:
        if not levels or not rest:
            return down(value, rest)
        return F.transform(value, lambda x: each(x, levels - 1, rest))

    return down(None, steps)


def _paths(kind: T.DataType, path: str, depth: int, out: dict[tuple[str, int], list]) -> None:
    """Groups of a schema: (repeated ancestor, depth) -> (column name, path, type, whether it counts a list's elements)."""
    if isinstance(kind, T.StructType):
        for f in kind:
            _paths(f.dataType, f"{path}.{f.name}" if path else f.name, depth, out)
        return
    ancestor = path[: path.rindex("[]") + 2] if "[]" in path else ""
    rest = path[len(ancestor) :].lstrip(".").replace(".", "_")
    group = out.setdefault((ancestor, depth), [])
    if isinstance(kind, T.ArrayType):
        group.append((rest, path, kind, True))
        _paths(kind.elementType, f"{path}[]", depth + 1, out)
    else:
        group.append((rest, path, kind, False))


def related(df: DataFrame, key: Sequence[str], aligned: Sequence[Aligned] = (), root: str = "records") -> dict[str, DataFrame]:
    """All flat tables of a nested table, as its schema groups them: name -> table.

    The root table has one row per record: the key, all fields outside arrays, and ``n_<array>``, the length of each array
    (null where it is missing). Each repeated ancestor gives a table named by its path (``boxes``, ``boxes.box``): the key, one
    ordinal per level (``no_1`` .. or the names of ``aligned``), the fields below it outside further arrays, the lengths of
    those, or ``value`` for arrays of plain values. A position that is there but null gives a row of nulls. Aligned arrays
    share one table for each level, with a row for each position that any of them has. Tables are read independently; each
    reads the columns that it needs and shuffles nothing. Repeated records give repeated rows.
    """
    groups: dict[tuple[str, int], list] = {}
    _paths(T.StructType([f for f in df.schema if f.name not in key]), "", 0, groups)
    own = {p: a for a in aligned for p in a.paths}
    merged: dict[str, tuple[int, Sequence[str], list]] = {}
    for (ancestor, depth), members in groups.items():
        top = ancestor.partition("[")[0]
        a = own.get(top)
        if a and depth <= len(a.tables):
            name, ordinals = a.tables[depth - 1], a.ordinals[:depth]
            label = lambda rest, top=top: f"{top}_{rest}" if rest else top
        else:
            name, ordinals = ancestor.replace("[]", "") + "[]" * max(0, ancestor.count("[]") - 1 - ancestor.count("[].")) if ancestor else root, [f"no_{i + 1}" for i in range(depth)]
            label = lambda rest: rest or "value"
        at = merged.setdefault(name, (depth, ordinals, []))
        at[2].extend((label(rest), path, kind, counts) for rest, path, kind, counts in members)
    out = {}
    for name, (depth, ordinals, members) in merged.items():
        columns: dict[str, tuple[Column, T.DataType]] = {}
        taken = {k.lower() for k in (*key, *ordinals)}
        for label, path, kind, counts in members:
            if counts:
                label, value, leaf = f"n_{label}", lambda c: F.when(c.isNotNull(), F.size(c)), T.IntegerType()
            else:
                value, leaf = (lambda c: c), kind
            nested = values_of(path)
            for _ in range(depth):
                leaf = T.ArrayType(leaf)
            columns[_free(label, taken)] = (_each(nested, depth, value) if counts else nested, leaf)
        if depth == 0:
            out[name] = df.select(*key, *[c.alias(n) for n, (c, _) in columns.items()])
        else:
            out[name] = _flatten(df, key, columns, depth, ordinals, False)
    return out


def _each(value: Column, depth: int, fn) -> Column:
    return fn(value) if depth == 0 else F.transform(value, lambda x: _each(x, depth - 1, fn))


def unequal_positions(flat: DataFrame, key: Sequence[str], paths: Sequence[str]) -> DataFrame:
    """Positions at which some path has a value and some has none, each once."""
    flags = [F.col(f"has_{p}") for p in paths]
    some, every = flags[0], flags[0]
    for f in flags[1:]:
        some, every = some | f, every & f
    return flat.filter(some & ~every).select(*key).distinct()
