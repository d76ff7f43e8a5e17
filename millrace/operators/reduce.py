"""A user's own aggregates and reducers: partial results in the map task, groups read as pages after the shuffle.

Groups reach the function as iterators of pages, so a group of any size passes through a task as a stream; what the
function itself keeps is its own affair.  Built-in aggregates combine better and stay in the JVM: these are for functions
that they cannot express.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregates import combine_runs
from millrace.session import ship_with_tasks

ship_with_tasks(__name__)

PAGE_ROWS = 10_000

Frames = Iterator[pd.DataFrame]
# A function may also yield a row of the result as a tuple, which costs far less than a frame of one row.
Results = Iterator[pd.DataFrame | tuple]


def aggregate(
    df: DataFrame, key: str, state: str, schema: str, partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame], finish: Callable[[pd.DataFrame], pd.DataFrame], held_keys: int = 100_000,
) -> DataFrame:
    """A two-phase aggregate.  ``partial`` makes rows of ``state`` (with the key) of a batch of input rows, ``merge`` unites
    such rows to one per key, ``finish`` makes result rows of them.

    Each map task merges what it has and sends about one row per key; a hot key sends one per task.  How often
    ``merge`` runs, and over which rows, must not matter.
    """
    def each(function: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Frames], Frames]:
        return lambda batches: (function(batch) for batch in batches if len(batch))

    states = df.mapInPandas(each(partial), state)
    return combine_runs(states, key, state, merge, held_keys).mapInPandas(each(finish), schema)


class _Rows:
    """Rows of an Arrow batch as pandas frames: turned to pandas once, not for each page."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.combine_chunks()
        kinds = [(i, f, f.type) for i, f in enumerate(self.rows.schema)]
        # Pandas turns integers to floats and booleans to objects among nulls: a page with such nulls is turned by itself.
        holes = [(i, f) for i, f, t in kinds if (pa.types.is_integer(t) or pa.types.is_boolean(t)) and self.rows[i].null_count]
        # So are nested values, whose type may depend on the others of the batch.
        self.nested = any(pa.types.is_nested(t) for _, _, t in kinds)
        self.missing = None
        if self.nested:
            return
        filled = self.rows
        if holes:
            absent = np.zeros(len(filled), dtype=bool)
            for i, field in holes:
                absent |= filled[i].is_null().to_numpy()
                filled = filled.set_column(i, field, filled[i].fill_null(pa.scalar(0).cast(field.type)))
            self.missing = np.append(0, np.cumsum(absent))
        self.frame = filled.to_pandas()

    def page(self, start: int, stop: int) -> pd.DataFrame:
        if self.nested or (self.missing is not None and self.missing[stop] > self.missing[start]):
            return self.rows.slice(start, stop - start).to_pandas()
        page = self.frame.iloc[start:stop].copy()
        page.index = pd.RangeIndex(stop - start)
        return page


class _Groups:
    """Groups of sorted Arrow batches, read one after another; a page ends where its batch, group or side ends.

    ``columns`` has for each side the names of its columns in the batches and in its frames.  With two sides the last key tells them apart.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch], keys: list[str], page_rows: int, columns: list[dict[str, str]]):
        self.batches, self.keys, self.page_rows, self.columns = iter(batches), keys, page_rows, columns
        self._load()

    def _load(self) -> None:
        """The next batch that has rows: where its runs of equal keys begin and end, their keys, and the rows of each side."""
        self.run, self.heads = 0, []
        for batch in self.batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                fresh = np.zeros(batch.num_rows, dtype=bool)
                for key in self.keys:
                    fresh[1:] |= _changes(rows[key].combine_chunks())
                fresh[0] = True
                starts = np.flatnonzero(fresh)
                self.bounds = [*starts.tolist(), batch.num_rows]
                self.heads = list(zip(*[rows[key].take(pa.array(starts)).to_pylist() for key in self.keys], strict=True))
                self.sides = []
                for side, names in enumerate(self.columns):
                    mine = rows[self.keys[-1]].to_numpy() == side if len(self.columns) > 1 else np.ones(batch.num_rows, dtype=bool)
                    part = rows.filter(pa.array(mine)) if len(self.columns) > 1 else rows
                    self.sides.append((np.append(0, np.cumsum(mine)), _Rows(part.select(list(names)).rename_columns(list(names.values())))))
                return

    def ended(self) -> bool:
        return not self.heads

    def head(self) -> tuple:
        return self.heads[self.run]

    def pages(self, key: tuple) -> Iterator[Callable[[], pd.DataFrame]]:
        """The rows up to the next key, each page as a function that makes its frame."""
        while self.heads and _equal(self.head(), key):
            before, rows = self.sides[key[-1] if len(self.columns) > 1 else 0]
            start, stop = int(before[self.bounds[self.run]]), int(before[self.bounds[self.run + 1]])
            for at in range(start, stop, self.page_rows):
                yield functools.partial(rows.page, at, min(at + self.page_rows, stop))
            self.run += 1
            if self.run < len(self.heads):
                return
            self._load()


def _changes(column: pa.Array) -> np.ndarray:
    """For each row but the first, whether its key is not that of the row before; nulls are equal, and so are NaNs and zeros."""
    if pa.types.is_floating(column.type):
        column = pc.add(column, pa.scalar(0.0, column.type))
    try:
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy()
    except (pa.ArrowNotImplementedError, pa.ArrowInvalid):
        values = column.to_pylist()
        return np.array([not _equal((x,), (y,)) for x, y in zip(values[1:], values, strict=False)], dtype=bool)
    return codes[1:] != codes[:-1]


def _equal(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


def reduce_groups(
    df: DataFrame, keys: list[str], order: list[str | Column], schema: str, function: Callable[[tuple, Frames], Results],
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """``function(key, pages)`` for each group: its rows come in ``order``, in pages of at most ``page_rows``.

    Pages the function does not read are passed over.  Null keys form a group.  The function yields frames, or rows as tuples.
    """
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(batches, keys, page_rows, [{c: c for c in columns}])
        out = _Out(target)
        while not groups.ended():
            key = groups.head()
            pages = groups.pages(key)
            yield from out.add(function(key, (page() for page in pages)))
            for _ in pages:
                pass
        yield from out.rest()

    target = _arrow(schema)
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.select(*columns).mapInArrow(run, schema)


def reduce_pairs(
    left: DataFrame, right: DataFrame, keys: list[str], schema: str, function: Callable[[tuple, Frames, Frames], Results],
    order: tuple[list[str], list[str]] = ((), ()), page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """``function(key, left pages, right pages)`` for each key of either input, like a co-group that is never held whole.

    Both sides travel in one shuffle, the left rows of a key before its right ones: a function reads the left pages
    first; once it reads the right ones, left pages it has not read are passed over.  A side without rows has no pages.
    """
    names = [("l", c) for c in left.columns if c not in keys] + [("r", c) for c in right.columns if c not in keys]
    frames = []
    for side, df, mine in ((0, left, "l"), (1, right, "r")):
        other = right if side == 0 else left
        values = [
            (F.col(c) if at == mine else F.lit(None).cast(other.schema[c].dataType)).alias(f"_{at}_{c}") for at, c in names
        ]
        ranks = [F.col(c) for c in order[side]]
        frames.append(df.select(*keys, F.lit(side).alias("_side"), *values, *[r.alias(f"_o{side}_{i}") for i, r in enumerate(ranks)]))
    both = frames[0].unionByName(frames[1], allowMissingColumns=True)
    ranks = [c for c in both.columns if c.startswith("_o")]
    columns = [keys + [c for c in df.columns if c not in keys] for df in (left, right)]

    sides = [{c: c if c in keys else f"_{'lr'[side]}_{c}" for c in columns[side]} for side in (0, 1)]
    sides = [{there: here for here, there in names.items()} for names in sides]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(batches, [*keys, "_side"], page_rows, sides)
        out = _Out(target)
        while not groups.ended():
            key = groups.head()[:-1]
            first, second = groups.pages((*key, 0)), groups.pages((*key, 1))

            def after(pages=second, before=first) -> Iterator[Callable[[], pd.DataFrame]]:
                for _ in before:
                    pass
                yield from pages

            rights = after()
            yield from out.add(function(key, (page() for page in first), (page() for page in rights)))
            for _ in rights:
                pass
        yield from out.rest()

    target = _arrow(schema)
    placed = both.repartition(*keys).sortWithinPartitions(*keys, "_side", *ranks).drop(*ranks)
    return placed.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = T._parse_datatype_string(schema)
    return to_arrow_schema(parsed)


class _Out:
    """What a function yields for its groups, frames or single rows, sent on as batches of many."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.kinds, self.held, self.rows = schema, None, [], 0

    def add(self, results: Iterator[pd.DataFrame | tuple]) -> Iterator[pa.RecordBatch]:
        for result in results:
            single = isinstance(result, tuple)
            if not single:
                if not len(result):
                    continue
                result = result[self.schema.names]
            # Frames of other types are not mixed, so that none changes its values.
            kinds = tuple if single else tuple(result.dtypes)
            if self.held and (kinds != self.kinds or self.rows >= PAGE_ROWS):
                yield from self.rest()
            self.held.append(result)
            self.kinds, self.rows = kinds, self.rows + (1 if single else len(result))

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        if self.kinds is tuple:
            columns = zip(*self.held, strict=True)
            table = pa.Table.from_arrays([pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        else:
            frame = self.held[0] if len(self.held) == 1 else pd.concat(self.held, ignore_index=True)
            table = pa.Table.from_pandas(frame, schema=self.schema, preserve_index=False)
        self.held, self.rows = [], 0
        yield from table.to_batches()
