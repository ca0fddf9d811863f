"""Whole-corpus JSON path/type profile, in one pass.

The reference walks the first document only; here every document is walked to
any depth. A task keeps a sketch of what it has seen, (path, type) -> (values,
least and greatest list length), whose size is that of the corpus' shape, not of
its rows; sketches add up, by one aggregation over them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = "path string, type string, n long, min_length int, max_length int"


#: Shapes of objects that a task remembers; beyond them it starts anew, which changes no result.
SHAPES = 20_000


class PathSketch:
    """(path, type) -> [values, least list length, greatest list length].

    Objects are counted by shape: the path they stand at, their keys and their values' types. What a shape adds is
    worked out when the shapes are summed up, so an object costs one look-up, whatever the number of its keys."""

    def __init__(self):
        self.seen: dict[tuple[str, str], list] = {}
        self.shapes: dict[tuple, list] = {}  # (path, keys, types) -> [objects, [(path, key) of nested values]]

    def add(self, path: str, kind: str, length: int | None = None, n: int = 1) -> None:
        got = self.seen.setdefault((path, kind), [0, length, length])
        got[0] += n
        if length is not None:
            got[1], got[2] = min(got[1], length), max(got[2], length)

    def sum_up(self) -> None:
        """Counts the values of the shapes seen since the last time; lists are counted as they are met."""
        for (path, keys, types), (n, _) in self.shapes.items():
            for k, t in zip(keys, types, strict=True):
                if (name := f"{path}.{k}" if path else k) and t is not list:
                    self.add(name, t.__name__, n=n)
        self.shapes.clear()

    def walk(self, document: object) -> None:
        """Objects add ".key", arrays add "[]"; the document itself has no path."""
        todo = [("", document)]  # no recursion: any depth
        while todo:
            path, value = todo.pop()
            if isinstance(value, list):
                if path:
                    self.add(path, "list", len(value))
                inner = f"{path}[]"
                for v in value:
                    if not isinstance(v, list):
                        self.add(inner, type(v).__name__)
                    if isinstance(v, (dict, list)):
                        todo.append((inner, v))
            elif isinstance(value, dict):
                types = tuple(map(type, value.values()))
                shape = (path, tuple(value), types)
                got = self.shapes.get(shape)
                if got is None:
                    if len(self.shapes) >= SHAPES:
                        self.sum_up()
                    nested = [(f"{path}.{k}" if path else k, k) for k, t in zip(value, types, strict=True) if t is dict or t is list]
                    got = self.shapes[shape] = [0, nested]
                got[0] += 1
                for name, k in got[1]:
                    todo.append((name, value[k]))

    def batch(self) -> pa.RecordBatch:
        self.sum_up()
        cols = zip(*[(p, k, *v) for (p, k), v in self.seen.items()], strict=True) if self.seen else [[]] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["path", "type", "n", "min_length", "max_length"])


def json_profile(df: DataFrame, col: str) -> DataFrame:
    """[path, type, n, min_length, max_length] over all documents in ``df[col]``
    (JSON text). Lengths are those of lists, NULL for other types; a text that
    is no JSON counts under the empty path as "malformed", a NULL as "missing"."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = PathSketch()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    found.add("", "missing")
                    continue
                try:
                    document = json.loads(text)
                except (ValueError, RecursionError):
                    found.add("", "malformed")
                    continue
                found.walk(document)
        yield found.batch()

    parts = df.select(F.col(col).cast("string")).mapInArrow(sketch, SKETCH)
    return parts.groupBy("path", "type").agg(F.sum("n").alias("n"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"))
