"""Columns of arrays of structs for Arrow UDFs, built column by column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


@dataclass(frozen=True)
class Structs:
    """An array of structs with these (name, SQL type) fields."""

    fields: tuple[tuple[str, str], ...]

    @property
    def sql(self) -> str:
        return f"array<struct<{', '.join(f'{name}: {kind}' for name, kind in self.fields)}>>"

    def array(self, rows: list[list[tuple]]) -> pa.Array:
        """One array a row, one tuple a struct."""
        flat = [x for row in rows for x in row]
        columns = [pa.array([x[i] for x in flat], type=_ARROW[kind]) for i, (_, kind) in enumerate(self.fields)]
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=[name for name, _ in self.fields]))
