"""In-memory sources (A4, A5): rows typed by the registry schema.

Rows may be tuples in schema order, dicts or ``Row`` objects. The schema is always passed to
``createDataFrame``, so an empty list still yields a typed, empty DataFrame (schema inference
cannot work on no rows), and string timestamps are parsed rather than inferred as strings.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from . import schemas as S

SOURCES = {
    "tile_events": S.TILE_EVENTS,
    "interstitial_events": S.INTERSTITIAL_EVENTS,
    "tile_metadata": S.TILE_METADATA,
}


def _coerce(value, dtype: T.DataType):
    if isinstance(value, str) and isinstance(dtype, T.TimestampType):
        return dt.datetime.fromisoformat(value)
    return value


def from_rows(spark: SparkSession, rows: Iterable, source: str | T.StructType) -> DataFrame:
    """A DataFrame of ``rows`` with the schema of a registry source (or an explicit schema).

    Missing fields of dict / Row inputs become null; unknown fields are refused.
    """
    schema = SOURCES[source] if isinstance(source, str) else source
    names = schema.fieldNames()
    out = []
    for r in rows:
        if isinstance(r, Row):
            r = r.asDict()
        if isinstance(r, Mapping):
            unknown = set(r) - set(names)
            if unknown:
                raise ValueError(f"fields not in the schema: {sorted(unknown)}")
            r = tuple(r.get(n) for n in names)
        out.append(tuple(_coerce(v, f.dataType) for v, f in zip(r, schema.fields)))
    return spark.createDataFrame(out, schema)
