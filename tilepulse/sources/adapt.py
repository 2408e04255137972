"""Old or drifted sources read as the registry's tables.

``conform`` maps a DataFrame to a schema of the registry by name, by declared aliases, and by casts
that lose nothing: integers to wider ones or to text, dates to timestamps, timestamps with and
without a zone into each other, and text or 0/1 to flags and text to timestamps where every value
has one reading. A value that has none fails the query that reads it, so nothing is published from
it. Optional columns may be absent (null); a required one may not, and a change of type outside
these fails at once. The report says what was done to each column.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import REQUIRED, SchemaDriftError
from . import schemas as S

log = logging.getLogger(__name__)

#: Source -> its schema in the registry.
SCHEMAS = {"tile_events": S.TILE_EVENTS, "interstitial_events": S.INTERSTITIAL_EVENTS, "tile_metadata": S.TILE_METADATA}
#: Spellings of a flag, lower-case.
TRUE_TEXT, FALSE_TEXT = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")

_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_TIMES = ("timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class Mapped:
    """What was done for one column: ``same``, ``renamed``, ``cast``, ``renamed and cast``, ``absent``
    (null) or ``dropped``."""

    column: str
    action: str
    found: str | None = None
    was: str | None = None
    now: str | None = None


def _or_fail(value: Column, raw: Column, what: str) -> Column:
    """``value``, or an error where a non-null ``raw`` has no value."""
    message = F.concat(F.lit(f"{what}: no reading of "), raw.cast("string"))
    return F.when(value.isNotNull() | raw.isNull(), value).otherwise(F.raise_error(message))


def safe_cast(col: Column, was: str, now: str, what: str) -> Column | None:
    """The column as type ``now`` where that loses nothing, else None. Types by simple name."""
    if was == now:
        return col
    if was in _INTEGERS:
        if now == "string" or (now in _INTEGERS and _INTEGERS.index(now) > _INTEGERS.index(was)):
            return col.cast(now)
        if now == "boolean":
            return _or_fail(F.when(col == 1, True).when(col == 0, False), col, what)
    if was == "date" and now in _TIMES or was in _TIMES and now in _TIMES:
        return col.cast(now)
    if was in ("float", "double") and now == "double":
        return col.cast(now)
    if was == "string" and now == "boolean":
        text = F.lower(F.trim(col))
        return _or_fail(F.when(text.isin(*TRUE_TEXT), True).when(text.isin(*FALSE_TEXT), False), col, what)
    if was == "string" and now in _TIMES:
        return _or_fail(F.expr(f"try_cast({_name(what)} AS {now})"), col, what)
    if was == "boolean" and now == "string":
        return None  # which spelling is not known
    return None


def _name(what: str) -> str:
    return "`" + what.split(".", 1)[-1].replace("`", "``") + "`"


def conform(
    df: DataFrame,
    source: str,
    aliases: Mapping[str, str] | None = None,
    required: Sequence[str] | None = None,
    keep: Sequence[str] = (S.EVENT_DATE,),
) -> tuple[DataFrame, list[Mapped]]:
    """``df`` with the columns, names and types of the registry's ``source``, and the report.

    ``aliases``: other name -> registry name. A column under its own name goes before an alias; two
    aliases of one column in a table are refused. ``keep``: further columns that stay as they are
    where they exist. Everything is an expression over the columns found: no action runs here.
    """
    schema = SCHEMAS[source]
    need = set(REQUIRED[source] if required is None else required)
    have = {f.name.lower(): f for f in df.schema.fields}
    by_alias: dict[str, list[T.StructField]] = {}
    for other, name in (aliases or {}).items():
        if name.lower() not in {f.name for f in schema.fields}:
            raise ValueError(f"{source} has no column {name} for the alias {other}")
        if other.lower() in have:
            by_alias.setdefault(name.lower(), []).append(have[other.lower()])
    columns, report, used, faults = [], [], set(), []
    for want in schema.fields:
        found = have.get(want.name)
        others = by_alias.get(want.name, [])
        if found is None and len(others) > 1:
            faults.append(f"{want.name}: several aliases {[f.name for f in others]}")
            continue
        field = found or (others[0] if others else None)
        now = want.dataType.simpleString()
        if field is None:
            if want.name in need:
                faults.append(f"required column missing: {want.name}")
            columns.append(F.lit(None).cast(want.dataType).alias(want.name))
            report.append(Mapped(want.name, "absent", now=now))
            continue
        was = field.dataType.simpleString()
        cast = safe_cast(F.col(f"`{field.name}`"), was, now, f"{source}.{field.name}")
        if cast is None:
            faults.append(f"{want.name}: {was} does not become {now} without loss")
            continue
        used.add(field.name)
        done = [w for w, is_so in (("renamed", field.name.lower() != want.name), ("cast", was != now)) if is_so]
        columns.append(cast.alias(want.name))
        report.append(Mapped(want.name, " and ".join(done) or "same", field.name, was, now))
    if faults:
        raise SchemaDriftError(f"{source}: {'; '.join(faults)}")
    kept = [f.name for f in df.schema.fields if f.name.lower() in keep and f.name not in used]
    report += [Mapped(f.name, "dropped", f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in used | set(kept)]
    for m in report:
        if m.action != "same":
            log.info("%s.%s: %s (%s %s -> %s)", source, m.column, m.action, m.found, m.was, m.now)
    return df.select(*columns, *kept), report
