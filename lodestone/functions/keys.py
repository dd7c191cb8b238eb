"""Recursive key clean-up of nested values.

Every character outside ``[a-zA-Z0-9_]`` becomes ``_`` and a key that then
starts with a digit gets a ``_`` prefix. Objects and arrays are walked,
scalars are left alone. When two keys of one object collide after the
clean-up, the later value wins and the earlier position is kept (the
behaviour of assigning into an ordered dict).

Struct columns are renamed from the schema on the driver (metadata only);
map columns are rewritten with higher-order functions on the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

# The allowed key characters and the digit-start rule.
_BAD_CHARS = r"[^a-zA-Z0-9_]"
_DIGIT_START = r"^[0-9]"


def sanitize_name(name: str) -> str:
    """Driver-side clean-up of one field name (used for struct schemas)."""
    new = re.sub(_BAD_CHARS, "_", name)
    return "_" + new if re.match(_DIGIT_START, new) else new


def sanitize_key(k: Column) -> Column:
    """Executor-side clean-up of one key column (used for map keys); the
    inner replacement is referenced once, so it is evaluated once."""
    return F.regexp_replace(F.regexp_replace(k, _BAD_CHARS, "_"), "^([0-9])", "_$1")


def _needs_work(dt: DataType) -> bool:
    if isinstance(dt, StructType):
        return True
    if isinstance(dt, ArrayType):
        return _needs_work(dt.elementType)
    if isinstance(dt, MapType):
        return isinstance(dt.keyType, StringType) or _needs_work(dt.valueType)
    return False


def _struct_plan(dt: StructType) -> list[tuple[str, StructField]]:
    """(new name, source field) per output field: first position, last value."""
    order: list[str] = []
    last: dict[str, StructField] = {}
    for f in dt.fields:
        new = sanitize_name(f.name)
        if new not in last:
            order.append(new)
        last[new] = f
    return [(n, last[n]) for n in order]


def sanitized_type(dt: DataType) -> DataType:
    if isinstance(dt, StructType):
        return StructType([StructField(n, sanitized_type(f.dataType), True) for n, f in _struct_plan(dt)])
    if isinstance(dt, ArrayType):
        return ArrayType(sanitized_type(dt.elementType), True)
    if isinstance(dt, MapType):
        return MapType(dt.keyType, sanitized_type(dt.valueType), True)
    return dt


def sanitize_column(c: Column, dt: DataType) -> Column:
    """Rewrite value ``c`` of type ``dt`` with cleaned keys at every depth."""
    if not _needs_work(dt):
        return c
    if isinstance(dt, StructType):
        fields = [sanitize_column(c.getField(f.name), f.dataType).alias(n) for n, f in _struct_plan(dt)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dt, ArrayType):
        return F.transform(c, lambda e: sanitize_column(e, dt.elementType))
    # map: clean keys; array_distinct keeps first positions, and the value of
    # each distinct key is taken from its last occurrence.
    keys = F.map_keys(c)
    if isinstance(dt.keyType, StringType):
        keys = F.transform(keys, sanitize_key)
    vals = F.map_values(c)
    if _needs_work(dt.valueType):
        vals = F.transform(vals, lambda v: sanitize_column(v, dt.valueType))
    return F.when(c.isNotNull(), _merge_last(keys, vals))


def _merge_last(keys: Column, vals: Column) -> Column:
    """Map from parallel key/value arrays: first position, last value per key."""
    distinct = F.array_distinct(keys)
    last = F.transform(distinct, lambda k: F.element_at(
        vals, (F.size(keys) - F.array_position(F.reverse(keys), k) + 1).cast("int")))
    return F.map_from_arrays(distinct, last)


def _each(values: Column, dt: DataType) -> Column:
    """The cleaned elements of an array of ``dt`` (a lambda of two parameters would be given the index)."""
    return F.transform(values, lambda v: sanitize_column(v, dt))


def sanitize_keys(df, *columns: str):
    """Apply the clean-up to the named nested columns of ``df`` (all by default).

    Top-level maps are done in two projections: the cleaned key array is
    computed once per row, then merged (inline, a higher-order function would
    re-evaluate it for every distinct key)."""
    targets = set(columns) if columns else {f.name for f in df.schema.fields}
    staged, final = [], []
    for f in df.schema.fields:
        dt = f.dataType
        if f.name in targets and isinstance(dt, MapType) and isinstance(dt.keyType, StringType):
            vals = F.map_values(f.name)
            if _needs_work(dt.valueType):
                vals = _each(vals, dt.valueType)
            staged += [F.col(f.name), F.transform(F.map_keys(f.name), sanitize_key).alias(f"__k_{f.name}"),
                       vals.alias(f"__v_{f.name}")]
            final.append(F.when(F.col(f.name).isNotNull(),
                                _merge_last(F.col(f"__k_{f.name}"), F.col(f"__v_{f.name}"))).alias(f.name))
        elif f.name in targets:
            staged.append(F.col(f.name))
            final.append(sanitize_column(F.col(f.name), dt).alias(f.name))
        else:
            staged.append(F.col(f.name))
            final.append(F.col(f.name))
    return df.select(*staged).select(*final)


# --------------------------------------------------------------------------
# JSON text of any shape. Nothing is declared: objects and arrays may nest as
# deep as they like and differ from row to row.

_QUOTE, _BACKSLASH = "\x02", "\x01"  # JSON text holds no raw control characters


def _clean_json_key(k: Column) -> Column:
    """One key as it stands between its quotes in canonical JSON: an escape is one character."""
    return F.regexp_replace(F.regexp_replace(k, r"\\u[0-9a-fA-F]{4}|\\.|[^a-zA-Z0-9_]", "_"), "^([0-9])", "_$1")


def sanitize_json(df, column: str):
    """Clean the keys of a JSON text column at every depth (null where the
    text is not JSON). The text is parsed as VARIANT, which also decides between keys that are, or
    become, equal: the last one wins. Keys come out in order.

    Between the two parses the canonical text is split at its quotes, which
    puts strings at the odd places of an array; those that a colon follows are
    keys. So the work is linear in the text and no depth needs a plan node of
    its own. Numbers keep their value up to 38 digits. The JSON parser takes names
    of up to 50,000 characters and a thousand levels; other texts count as not JSON.

    Sets ``spark.sql.variant.allowDuplicateKeys`` for the session: without it
    the parser refuses documents with equal keys."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    hidden = F.replace(F.replace(F.to_json(F.try_parse_json(F.col(column))), F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    parts = F.split(hidden, '"', -1)

    def piece(x: Column, i: Column) -> Column:
        is_key = (i % 2 == 1) & F.get(F.col("__parts"), i + 1).startswith(":")
        return F.when(is_key, _clean_json_key(x)).otherwise(x)
    joined = F.array_join(F.transform("__parts", piece), '"')
    shown = F.replace(F.replace(joined, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return df.withColumn("__parts", parts).withColumn(column, F.to_json(F.try_parse_json(shown))).drop("__parts")
