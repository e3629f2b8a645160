"""Normalise nested records into flat relational tables.

* nested structs become columns ``parent__child`` at any depth;
* each array becomes a child table ``<table>__<array>`` holding the element
  fields plus ``_parent_id`` (the parent's key) and ``_list_idx`` (0-based
  position); empty or NULL lists add no child rows;
* names are snake-cased.

All of it is column expressions plus ``posexplode`` over each row's own
list: no grouping, no shuffle, work stays with the partition that read it.
Records without a key of their own are written once, and named by the file and
the row where they lie, which tells identical records apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from faresight.functions.columns import snake_case
from faresight.session import scratch_path

PARENT_ID = "_parent_id"
LIST_IDX = "_list_idx"
RECORD_ID = "_record_id"


def _flatten_fields(schema: StructType, prefix: Column | None, name_prefix: str):
    cols, arrays = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if prefix is None else prefix.getField(f.name)
        name = f"{name_prefix}{snake_case(f.name)}"
        if isinstance(f.dataType, StructType):
            sub_cols, sub_arrays = _flatten_fields(f.dataType, c, f"{name}__")
            cols += sub_cols
            arrays += sub_arrays
        elif isinstance(f.dataType, ArrayType):
            arrays.append((name, c, f.dataType.elementType))
        else:
            cols.append(c.alias(name))
    return cols, arrays


def flatten(df: DataFrame) -> DataFrame:
    """Flatten nested structs to ``a__b`` columns; arrays are left out."""
    cols, _ = _flatten_fields(df.schema, None, "")
    return df.select(*cols)


def record_key(df: DataFrame, key: str | None = None) -> Column:
    """The parent key: an existing column, else an MD5 of the whole row as JSON."""
    if key is not None:
        return F.col(key).cast("string")
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def with_place(df: DataFrame) -> DataFrame:
    """``df`` written under the scratch path and read back with ``_record_id``: an MD5 of each row's file and place in it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "records")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.withColumn(RECORD_ID, F.md5(F.concat_ws("-", "_metadata.file_name", "_metadata.row_index")))


def normalise(df: DataFrame, table: str, key: str | None = None) -> dict[str, DataFrame]:
    """Return ``{table: flat_parent, f"{table}__{list}": child, ...}``.

    ``key`` names the column identifying a record (e.g. ``record_hash``);
    without it a record is named by its place (see :func:`with_place`), so
    identical records keep ids of their own.  Nested lists inside list
    elements, and lists of lists, become grandchild tables keyed by the child's
    own ``_record_id`` (its parent and place in the list tell it apart).
    """
    if key is None and PARENT_ID not in df.columns:
        keyed = with_place(df)
    else:
        keyed = df.withColumn(RECORD_ID, record_key(df, key))
    cols, arrays = _flatten_fields(keyed.schema, None, "")
    out = {table: keyed.select(*cols)}
    for name, col, elem in arrays:
        exploded = keyed.select(F.col(RECORD_ID).alias(PARENT_ID),
                                F.posexplode(col).alias(LIST_IDX, "_elem"))
        child = f"{table}__{name}"
        if isinstance(elem, StructType):
            flat = exploded.select(PARENT_ID, LIST_IDX, "_elem.*")
            inner = normalise(flat, child, key=None)
            # keep the link columns first for readability
            out.update(inner)
        elif isinstance(elem, ArrayType):
            out.update(normalise(exploded.select(PARENT_ID, LIST_IDX, F.col("_elem").alias("value")), child))
        else:
            out[child] = exploded.select(PARENT_ID, LIST_IDX, F.col("_elem").alias("value"))
    return out


def unwrap(df: DataFrame, list_col: str) -> DataFrame:
    """Rows of the array under one key (``data["products"]``), one per element."""
    return df.select(F.explode(F.col(list_col)).alias("_item")).select("_item.*")
