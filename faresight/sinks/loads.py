"""Replace / append / incremental loads with a load-state table.

The incremental load tracks a cursor column: the first run loads rows with
``cursor >= initial_value``; later runs load rows with ``cursor >= last``,
where ``last`` is the largest cursor that the resource has loaded so far, less
the rows that it already loaded at ``last`` (a multiset difference of whole
rows, against the loads that ended at this cursor only), so a row that turns up
later with the same cursor is not lost.  The state table has one row per load
``(load_id, resource, rows, cursor_value, loaded_at, target, disposition)``.

Several resources may share a target.  Its rows are partitioned by ``_load_id``
and incremental loads are numbered over the whole state table, so no load
touches another one's partition: a partition that no state row names is what a
run left that died before writing its state, and the next run replaces it.
One load at a time runs against a state table.

A replace load removes all earlier loads from the target.  A cursor counts only
while the load it comes from is still in the target, so after a replace (or a
dropped target) an incremental load starts at its initial value again.

Beside the state lies the target's schema history: a load with columns that
the target lacks adds a version, in which these are NULL for older rows; one
that lacks columns adds none; one that changes a column's type is refused
before anything is written, unless it replaces the target.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from faresight.session import delete_path, path_exists

LOAD_ID = "_load_id"
STATE_DDL = ("load_id string, resource string, rows bigint, cursor_value string, loaded_at timestamp_ntz, "
             "target string, disposition string")
SCHEMA_DDL = "target string, version int, schema string, load_id string"


def _new_load_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def partition_path(target_path: str, load_id: str) -> str:
    return f"{target_path.rstrip('/')}/{LOAD_ID}={load_id}"


def read_target(spark: SparkSession, target_path: str, schema: StructType) -> DataFrame:
    """A target's rows and load ids; ``schema`` is the rows' (an empty target has no files to tell it)."""
    return spark.read.schema(StructType([*schema.fields, StructField(LOAD_ID, StringType())])).parquet(target_path)


def incremental_rows(source: DataFrame, cursor_col: str, last_value=None, initial_value=None,
                     loaded: DataFrame | None = None) -> DataFrame:
    """Rows to load: from ``last_value`` on less those ``loaded`` at it, or else from ``initial_value`` on."""
    c, kind = F.col(cursor_col), source.schema[cursor_col].dataType
    if last_value is not None:
        last = F.lit(last_value).cast(kind)
        at_last = source.filter(c == last)
        if loaded is not None:
            at_last = at_last.exceptAll(loaded.filter(c == last).select(*source.columns))
        return source.filter((c > last) | c.isNull()).unionAll(at_last)
    if initial_value is not None:
        return source.filter((c >= F.lit(initial_value).cast(kind)) | c.isNull())
    return source


# -- schema versions -------------------------------------------------------------

def schema_history(spark: SparkSession, state_path: str) -> DataFrame:
    """``target, version, schema (JSON), load_id`` of every version beside a state table."""
    return spark.read.schema(SCHEMA_DDL).parquet(f"{state_path.rstrip('/')}_schema")


def target_schema(spark: SparkSession, state_path: str, target_path: str) -> tuple[int, StructType | None]:
    """The newest version of a target's schema: its number (0 if there is none) and the schema."""
    if not path_exists(spark, f"{state_path.rstrip('/')}_schema"):
        return 0, None
    found = (schema_history(spark, state_path).filter(F.col("target") == target_path)
             .orderBy(F.col("version").desc()).limit(1).collect())
    return (found[0]["version"], StructType.fromJson(json.loads(found[0]["schema"]))) if found else (0, None)


def evolve_schema(old: StructType | None, new: StructType) -> StructType:
    """``old`` with the columns that ``new`` adds; a changed type is an error."""
    fields = {f.name: f for f in old.fields} if old else {}
    for f in new.fields:
        had = fields.get(f.name)
        if had is not None and had.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {had.dataType.simpleString()} in the target and "
                             f"{f.dataType.simpleString()} in the load")
        fields.setdefault(f.name, StructField(f.name, f.dataType, True))
    return StructType(list(fields.values()))


def _agree(spark: SparkSession, state_path: str, target_path: str, schema: StructType, load_id: str, replace: bool) -> None:
    """Add a version if the load's columns ask for one."""
    version, had = target_schema(spark, state_path, target_path)
    agreed = evolve_schema(None if replace else had, schema)
    if had is None or agreed.jsonValue() != had.jsonValue():
        row = spark.createDataFrame([(target_path, version + 1, agreed.json(), load_id)], SCHEMA_DDL)
        row.write.mode("append").parquet(f"{state_path.rstrip('/')}_schema")


def read_loaded(spark: SparkSession, target_path: str, state_path: str) -> DataFrame:
    """A target's rows under the newest version of its schema; columns added later are NULL in older rows."""
    version, schema = target_schema(spark, state_path, target_path)
    if schema is None:
        raise ValueError(f"{target_path} has no schema beside {state_path}")
    return read_target(spark, target_path, schema)


# -- loads ------------------------------------------------------------------------

def _read_state(spark: SparkSession, state_path: str, resource: str, target_path: str) -> tuple[int, str | None, list[str]]:
    """Loads so far, the resource's cursor in this target, and the ids of its loads that ended at the cursor."""
    if not path_exists(spark, state_path):
        return 0, None, []
    state = load_state(spark, state_path)
    own = state.filter((F.col("resource") == resource) & (F.coalesce("target", F.lit(target_path)) == target_path)
                       & F.col("cursor_value").isNotNull())
    newest = own.orderBy(F.col("loaded_at").desc()).limit(1).collect()
    if not newest or not path_exists(spark, partition_path(target_path, newest[0]["load_id"])):
        return state.count(), None, []
    last = newest[0]["cursor_value"]
    at_last = own.filter((F.col("cursor_value") == last) & (F.col("rows") > 0)).select("load_id").collect()
    return state.count(), last, [r["load_id"] for r in at_last]


def load(spark: SparkSession, df: DataFrame, target_path: str, disposition: str = "replace",
         state_path: str | None = None, resource: str = "rows") -> dict:
    """``replace`` overwrites the target (whatever the session's partition
    overwrite mode), ``append`` adds to it."""
    load_id = _new_load_id()
    mode = {"replace": "overwrite", "append": "append"}[disposition]
    if state_path:
        _agree(spark, state_path, target_path, df.schema, load_id, disposition == "replace")
    (df.withColumn(LOAD_ID, F.lit(load_id)).write.mode(mode).option("partitionOverwriteMode", "static")
       .partitionBy(LOAD_ID).parquet(target_path))
    rows = read_target(spark, target_path, df.schema).filter(F.col(LOAD_ID) == load_id).count()
    info = {"load_id": load_id, "resource": resource, "rows": rows, "cursor_value": None}
    if state_path:
        _append_state(spark, state_path, info, target_path, disposition)
    return info


def load_incremental(spark: SparkSession, source: DataFrame, target_path: str, state_path: str,
                     resource: str, cursor_col: str, initial_value=None, null_cursor: str = "error") -> dict:
    """One incremental run; it may find nothing to load.

    A row without a cursor can be neither placed before nor after the last
    load: it is an error (what the run wrote is removed), or left out with
    ``null_cursor="skip"``.  The rows are read once beyond the cursor and once
    at it.
    """
    if null_cursor not in ("error", "skip"):
        raise ValueError(f"null_cursor must be 'error' or 'skip', not {null_cursor!r}")
    before, last, at_last = _read_state(spark, state_path, resource, target_path)
    load_id = f"{before + 1:08d}"
    part = partition_path(target_path, load_id)
    _agree(spark, state_path, target_path, source.schema, load_id, False)
    loaded = None
    if at_last:
        loaded = spark.read.schema(source.schema).parquet(*[partition_path(target_path, i) for i in at_last])
    rows = incremental_rows(source, cursor_col, last, initial_value if last is None else None, loaded)
    seen = Observation()
    rows = rows.observe(seen, F.count_if(F.col(cursor_col).isNull()).alias("without"))
    rows.filter(F.col(cursor_col).isNotNull()).write.mode("overwrite").parquet(part)  # also over a died run's
    if null_cursor == "error" and seen.get["without"]:
        delete_path(spark, part)
        raise ValueError(f"{seen.get['without']} rows with a NULL {cursor_col} cannot be loaded incrementally")
    info = _told(spark, part, source.schema, load_id, resource, cursor_col, last)
    _append_state(spark, state_path, info, target_path, "incremental")
    return info


def _told(spark: SparkSession, part: str, schema: StructType, load_id: str, resource: str, cursor_col: str | None, last) -> dict:
    """What a written partition holds, as a state row."""
    written = spark.read.schema(schema).parquet(part)
    top = F.max(cursor_col).cast("string") if cursor_col else F.lit(None).cast("string")
    s = written.agg(F.count(F.lit(1)).alias("n"), top.alias("m")).collect()[0]
    return {"load_id": load_id, "resource": resource, "rows": s["n"], "cursor_value": s["m"] if s["m"] is not None else last}


def _state_row(spark: SparkSession, info: dict, target_path: str, disposition: str) -> DataFrame:
    return spark.createDataFrame(
        [(info["load_id"], info["resource"], int(info["rows"]), info["cursor_value"],
          dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), target_path, disposition)], STATE_DDL)


def _append_state(spark: SparkSession, state_path: str, info: dict, target_path: str, disposition: str) -> None:
    _state_row(spark, info, target_path, disposition).write.mode("append").parquet(state_path)


def load_state(spark: SparkSession, state_path: str) -> DataFrame:
    return spark.read.schema(STATE_DDL).parquet(state_path)
