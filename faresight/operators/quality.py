"""Declarative column checks: unique, not_null, relationships, accepted_values.

``run_checks`` evaluates all row-level checks of one table in a single
aggregate pass (``count_if`` per check; relationship checks join the parent
key set first, which Spark broadcasts when its size allows), plus one
grouped aggregate for each ``unique`` check.  The result has one row per
check: ``(check_name, column_name, severity, failures)``.  ``enforce``
raises only for failed checks of severity ``error``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str                      # unique | not_null | relationships | accepted_values
    column: str
    severity: str = "error"        # warn | error
    to: DataFrame | None = field(default=None, compare=False)   # parent table (relationships)
    field_name: str | None = None  # parent column (relationships)
    values: tuple = ()             # accepted values


def unique(column: str, severity: str = "error") -> Check:
    return Check("unique", column, severity)


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, severity)


def relationships(column: str, to: DataFrame, field_name: str, severity: str = "error") -> Check:
    return Check("relationships", column, severity, to=to, field_name=field_name)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    return Check("accepted_values", column, severity, values=tuple(values))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; one result row per check.

    One pass: relationship checks first join the parent key set (broadcast
    when small), every row-level check becomes a ``count_if`` flag, and if a
    ``unique`` check is present the flags are summed inside the group-by on
    that column (map-side partial aggregation, so a hot key is pre-combined),
    which then also yields the duplicate count.  Further ``unique`` checks on
    other columns need one more grouped pass each.
    """
    row_checks = [c for c in checks if c.kind != "unique"]
    uniques = [c for c in checks if c.kind == "unique"]
    base = df
    conds = []
    for i, c in enumerate(row_checks):
        col = F.col(c.column)
        if c.kind == "not_null":
            conds.append(col.isNull())
        elif c.kind == "accepted_values":
            # NULLs are not checked (as in SQL ``NOT IN`` over non-null values)
            conds.append(col.isNotNull() & ~col.isin(list(c.values)))
        elif c.kind == "relationships":
            flag = f"_found_{i}"
            parent = c.to.select(F.col(c.field_name).alias(f"_pk_{i}")).distinct() \
                         .withColumn(flag, F.lit(True))
            base = base.join(parent, col == F.col(f"_pk_{i}"), "left")
            conds.append(col.isNotNull() & F.col(flag).isNull())
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")

    results = [(c, f"_f{i}") for i, c in enumerate(row_checks)]
    keys = list(dict.fromkeys(c.column for c in uniques))
    if keys:
        agg = _counted(base, keys, conds)
        results += [(c, f"_u{keys.index(c.column)}") for c in uniques]
    else:
        agg = base.agg(*[F.count_if(cond).alias(f"_f{i}") for i, cond in enumerate(conds)])
    rows = F.array(*[
        F.struct(F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"),
                 F.lit(c.severity).alias("severity"), F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("failures"))
        for c, name in results])
    return agg.select(F.inline(rows))


def _counted(base: DataFrame, keys: list[str], conds: list) -> DataFrame:
    """One row: rows that fail each condition (``_f0`` ...) and values that occur twice or more (``_u0`` ...).

    With several key columns each row is expanded once for each of them and
    grouped by that one alone, so the table is read once and combined in each
    task whatever the number of columns; the conditions count in the first.
    """
    flags = [F.count_if(cond).alias(f"_f{i}") for i, cond in enumerate(conds)]
    if len(keys) == 1:
        grouped = base.groupBy(F.col(keys[0]).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *flags)
        first, repeated = F.lit(True), [(F.col("_n") > 1) & F.col("_key").isNotNull()]
    else:
        columns = [F.col(k) for k in keys]
        grouped = base.groupingSets([[c] for c in columns], *columns).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *flags)
        numbers = [(1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)) for i in range(len(keys))]
        first = F.col("_set") == numbers[0]
        repeated = [(F.col("_set") == s) & (F.col("_n") > 1) & F.col(k).isNotNull() for s, k in zip(numbers, keys)]
    return grouped.agg(
        *[F.sum(F.when(first, F.col(f"_f{i}"))).cast("bigint").alias(f"_f{i}") for i in range(len(conds))],
        *[F.count_if(r).alias(f"_u{i}") for i, r in enumerate(repeated)])


class CheckFailed(AssertionError):
    pass


def enforce(results: DataFrame) -> list[dict]:
    """Collect the (one row per check) result; raise if an ``error`` check failed."""
    rows = [r.asDict() for r in results.collect()]
    bad = [r for r in rows if r["severity"] == "error" and r["failures"] > 0]
    if bad:
        raise CheckFailed(f"{len(bad)} check(s) failed: {bad}")
    return rows
