"""File sinks (parquet / JSON / CSV) and JDBC appends."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None,
                  partition_by: list[str] | None = None) -> None:
    """Write parquet; ``partitions`` fixes the number of output files
    (``repartition(n)``, a round-robin shuffle).

    With ``partition_by`` (and no fixed count) rows are first rebalanced on
    the partition columns: AQE then merges small outputs into few files per
    directory and splits a hot directory's rows over several tasks, instead
    of every task writing a small file into every directory.
    """
    if partitions:
        out = df.repartition(partitions)
    elif partition_by:
        out = df.hint("rebalance", *partition_by)
    else:
        out = df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Append rows.  The reference appends in fixed batches of 100,000 rows
    from a driver loop; here every task writes its own rows in parallel and
    ``rows_per_file`` caps each output file at that many rows."""
    w = df.write.mode("append")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", int(rows_per_file))
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one record per row."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # keep microseconds (the default keeps milliseconds)
    df.write.mode(mode).option("timestampFormat", fmt).option("timestampNTZFormat", fmt).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def _open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, which is made if it is missing."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    store, folder = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    store.create_dir(folder, recursive=True)
    return store, folder.rstrip("/")


def write_pages(pages: DataFrame, path: str, suffix: str = ".json") -> None:
    """Land every row of ``name, value`` as the file ``<name><suffix>`` of one folder; names are unique.

    Tasks write the files themselves, so a page costs one file, not a folder
    that the driver commits and readers list.  A file gets its name when it is
    whole; what a failed task leaves is hidden from readers.
    """
    _open_folder(path)

    def land(rows: Iterator[Row]) -> None:
        store, folder = _open_folder(path)
        for name, value in rows:
            hidden = f"{folder}/_{uuid.uuid4().hex}"
            with store.open_output_stream(hidden, compression=None) as f:
                f.write(value.encode("utf-8"))
            store.move(hidden, f"{folder}/{name}{suffix}")

    pages.select("name", "value").foreachPartition(land)


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 100_000,
                properties: dict | None = None) -> None:
    """Append to a database table over JDBC, ``batch_size`` rows per insert batch.

    Each task opens its own connection; repartition first to bound the number
    of concurrent connections the database sees.
    """
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
       .option("batchsize", batch_size).options(**(properties or {})).save())
