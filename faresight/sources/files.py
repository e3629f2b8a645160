"""File and database readers.

Scale notes: ``inferSchema`` costs an extra pass over the data, so
production loads pass a fixed DDL schema; gzip files are not splittable, so
a gzip read is one task per file until ``repartition``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             sep: str = ",", repartition: int | None = None) -> DataFrame:
    """CSV with a header.  ``schema`` (DDL) fixes the types, and then a header
    that names other columns, or a value that does not fit its column (such as
    ``1.0`` in an INT), is an error, as in a database's bulk load; without it
    the types are inferred.  ``.gz`` files decode transparently."""
    r = spark.read.option("header", header).option("sep", sep)
    r = _strict(r.schema(schema)) if schema else r.option("inferSchema", True)
    df = r.csv(path)
    return df.repartition(repartition) if repartition else df


def _strict(reader):
    return reader.option("enforceSchema", False).option("mode", "FAILFAST")


def read_csv_columns(spark: SparkSession, path: str, file_schema: str, columns: Sequence[str],
                     header: bool = True) -> DataFrame:
    """Bulk load into chosen columns: read with the file's schema, project
    ``columns`` in order; columns absent from the file come back NULL, of the
    type given as ``"name type"`` (a bare name is a string)."""
    df = read_csv(spark, path, schema=file_schema, header=header)
    present = {c.lower(): c for c in df.columns}
    out = []
    for column in columns:
        c, _, kind = column.partition(" ")
        src = present.get(c.lower())
        value = F.col(src) if src else F.lit(None).cast("string")
        out.append((value.cast(kind) if kind else value).alias(c))
    return df.select(*out)


def external_table(spark: SparkSession, name: str, path: str, schema: str, fmt: str = "csv",
                   header: bool = True) -> DataFrame:
    """Schema-on-read table over files in place, registered as a temp view."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = _strict(r.option("header", header))
    df = r.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return df


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet file(s), directory or glob; schema from the footers."""
    return spark.read.parquet(*paths)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multiline: bool = True,
              timestamp_format: str | None = None) -> DataFrame:
    """JSON documents (``multiLine``: one document per file, a top-level
    array gives one row per element) or JSON lines; inferred schema unless
    ``schema`` is given."""
    r = spark.read.option("multiLine", multiline)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if schema:
        r = r.schema(schema)
    return r.json(path)


def _pages(spark: SparkSession, pages_dir: str, pattern: str) -> tuple[DataFrameReader, str]:
    """Reader and path of landed pages.

    Pages in one folder are found by listing that folder; a glob would give
    each file as a path of its own, which Spark lists again in a task each.
    """
    if "/" in pattern:
        return spark.read, f"{pages_dir.rstrip('/')}/{pattern}"
    return spark.read.option("pathGlobFilter", pattern), pages_dir


def read_json_pages(spark: SparkSession, pages_dir: str, schema: str | None = None,
                    pattern: str = "*.json") -> DataFrame:
    """Numbered JSON pages landed as files (``page_1.json``, ...), each a
    top-level array of records.  All pages are read in parallel; an empty
    page (``[]``) contributes no rows, so "stop at the first empty page" is
    the same as reading every page that exists."""
    reader, path = _pages(spark, pages_dir, pattern)
    if schema:
        reader = reader.schema(schema)
    return reader.option("multiLine", True).json(path)


def _numbered(df: DataFrame, pattern: str) -> DataFrame:
    number = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn("_page", F.when(number != "", number.cast("bigint")))


def page_bounds(spark: SparkSession, pages_dir: str, start_page: int = 1, pattern: str = "*.json",
                number: str = r"page[_=](\d+)") -> tuple[int, int]:
    """``(start, end)`` of the pages to read: from ``start_page`` up to, not including, the first one that is empty or missing.

    Pages are looked at in parallel, once and each as one text; one number comes back.
    """
    reader, path = _pages(spark, pages_dir, pattern)
    texts = _numbered(reader.option("wholetext", True).text(path), number).filter(F.col("_page") >= start_page)
    empty = F.col("value").rlike(r"^\s*(\[\s*\])?\s*$")
    # Each page marks itself and the next one; a page that nothing but the page before it marks is missing.
    marks = texts.select(F.explode(F.array(
        F.struct("_page", empty.alias("_empty")),
        F.struct((F.col("_page") + 1).alias("_page"), F.lit(None).cast("boolean").alias("_empty")))).alias("m")).select("m.*")
    first = spark.range(1).select(F.lit(start_page).cast("bigint").alias("_page"), F.lit(None).cast("boolean").alias("_empty"))
    pages = marks.unionByName(first).groupBy("_page").agg(F.min("_empty").alias("_empty"))
    return start_page, pages.filter(F.coalesce("_empty", F.lit(True))).agg(F.min("_page")).first()[0]


def read_numbered_pages(spark: SparkSession, pages_dir: str, schema: str, start_page: int = 1, pattern: str = "*.json",
                        number: str = r"page[_=](\d+)") -> DataFrame:
    """Records of landed API pages with their ``page``, read as the API is read: pages follow each other from
    ``start_page`` and the first empty one ends the data, whatever lies behind it.

    To resume, start at the ``end`` that :func:`page_bounds` gives: it is the
    first page not read.  A page may be a file or a folder of files.
    """
    start, end = page_bounds(spark, pages_dir, start_page, pattern, number)
    rows = _numbered(read_json_pages(spark, pages_dir, schema, pattern), number)
    return rows.filter((F.col("_page") >= start) & (F.col("_page") < end)).withColumnRenamed("_page", "page")


def even_ranges(spark: SparkSession, url: str, query: str, column: str, parts: int, properties: dict | None = None,
                bins: int = 256) -> list[tuple[float, float, int]]:
    """Ranges ``[low, high)`` of a numeric column that hold about equal numbers of a query's rows, with these numbers.

    The database counts its rows in ``bins`` equal steps between the least and
    largest value; steps that hold more than their share of a part are divided
    again, until a step is within its share or a single value.  Only counts
    come back, at most ``bins`` a round for each of at most ``2 * parts`` steps.
    """
    def ask(sql: str) -> list:
        return read_jdbc_query(spark, url, sql, properties).collect()

    source = f"({query}) q"
    (low, high, n), = ask(f"SELECT min({column}) AS LO, max({column}) AS HI, count({column}) AS N FROM {source}")
    if not n:
        return []
    share, done, todo = max(1, n // (2 * parts)), [], [(float(low), float(high) + 1.0)]
    while todo:
        a, b = todo.pop()
        step = max((b - a) / bins, 1.0)
        place = f"FLOOR((CAST({column} AS DOUBLE PRECISION) - {a!r}) / {step!r})"
        counted = ask(f"SELECT B, count(*) AS N FROM (SELECT {place} AS B FROM {source} WHERE {column} >= {a!r} AND {column} < {b!r}) s "
                      "GROUP BY B")
        for r in counted:
            lo, hi = a + float(r[0]) * step, min(a + (float(r[0]) + 1) * step, b)
            if r[1] > share and step > 1.0:
                todo.append((lo, hi))
            else:
                done.append((lo, hi, int(r[1])))
    done.sort()
    out, begin, held = [], done[0][0], 0
    for i, (_, hi, count) in enumerate(done):
        held += count
        if held * parts >= n or i == len(done) - 1:
            out.append((begin, hi, held))
            begin, held = hi, 0
    return out


def read_jdbc_even(spark: SparkSession, url: str, query: str, column: str, parts: int, properties: dict | None = None) -> DataFrame:
    """A query's result in about ``parts`` even partitions by a numeric column whose range and skew are not known.

    The first and last range are open, so rows that come while the ranges are
    measured are read too; rows without a value are read with the first.
    """
    ranges = even_ranges(spark, url, query, column, parts, properties)
    cuts = [r[0] for r in ranges[1:]]
    edges = [None, *cuts, None]
    predicates = []
    for a, b in zip(edges, edges[1:]):
        bounds = [f"{column} >= {a!r}" if a is not None else "", f"{column} < {b!r}" if b is not None else ""]
        inside = " AND ".join(x for x in bounds if x) or "1 = 1"
        predicates.append(f"({inside}) OR {column} IS NULL" if a is None else inside)
    return spark.read.jdbc(url, f"({query}) q", predicates=predicates, properties=dict(properties or {}))


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Result of a SQL query over JDBC.  With a partition column and bounds
    the read is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
              .option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def from_records(spark: SparkSession, records: list, schema: str | None = None) -> DataFrame:
    """Small in-memory nested records (dicts, dicts of dicts, lists of dicts).

    Without a schema, nested dicts are inferred as structs (not maps), so
    they flatten into columns like records read from JSON."""
    if schema:
        return spark.createDataFrame(records, schema=schema)
    key = "spark.sql.pyspark.inferNestedDictAsStruct.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return spark.createDataFrame(records)
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
