"""Table writes that never lose the rows they replace (K1-K9).

Tables are catalog tables in Parquet, partitioned by their window key where
they have one. There is no transaction log here, so every write has three
steps: *stage* (the new rows are written once, to a folder of their own inside
the table's root), *verify* (checks ride along with that write as observed
metrics; on any failure the staged folder is removed and the table is as it
was), *switch* (metadata only: ``SET LOCATION`` of the table or of a partition
to the staged folder). Readers see the old rows or the new ones. Tables of days
change over in one statement, whatever the number of days (``versions``). The
watermark moves last, so a run that dies between two tables is repeated for the
same window.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table_name(layer: str, name: str, sandbox: str | None = None) -> str:
    """K8: ``{sandbox}_{layer}.{name}`` in a sandbox, else ``{layer}.{name}``."""
    db = f"{sandbox}_{layer}" if sandbox else layer
    return f"{db}.{name}"


def ensure_namespace(spark: SparkSession, table: str) -> None:
    """K7: create the table's database if needed."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """K9: count rows while they are written (no second scan)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def append_rows(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append to a table, created from the rows' schema when there is none."""
    ensure_namespace(spark, table)
    if not spark.catalog.tableExists(table):
        _create_empty(spark, df, table, [])
    df.select(*spark.table(table).columns).coalesce(1).write.insertInto(table)


def table_location(spark: SparkSession, table: str) -> str:
    """Folder that the catalog reads a table from (of an unpartitioned table: its current version)."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r["col_name"] == "Location":
            return r["data_type"].rstrip("/")
    raise ValueError(f"no location for {table}")


def _root(spark: SparkSession, table: str) -> str:
    """The table's own folder, whatever version of it is current."""
    from vesseltrack.plans import versions
    if versions.is_view(spark, table):
        table = versions.data_table(spark, table)
    where = table_location(spark, table)
    parent, _, name = where.rpartition("/")
    return parent if name.startswith("_v-") else where


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _literal(value: str) -> str:
    """A SQL string literal; quotes and backslashes of a file name stay data."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folder(spark: SparkSession, column: str, value: str) -> str:
    """Name of a partition's folder as Spark's writer escapes it."""
    return f"{column}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))}"


def _create_empty(spark: SparkSession, df: DataFrame, table: str, partition_by: list[str]) -> None:
    w = df.where(F.lit(False)).write.format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(table)


def _same_columns(spark: SparkSession, df: DataFrame, table: str) -> bool:
    flat = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return sorted(flat(df.schema)) == sorted(flat(spark.table(table).schema))


def partition_values(spark: SparkSession, table: str, columns: list[str]) -> set[tuple]:
    """Values of the table's partitions, from the catalog; no data is read."""
    from urllib.parse import unquote

    from vesseltrack.plans import versions
    if versions.is_view(spark, table):
        return versions.days_of(spark, table)
    found = set()
    for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        pairs = dict(part.split("=", 1) for part in r[0].split("/"))
        found.add(tuple(None if pairs[c] == "__HIVE_DEFAULT_PARTITION__" else unquote(pairs[c]) for c in columns))
    return found


def _spec(columns: list[str], values: tuple) -> str:
    return "PARTITION (" + ", ".join(f"{c} = {'NULL' if v is None else _literal(v)}" for c, v in zip(columns, values)) + ")"


def _switch_partitions(spark: SparkSession, table: str, columns: list[str], staged: dict[tuple, str], gone: set[tuple]) -> None:
    """Point existing partitions at their staged folders, attach new ones, then drop those without rows."""
    there = partition_values(spark, table, columns)
    new = sorted((v for v in staged if v not in there), key=str)
    for v in sorted((v for v in staged if v in there), key=str):
        spark.sql(f"ALTER TABLE {table} {_spec(columns, v)} SET LOCATION {_literal(staged[v])}")
    for i in range(0, len(new), 100):
        specs = " ".join(f"{_spec(columns, v)} LOCATION {_literal(staged[v])}" for v in new[i:i + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    drop = sorted(gone & there - set(staged), key=str)
    for i in range(0, len(drop), 100):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(columns, v) for v in drop[i:i + 100])}")
    spark.catalog.refreshTable(table)


def _staged_partitions(spark: SparkSession, stage: str, columns: list[str], days: list) -> dict[tuple, str]:
    out = {}
    for values in days:
        values = tuple(values)
        names = [_folder(spark, c, "__HIVE_DEFAULT_PARTITION__" if v is None else v) for c, v in zip(columns, values)]
        out[values] = "/".join([stage, *names])
    return out


def _staged_rows(spark: SparkSession, df: DataFrame, stage: str, columns: list[str]) -> dict[tuple, int]:
    """Rows of each partition that was staged: folder names and row counts only."""
    staged = spark.read.schema(df.schema).parquet(stage)
    return {tuple(r[:-1]): r[-1] for r in staged.groupBy(*[F.col(c).cast("string").alias(c) for c in columns]).count().collect()}


def overwrite_table(spark: SparkSession, df: DataFrame, table: str,
                    partition_by: str | None = None, cluster_by=()) -> int:
    """K3/K5: replace the whole table (snapshot, full rebuild). Returns rows written.

    The old rows stay readable until the new ones are written in full. The
    version before the one replaced is removed, the replaced one is kept for
    readers that are still on it. With ``partition_by`` (a column of days) the
    table is a view over versioned days (``versions``) whose files are sorted by
    ``cluster_by``.
    """
    from vesseltrack.plans import versions
    ensure_namespace(spark, table)
    if partition_by:
        return versions.change(spark, df, table, partition_by, None, ([], lambda found: None), cluster_by)
    if spark.catalog.tableExists(table) and not _same_columns(spark, df, table):
        # other columns: the new rows are complete in a table of their own before the old one goes
        fresh = f"{table}_new_{uuid.uuid4().hex[:8]}"
        rows = overwrite_table(spark, df, fresh)
        roots = _root(spark, table), _root(spark, fresh)
        spark.sql(f"DROP TABLE {table}")
        _remove(spark, roots[0])
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        if not table_location(spark, table).startswith(roots[1]):
            _remove(spark, roots[1])
        return rows
    if not spark.catalog.tableExists(table):
        _create_empty(spark, df, table, [])
    root = _root(spark, table)
    stage = f"{root}/_v-{uuid.uuid4().hex}"
    df, obs = counted(df.select(*spark.table(table).columns))
    try:
        df.write.format("parquet").save(stage)
    except Exception:
        _remove(spark, stage)
        raise
    before = table_location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(stage)}")
    spark.catalog.refreshTable(table)
    fs, p = _fs(spark, root)
    for old in fs.listStatus(p):
        path = old.getPath()
        if path.getName().startswith("_v-") and path.getName() not in (stage.rpartition("/")[2], before.rpartition("/")[2]):
            fs.delete(path, True)
    return obs.get["rows"]


def replace_window(spark: SparkSession, df: DataFrame, table: str, start, end,
                   partition_col: str = "event_date", cluster_by=()) -> int:
    """K4: make the table's rows with ``partition_col`` in [start, end] equal ``df``.

    Every row is checked to be inside the window while it is staged; a failed
    check or write leaves the table as it was. Then all days of the window change
    over in one statement, those without new rows included; other days are
    untouched. On first use an empty table is created from ``df``'s schema.
    """
    from vesseltrack.plans import versions
    start = start if isinstance(start, date) else date.fromisoformat(str(start))
    end = end if isinstance(end, date) else date.fromisoformat(str(end))
    key = F.col(partition_col)

    def judge(found) -> None:
        if found["outside"]:
            raise ValueError(f"rows outside [{start}, {end}] in the result for {table}")

    outside = F.count_if(key.isNull() | ~key.between(F.lit(start), F.lit(end))).alias("outside")
    return versions.change(spark, df, table, partition_col, (start, end), ([outside], judge), cluster_by)


def replace_files(spark: SparkSession, df: DataFrame, table: str, files: list[str],
                  partition_cols: list[str] | None = None, per_file: dict | None = None) -> int:
    """K2: idempotent re-ingest: the table's rows of ``files`` become ``df``'s.

    The last of ``partition_cols`` (default: ``_source_file``) names the file.
    Returns the rows written; with ``per_file`` (a dict) also fills in the rows
    of each file. Both come from the staged files' footers (no column is read),
    so a row costs the same however many files the batch has.
    """
    ensure_namespace(spark, table)
    cols = partition_cols or ["_source_file"]
    files = list(files)
    if not spark.catalog.tableExists(table):
        _create_empty(spark, df, table, cols)
    stage = f"{_root(spark, table)}/_stage-{uuid.uuid4().hex}"
    df = df.select(*spark.table(table).columns)
    try:
        df.write.format("parquet").partitionBy(*cols).save(stage)
        found = _staged_rows(spark, df, stage, cols)
        if strange := {p[-1] for p in found} - set(files):
            raise ValueError(f"rows of files that are not being replaced: {sorted(map(str, strange))[:3]}")
    except Exception:
        _remove(spark, stage)
        raise
    gone = {v for v in partition_values(spark, table, cols) if v[-1] in set(files)}
    _switch_partitions(spark, table, cols, _staged_partitions(spark, stage, cols, list(found)), gone)
    if per_file is not None:
        counts = dict.fromkeys(files, 0)
        for p, n in found.items():
            counts[p[-1]] += n
        per_file.update(counts)
    return sum(found.values())


def commit_watermark(spark: SparkSession, table: str, window) -> bool:
    """Write ``last_end`` only for an advancing window; returns whether it did."""
    if window is None or not getattr(window, "advance", False) or not window.end:
        return False
    state = (spark.createDataFrame([(window.end,)], "last_end date")
                  .withColumn("_updated_at", F.current_timestamp()))
    overwrite_table(spark, state, table)
    return True
