"""The log as persistent tables of the catalog.

Each registered table gets ``<table>_commits`` over its commit folders, whose partitions are
registered as commits are listed, and ``<table>_segments`` over its compacted ranges.  The name
users query, ``<table>``, is a view of both, bound to the newest listed commit and to the listed
segments.  Publishing registers what is new and then replaces the view: one catalog operation
moves readers from one state to the next, and tables outlive the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from changelake import files
from changelake.schemas import REGISTRY
from changelake.sinks.ddl import create_database
from changelake.sinks.snapshot import OVERWRITE_MODE
from changelake.sources.lake import COMMIT_ID, log_fields, read_commits, segment_path, segments


def _columns(fields: list[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_log_table_sql(name: str, table: str, location: str | None = None, by_segment: bool = False) -> str:
    """DDL with all columns of the log, partitioned by commit (or segment) and the table's own partition columns."""
    spec = REGISTRY[table]
    first = "segment string" if by_segment else "commit_id bigint"
    own = [f for f in spec.log_schema.fields if f.name not in spec.partition_by] + ([COMMIT_ID] if by_segment else [])
    parts = [f for f in spec.log_schema.fields if f.name in spec.partition_by]
    names = ", ".join([first.split()[0], *(f.name for f in parts)])
    place = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({_columns(own)}, {first}{''.join(', ' + _columns([p]) for p in parts)}) USING parquet PARTITIONED BY ({names}){place}"


def _register(spark: SparkSession, name: str, table: str, column: str, folders: dict[str, str]) -> None:
    """Add the partitions of folders the table does not know yet."""
    parts = REGISTRY[table].partition_by
    known = {r["partition"].split("/")[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for value, folder in folders.items():
        if value in known:
            continue
        for path in files.matching(spark, "/".join([folder, *(f"{p}=*" for p in parts)])):
            names = [x.split("=", 1) for x in path.rsplit("/", len(parts))[1:]] if parts else []
            values = [(column, value), *((k, spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(v)) for k, v in names)]
            spec = ", ".join(f"`{k}` = '{_quoted(v)}'" for k, v in values)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{_quoted(path)}'")


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def publish(spark: SparkSession, base: str, database: str, tables: list[str] | None = None) -> list[str]:
    """Bring the catalog to the newest listed commit; returns the views."""
    create_database(spark, database)
    newest = read_commits(spark, base).agg(F.max("commit_id")).first()[0] or 0
    made = []
    for table in tables or list(REGISTRY):
        spec = REGISTRY[table]
        active = segments(spark, base, table)
        last = active[-1].last if active else 0
        rows, packed = (f"`{database}`.`{table}_{kind}`" for kind in ("commits", "segments"))
        spark.sql(create_log_table_sql(rows, table, f"{base}/log/{table}"))
        spark.sql(create_log_table_sql(packed, table, f"{base}/segments/{table}", by_segment=True))
        found = {p.rsplit("=", 1)[1]: p for p in files.matching(spark, f"{base}/log/{table}/commit_id=*")}
        _register(spark, rows, table, "commit_id", {c: p for c, p in found.items() if last < int(c) <= newest})
        _register(spark, packed, table, "segment", {f"{s.first}-{s.last}": segment_path(base, table, s.first, s.last) for s in active})
        shown = ", ".join(f"regexp_replace(`{f}`, '^=', '') AS `{f}`" if f in spec.partition_by else f"`{f}`" for f in log_fields(table).fieldNames())
        ranges = ", ".join(f"'{s.first}-{s.last}'" for s in active) or "''"
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT {shown} FROM {rows} WHERE commit_id > {last} AND commit_id <= {newest} "
            f"UNION ALL SELECT {shown} FROM {packed} WHERE segment IN ({ranges})"
        )
        made.append(f"`{database}`.`{table}`")
    return made


def append_commit(df: DataFrame, name: str, commit_id: int) -> None:
    """Append to a catalog table partitioned by ``commit_id``; the same commit again replaces its own rows."""
    spark = df.sparkSession
    rows = df.withColumn("commit_id", F.lit(commit_id).cast("bigint")).select(*spark.table(name).columns)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
