"""Catalog tables in Parquet: append, replace by partition, replace by predicate, upsert and staged overwrite.

Every write goes through the session catalog, so the tables live wherever the cluster's warehouse does. Nothing
here collects keys or partitions: rows to replace are found with joins, partitions that are touched are replaced with
INSERT OVERWRITE, and of a partitioned table no other partition is read or written. A table without partitions that is
overwritten as a whole is written once, under another name, and takes the old one's place by renaming. Rows are clustered by partition
before a partitioned write, and large partitions split again, so files follow the data and not tasks times partitions.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import rows_with_keys
from tidemark.session import materialize, metadata_rows, scratch_dir, setting

KEY_BUCKET = "_key_bucket"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def scratch_database(spark: SparkSession, prefix: str = "tidemark") -> str:
    """A new database in shared scratch, for runs that must not touch real tables."""
    location = scratch_dir(spark)
    name = f"{prefix}_{location.rsplit('/', 1)[1]}"
    ensure_database(spark, name, location)
    return name


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_empty(df: DataFrame, table: str, partition_by: list[str] = ()) -> None:
    """Create the table from the frame's schema, without running the frame."""
    spark = df.sparkSession
    if not table_exists(spark, table):
        writer = spark.createDataFrame([], df.schema).write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def align(df: DataFrame, table: str, add_missing: bool = True) -> DataFrame:
    """Columns in table order. Columns the frame lacks become NULL; new ones extend the table, or are dropped."""
    spark = df.sparkSession
    current = spark.table(table).schema
    new = [f for f in df.schema.fields if f.name not in current.fieldNames()]
    if new and add_missing:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
        current = spark.table(table).schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in current.fields
        ]
    )


def clustered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of a partition together; adaptive execution splits the large ones and joins the small ones."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append(df: DataFrame, table: str, partition_by: list[str] = ()) -> None:
    """Append-only table: created on first use, widened when the frame has new columns."""
    create_empty(df, table, partition_by)
    clustered(align(df, table), _partitions(df.sparkSession, table)).write.insertInto(table)


def replace_batches(df: DataFrame, table: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in the frame; all others stay."""
    spark = df.sparkSession
    create_empty(df, table, partition_by)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        clustered(align(df, table), list(partition_by)).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def partition_spec(batch: dict) -> str:
    """Partition values as SQL, escaped; None is the partition of NULL."""

    def shown(value) -> str:
        return "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{c}`={shown(v)}" for c, v in batch.items())


def append_batch(df: DataFrame, table: str, batch: dict[str, str]) -> None:
    """Append rows of one batch, named by its partition values. They stay where they are: nothing is shuffled or sorted."""
    spark = df.sparkSession
    named = df.withColumns({c: F.lit(v) for c, v in batch.items()})
    create_empty(named, table, list(batch))
    rows = align(named, table).drop(*batch)
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"INSERT INTO {table} PARTITION ({partition_spec(batch)}) ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)


def replace_batch(df: DataFrame, table: str, batch: dict[str, str]) -> int:
    """Replace one batch, named by its partition values. An empty frame clears the batch. Returns its row count."""
    spark = df.sparkSession
    named = df.withColumns({c: F.lit(v) for c, v in batch.items()})
    create_empty(named, table, list(batch))
    rows = align(named, table).drop(*batch)
    names = [c for c in spark.table(table).columns if c not in batch]
    columns = ", ".join(f"`{c}`" for c in names)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({partition_spec(batch)}) SELECT {columns} FROM {{rows}}", rows=rows)
    current = spark.table(table)
    for column, value in batch.items():
        current = current.filter(F.col(column).eqNullSafe(F.lit(value)))
    return current.count()


def shaped_for(df: DataFrame, table: str, partition_by: list[str]) -> DataFrame:
    """The frame with the table's types, for files that become part of it; the table is created, or widened, to fit."""
    create_empty(df, table, partition_by)
    kinds = {f.name: f.dataType for f in align(df, table).schema.fields}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])


def parts_folder(spark: SparkSession, table: str) -> str:
    """A new folder beside a table, for files that tables take in as partitions."""
    root = spark.catalog.getDatabase(table.split(".")[0]).locationUri
    return f"{root.rstrip('/')}/_parts/{uuid.uuid4().hex}"


def attach_batch(spark: SparkSession, table: str, batch: dict, folder: str) -> None:
    """Make the files of a folder the table's partition. The switch is one change in the catalog; old files go after it."""
    spec = partition_spec(batch)
    database, name = table.split(".")
    was = None
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").count():
        shown = spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '{name}' PARTITION ({spec})").first()["information"]
        was = next(line.split(":", 1)[1].strip() for line in shown.splitlines() if line.startswith("Location:"))
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    if was and was != folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(was)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_by_route(rows: DataFrame, route: str, folder: str) -> None:
    """Files laid out by a column of few values. A task keeps a file open for each, so its rows are not sorted by it."""
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        rows.write.mode("append").partitionBy(route).parquet(folder)


def split_write(df: DataFrame, route: Column, targets: dict[str, tuple[str, list[str]]], batch: dict) -> dict[str, int]:
    """Write a frame once and make it one batch of several tables; returns the rows of each.

    `route` names the target of a row, `targets` gives each its table and columns. The frame is evaluated by a single
    job, whose files are laid out by route; each table takes its folder in as the partition of the batch. A table without
    rows has the batch cleared.
    """
    spark, parts = df.sparkSession, list(batch)
    named = df.withColumns({c: F.lit(v).cast("string") for c, v in batch.items()})
    for table, columns in targets.values():
        shaped = shaped_for(named.select(*[c for c in columns if c not in parts], *parts), table, parts)
        named = named.withColumns({c: F.col(c).cast(shaped.schema[c].dataType) for c in columns if c not in parts})
    folder = parts_folder(spark, next(iter(targets.values()))[0])
    rows = named.drop(*parts).withColumn("_route", route)
    write_by_route(rows, "_route", folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    counts = {r["_route"]: r["count"] for r in written.groupBy("_route").count().collect()}
    for name, (table, _) in targets.items():
        if counts.get(name):
            attach_batch(spark, table, batch, f"{folder}/_route={name}")
        else:
            drop_batch(spark, table, batch)
    return {name: counts.get(name, 0) for name in targets}


def overwrite_staged(df: DataFrame, table: str, partition_by: list[str] = ()) -> DataFrame:
    """Overwrite a table with a frame that may read the table itself.

    Without partitions the frame is written once, as a table beside it, which then takes its name. The old table is
    dropped last; a run that stops in between leaves it as <table>__old, and the next overwrite puts it back first.
    Renaming does not move what the catalog knows of partitions, so a partitioned table is staged and then overwritten
    in place: it is never dropped.
    """
    spark, parts = df.sparkSession, list(partition_by)
    fresh, old = f"{table}__new", f"{table}__old"
    if table_exists(spark, old):
        if table_exists(spark, table):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    if parts:
        staged = materialize(df)
        create_empty(staged, table, parts)
        clustered(align(staged, table), parts).write.insertInto(table, overwrite=True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        df.write.format("parquet").saveAsTable(fresh)
        if table_exists(spark, table):
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _replace_in_partitions(
    table: str, kept: DataFrame, rows: DataFrame | None, touched: DataFrame, stored: bool = False
) -> None:
    """Rewrite the touched partitions of a table with the kept rows and the new ones; clear those left without any."""
    spark, parts = kept.sparkSession, touched.columns
    staged = materialize(kept if rows is None else kept.unionByName(rows))
    touched = touched if stored else materialize(touched.distinct())
    replace_batches(staged, table, parts)
    emptied = rows_with_keys(touched, parts, staged.select(*parts).distinct(), "left_anti")
    for partition in emptied.toLocalIterator():
        drop_batch(spark, table, partition.asDict())


def replace_where(df: DataFrame, table: str, predicate: Column, within: DataFrame | None = None) -> None:
    """Replace the rows that meet the predicate. Unknown columns of the frame are dropped, missing ones are NULL.

    Of a partitioned table only partitions with such rows, or with new ones, are read and rewritten. `within` lists the
    partitions to which this is limited; rows elsewhere stay, and those of the frame that belong there are not taken.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        df.write.format("parquet").saveAsTable(table)
        return
    rows, parts, meets = align(df, table, add_missing=False), _partitions(spark, table), F.coalesce(predicate, F.lit(False))
    existing = spark.table(table)
    if not parts:
        overwrite_staged(existing.filter(~meets).unionByName(rows), table)
        return
    if within is None:
        touched = materialize(existing.filter(meets).select(*parts).unionByName(rows.select(*parts)).distinct())
    else:
        touched = materialize(within.select(*parts).distinct())  # few rows, and known to be few: the others stay in place
        rows = rows_with_keys(rows, parts, touched, "left_semi")
    kept = rows_with_keys(existing.filter(~meets), parts, touched, "left_semi")
    _replace_in_partitions(table, kept, rows, touched, stored=True)


def partition_values(spark: SparkSession, table: str) -> list[dict]:
    """The partitions of a table, from the catalog; None is the partition of NULL."""
    rows = metadata_rows(spark.sql(f"SHOW PARTITIONS {table}"))
    named = [[unquote(part).partition("=") for part in r["partition"].split("/")] for r in rows]
    return [{name: None if value == "__HIVE_DEFAULT_PARTITION__" else value for name, _, value in parts} for parts in named]


def replace_changed(df: DataFrame, table: str, predicate: Column, changed: str, by: list[str]) -> list[tuple[tuple, int]]:
    """Rows of the frame take the place of those that meet the predicate, in partitions where one of them is marked as `changed`.

    The frame has the new form of every row that meets it, in the same partition. It is evaluated by one job, whose files lie by
    partition; where a row is changed, they become the partition, with the rows that stay. Nothing is shuffled or staged for
    that. Returns the values of `by`, the partition columns, and the number of changed rows where there are any.
    """
    spark, parts = df.sparkSession, _partitions(df.sparkSession, table)
    known = partition_values(spark, table) if parts else []
    if set(parts) != set(by) or any(None in p.values() for p in known):  # no partition whose location could be named
        df = materialize(df)
        touched = df.filter(changed).groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
        counts = [(tuple(r[c] for c in by), r["__n"]) for r in metadata_rows(touched)]
        if counts:
            replace_where(df.drop(changed), table, predicate, touched.select(*parts) if parts else None)
        return counts
    if not known:
        return []
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    listed = [(*[p[c] for c in parts], i) for i, p in enumerate(known)]
    routes = spark.createDataFrame(listed, ", ".join([*[f"`{c}` string" for c in parts], "_route int"]))
    routes = F.broadcast(routes.select(*[F.col(c).cast(kinds[c]).alias(c) for c in parts], "_route"))
    folder = parts_folder(spark, table)
    own = [c for c in kinds if c not in parts]
    rows = df.join(routes, parts).select(*[F.col(c).cast(kinds[c]).alias(c) for c in own], changed, "_route")
    write_by_route(rows, "_route", folder)
    written = spark.read.schema(rows.schema).parquet(folder).groupBy("_route")
    found = {r["_route"]: r for r in metadata_rows(written.agg(F.count_if(changed).alias("n"), F.count(F.lit(1)).alias("rows")))}
    counts = {i: r["n"] for i, r in found.items() if r["n"]}
    if not counts:
        return []
    there = spark.table(table).join(routes.filter(F.col("_route").isin(list(counts))), parts)
    sizes = {r["_route"]: r["rows"] for r in metadata_rows(there.groupBy("_route").agg(F.count(F.lit(1)).alias("rows")))}
    partly = [i for i in counts if sizes[i] > found[i]["rows"]]  # by the footers of the files
    if partly:
        staying = there.filter(F.col("_route").isin(partly) & ~F.coalesce(predicate, F.lit(False)))
        write_by_route(staying.select(*own, "_route"), "_route", folder)
    for i in counts:
        attach_batch(spark, table, known[i], f"{folder}/_route={i}")
    return [(tuple(known[i][c] for c in by), n) for i, n in counts.items()]


def delete_where(spark: SparkSession, table: str, predicate: Column) -> None:
    """Remove the rows that meet the predicate; partitions without such rows are left alone."""
    existing, parts, meets = spark.table(table), _partitions(spark, table), F.coalesce(predicate, F.lit(False))
    if not parts:
        overwrite_staged(existing.filter(~meets), table)
        return
    touched = materialize(existing.filter(meets).select(*parts).distinct())
    kept = rows_with_keys(existing.filter(~meets), parts, touched, "left_semi")
    _replace_in_partitions(table, kept, None, touched, stored=True)


def drop_batch(spark: SparkSession, table: str, batch: dict) -> None:
    """Remove one partition, files included, without reading the table."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_spec(batch)})")


def with_key_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Add `_key_bucket`, a partition column for tables that are upserted by key."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return df.withColumn(KEY_BUCKET, bucket)


def upsert(df: DataFrame, table: str, keys: list[str], removed: DataFrame | None = None) -> None:
    """Rows of the frame take the place of rows with the same key; keys of `removed` disappear as well.

    Of a partitioned table only the partitions that hold one of these keys, or get a row, are rewritten; they are found
    and read by joins on the partition columns, and are never listed on the driver.
    """
    spark = df.sparkSession
    rows = align(df, table)
    outgoing = rows.select(*keys)
    if removed is not None:
        outgoing = outgoing.unionByName(removed.select(*keys))
    outgoing = outgoing.distinct()
    existing, parts = spark.table(table), _partitions(spark, table)
    if not parts:
        overwrite_staged(rows_with_keys(existing, keys, outgoing, "left_anti").unionByName(rows), table)
        return
    near = existing.select(*parts, *[k for k in keys if k not in parts])
    if set(parts) <= set(keys):  # the keys say where they may be, so rows elsewhere need not meet them
        near = rows_with_keys(near, parts, materialize(outgoing.select(*parts).distinct()))
    held = rows_with_keys(near, keys, outgoing).select(*parts)
    touched = materialize(held.unionByName(rows.select(*parts)).distinct())
    affected = rows_with_keys(existing, parts, touched, "left_semi")
    _replace_in_partitions(table, rows_with_keys(affected, keys, outgoing, "left_anti"), rows, touched)


def snapshot(spark: SparkSession, table: str, copy: str) -> DataFrame:
    """Physical copy of a table, to compare against later."""
    spark.table(table).write.mode("overwrite").format("parquet").saveAsTable(copy)
    return spark.table(copy)
