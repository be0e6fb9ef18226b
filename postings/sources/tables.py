"""Log tables with their file fallback, versioned snapshots, schema checks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.schemas import ERROR_LOGS, PROCESS_LOGS


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


# ---- logs ----------------------------------------------------------------------------------


#: Bytes of log rows, uncompressed, that a task sorts and writes.
LOG_BYTES = 128 << 20


def write_log(df: DataFrame, path: str, schema: T.StructType, batch: str, like: DataFrame | None = None) -> None:
    """Write rows under ``day=.../batch=...``. Writing the same batch again replaces its own files only.

    Days are dealt to tasks in slices of about ``LOG_BYTES`` of text: stack traces shrink so much in a shuffle that its
    own sizes say little about what a task has to hold. ``like``: rows of about the same days and texts to take the sizes from,
    where those of ``df`` are costly to make.
    """
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = df.select(*fields)
    day, texts = F.to_date("created_at"), [F.octet_length(f.name) for f in schema.fields if isinstance(f.dataType, T.StringType)]
    size = F.sum(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(100)).cast("bigint"))
    sizes = (rows if like is None else like.select(*fields)).groupBy(day.alias("day")).agg(size.alias("n")).collect()
    large = {r.day: -(-r.n // LOG_BYTES) for r in sizes if r.n > LOG_BYTES and r.day is not None}
    slices = F.lit(1)
    if large:
        slices = F.coalesce(F.create_map(*[F.lit(x) for d in large.items() for x in d])[day], slices)
    placed = rows.withColumns({"day": day, "batch": F.lit(batch)})
    tasks = -(-sum(r.n for r in sizes) // LOG_BYTES) or 1
    # Dealt by the short columns; equal rows may share a slice.
    short = [c for c in ("created_at", "domain", "run_id", "message", "step") if c in rows.columns]
    placed = placed.repartition(tasks, F.col("day"), F.pmod(F.xxhash64(*short), slices))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)


def append_error_logs(df: DataFrame, path: str) -> None:
    """Append to the error log, one folder per day."""
    write_log(df, path, ERROR_LOGS, uuid.uuid4().hex)


def append_process_logs(df: DataFrame, path: str) -> None:
    """Append to the process log, one folder per day."""
    write_log(df, path, PROCESS_LOGS, uuid.uuid4().hex)


def jsonl_schema(schema: T.StructType) -> T.StructType:
    """Schema of the fallback lines: the metadata object arrives as VARIANT."""
    return T.StructType([T.StructField(f.name, T.VariantType() if f.name == "metadata" else f.dataType) for f in schema.fields])


def conform_jsonl(df: DataFrame) -> DataFrame:
    return df.withColumn("metadata", F.to_json("metadata"))


# Compaction: many small batches of a day are rewritten as one. The new batch counts from the moment a file in
# ``_compactions`` names it; the same file says which batches it stands for, and those are read no more.

_COMPACT = "compact-"


def _compactions(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """{new batch: batches it stands for} of the finished compactions; empty lists once those are deleted."""
    target, fs = _hadoop(spark, f"{path}/_compactions")
    if not fs.exists(target):
        return {}
    rows = spark.read.schema("batch string, replaced array<string>").json(f"{path}/_compactions").collect()
    return {r.batch: list(r.replaced or []) for r in rows}


def _current(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a log in the batches that count now."""
    done = _compactions(spark, path)
    rows = spark.read.option("basePath", path).parquet(path)
    gone = sorted({b for replaced in done.values() for b in replaced})
    finished = ~F.col("batch").startswith(_COMPACT) | F.col("batch").isin(sorted(done))
    return rows.filter(finished & ~F.col("batch").isin(gone)) if gone else rows.filter(finished)


def compact_log(spark: SparkSession, path: str, least: int = 2, rows_per_file: int = 5_000_000) -> dict[str, str]:
    """Rewrite every day that holds at least ``least`` batches as one batch; {day: new batch}.

    Readers see each row once at any time: until the entry in ``_compactions`` is there they skip the new batch, afterwards
    the old ones. Old files stay for readers that began before; :func:`vacuum_log` deletes them. One compaction at a time;
    writers may go on appending, their new batches are not touched.
    """
    if not path_exists(spark, path):
        return {}
    done = _compactions(spark, path)
    gone = {b for replaced in done.values() for b in replaced}
    out = {}
    for day in _names(spark, path, "day="):
        batches = [b for b in _names(spark, f"{path}/day={day}", "batch=") if b not in gone and (not b.startswith(_COMPACT) or b in done)]
        if len(batches) < least:
            continue
        name = f"{_COMPACT}{uuid.uuid4().hex}"
        rows = spark.read.parquet(*[f"{path}/day={day}/batch={b}" for b in batches])
        rows.hint("rebalance").write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/day={day}/batch={name}")
        _note(spark, path, name, batches)
        out[day] = name
    return out


def vacuum_log(spark: SparkSession, path: str) -> int:
    """Delete batches that a finished compaction stands for, and what unfinished ones left; how many folders went.

    Not while a compaction runs, nor while readers from before it do.
    """
    done = _compactions(spark, path) if path_exists(spark, path) else {}
    gone = {b for replaced in done.values() for b in replaced}
    count = 0
    for day in _names(spark, path, "day=") if path_exists(spark, path) else []:
        for batch in _names(spark, f"{path}/day={day}", "batch="):
            if batch in gone or (batch.startswith(_COMPACT) and batch not in done):
                target, fs = _hadoop(spark, f"{path}/day={day}/batch={batch}")
                fs.delete(target, True)
                count += 1
    for name, replaced in done.items():
        if replaced:
            _note(spark, path, name, [])
    return count


def _note(spark: SparkSession, path: str, name: str, replaced: list[str]) -> None:
    """Write the entry of a compaction under a hidden name and move it into place: it is there as a whole or not at all."""
    draft, fs = _hadoop(spark, f"{path}/_compactions/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps({"batch": name, "replaced": replaced}), "utf-8"))
    stream.close()
    final, _ = _hadoop(spark, f"{path}/_compactions/{name}.json")
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"could not write {final}")


def _names(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    target, fs = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def _read_log(spark: SparkSession, table: str | None, jsonl_dir: str | None, schema: T.StructType) -> DataFrame:
    parts = []
    if table and path_exists(spark, table):
        parts.append(_current(spark, table).select(*schema.fieldNames(), "day"))
    if jsonl_dir and path_exists(spark, jsonl_dir):
        lines = conform_jsonl(spark.read.schema(jsonl_schema(schema)).json(jsonl_dir))
        parts.append(lines.withColumn("day", F.to_date("created_at")))
    if not parts:
        return spark.createDataFrame([], schema).withColumn("day", F.to_date("created_at"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_error_logs(spark: SparkSession, table: str | None, jsonl_dir: str | None = None) -> DataFrame:
    """Table rows and the lines that fell back to files, with their ``day``: bounds on it skip whole folders."""
    return _read_log(spark, table, jsonl_dir, ERROR_LOGS)


def read_process_logs(spark: SparkSession, table: str | None, jsonl_dir: str | None = None) -> DataFrame:
    return _read_log(spark, table, jsonl_dir, PROCESS_LOGS)


# ---- snapshots -----------------------------------------------------------------------------


def _snapshots(spark: SparkSession, root: str) -> list[tuple[int, str, str]]:
    """(version, tag, folder) of the complete versions under ``root``, oldest first."""
    target, fs = _hadoop(spark, root)
    if not fs.exists(target):
        return []
    found = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("v=") and path_exists(spark, f"{root}/{name}/_SUCCESS"):
            version, _, tag = name[2:].partition("~")
            found.append((int(version), tag, f"{root}/{name}"))
    return sorted(found)


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions under ``root``; a version counts once its ``_SUCCESS`` marker is there."""
    return [version for version, _, _ in _snapshots(spark, root)]


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Newest complete version (older than ``before``, when given); empty when there is none."""
    folders = [path for version, _, path in _snapshots(spark, root) if before is None or version < before]
    return spark.read.schema(schema).parquet(folders[-1]) if folders else spark.createDataFrame([], schema)


def write_snapshot(df: DataFrame, root: str, version: int | None = None, tag: str = "", keep: int | None = None) -> bool:
    """Write a version (the next one by default) once; False when it, or one of the same ``tag``, is complete already.

    A path being read is never touched: every version has its own folder, and a half-written one is overwritten by
    the retry. The tag is part of the folder's name, so a version and the fact of what it holds become
    visible together. ``keep``: how many of the newest versions stay; readers of older ones must be done.
    """
    spark = df.sparkSession
    known = _snapshots(spark, root)
    if version in [v for v, _, _ in known] or (tag and tag in [t for _, t, _ in known]):
        return False
    number = version if version is not None else max([v for v, _, _ in known], default=-1) + 1
    df.write.mode("overwrite").parquet(f"{root}/v={number}" + (f"~{tag}" if tag else ""))
    for _, _, folder in known[:max(0, len(known) + 1 - keep)] if keep else []:
        target, fs = _hadoop(spark, folder)
        fs.delete(target, True)
    return True


# ---- schema --------------------------------------------------------------------------------


def check_schema(df: DataFrame, expected: list[str]) -> DataFrame:
    """Expected columns with type and nullability; ``missing`` marks those the table lacks."""
    spark = df.sparkSession
    found = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields if f.name in set(expected)],
        "column string, data_type string, nullable boolean",
    )
    wanted = spark.createDataFrame([(c,) for c in sorted(set(expected))], "column string")
    missing = wanted.exceptAll(found.select("column")).withColumn("missing", F.lit(True))
    return found.withColumn("missing", F.lit(False)).unionByName(missing, allowMissingColumns=True).orderBy("column")
