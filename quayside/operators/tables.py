"""Changes to partitioned Parquet tables. Every rewrite goes to a folder beside the table first and is swapped in by renames, so a
table is never overwritten while it is read, and only the partitions that change are rewritten. What is replaced is moved aside
before its successor comes; a swap that was broken off is completed, or undone if it had not begun, by recover(), which every
change calls first."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.exprs import date_parts, sanitize

CODEC = "zstd"
# Fixed value: the folder of null, as Spark and Hive name it.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Files:
    """The Hadoop file system of a path: local, S3 and others alike."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, p: str) -> bool:
        return self.fs.exists(self._path(p))

    def delete(self, p: str) -> bool:
        return self.fs.delete(self._path(p), True)

    def rename(self, a: str, b: str) -> None:
        self.fs.mkdirs(self._path(b).getParent())
        if not self.fs.rename(self._path(a), self._path(b)):
            raise OSError(f"cannot move {a} to {b}")

    def list(self, p: str, suffix: str = ".parquet") -> list[tuple[str, int]]:
        """(path, bytes) of all files below p."""
        if not self.exists(p):
            return []
        it, out = self.fs.listFiles(self._path(p), True), []
        while it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(suffix):
                out.append((f.getPath().toString(), f.getLen()))
        return sorted(out)

    def inside(self, p: str, name: str) -> str:
        """The part of a file's path below p."""
        root = self.fs.makeQualified(self._path(p)).toUri().getPath().rstrip("/")
        return name.split(root, 1)[1].lstrip("/")

    def folders(self, p: str) -> set[str]:
        """Folders below p that hold Parquet files, relative to p."""
        return {self.inside(p, name).rpartition("/")[0] for name, _ in self.list(p)}

    def beside(self, p: str, mark: str) -> list[str]:
        """Folders beside p whose names are that of p and mark with something behind."""
        found = self.fs.globStatus(self._path(f"{p.rstrip('/')}{mark}*"))
        return [str(x.getPath().toString()) for x in found or ()]

    def write_text(self, p: str, text: str) -> None:
        out = self.fs.create(self._path(p), True)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def read_text(self, spark: SparkSession, p: str) -> str:
        stream = self.fs.open(self._path(p))
        try:
            return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def write(df: DataFrame, path: str, keys: list[str], mode: str = "append", sanitized: bool = True, files_per_partition: int = 0, max_records: int = 0) -> None:
    """Partitioned sink, flat without keys. mode: append, overwrite (the table), overwrite_partition (those that df holds), merge needs upsert()."""
    if mode not in ("append", "overwrite", "overwrite_partition"):
        raise ValueError(f"unknown mode: {mode}")
    if sanitized:
        text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
        df = df.withColumns({k: sanitize(k) for k in keys if k in text})
    if files_per_partition == 1:
        df = df.repartition(*keys)
    elif files_per_partition > 1:
        df = df.withColumn("_s", F.floor(F.rand(7) * files_per_partition)).repartition(*keys, "_s").drop("_s")
    w = df.write.option("compression", CODEC)
    w = w.partitionBy(*keys) if keys else w
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    if mode == "overwrite_partition":
        w.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        w.option("partitionOverwriteMode", "static").mode(mode).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def partition_keys(spark: SparkSession, path: str) -> list[str]:
    """Keys in the order of the folders."""
    files = Files(spark, path).list(path)
    return [x.split("=", 1)[0] for x in files[0][0].split(path.rstrip("/").split(":")[-1])[-1].split("/") if "=" in x] if files else []


@dataclass
class Stats:
    partitions: int = 0
    rows_before: int = 0
    rows_after: int = 0
    changed: int = 0
    inserted: int = 0
    dry_run: bool = False


SWAP = ".swap-"


def values_of(folder: str) -> tuple[str | None, ...]:
    """'a=1/b=x%3Ay' -> ('1', 'x:y'); null for the folder that stands for it."""
    found = [unquote(x.split("=", 1)[1]) for x in folder.split("/") if "=" in x]
    return tuple(None if v == NULL_FOLDER else v for v in found)


def _finish(fs: Files, path: str, swap: str, plan: dict) -> None:
    """Puts each folder of a plan in its place; steps that have been taken are left out, so it can be done again."""
    for folder in plan["folders"]:
        here, new, old = f"{path}/{folder}", f"{swap}/new/{folder}", f"{swap}/old/{folder}"
        if fs.exists(here) and not fs.exists(old) and (fs.exists(new) or folder in plan["dropped"]):
            fs.rename(here, old)
        if fs.exists(new):
            fs.rename(new, here)
    if plan["backup"]:
        for folder in plan["folders"]:
            if fs.exists(f"{swap}/old/{folder}"):
                fs.rename(f"{swap}/old/{folder}", f"{plan['backup']}/{folder}")
    fs.delete(swap)


def recover(spark: SparkSession, path: str) -> int:
    """Completes swaps that were broken off, and removes what never came to a swap; returns how many of either."""
    fs, path = Files(spark, path), path.rstrip("/")
    left = fs.beside(path, SWAP)
    for swap in left:
        if fs.exists(f"{swap}/plan.json"):
            _finish(fs, path, swap, json.loads(fs.read_text(spark, f"{swap}/plan.json")))
        else:
            fs.delete(swap)
    return len(left)


def _swap(spark: SparkSession, path: str, stage: Callable[[str], None], touched: Iterable[str], backup: str | None) -> None:
    """stage writes new folders to the path that it is given; they replace those of the table. Touched folders without a successor
    are dropped."""
    fs, path = Files(spark, path), path.rstrip("/")
    swap = f"{path}{SWAP}{uuid.uuid4().hex}"
    stage(f"{swap}/new")
    new = fs.folders(f"{swap}/new")
    plan = {"folders": sorted(new | set(touched)), "dropped": sorted(set(touched) - new), "backup": backup}
    # Under its name only when it is whole: from here on the swap can be completed.
    fs.write_text(f"{swap}/plan.part", json.dumps(plan))
    fs.rename(f"{swap}/plan.part", f"{swap}/plan.json")
    _finish(fs, path, swap, plan)


def _staged(df: DataFrame, keys: list[str]) -> Callable[[str], None]:
    return lambda to: df.repartition(*keys).write.option("compression", CODEC).partitionBy(*keys).parquet(to)


def _folders(spark: SparkSession, path: str, schema, folders: Iterable[str]) -> DataFrame:
    """The rows of some folders of a table."""
    if not (paths := [f"{path.rstrip('/')}/{f}" for f in folders]):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def _touched(spark: SparkSession, path: str, df: DataFrame, hit: Column) -> dict[str, int]:
    """Folders with rows that are hit, and how many; there are no more of them than folders."""
    found = df.filter(hit).groupBy(F.regexp_replace("_metadata.file_path", "/[^/]*$", "/").alias("f")).agg(F.count("*").alias("n")).collect()
    fs = Files(spark, path)
    return {fs.inside(path, unquote(r.f)).rstrip("/"): r.n for r in found}


def delete(spark: SparkSession, path: str, where: Column, partitions: Column | None = None, dry_run: bool = False, backup: str | None = None, parity: bool = False) -> Stats:
    """Deletes rows where the predicate is true; rows where it is null stay (parity: go). Only partitions that hold such rows are read again."""
    recover(spark, path)
    df = read(spark, path)
    hit = F.coalesce(where, F.lit(bool(parity)))
    touched = _touched(spark, path, df.filter(partitions) if partitions is not None else df, hit)
    mine = _folders(spark, path, df.schema, touched)
    mine_hit = hit & F.coalesce(partitions, F.lit(False)) if partitions is not None else hit
    before, changed = mine.count(), sum(touched.values())
    if not dry_run and touched:
        _swap(spark, path, _staged(mine.filter(~mine_hit), partition_keys(spark, path)), touched, backup)
    return Stats(len(touched), before, before - changed, changed, dry_run=dry_run)


def updated(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """df with values set where the predicate, judged once on the old row, is true; later values see earlier ones."""
    d = df.withColumn("_hit", F.coalesce(where, F.lit(False)))
    for c, v in values.items():
        d = d.withColumn(c, F.when(F.col("_hit"), v).otherwise(F.col(c)))
    return d.drop("_hit")


def update(spark: SparkSession, path: str, where: Column, values: dict[str, Column], partitions: Column | None = None, dry_run: bool = False, backup: str | None = None) -> Stats:
    recover(spark, path)
    keys = partition_keys(spark, path)
    if set(values) & set(keys):
        raise ValueError("partition columns cannot be updated")
    df = read(spark, path)
    hit = F.coalesce(where, F.lit(False)) & (F.coalesce(partitions, F.lit(False)) if partitions is not None else F.lit(True))
    touched = _touched(spark, path, df, hit)
    mine = _folders(spark, path, df.schema, touched)
    before = mine.count()
    if not dry_run and touched:
        _swap(spark, path, _staged(updated(mine, hit, values), keys), touched, backup)
    return Stats(len(touched), before, before, sum(touched.values()), dry_run=dry_run)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """old with rows of new merged by key (null keys are equal): non-null new values win, rows with new keys are added. One full outer join."""
    values = [c for c in old.columns if c not in keys]
    change = set(columns or values) & set(new.columns)
    a = old.select(F.struct(*keys).alias("_ok"), F.struct(*values).alias("_o"))
    b = new.select(F.struct(*keys).alias("_nk"), F.struct(*(F.col(c) for c in values if c in new.columns), F.lit(1).alias("_there")).alias("_n"))
    on = F.lit(True)
    for k in keys:
        on = on & a["_ok"][k].eqNullSafe(b["_nk"][k])

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col("_ok")[c], F.col("_nk")[c])
        if c not in new.columns:
            return F.col("_o")[c]
        was, now = F.col("_o")[c], F.col("_n")[c]
        return F.coalesce(now, was) if c in change else F.when(F.col("_o").isNull(), now).otherwise(was)

    return a.join(b, on, "full_outer").select(*(value(c).alias(c) for c in old.columns))


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition_by: list[str], columns: list[str] | None = None, dry_run: bool = False, backup: str | None = None) -> Stats:
    """Merges new into a table, of which only the partitions of new are rewritten. An empty text as partition value is null, as Spark stores it."""
    missing = (set(keys) | set(partition_by)) - set(new.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    recover(spark, path)
    text = {f.name for f in new.schema.fields if f.dataType.simpleString() == "string"}
    new = new.withColumns({k: F.nullif(k, F.lit("")) for k in partition_by if k in text})
    fs = Files(spark, path)
    if not fs.list(path):
        n = new.count()
        if not dry_run:
            write(new, path, partition_by, sanitized=False)
        return Stats(new.select(*partition_by).distinct().count(), 0, n, 0, n, dry_run)
    wanted = {tuple(r) for r in new.select(*(F.col(k).cast("string") for k in partition_by)).distinct().toLocalIterator()}
    touched = [f for f in fs.folders(path) if values_of(f) in wanted]
    old = _folders(spark, path, read(spark, path).schema, touched)
    on = list(dict.fromkeys([*partition_by, *keys]))
    before = old.count()
    merged = upserted(old, new, on, columns)
    after = merged.count()
    inserted = after - before
    if not dry_run:
        _swap(spark, path, _staged(merged, partition_by), touched, backup)
    return Stats(len(wanted), before, after, new.count() - inserted, inserted, dry_run)


def repartition(spark: SparkSession, source: str, target: str, keys: list[str], transform: Callable[[DataFrame], DataFrame] | None = None, delete_source: bool = False, validate: bool = True, dry_run: bool = False) -> Stats:
    """Writes a table under other partition keys, one shuffle; counts are compared before the source goes."""
    df = read(spark, source)
    df = df.transform(transform) if transform else df
    before = df.count()
    if dry_run:
        return Stats(0, before, before, dry_run=True)
    write(df, target, keys, "append", files_per_partition=1)
    after = read(spark, target).count()
    if validate and before != after:
        raise ValueError(f"{before} rows became {after}")
    if delete_source:
        Files(spark, source).delete(source)
    return Stats(0, before, after)


def compact(spark: SparkSession, path: str, min_files: int = 2, target_mb: float = 100, sort_by: list[str] | None = None, dry_run: bool = False, at_once: int = 8) -> dict[str, int]:
    """Rewrites partitions of min_files or more small files to ceil(size / target) files each."""
    recover(spark, path)
    fs = Files(spark, path)
    folders: dict[str, list[int]] = {}
    for name, size in fs.list(path):
        folders.setdefault(name.rsplit("/", 1)[0], []).append(size)
    todo = {f: max(1, math.ceil(sum(s) / 1e6 / target_mb)) for f, s in folders.items() if len(s) >= min_files and len(s) > max(1, math.ceil(sum(s) / 1e6 / target_mb))}
    out = {"partitions": len(todo), "files_before": sum(len(folders[f]) for f in todo), "files_after": sum(todo.values())}
    if dry_run or not todo:
        return out

    def stage(to: str) -> None:
        def one(folder: str, n: int) -> None:
            d = spark.read.parquet(folder).repartition(n)
            cols = [c for c in sort_by or [] if c in d.columns]
            (d.sortWithinPartitions(*cols) if cols else d).write.option("compression", CODEC).parquet(f"{to}/{fs.inside(path, folder)}")

        # Jobs of different folders run side by side; each is a small one.
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(one, todo.keys(), todo.values()))

    _swap(spark, path, stage, [fs.inside(path, f) for f in todo], None)
    return out


def size_estimate(df: DataFrame, keys: list[str], row_bytes: int = 1024) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).agg(
        F.sum("rows").alias("total_rows"), F.count("*").alias("partitions"), F.avg("rows").alias("avg_rows"), (F.sum("rows") * row_bytes / 1e6).alias("est_mb")
    )


def manifest(df: DataFrame, keys: list[str] = ["exchange", "symbol"]) -> DataFrame:
    """Hours that there are for each instrument, and their range."""
    hour = F.floor(F.col("ms") / 3_600_000) * 3_600_000
    return df.select(*keys, hour.alias("hour_ms")).distinct().groupBy(*keys).agg(F.count("*").alias("hours"), F.min("hour_ms").alias("first_ms"), F.max("hour_ms").alias("last_ms"))


def not_done(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def mismatched(spark: SparkSession, path: str, expected: dict[str, Column]) -> DataFrame:
    """Rows, with their file, whose partition folder contradicts the value that the row itself implies."""
    bad = F.lit(False)
    for k, v in expected.items():
        bad = bad | ~F.col(k).cast("string").eqNullSafe(v.cast("string"))
    return read(spark, path).filter(bad).withColumn("file", F.col("_metadata.file_path"))


def fix_mismatched(spark: SparkSession, path: str, expected: dict[str, Column], dry_run: bool = False) -> Stats:
    """Moves such rows to the partitions that they imply; folders without them, unless rows come to them, are left alone."""
    recover(spark, path)
    keys, df = partition_keys(spark, path), read(spark, path)
    bad = F.lit(False)
    for k, v in expected.items():
        bad = bad | ~F.col(k).cast("string").eqNullSafe(v.cast("string"))
    touched = _touched(spark, path, df, bad)
    n = sum(touched.values())
    if not touched:
        return Stats(dry_run=dry_run)
    right = lambda d: d.select(*(expected[c].cast(d.schema[c].dataType).alias(c) if c in expected else F.col(c) for c in d.columns))
    moved = right(_folders(spark, path, df.schema, touched).filter(bad))
    to = {tuple(r) for r in moved.select(*(F.col(k).cast("string") for k in keys)).distinct().toLocalIterator()}
    every = sorted(touched.keys() | {f for f in Files(spark, path).folders(path) if values_of(f) in to})
    mine = _folders(spark, path, df.schema, every)
    rows = mine.count()
    if not dry_run:
        _swap(spark, path, _staged(right(mine), keys), every, None)
    return Stats(len(every), rows, rows, n, dry_run=dry_run)


def migrate_symbols(spark: SparkSession, path: str, from_suffix: str, to_suffix: str, column: str = "symbol", dry_run: bool = False) -> Stats:
    """Renames the suffix of a partition column's values (X-USDC to X-USD); rows that already stand under the new name stay beside them.
    Only whole suffixes count: -USD does not match X-USDC."""
    as_text = F.col(column).cast("string")
    renamed = F.when(as_text.endswith(f"-{from_suffix}"), F.concat(F.expr(f"left(cast(`{column}` AS string), length(`{column}`) - {len(from_suffix)})"), F.lit(to_suffix))).otherwise(as_text)
    return fix_mismatched(spark, path, {column: renamed}, dry_run)


def layout_problems(spark: SparkSession, path: str, keys: list[str]) -> list[tuple[str, str]]:
    """(folder, what is wrong) of folders that are not key=value in the order of keys, or that hold no value."""
    out = []
    for f in sorted(Files(spark, path).folders(path)):
        names = [x.split("=", 1)[0] for x in f.split("/") if x] if f else []
        if names != keys:
            out.append((f, f"keys are {names}"))
        elif any(v == "" for v in values_of(f)):
            out.append((f, "a value is empty"))
    return out


def ensure_partition_columns(df: DataFrame, keys: list[str], ms: str = "ms") -> DataFrame:
    """df with missing date parts taken from its time (epoch milliseconds, or capture_ts); other missing keys are an error."""
    missing = [k for k in keys if k not in df.columns]
    if lacking := [k for k in missing if k not in ("year", "month", "day", "hour")]:
        raise ValueError(f"partition columns missing: {lacking}")
    if not missing:
        return df
    if ms not in df.columns and "capture_ts" not in df.columns:
        raise ValueError(f"no time to take {missing} from")
    parts = date_parts(ms if ms in df.columns else F.unix_millis("capture_ts"))
    return df.withColumns({k: parts[k] for k in missing})


def split(df: DataFrame, keys: list[str]) -> Iterable[tuple[tuple, DataFrame]]:
    """(key, rows) of each group, one after the other, null keys too; to work on all groups at once use groupBy or a partitioned write."""
    for r in df.select(*keys).distinct().orderBy(*keys).toLocalIterator():
        own = F.lit(True)
        for k in keys:
            own = own & F.col(k).eqNullSafe(F.lit(r[k]))
        yield tuple(r), df.filter(own)


def broken_files(spark: SparkSession, path: str) -> list[str]:
    """Files that are no whole Parquet files, judged by their marks and the length of their footer. Tasks read the ends of the files only."""
    files = Files(spark, path).list(path)
    if not files:
        return []

    def judge(batches):
        from pyarrow import fs as arrow_fs

        for b in batches:
            bad = []
            for name, n in zip(b["path"], b["size"], strict=True):
                where, own = arrow_fs.FileSystem.from_uri(quote(name, safe=":/"))
                with where.open_input_file(own) as f:
                    head, foot = f.read(4), f.read_at(8, n - 8) if n >= 12 else b""
                bad.append(head != b"PAR1" or foot[4:] != b"PAR1" or not 0 < int.from_bytes(foot[:4], "little") <= n - 12)
            yield b[["path"]][bad]

    d = spark.createDataFrame(files, "path string, size long").repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism))
    return sorted(r.path for r in d.mapInPandas(judge, "path string").collect())


def repair(spark: SparkSession, path: str, source: str | None = None, dry_run: bool = False) -> dict[str, list[str]]:
    """Broken files are fetched anew from the same place below source, or deleted where source has none."""
    fs, out = Files(spark, path), {"fetched": [], "deleted": []}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in broken_files(spark, path):
        own = fs.inside(path, name)
        origin = f"{source.rstrip('/')}/{own}" if source else None
        there = origin is not None and Files(spark, origin).exists(origin)
        out["fetched" if there else "deleted"].append(own)
        if dry_run:
            continue
        fs.delete(f"{path}/{own}")
        if there:
            other = Files(spark, origin)
            jvm.org.apache.hadoop.fs.FileUtil.copy(other.fs, other._path(origin), fs.fs, fs._path(f"{path}/{own}"), False, conf)
    return out


def sync(
    spark: SparkSession, source: str, target: str, suffix: str = ".parquet", skip_existing: bool = True, delete_after: bool = False, dry_run: bool = False,
    pattern: str | None = None, at_once: int = 8, on_file: Callable[[str, int], None] | None = None,
) -> dict[str, int]:
    """Copies files below source (whose path below it holds the regular expression, where given) to the same places below target, between any
    file systems, several at a time; on_file hears of each."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = Files(spark, source), Files(spark, target)
    out = {"copied": 0, "skipped": 0, "bytes": 0}
    todo = []
    for name, size in a.list(source, suffix):
        own = a.inside(source, name)
        if pattern and not re.search(pattern, own):
            continue
        to = f"{target.rstrip('/')}/{own}"
        if skip_existing and b.exists(to):
            out["skipped"] += 1
        else:
            todo.append((name, to, size))

    def one(name: str, to: str, size: int) -> int:
        if not dry_run:
            jvm.org.apache.hadoop.fs.FileUtil.copy(a.fs, a._path(name), b.fs, b._path(to), delete_after, conf)
        if on_file:
            on_file(to, size)
        return size

    with ThreadPoolExecutor(at_once) as pool:
        sizes = list(pool.map(lambda x: one(*x), todo))
    return out | {"copied": len(sizes), "bytes": sum(sizes)}
