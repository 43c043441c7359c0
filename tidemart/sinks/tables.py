"""Table writes: staged Parquet, and catalog tables whose partitions point to folders.

* ``stage_parquet`` (W1/W2): staged extract files, optionally capped per file
  and laid out by window keys.
* ``PartitionTable`` (W7-W12, J4): an external catalog table. New content of
  partitions is written by one job to a fresh folder; when it is complete, the
  catalog is told where each partition now is (``ALTER TABLE ... SET LOCATION``
  for those it has, one ``ADD PARTITION`` for all new ones, one ``DROP
  PARTITION`` for all emptied ones). Data files are never overwritten, so a
  reader finds every partition either old or new at any moment, and a run that
  stops leaves whole partitions; the same run again finishes the work.
  ``vacuum`` removes folders that no partition points to any more.
* ``DayTable``: partitioned by the day of a stamp. Days are replaced, reloaded
  or deleted; deleting starts no Spark job.
* ``HourTable``: partitioned by a load window's date and hour.
* ``KeyTable``: a current image in hash buckets of its key. A merge reads the
  key and stamp of the buckets its source falls in, rewrites only buckets in
  which a row really changes, and appends to buckets that only get new keys.
* ``ImageTable``: unpartitioned; a new image takes the table's place with one
  ``ALTER TABLE ... SET LOCATION``.
* ``write_incremental`` (W11): create when the catalog lacks the table, else
  replace the given days.

Bulk writes are rebalanced by partition first: every task writes few folders
(no tasks x days small-file blow-up) and a hot day is split over several
tasks instead of landing in one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import as_date
from ..operators.merge import merge
from ..session import scratch_path

DAY_COLUMN = "dt"
BUCKET_COLUMN = "bucket"
#: Partitions named in one catalog statement.
STATEMENT_PARTITIONS = 1000
#: Of the files of tables and of rows stored for several steps.
COMPRESSION = "zstd"
#: Spark's name of the folder of a NULL partition, and the characters it escapes in folder names.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


def stage_parquet(df: DataFrame, path: str, max_records_per_file: int | None = None,
                  partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Write staged Parquet (W1/W2). An empty DataFrame still leaves a
    readable schema behind."""
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


@contextmanager
def stored_once(df: DataFrame, name: str, spark: SparkSession | None = None) -> Iterator[DataFrame]:
    """``df`` written to a fresh shared folder: evaluated once, read by several steps (of another session, if given), removed after them."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.option("compression", COMPRESSION).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def _folder_of(spark: SparkSession, path: str) -> tuple:
    """Spark's file system of the path, and the path as an object of it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder_of(spark, path)
    files.delete(folder, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by one listing."""
    files, folder = _folder_of(spark, path)
    return [f.getPath().getName() for f in files.listStatus(folder)]


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> None:
    """Create-or-replace a catalog table from a query."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Create-or-replace a (session) view; returns the view's DataFrame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _columns_sql(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _member(column: str, values: Iterable) -> Column:
    """Membership in which NULL is a value like any other; without NULL a predicate that prunes partitions."""
    values = set(values)
    named = F.col(column).isin(sorted(v for v in values if v is not None))
    return F.coalesce(named, F.lit(False)) | F.col(column).isNull() if None in values else named


class ImageTable:
    """An unpartitioned external table whose whole content is replaced at once."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, df: DataFrame) -> None:
        """The table's content from a query, which may read the table itself."""
        folder = f"{self.path}/load-{uuid.uuid4().hex[:12]}"
        df.write.parquet(folder)
        if self.exists():
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
            self.spark.catalog.refreshTable(self.name)
        else:
            self.spark.sql(f"CREATE TABLE {self.name} ({_columns_sql(df)}) USING parquet LOCATION '{folder}'")


class LoadRejected(ValueError):
    """A load failed its checks: its files are gone and the table is as it was."""


class PartitionTable:
    """External Parquet table whose partitions are replaced by pointing them to fresh folders."""

    #: Partition columns in order; rows passed to the methods below with an underscore have them.
    columns: tuple[str, ...] = ()
    #: Checks by name that every load has to pass before the catalog learns of it: each gives the rows that fail.
    checks: dict[str, Callable[[DataFrame], DataFrame]] = {}
    #: Value of a partition column from its text in a folder's name.
    parse: Callable = staticmethod(str)

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")

    # ------------------------------------------------------------- helpers
    def _folder(self, values: tuple) -> str:
        """The folder (and catalog name) of a partition below a load."""
        def text(v) -> str:
            return NULL_FOLDER if v is None else "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(v))
        return "/".join(f"{c}={text(v)}" for c, v in zip(self.columns, values, strict=True))

    def _spec(self, values: tuple) -> str:
        return "PARTITION (" + ", ".join(f"{c} = {_literal(v)}" for c, v in zip(self.columns, values, strict=True)) + ")"

    def _statement(self, action: str, parts: Sequence[str], between: str) -> None:
        for lo in range(0, len(parts), STATEMENT_PARTITIONS):
            self.spark.sql(f"ALTER TABLE {self.name} {action} {between.join(parts[lo:lo + STATEMENT_PARTITIONS])}")

    def _balanced(self, df: DataFrame, sort_key: str | None) -> DataFrame:
        """Shuffle by partition with AQE rebalancing, then cluster each file.

        ``REBALANCE`` hash-partitions by the partition columns; AQE splits a
        partition that is too large (a hot day goes to several writers) and
        merges small ones (few folders per writer). Unlike a range
        repartition it needs no sampling pass over the upstream plan.
        """
        return df.hint("rebalance", *self.columns).sortWithinPartitions(*self.columns, *([sort_key] if sort_key else []))

    def _raw(self) -> DataFrame:
        return self.spark.table(self.name)

    # ------------------------------------------------------------- catalog
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def partitions(self) -> set[str]:
        """Names of the partitions in the catalog (a bounded list: one short name each)."""
        return {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()} if self.exists() else set()

    def read(self) -> DataFrame:
        return self._raw().drop(*self.columns)

    def _load(self, rows: DataFrame, sort_key: str | None, max_records_per_file: int | None = None, judged: bool = False) -> tuple[str, set[tuple]]:
        """Rows written to a fresh folder by one job; the folder, and the partitions it fills (its own subfolders).
        They have to pass the checks, unless they have been judged."""
        folder = f"{self.path}/load-{uuid.uuid4().hex[:12]}"
        (self._balanced(rows, sort_key).write.options(maxRecordsPerFile=str(max_records_per_file or 0), compression=COMPRESSION)
         .partitionBy(*self.columns).parquet(folder))
        names = [""]
        for column in self.columns:
            names = [f"{top}/{n}" for top in names for n in _children(self.spark, folder + top) if n.startswith(f"{column}=")]
        if self.checks and names and not judged:
            try:
                self._check(self.spark.read.schema(rows.schema).parquet(folder))
            except LoadRejected:
                _delete(self.spark, folder)
                raise
        return folder, {self._values(n[1:]) for n in names}

    def _check(self, written: DataFrame) -> None:
        """Runs the checks on rows that are written: they read the columns they need, the source is not scanned again."""
        failed = {name: n for name, check in self.checks.items() if (n := check(written).count())}
        if failed:
            raise LoadRejected(f"load of {self.name} rejected: " + ", ".join(f"{name} fails for {n}" for name, n in failed.items()))

    def _values(self, name: str) -> tuple:
        """The values in a partition's name."""
        texts = [unquote(part.split("=", 1)[1]) for part in name.split("/")]
        return tuple(None if t == NULL_FOLDER else self.parse(t) for t in texts)

    def _create(self, rows: DataFrame) -> None:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_columns_sql(rows)}) USING parquet "
                       f"PARTITIONED BY ({', '.join(self.columns)}) LOCATION '{self.path}'")

    def _point(self, folder: str, filled: Iterable[tuple]) -> None:
        """The partitions are from now on where the load has put them: one statement for all new ones, one for each other."""
        held, new = self.partitions(), []
        for values in sorted(filled, key=self._folder):
            place = f"{folder}/{self._folder(values)}"
            if self._folder(values) in held:
                self.spark.sql(f"ALTER TABLE {self.name} {self._spec(values)} SET LOCATION '{place}'")
            else:
                new.append(f"{self._spec(values)} LOCATION '{place}'")
        self._statement("ADD IF NOT EXISTS", new, " ")
        self.spark.catalog.refreshTable(self.name)

    def _replace(self, rows: DataFrame, listed: Iterable[tuple], sort_key: str | None = None,
                 max_records_per_file: int | None = None, judged: bool = False) -> set[tuple]:
        """Partitions that ``rows`` fills are replaced; of the listed ones, those it does not fill go."""
        folder, filled = self._load(rows, sort_key, max_records_per_file, judged)
        self._create(rows)
        self._point(folder, filled)
        self._drop(set(listed) - filled)
        return filled

    def _drop(self, values: Iterable[tuple]) -> None:
        held = self.partitions()
        self._statement("DROP IF EXISTS", [self._spec(v) for v in sorted(values, key=self._folder) if self._folder(v) in held], ", ")

    def vacuum(self) -> int:
        """Removes loads that no partition points to; how many. Only while no reader of an older state is running."""
        used = {part for name in self._raw().inputFiles() for part in name.split("/") if part.startswith("load-")}
        old = [n for n in _children(self.spark, self.path) if n.startswith("load-") and n not in used]
        for name in old:
            _delete(self.spark, f"{self.path}/{name}")
        return len(old)


class DayTable(PartitionTable):
    """Table partitioned by the UTC day ``dt`` of ``day_source`` (hidden on read).

    With ``granularity="month"`` the days of a month share a partition, named
    by its first day: for tables whose days are far smaller than a file should
    be (thousands of files of a few rows each cost more than their rows). Days
    are replaced and deleted in both layouts; a month's other days are then
    written again with them.
    """

    columns = (DAY_COLUMN,)
    parse = staticmethod(as_date)

    def __init__(self, spark: SparkSession, name: str, path: str, day_source: str, granularity: str = "day"):
        if granularity not in ("day", "month"):
            raise ValueError(f"unknown granularity: {granularity}")
        super().__init__(spark, name, path)
        self.day_source, self.monthly = day_source, granularity == "month"

    def _day(self) -> Column:
        return F.to_date(F.col(self.day_source))

    def _with_day(self, df: DataFrame) -> DataFrame:
        return df.withColumn(DAY_COLUMN, F.trunc(self._day(), "month") if self.monthly else self._day())

    def _part(self, day: dt.date | None) -> dt.date | None:
        """The partition of a day."""
        return day.replace(day=1) if self.monthly and day is not None else day

    def read(self, days=None) -> DataFrame:
        """Rows of the table; listed days prune partitions in the catalog."""
        df = self._raw()
        if days is not None:
            listed = _dates(days)
            df = df.filter(_member(DAY_COLUMN, map(self._part, listed)))
            if self.monthly:
                df = df.filter(self._day().isin(listed))
        return df.drop(DAY_COLUMN)

    def create(self, df: DataFrame, sort_key: str | None = None) -> None:
        """Bootstrap: the whole table from a query (CTAS); of an older table, days without rows go."""
        self._replace(self._with_day(df), {self._values(name) for name in self.partitions()}, sort_key)

    def replace_days(self, df: DataFrame, days=None, sort_key: str | None = None) -> None:
        """Rows of the listed days are replaced by the query's rows.

        Listed days the query has no rows for are emptied. Query rows of
        days not listed are added (MERGE ON FALSE inserts all of them).
        ``days=None`` replaces exactly the days the query has rows for; rows
        without a day count as one more day there. The query runs once.
        """
        rows = self._with_day(df)
        if not self.exists():
            self._replace(rows, [], sort_key)
        elif self.monthly:
            self._replace_in_months(rows, days, sort_key)
        elif days is None:
            self._replace(rows, [], sort_key)
        else:
            self._replace_listed(rows, {(d,) for d in _dates(days)}, sort_key)

    def _replace_listed(self, rows: DataFrame, listed: set[tuple], sort_key: str | None) -> None:
        folder, filled = self._load(rows, sort_key)
        held = self.partitions()
        strays = [v for v in filled - listed if self._folder(v) in held]
        self._point(folder, filled - set(strays))
        self._drop(listed - filled)
        if strays:
            added = self.spark.read.schema(rows.schema).option("basePath", folder).parquet(*[f"{folder}/{self._folder(v)}" for v in strays])
            added.select(*self._raw().columns).write.insertInto(self.name)

    def _replace_in_months(self, rows: DataFrame, days, sort_key: str | None) -> None:
        with stored_once(rows, "staged-days", self.spark) as staged:
            filled = staged.select(DAY_COLUMN, self._day().alias("d")).distinct().collect()  # at most one row per day
            listed = {r["d"] for r in filled} if days is None else set(_dates(days))
            touched = {r[DAY_COLUMN] for r in filled} | set(map(self._part, listed))
            old = self._raw().filter(_member(DAY_COLUMN, touched))
            kept = old.filter(~F.coalesce(self._day().isin([d for d in listed if d]), F.lit(False)) & (F.lit(None not in listed) | self._day().isNotNull()))
            whole = kept.unionByName(staged)  # the months as they will be, all of it written rows
            if self.checks and not whole.isEmpty():
                self._check(whole)  # before they are shuffled and written: a refused load costs its stage alone
            self._replace(whole, {(m,) for m in touched}, sort_key, judged=True)

    def reload_day(self, df: DataFrame, day, sort_key: str | None = None) -> None:
        """Delete-then-insert of one day, as one change of its location."""
        self.replace_days(df, [day], sort_key)

    def delete_days(self, days) -> None:
        """Remove the rows of the listed days, by the catalog alone where days have partitions of their own."""
        if self.monthly:
            self.replace_days(self.read().limit(0), days)
        else:
            self._drop({(d,) for d in _dates(days)})


class HourTable(PartitionTable):
    """Table partitioned by the load window's date and hour, which its rows carry as text."""

    columns = ("load_date", "load_hour")

    def replace_hours(self, rows: DataFrame, hours: Iterable[tuple[str, str]], max_records_per_file: int | None = None) -> None:
        """The listed (date, hour) windows hold exactly these rows."""
        self._replace(rows, set(hours), max_records_per_file=max_records_per_file)

    def hours(self) -> set[tuple[str, str]]:
        """Every window the table has."""
        return {self._values(name) for name in self.partitions()}


class KeyTable(PartitionTable):
    """Current image with one row per key, in ``buckets`` hash buckets of the key.

    The number of buckets is fixed with the table: the image's bytes divided
    by what one task should rewrite (some 256 MB).
    """

    columns = (BUCKET_COLUMN,)
    parse = staticmethod(int)

    def __init__(self, spark: SparkSession, name: str, path: str, key: str = "id", buckets: int = 16):
        super().__init__(spark, name, path)
        self.key, self.buckets = key, buckets

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """NULL keys never match, so they are spread over all buckets; a row that is in the table keeps its bucket."""
        hashed = F.when(F.col(self.key).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(self.key))
        return df.withColumn(BUCKET_COLUMN, F.pmod(hashed, F.lit(self.buckets)).cast("int"))

    def create(self, df: DataFrame, sort_key: str | None = None) -> None:
        """The whole image from a query, which may read the table; every bucket is replaced."""
        self.replace_buckets(self.with_bucket(df), range(self.buckets), sort_key)

    def bucket_rows(self, buckets: Iterable[int]) -> DataFrame:
        return self._raw().filter(F.col(BUCKET_COLUMN).isin(sorted(buckets)))

    def replace_buckets(self, rows: DataFrame, buckets: Iterable[int], sort_key: str | None = None) -> None:
        """The listed buckets hold exactly these rows, which carry their bucket."""
        self._replace(rows, {(b,) for b in buckets}, sort_key)

    def merge(self, source: DataFrame, version_col: str | None = None, update_columns: Sequence[str] | None = None,
              sort_key: str | None = None) -> dict[str, list[int]]:
        """MERGE ``source`` into the table; the buckets that were rewritten and those that were appended to.

        The source is written once. Its rows meet the keys and stamps of the
        buckets they fall in, and rows that the version guard refuses leave.
        Buckets with an updated row are merged and replaced; buckets that get
        new keys alone are appended to without reading their other columns. A
        replayed guarded merge finds nothing to do.
        """
        if not self.exists():
            self.create(source, sort_key)
            return {"rewritten": list(range(self.buckets)), "appended": []}
        key = self.key
        if version_col is not None and version_col not in source.columns:
            raise ValueError(f"version column {version_col!r} missing")
        with stored_once(self.with_bucket(source), "merge-source", self.spark) as rows:
            if not rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty():
                raise ValueError(f"source has more than one row for some {key}")
            met = [r[0] for r in rows.select(BUCKET_COLUMN).distinct().collect()]  # at most one row per bucket
            stamp = F.col(version_col) if version_col else F.lit(None)
            held = self.bucket_rows(met).filter(F.col(key).isNotNull()).select(
                F.col(key).alias("__key"), stamp.alias("__stamp"), F.lit(True).alias("__held"))
            new = F.col("__held").isNull()
            takes_effect = new | (F.coalesce(F.col("__stamp") < F.col(version_col), F.lit(False)) if version_col else F.lit(True))
            judged = rows.join(held, F.col(key) == F.col("__key"), "left").filter(takes_effect).withColumn("__new", new)
            with stored_once(judged.drop("__key", "__stamp", "__held"), "merge-effective") as changes:
                kinds = changes.groupBy(BUCKET_COLUMN).agg(F.bool_and("__new").alias("new")).collect()  # one row per bucket
                rewritten = sorted(r[BUCKET_COLUMN] for r in kinds if not r["new"])
                appended = sorted(r[BUCKET_COLUMN] for r in kinds if r["new"])
                if rewritten:
                    own = changes.filter(F.col(BUCKET_COLUMN).isin(rewritten)).drop("__new")
                    image = merge(self.bucket_rows(rewritten), own, key=key, update_columns=update_columns, check_unique=False)
                    self.replace_buckets(image, rewritten, sort_key)
                if appended:
                    own = changes.filter(F.col(BUCKET_COLUMN).isin(appended))
                    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._raw().schema.fields if f.name not in own.columns]
                    self._balanced(own.select("*", *missing), sort_key).select(*self._raw().columns).write.insertInto(self.name)
        return {"rewritten": rewritten, "appended": appended}

    def _load(self, rows: DataFrame, sort_key: str | None, max_records_per_file: int | None = None, judged: bool = False) -> tuple[str, set[tuple]]:
        return super()._load(rows, sort_key or self.key, max_records_per_file, judged)


def _dates(days) -> list:
    if isinstance(days, (str, dt.date)):
        days = [days]
    return [as_date(d) for d in days]


def write_incremental(table: DayTable, df: DataFrame, days=None, sort_key: str | None = None) -> str:
    """Create the table if the catalog lacks it, else replace the listed days."""
    if not table.exists():
        table.create(df, sort_key)
        return "created"
    table.replace_days(df, days, sort_key)
    return "replaced"
