"""Keyed tables that readers see before or after a whole publication, never in between.

A publication's folder holds numbered commits. A commit is one small file that names, for every table, the folder that
holds each of its days; it is moved into place at once, and nothing that an earlier commit names is
changed. A merge writes the days it touches into new folders, so until its commit is there, nobody sees
them, whatever breaks.

    <root>/_commits/000000012.json
    <root>/<table>/data/day=2024-01-09/commit=<id>/*.parquet
    <root>/<table>/keys/bucket=17/commit=<id>/*.parquet

A table whose key lacks the day has an index of its keys, with the day and the version of each, in hash
buckets. A merge reads the buckets of the changed keys only, and learns from them which days hold those
keys and which of the new rows are older than what is stored. One publication is written by one run at a time: if two
start from the same commit, the second to end fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetday.operators.quality import duplicate_keys
from fleetday.sources.tables import RepeatedKeys, distinct_days, stage

#: Keys that a bucket of a new index holds on average; an index that outgrows this four times gets more buckets.
BUCKET_KEYS = 500_000
MOST_BUCKETS = 1 << 14


@dataclass
class TableState:
    """What a commit says of one table: its columns, the folder of each day and of each bucket of keys."""

    schema: dict
    day: str
    days: dict[str, str] = field(default_factory=dict)
    buckets: dict[str, str] = field(default_factory=dict)
    n_buckets: int = 0
    n_keys: int = 0


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def commits(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the commits that are there, rising."""
    names = _children(spark, f"{root}/_commits")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _commit_path(root: str, number: int) -> str:
    return f"{root}/_commits/{number:09d}.json"


def tables_of(spark: SparkSession, root: str, number: int) -> dict[str, TableState]:
    text = spark.read.text(_commit_path(root, number), wholetext=True).first()[0]
    return {name: TableState(**state) for name, state in json.loads(text).items()}


def read_days(spark: SparkSession, root: str, table: str, state: TableState, days: list[str] | None = None) -> DataFrame:
    """A table's rows, or those of some of its days, as a commit has them."""
    schema = StructType.fromJson(state.schema)
    base = f"{root}/{table}/data"
    wanted = state.days if days is None else {d: state.days[d] for d in days if d in state.days}
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{base}/{state.day}={d}/commit={c}" for d, c in sorted(wanted.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.names)


def read_published(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame | None:
    """A table as the last commit (or commit `number`) has it; None if it has no such table."""
    if number is None:
        known = commits(spark, root)
        if not known:
            return None
        number = known[-1]
    state = tables_of(spark, root, number).get(table)
    return None if state is None else read_days(spark, root, table, state)


class Conflict(RuntimeError):
    """Another run has published since this one began."""


class Publication:
    """Merges into the tables of a folder; readers see all of them when `commit` returns, or none."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, uuid.uuid4().hex
        known = commits(spark, root)
        self.number = known[-1] if known else 0
        self.tables = tables_of(spark, root, self.number) if known else {}
        self.changed = False

    def read(self, table: str) -> DataFrame | None:
        """The table with what this publication has merged so far."""
        state = self.tables.get(table)
        return None if state is None else read_days(self.spark, self.root, table, state)

    def merge(
        self, table: str, keys: list[str], day: str, updates: DataFrame, deletes: DataFrame | None = None, version: str | None = None
    ) -> None:
        """Insert or replace `updates` by key, then remove the keys of `deletes`.

        Both are read several times, so the caller stages what is costly to compute. With `version`, a
        column of the updates that is not stored in the table, a row replaces a stored one only if its
        version is the same or higher (no version is the lowest). Only the days that changed keys are
        on now or were on before are rewritten.
        """
        if not duplicate_keys(updates, keys).isEmpty():
            raise RepeatedKeys(f"{table}: repeated key in {keys}")
        columns = [c for c in updates.columns if c != version]
        state = self.tables.get(table) or TableState(updates.select(columns).schema.jsonValue(), day)
        gone = updates.select(*keys).limit(0) if deletes is None else deletes.select(*keys).distinct()
        if day in keys:
            accepted = updates.select(columns)
            touched = set(distinct_days(accepted.select(*keys).unionByName(gone), day))
            stored_keys = None
        else:
            stored_keys = _Keys(self, table, state, keys, day)
            updates = stored_keys.accept(updates, gone, version)
            accepted = updates.select(columns)
            touched = stored_keys.days(updates, None if deletes is None else gone)
        if not touched:
            return
        uid = f"{self.id}-{uuid.uuid4().hex[:8]}"  # a table may be merged twice in one publication
        content = accepted.join(gone, keys, "left_anti")
        if touched & set(state.days):
            current = read_days(self.spark, self.root, table, state, sorted(touched))
            kept = current.join(accepted.select(*keys).unionByName(gone), keys, "left_anti")
            content = kept.unionByName(content, allowMissingColumns=True)
        else:
            content = read_days(self.spark, self.root, table, state, []).unionByName(content, allowMissingColumns=True)
        base = f"{self.root}/{table}/data"
        _write(content.hint("rebalance", day), base, day, uid)
        filled = {d for d in touched if _exists(self.spark, f"{base}/{day}={d}/commit={uid}")}
        days = {d: c for d, c in state.days.items() if d not in touched} | dict.fromkeys(filled, uid)
        new = TableState(content.schema.jsonValue(), day, days)
        if stored_keys is not None:
            stored_keys.store(new, updates, gone, version, uid)
        self.tables[table], self.changed = new, True

    def commit(self) -> int:
        """Make the merges visible; returns the number of the commit that readers now get."""
        if not self.changed:
            return self.number
        text = json.dumps({name: asdict(state) for name, state in self.tables.items()})
        number = self.number + 1
        _move_into_place(self.spark, text, f"{self.root}/_commits/.{self.id}", _commit_path(self.root, number))
        self.number, self.changed = number, False
        return number


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the last `keep` commits, and the folders that none of those names.

    Readers of an older commit lose it. Not for use while a publication is being written.
    """
    known = commits(spark, root)
    used = set()
    for number in known[-keep:]:
        for table, state in tables_of(spark, root, number).items():
            used |= {f"{table}/data/{state.day}={d}/commit={c}" for d, c in state.days.items()}
            used |= {f"{table}/keys/bucket={b}/commit={c}" for b, c in state.buckets.items()}
    for number in known[:-keep]:
        _delete(spark, _commit_path(root, number))
    for table in _children(spark, root):
        for kind in ("data", "keys"):
            for part in _children(spark, f"{root}/{table}/{kind}"):
                for folder in _children(spark, f"{root}/{table}/{kind}/{part}") if "=" in part else ():
                    if f"{table}/{kind}/{part}/{folder}" not in used:
                        _delete(spark, f"{root}/{table}/{kind}/{part}/{folder}")


#: What a new row finds in the index: whether its key is there, and its day.
_FOUND, _STORED_DAY = "_found", "_stored_day"


class _Keys:
    """The index of one table's keys: where each key is, and the version of its row."""

    def __init__(self, publication: Publication, table: str, state: TableState, keys: list[str], day: str):
        self.spark, self.table, self.state, self.keys, self.day = publication.spark, table, state, keys, day
        self.base = f"{publication.root}/{table}/keys"
        self.n_buckets = state.n_buckets

    def bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")

    def accept(self, updates: DataFrame, gone: DataFrame, version: str | None) -> DataFrame:
        """The rows of `updates` that are not older than what is stored, each with what it finds in the index.

        Reads the buckets of the changed keys only. The updates meet the index once, and the result is
        staged: days and counts are read from it.
        """
        self.changed_buckets, self.read = [], None
        if self.n_buckets:
            changed = updates.select(*self.keys).unionByName(gone)
            self.changed_buckets = sorted(r[0] for r in changed.select(self.bucket(self.n_buckets).alias("b")).distinct().collect())
            self.read = self._read(self.changed_buckets)
        if self.read is None:
            return updates.withColumns({_FOUND: F.lit(False), _STORED_DAY: F.lit(None).cast("string")})
        stored = self.read.withColumnsRenamed({self.day: _STORED_DAY, "version": "_stored"}).withColumn(_FOUND, F.lit(True))
        joined = updates.join(stored, self.keys, "left").withColumn(_FOUND, F.coalesce(_FOUND, F.lit(False)))
        if version is not None:
            joined = joined.where(F.col("_stored").isNull() | (F.col(version) >= F.col("_stored")))
        return stage(joined.drop("_stored"), f"{self.table}-accepted")

    def days(self, updates: DataFrame, gone: DataFrame | None) -> set[str]:
        """The days that the accepted updates go to, and those that they and the deleted keys were on."""
        at = updates.select(F.col(self.day).cast("string").alias(self.day))
        if self.read is not None:
            at = at.unionByName(updates.where(_FOUND).select(F.col(_STORED_DAY).alias(self.day)))
            if gone is not None:
                at = at.unionByName(self.read.join(gone, self.keys, "left_semi").select(self.day))
        return set(distinct_days(at, self.day))

    def _read(self, buckets: list[int]) -> DataFrame | None:
        named = [(b, self.state.buckets[str(b)]) for b in buckets if str(b) in self.state.buckets]
        if not named:
            return None
        paths = [f"{self.base}/bucket={b}/commit={c}" for b, c in named]
        return self.spark.read.option("basePath", self.base).parquet(*paths).drop("bucket", "commit").select(*self.keys, F.col(self.day).cast("string").alias(self.day), "version")

    def store(self, new: TableState, updates: DataFrame, gone: DataFrame, version: str | None, uid: str) -> None:
        """Write the buckets of the changed keys anew, or all of them if they have become too full."""
        kind = "timestamp_ntz" if self.read is None else self.read.schema["version"].dataType
        own = F.lit(None).cast(kind) if version is None else F.col(version)
        kept = updates.join(gone, self.keys, "left_anti")
        rows = kept.select(*self.keys, F.col(self.day).cast("string").alias(self.day), own.alias("version"))
        changed = updates.select(*self.keys).unionByName(gone)
        # a key that is there already is replaced by its row, or deleted
        deleted = 0 if self.read is None else self.read.join(gone, self.keys, "left_semi").count()
        new.n_keys = self.state.n_keys - deleted + kept.where(~F.col(_FOUND)).count()
        new.n_buckets, new.buckets, old = self.n_buckets, dict(self.state.buckets), self.read
        if not new.n_buckets or (new.n_keys > 4 * BUCKET_KEYS * new.n_buckets and new.n_buckets < MOST_BUCKETS):
            new.n_buckets = min(MOST_BUCKETS, 1 << max(0, (new.n_keys // BUCKET_KEYS).bit_length()))
            old, rewritten = self._read([int(b) for b in self.state.buckets]), range(new.n_buckets)
        else:
            rewritten = self.changed_buckets
        if old is not None:
            rows = old.join(changed, self.keys, "left_anti").unionByName(rows)
        _write(rows.withColumn("bucket", self.bucket(new.n_buckets)).hint("rebalance", "bucket"), self.base, "bucket", uid)
        written = {str(b) for b in rewritten if _exists(self.spark, f"{self.base}/bucket={b}/commit={uid}")}
        if new.n_buckets != self.n_buckets:
            new.buckets = {}
        new.buckets = {b: c for b, c in new.buckets.items() if int(b) not in set(rewritten)} | dict.fromkeys(written, uid)


def _write(rows: DataFrame, base: str, part: str, uid: str) -> None:
    dated = rows.withColumn("commit", F.lit(uid))
    dated.write.option("compression", "zstd").partitionBy(part, "commit").mode("append").parquet(base)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _move_into_place(spark: SparkSession, text: str, temporary: str, final: str) -> None:
    """One file, whole or not at all, and never in the place of another."""
    fs, source = _file_system(spark, temporary)
    out = fs.create(source, True)
    out.write(bytearray(text.encode()))
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(final)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(spark._jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        files.rename(source, target, options)
    except Exception as e:
        fs.delete(source, False)
        if fs.exists(target):
            raise Conflict(f"{final} was published meanwhile") from e
        raise
