"""A table that keeps its versions, as Parquet folders.

``path/data/_version=N`` holds the rows written by commit N and
``path/commits`` one small record per commit, with the schema of its rows. A
version counts only once its record exists, so a write that died half-way is
never read, and the next commit replaces it. One writer at a time; any number
of readers. Since the schemas are recorded, no read opens files to find them.

A commit only appends the rows it brings; it joins nothing. Rows that repeat a
key are refused: the keys just written are counted before the commit's record
is made, so a refused commit is never read. A read takes the versions since the
last whole one (an overwrite or a compaction) and keeps each key's newest row,
by ``order`` if the table has one and then by version.

With ``buckets``, rows are laid out by a hash of their key, and beside each
version stands a summary: per bucket the number of rows and two sums of row
hashes. Two states are compared by their summaries first; only buckets whose
summaries differ are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.operators import changelog
from macrospark.operators.dedupe import any_null
from macrospark.operators.select import stack
from macrospark.sources.inline import inline_table
from macrospark.sources.sinks import _exists

COMMIT = "version INT, kind STRING, committed_at TIMESTAMP, batch STRING, schema STRING"
WHOLE = ("overwrite", "compact")
SUMMARY = "_version INT, bucket INT, rows BIGINT, low DECIMAL(38,0), high DECIMAL(38,0)"
_BUCKET = "_bucket_of_"
# Fixed value: default retention.
KEEP_HOURS = 168


# The wider types that a type may become; a column's type never narrows.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_WIDER = {a: _WHOLE[i + 1 :] for i, a in enumerate(_WHOLE)} | {T.FloatType: (T.DoubleType,), T.DateType: (T.TimestampNTZType,)}
_WIDER |= {a: (*_WIDER[a], T.FloatType, T.DoubleType) for a in (T.ByteType, T.ShortType)}
_WIDER |= {a: (*_WIDER[a], T.DoubleType) for a in (T.IntegerType, T.LongType)}
# Digits of whole numbers, for decimals that are to hold them.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type has its place in the new one (a long as a double may lose digits)."""
    if old == new or isinstance(old, T.NullType):
        return True
    if isinstance(new, T.DecimalType):
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return type(old) in _DIGITS and new.precision - new.scale >= _DIGITS[type(old)]
    return type(new) in _WIDER.get(type(old), ())


def widened(before: T.StructType, after: T.StructType) -> T.StructType:
    """The columns of both; a column that both have takes the wider type, and types that are neither are an error."""
    fields = {f.name: f for f in before}
    for field in after:
        old = fields.get(field.name)
        if old is None or widens(old.dataType, field.dataType):
            fields[field.name] = field
        elif not widens(field.dataType, old.dataType):
            raise ValueError(f"{field.name} cannot go from {old.dataType.simpleString()} to {field.dataType.simpleString()}")
    return T.StructType(list(fields.values()))


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        order: Sequence[str] = (),
        buckets: int | None = None,
    ):
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.partition_by = list(partition_by)
        self.order = list(order)
        self.buckets = buckets
        # the number is part of the name, so versions of another layout are noticed
        self._bucket = f"{_BUCKET}{buckets}" if buckets else None

    # Commits ------------------------------------------------------------------

    def commits(self) -> DataFrame:
        folder = f"{self.path}/commits"
        if not _exists(self.spark, folder):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(folder)

    def _until(self, version: int | None = None, at: datetime | None = None) -> DataFrame:
        """Commits up to a version or a moment."""
        commits = self.commits()
        if version is not None:
            commits = commits.filter(F.col("version") <= version)
        if at is not None:
            limit = at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)
            commits = commits.filter(F.col("committed_at") <= F.lit(limit))
        return commits

    def _records(self, version: int | None = None, at: datetime | None = None) -> list:
        """The commits that make up a state: those since the last whole version, and no others."""
        commits = self._until(version, at)
        whole = commits.filter(F.col("kind").isin(*WHOLE)).agg(F.max("version")).first()[0]
        if whole is not None:
            commits = commits.filter(F.col("version") >= whole)
        records = sorted(commits.collect(), key=lambda r: r.version)
        if not records or (version is not None and records[-1].version != version):
            raise ValueError(f"{self.path} has no version {'that old' if version is None else version}")
        return records

    def exists(self) -> bool:
        return not self.commits().isEmpty()

    def _commit(self, rows: DataFrame, kind: str, at: datetime | None, batch: str | None = None) -> int:
        last = self.last_version()
        version = 0 if last is None else last + 1
        if last is not None and kind == "merge":
            self._refuse_narrowing(rows.schema)
        at = at or datetime.now(timezone.utc)
        rows = rows.withColumn("_committed_at", F.lit(at).cast("timestamp"))
        folders = list(self.partition_by)
        if self._bucket:
            rows = rows.withColumn(self._bucket, self._bucket_of())
            folders.insert(0, self._bucket)
        if last is not None:
            self._refuse_layout(last)
        # a compaction has dealt its rows already
        written = rows.hint("rebalance", *folders) if folders and kind != "compact" else rows
        writer = written.write.mode("overwrite").option("partitionOverwriteMode", "static")
        folder = f"{self.path}/data/_version={version}"
        writer.partitionBy(*folders).parquet(folder)
        if kind != "compact":
            self._refuse_repeats(self.spark.read.schema(rows.schema).parquet(folder))
        if self._bucket:
            self._summarise(self.spark.read.schema(rows.schema).parquet(folder), version)
        record = inline_table(self.spark, [(version, kind, at, batch, rows.schema.json())], COMMIT)
        record.coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return version

    def _refuse_narrowing(self, schema: T.StructType) -> None:
        """A merge may add columns and widen types; what it cannot say of earlier rows it may not change."""
        known = T.StructType([])
        for record in self._records():
            known = widened(known, T.StructType.fromJson(json.loads(record.schema)))
        now = {f.name: f.dataType for f in known}
        for field in schema:
            if field.name in now and not widens(now[field.name], field.dataType):
                raise ValueError(f"{field.name} would narrow from {now[field.name].simpleString()} to {field.dataType.simpleString()}")

    def _bucket_of(self) -> Column:
        """A row's bucket; null keys, which equal nothing, share one."""
        number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")
        return F.when(any_null(self.keys), F.lit(self.buckets)).otherwise(number)

    def _refuse_layout(self, last: int) -> None:
        record = self.commits().filter(F.col("version") == last).first()
        found = [f.name for f in T.StructType.fromJson(json.loads(record.schema)) if f.name.startswith(_BUCKET)]
        if found != ([self._bucket] if self._bucket else []):
            raise ValueError(f"{self.path} is laid out by {found or 'no buckets'}; open it with the same number")

    def _summarise(self, rows: DataFrame, version: int) -> None:
        """Rows of each bucket and sums of their hashes, which no order of rows changes."""
        data = sorted(c for c in rows.columns if c not in changelog.BOOKKEEPING and c != self._bucket)
        # a hash passes over nulls, so it is told where they are
        cells = [cell for c in data for cell in (F.lit(c), F.col(c).isNull(), F.col(c))]

        def total(hashed: Column) -> Column:
            return F.sum(hashed.cast("decimal(38,0)")).cast("decimal(38,0)")

        found = rows.groupBy(F.col(self._bucket).alias("bucket")).agg(
            F.count("*").alias("rows"),
            total(F.xxhash64(*cells)).alias("low"),
            total(F.xxhash64(F.lit(1), *reversed(cells))).alias("high"),
        )
        found.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/summaries/_version={version}")  # a row per bucket

    def _differing(self, before: Sequence, after: Sequence) -> list[int] | None:
        """Buckets whose summaries differ between two states; None if they cannot tell.

        A state's bucket is told by what its versions brought to it, in their
        order: the rows of a key depend on nothing else.
        """
        schemas = [T.StructType.fromJson(json.loads(r.schema)) for r in (*before, *after)]
        if any(self._bucket not in s.names or [s[k].dataType for k in self.keys] != [schemas[0][k].dataType for k in self.keys] for s in schemas):
            return None

        def brought(records: Sequence, name: str) -> DataFrame:
            folders = [f"{self.path}/summaries/_version={r.version}" for r in records]
            parts = self.spark.read.schema(SUMMARY).option("basePath", f"{self.path}/summaries").parquet(*folders)
            steps = F.sort_array(F.collect_list(F.struct("_version", "rows", "low", "high")))  # a step per commit
            return parts.groupBy("bucket").agg(F.transform(steps, lambda s: s.dropFields("_version")).alias(name))

        both = brought(before, "old").join(brought(after, "new"), "bucket", "full")
        # null keys match nothing, not even themselves, so their bucket always differs
        differs = ~F.col("old").eqNullSafe(F.col("new")) | (F.col("bucket") == self.buckets)
        return sorted(r.bucket for r in both.filter(differs).select("bucket").collect())  # at most one per bucket

    def _refuse_repeats(self, rows: DataFrame) -> None:
        """Reads key columns only; a null key equals nothing, so it may come several times."""
        keyed = rows.select(*self.keys).filter(~any_null(self.keys))
        repeated = keyed.groupBy(*self.keys).agg(F.count("*").alias("_rows")).filter("_rows > 1").first()
        if repeated is not None:
            key = {k: repeated[k] for k in self.keys}
            raise ValueError(f"{repeated['_rows']} rows have the key {key}; one row per key is needed")

    def overwrite(self, df: DataFrame, at: datetime | None = None) -> int:
        """Replace the whole table; earlier versions stay readable."""
        return self._commit(df, "overwrite", at)

    def upsert(self, source: DataFrame, at: datetime | None = None, batch: str | None = None) -> int:
        """Update rows whose key is known, insert the others; the first write creates the table.

        A source that repeats a key is refused. A ``batch`` that was committed
        before is not written again.
        """
        if batch is not None:
            known = self.commits().filter(F.col("batch") == batch).first()
            if known is not None:
                return known.version
        return self._commit(source, "merge", at, batch)

    # Reads --------------------------------------------------------------------

    def _scan(self, records: Sequence, buckets: Sequence[int] | None = None) -> DataFrame:
        """Log rows of the records, of some buckets if told; a column that came later is null in earlier ones."""
        merged, groups = T.StructType([]), {}
        for record in records:
            own = T.StructType.fromJson(json.loads(record.schema))
            merged = widened(merged, own)
            groups.setdefault(record.schema, (own, []))[1].append(f"{self.path}/data/_version={record.version}")
        cast = {f.name: f.dataType for f in merged}

        def part(own: T.StructType, folders: list[str]) -> DataFrame:
            rows = self.spark.read.schema(T.StructType([*own.fields]).add("_version", T.IntegerType())).option("basePath", f"{self.path}/data").parquet(*folders)
            if buckets is not None:
                rows = rows.filter(F.col(self._bucket).isin(*buckets) if buckets else F.lit(False))
            rows = rows.drop(*[f.name for f in own if f.name.startswith(_BUCKET)])
            return rows.withColumns({f.name: F.col(f.name).cast(cast[f.name]) for f in own if f.dataType != cast[f.name]})

        # One scan, unless a column's type was widened: then one for each run of types.
        if all(f.dataType == cast[f.name] for own, _ in groups.values() for f in own):
            whole = T.StructType([T.StructField(f.name, f.dataType) for f in merged])
            return part(whole, [folder for _, folders in groups.values() for folder in folders])
        return stack([part(own, folders) for own, folders in groups.values()])

    def read(self, version: int | None = None, at: datetime | None = None, partitions: Column | None = None) -> DataFrame:
        """The newest state, or the state after a version or at a moment.

        ``partitions`` is a condition on partition columns that follow from the
        key (the year of a month, the category of a series): all rows of a key
        agree in it, so it is applied to the scan, ahead of choosing rows.
        """
        return self._state(self._records(version, at), partitions)

    def _state(self, needed: Sequence, partitions: Column | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        log = self._scan(needed, buckets)
        if partitions is not None:
            log = log.filter(partitions)
        # one version has one row per key
        return changelog.resolve(log, self.keys, order=self.order) if len(needed) > 1 else log.drop(*changelog.BOOKKEEPING)

    def last_version(self) -> int | None:
        return self.commits().agg(F.max("version")).first()[0]

    def changes(self, after: int | None = None) -> DataFrame:
        """The rows that commits after a version brought (all commits, without one); compactions bring none."""
        commits = self.commits().filter((F.col("version") > (-1 if after is None else after)) & (F.col("kind") != "compact"))
        records = sorted(commits.collect(), key=lambda r: r.version)  # the commits since then
        return self._scan(records) if records else self.read().limit(0)

    def history(self, n: int | None = None) -> DataFrame:
        """Commits, newest first, with the rows each inserted, updated and wrote."""
        there = self._folders()
        kept = [r for r in sorted(self.commits().collect(), key=lambda r: r.version) if f"_version={r.version}" in there]
        whole = [r.version for r in kept if r.kind in WHOLE]
        counts = changelog.history(self._scan(kept), self.keys, whole).withColumnRenamed("_version", "version")
        listed = self.commits().drop("batch", "schema").join(counts, "version", "left")
        listed = listed.fillna(0, ["inserted", "updated", "total"]).orderBy(F.desc("version"))
        return listed if n is None else listed.limit(n)

    def _folders(self) -> set[str]:
        """Names of the versions' folders, by one listing."""
        data = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        return {status.getPath().getName() for status in data.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(data)}

    def register(self, name: str) -> None:
        """Let SQL text read any past state: ``name_at(version)`` and ``name_asof(moment)``, over the view ``name_log``.

        A row of the log is part of the states from its commit up to the next
        whole version. The functions know the commits made so far; register
        again after more.
        """
        there = self._folders()
        kept = [r for r in sorted(self.commits().collect(), key=lambda r: r.version) if f"_version={r.version}" in there]
        whole = [r for r in kept if r.kind in WHOLE]
        ends = [(r.version, next(((w.version, w.committed_at) for w in whole if w.version > r.version), (None, None))) for r in kept]
        spans = inline_table(self.spark, [(v, *end) for v, end in ends], "_version INT, _hidden_from INT, _hidden_at TIMESTAMP")
        log = self._scan(kept).join(spans, "_version")  # a row per commit
        log.withColumn("_apart", changelog._apart(self.keys)).createOrReplaceTempView(f"{name}_log")
        hidden = (*changelog.BOOKKEEPING, *spans.columns)
        columns = [f for f in log.schema if f.name not in hidden]
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        row = ", ".join(f"'{f.name}', `{f.name}`" for f in columns)
        keys = ", ".join(f"`{k}`" for k in [*self.keys, "_apart"])
        newest = ", ".join(f"`{c}`" for c in [*self.order, "_version"])
        for function, argument, seen in (
            (f"{name}_at", "_at_version INT", "_version <= _at_version AND (_hidden_from IS NULL OR _at_version < _hidden_from)"),
            (f"{name}_asof", "_at_moment TIMESTAMP", "_committed_at <= _at_moment AND (_hidden_at IS NULL OR _at_moment < _hidden_at)"),
        ):
            self.spark.sql(f"""
                CREATE OR REPLACE TEMPORARY FUNCTION {function}({argument}) RETURNS TABLE ({shape})
                RETURN SELECT state.* FROM (
                  SELECT max_by(named_struct({row}), struct({newest})) AS state FROM {name}_log WHERE {seen} GROUP BY {keys})""")

    def compare(self, old: int, new: int) -> DataFrame:
        """Keys added, removed or changed between an earlier and a later version."""
        before, after = self._records(old), self._records(new)
        buckets = self._differing(before, after) if self._bucket else None
        if old <= new and not self.order and before[0].version == after[0].version:
            return changelog.log_diff(self._scan(after, buckets), self.keys, old, new)
        return changelog.state_diff(self._state(before, buckets=buckets), self._state(after, buckets=buckets), self.keys)

    def row_counts(self, versions: Sequence[int]) -> DataFrame:
        """Number of rows the table had after each of the versions."""
        groups: dict[int, tuple[list, list[int]]] = {}
        for version in sorted(set(versions)):
            needed = self._records(version)
            _, members = groups.get(needed[0].version, (None, []))
            groups[needed[0].version] = (needed, [*members, version])
        return stack([changelog.state_counts(self._scan(r), self.keys, members) for r, members in groups.values()])

    # Maintenance --------------------------------------------------------------

    def compact(self, cluster_by: Sequence[str] | None = None, at: datetime | None = None) -> int:
        """Write the current state as one sorted version with few files; rows do not change."""
        cols = list(cluster_by or self.keys)
        dealt = [self._bucket_of(), *cols] if self._bucket else cols
        return self._commit(self.read().repartitionByRange(*dealt).sortWithinPartitions(*dealt), "compact", at)

    def expire(self, keep_hours: int = KEEP_HOURS, now: datetime | None = None) -> list[int]:
        """Delete versions that no state of the last ``keep_hours`` needs; returns them.

        Those are the versions before the last whole version committed by then,
        so a table that was never compacted or overwritten keeps everything.
        """
        cutoff = (now or datetime.now(timezone.utc)) - timedelta(hours=keep_hours)
        cutoff = cutoff if cutoff.tzinfo else cutoff.replace(tzinfo=timezone.utc)
        whole = self._until(at=cutoff).filter(F.col("kind").isin(*WHOLE)).agg(F.max("version")).first()[0]
        if whole is None:
            return []
        gone = []
        for (version,) in self._until(whole - 1).select("version").orderBy("version").collect():
            summary = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/summaries/_version={version}")
            summary.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(summary, True)
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/_version={version}")
            if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True):
                gone.append(version)
        return gone
