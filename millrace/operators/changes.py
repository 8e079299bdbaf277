"""Change tables: versions, change feed, restore and expiry on append-only parquet.

A change table is a folder with three parquet data sets:

* ``changes/_commit_version=n`` - the row changes of version n, with ``_change_type``
  (``insert``, ``update_preimage``, ``update_postimage``, ``delete``) and
  ``_commit_timestamp``. It is only ever appended to, so it is also the change feed.
* ``base/_version=n`` - the full content as of version n, written by a fold.
* ``commits`` - one row per finished commit. A version exists for readers once its
  row is there, so a job that dies half way leaves nothing visible, to feed streams neither.
  The row also has the version's change counts, taken while its files were written.
* ``constraints`` - the table's CHECK constraints, one row per addition or removal.

Keys identify rows; NULL is a key like any other. A commit with two inserts or after-images
for one key, an insert of a key that is present, or a row that breaks a constraint is
refused as a whole.

Each table has one writer at a time; there is no concurrency control. Reads cost one
pass over the base plus work on the changes since, so a table with many commits
should be folded now and then (``fold_every`` does it while committing).
"""

from __future__ import annotations

import datetime as dt

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import BROADCAST_BYTES, checked_broadcast, row_bytes
from millrace.operators.latest import latest_per_key
from millrace.operators.merge import merge_changes
from millrace.session import read_if_present
from millrace.sources.versions import version_stream

# versions read by naming their folders, rather than by a filter on all of them
NAMED_FOLDERS = 1_000
# fixed value: shortest retention that needs no force
RETENTION_HOURS = 7 * 24

_COMMITS = (
    T.StructType()
    .add("version", T.LongType())
    .add("committed_at", T.TimestampType())
    .add("operation", T.StringType())
    .add("writer", T.StringType())
    .add("batch", T.LongType())
    .add("is_base", T.BooleanType())
    .add("changes_so_far", T.LongType())
    .add("rows_inserted", T.LongType())
    .add("rows_updated", T.LongType())
    .add("rows_deleted", T.LongType())
    .add("key_bytes_so_far", T.LongType())
)
_COUNTS = {"rows_inserted": "insert", "rows_updated": "update_postimage", "rows_deleted": "delete"}
_CONSTRAINTS = "seq BIGINT, name STRING, condition STRING"


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join on keys that may be NULL."""
    renamed = right.select([F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])  # a broadcast hint stays on it
    return left.join(renamed, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]), how)


def diff_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The row changes that turn ``old`` into ``new``; keys identify rows in both.

    One full outer join; an update yields its two images. Values compare null-safely.
    """
    columns = old.columns
    before = old.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                        F.struct(*columns).alias("_before"))
    after = new.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)],
                       F.struct(*columns).alias("_after"))
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}"))
    pairs = before.join(after, same, "full_outer").where(~F.col("_before").eqNullSafe(F.col("_after")))

    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    images = (
        F.when(F.col("_before").isNull(), F.array(image("insert", "_after")))
        .when(F.col("_after").isNull(), F.array(image("delete", "_before")))
        .otherwise(F.array(image("update_preimage", "_before"), image("update_postimage", "_after")))
    )
    return pairs.select(F.explode(images).alias("_image")).select(
        *[F.col(f"_image.row.`{c}`").alias(c) for c in columns],
        F.col("_image.kind").alias("_change_type"),
    )


class ChangeTable:
    """A keyed table kept as its row changes; see the module text for the layout."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str],
                 fold_every: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.columns = self.schema.fieldNames()
        self.keys = list(keys)
        self.fold_every = fold_every

    # -- commits ---------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Finished commits, folds and expiries, one row each."""
        return read_if_present(self.spark, f"{self.path}/commits", _COMMITS)

    def _record(self, version: int, operation: str, writer: str | None, batch: int | None,
                is_base: bool, at: dt.datetime, changes_so_far: int, key_bytes_so_far: int,
                counts: dict[str, int] | None = None) -> None:
        counted = [(counts or {}).get(name, 0) for name in _COUNTS]
        values = [version, at, operation, writer, batch, is_base, changes_so_far, *counted, key_bytes_so_far]
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, _COMMITS.fields)]
        )
        row.write.mode("append").parquet(f"{self.path}/commits")

    def _state(self, upto: int | None = None, writer: str | None = None, batch: int | None = None):
        """What the commits (by ``upto``) say, as one row.

        Newest version, newest fold and expiry, a writer's earlier commit, the number of change
        rows so far, and how many bytes of keys changed up to the newest version, the base and version 1.
        """
        is_commit = ~F.col("is_base")
        in_range = F.lit(True) if upto is None else F.col("version") <= upto
        mine = (F.col("writer") == F.lit(writer)) & (F.col("batch") == F.lit(batch))

        def newest(condition, column="version"):
            return F.coalesce(F.max(F.when(condition, F.col(column))), F.lit(0))

        return self.commits().agg(
            newest(is_commit).alias("newest"),
            newest(F.col("is_base") & in_range).alias("base"),
            newest(F.col("operation") == "EXPIRE").alias("expired"),
            newest(mine).alias("done"),
            newest(is_commit & in_range, "changes_so_far").alias("changes"),
            newest(is_commit & in_range, "key_bytes_so_far").alias("key_bytes"),
            newest(F.col("is_base") & in_range, "key_bytes_so_far").alias("key_bytes_to_base"),
            newest(is_commit & (F.col("version") == 1), "key_bytes_so_far").alias("key_bytes_to_first"),
        ).first()

    def version(self) -> int:
        """Newest version; 0 before the first commit."""
        return self._state().newest

    def commit(self, changes: DataFrame, operation: str, writer: str | None = None,
               batch: int | None = None, at: dt.datetime | None = None) -> int:
        """Append ``changes`` as the next version and return its number.

        A micro-batch replayed after a failure names the same ``writer`` and ``batch``
        and is then skipped. A version whose write did not finish is written over.
        """
        state = self._state(writer=writer, batch=batch)
        if state.done:
            return state.done
        version = state.newest + 1
        at = at or dt.datetime.now(dt.timezone.utc)
        folder = f"{self.path}/changes/_commit_version={version}"
        seen = Observation()
        rows = changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], "_change_type").observe(
            seen, F.count(F.lit(1)).alias("all"), F.sum(self._key_bytes()).alias("key_bytes"),
            *[F.count_if(F.col("_change_type") == kind).alias(name) for name, kind in _COUNTS.items()])
        rows.withColumn("_commit_timestamp", F.lit(at)).write.mode("overwrite").parquet(folder)
        counts = seen.get
        self._check(self.spark.read.schema(self._feed_schema()).parquet(folder), state.newest, operation)
        self._record(version, operation, writer, batch, False, at, state.changes + counts["all"],
                     state.key_bytes + (counts["key_bytes"] or 0), counts)
        if self.fold_every and version - max(state.base, 1) >= self.fold_every:
            self.fold(version)
        return version

    def _key_bytes(self) -> Column:
        return row_bytes(T.StructType([self.schema[k] for k in self.keys]))

    def _check(self, written: DataFrame, newest: int, operation: str) -> None:
        """Refuse a version that breaks a rule; without its commit row it does not exist."""
        stored = written.where("_change_type IN ('insert', 'update_postimage')")
        twice = stored.groupBy(self.keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
        if twice is not None:
            key = {k: twice[k] for k in self.keys}
            raise ValueError(f"{operation}: several source rows would write one row key, for example {key}")
        if newest and operation in self._plain_inserts:
            present = join_keys(stored, self.current(), self.keys, "left_semi").first()
            if present is not None:
                key = {k: present[k] for k in self.keys}
                raise ValueError(f"{operation}: a row with this key exists already, for example {key}")
        broken = [(name, F.coalesce(~F.expr(condition), F.lit(False))) for name, condition in self.constraints().items()]
        if broken:
            found = stored.agg(*[F.count_if(failed).alias(f"_c{i}") for i, (_, failed) in enumerate(broken)]).first()
            failed = {name: found[i] for i, (name, _) in enumerate(broken) if found[i]}
            if failed:
                raise ValueError(f"{operation}: rows break constraints: {failed}")

    #: operations that add rows without looking at those present
    _plain_inserts = ("WRITE",)

    # -- constraints -----------------------------------------------------------

    def constraints(self) -> dict[str, str]:
        """The table's constraints by name."""
        log = read_if_present(self.spark, f"{self.path}/constraints", _CONSTRAINTS)
        newest = log.groupBy("name").agg(F.max_by("condition", "seq").alias("condition"), F.max("seq").alias("seq"))
        return {r["name"]: r["condition"] for r in newest.orderBy("seq").collect() if r["condition"]}

    def _log_constraint(self, name: str, condition: str) -> None:
        log = read_if_present(self.spark, f"{self.path}/constraints", _CONSTRAINTS)
        seq = (log.agg(F.max("seq")).first()[0] or 0) + 1
        row = self.spark.range(0, 1, 1, 1).select(F.lit(seq).cast("bigint").alias("seq"), F.lit(name).alias("name"), F.lit(condition).alias("condition"))
        row.write.mode("append").parquet(f"{self.path}/constraints")

    def add_constraint(self, name: str, condition: str) -> None:
        """Check ``condition`` in every later commit; refused if rows present now break it. NULL passes."""
        if name in self.constraints():
            raise ValueError(f"constraint {name} exists already")
        if self.version() and not self.current().where(~F.expr(condition)).isEmpty():
            raise ValueError(f"rows present break constraint {name}")
        self._log_constraint(name, condition)

    def drop_constraint(self, name: str) -> None:
        if name not in self.constraints():
            raise ValueError(f"no constraint {name}")
        self._log_constraint(name, "")

    def insert(self, rows: DataFrame, operation: str = "WRITE", **commit) -> int:
        """Add rows whose keys are new."""
        return self.commit(rows.withColumn("_change_type", F.lit("insert")), operation, **commit)

    def delete(self, doomed: DataFrame, operation: str = "DELETE", **commit) -> int:
        """Remove ``doomed``, which are rows of the current content."""
        return self.commit(doomed.withColumn("_change_type", F.lit("delete")), operation, **commit)

    def merge(self, source: DataFrame, on, matched=(), not_matched=(), operation: str = "MERGE", **commit) -> int:
        changes = merge_changes(self.current(), source, on, matched, not_matched)
        return self.commit(changes, operation, **commit)

    def replace_with(self, rows: DataFrame, operation: str = "OVERWRITE", **commit) -> int:
        """Make ``rows`` the content, recording only what differs."""
        return self.commit(diff_changes(self.current(), rows, self.keys), operation, **commit)

    # -- reads -----------------------------------------------------------------

    def _feed_schema(self) -> T.StructType:
        extra = T.StructType.fromDDL("_change_type STRING, _commit_timestamp TIMESTAMP, _commit_version BIGINT")
        return T.StructType(self.schema.fields + extra.fields)

    def _changes(self, after: int, upto: int) -> DataFrame:
        """Change rows of the versions ``after < v <= upto``.

        Naming the folders gives the planner the size of just these versions.
        """
        root, schema = f"{self.path}/changes", self._feed_schema()
        if upto <= after:
            return self.spark.createDataFrame([], schema)
        if upto - after > NAMED_FOLDERS:
            version = F.col("_commit_version")
            return self.spark.read.schema(schema).parquet(root).where((version > after) & (version <= upto))
        folders = [f"{root}/_commit_version={v}" for v in range(after + 1, upto + 1)]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders)

    def _version_at(self, moment: dt.datetime) -> int:
        seen = self.commits().where(~F.col("is_base") & (F.col("committed_at") <= F.lit(moment)))
        return seen.agg(F.max("version")).first()[0] or 0

    def touched(self, after: int, upto: int) -> DataFrame:
        """Keys that changed in the versions ``after < v <= upto``."""
        expired = self._state().expired
        if upto > after and after < expired:
            raise ValueError(f"the changes up to version {expired} have expired")
        return self._changes(after, upto).select(self.keys).distinct()

    def feed(self, start: int | dt.datetime = 1, end: int | dt.datetime | None = None) -> DataFrame:
        """The change feed between two versions or two moments, both included."""
        state = self._state()
        last = state.newest if end is None else end if isinstance(end, int) else self._version_at(end)
        first = start if isinstance(start, int) else self._version_at(start - dt.timedelta(microseconds=1)) + 1
        if state.expired and first <= state.expired:
            raise ValueError(f"the change feed up to version {state.expired} has expired")
        return self._changes(first - 1, min(last, state.newest))

    def feed_stream(self, start: int = 1, types: list[str] | None = None, most_versions: int | None = None) -> DataFrame:
        """The change feed as a stream of committed versions from ``start``, which must not have expired.

        ``most_versions`` bounds how many a micro-batch takes. See ``millrace.sources.versions``.
        """
        expired = self._state().expired
        if expired and start <= expired:
            raise ValueError(f"the change feed up to version {expired} has expired")
        feed = version_stream(self.spark, self.path, self._feed_schema(), start, most_versions)
        return feed if types is None else feed.where(F.col("_change_type").isin(types))

    def as_of(self, version: int | None = None, timestamp: dt.datetime | None = None) -> DataFrame:
        """Content at a version, or at the newest version committed by ``timestamp``.

        The base - the newest fold, or version 1, which can only hold inserts - without
        the keys that changed since, plus the newest change of each of those. Changes
        are few next to the base, so their keys broadcast and the base is scanned
        without a shuffle.
        """
        if version is None and timestamp is not None:
            version = self._version_at(timestamp)
        state = self._state(upto=version)
        version = state.newest if version is None else version
        if version > state.newest:
            raise ValueError(f"version {version} does not exist yet")
        if version < state.expired:
            raise ValueError(f"version {version} has expired")
        if state.base:
            base, since = state.base, state.key_bytes - state.key_bytes_to_base
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/base/_version={base}")
        else:
            base, since = min(version, 1), state.key_bytes - state.key_bytes_to_first
            rows = self._changes(0, base)
        rows = rows.select(self.columns)
        if version == base:
            return rows
        changes = self._changes(base, version).where("_change_type <> 'update_preimage'")
        newest = latest_per_key(changes, self.keys, [F.col("_commit_version").desc()])
        live = newest.where("_change_type <> 'delete'").select(self.columns)
        touched = self.touched(base, version)
        touched = F.broadcast(touched) if since <= BROADCAST_BYTES else touched
        return join_keys(rows, touched, self.keys, "left_anti").select(self.columns).unionByName(live)

    def current(self) -> DataFrame:
        return self.as_of()

    def history(self) -> DataFrame:
        """One row per version with its operation and its change counts, also of expired versions."""
        return self.commits().where("NOT is_base").select("version", "committed_at", "operation", *_COUNTS)

    # -- maintenance -----------------------------------------------------------

    def net_changes(self, other: DataFrame, keys: DataFrame) -> DataFrame:
        """The changes that turn the current content into ``other``, looking at ``keys`` only."""
        keys = checked_broadcast(keys)
        ours = join_keys(self.current(), keys, self.keys, "left_semi")
        return diff_changes(ours, join_keys(other, keys, self.keys, "left_semi"), self.keys)

    def restore(self, version: int, **commit) -> int:
        """Bring back an older content as a new version.

        Only keys that changed since that version are compared.
        """
        keys = self.touched(version, self.version())
        return self.commit(self.net_changes(self.as_of(version), keys), "RESTORE", **commit)

    def fold(self, version: int | None = None) -> int:
        """Write the full content of a version, so later reads start from there."""
        state = self._state(upto=version)
        version = state.newest if version is None else version
        if state.base != version:
            self.as_of(version).write.mode("overwrite").parquet(f"{self.path}/base/_version={version}")
            self._record(version, "FOLD", None, None, True, dt.datetime.now(dt.timezone.utc), state.changes, state.key_bytes)
        return version

    def expire(self, older_than_hours: float = RETENTION_HOURS, force: bool = False,
               now: dt.datetime | None = None) -> int:
        """Drop what only versions older than the limit need; returns the oldest kept one.

        Fewer than seven days is refused unless forced. Afterwards the older versions
        can no longer be read, and neither can their part of the change feed. The rows
        are gone from storage: their files are overwritten with empty ones.
        """
        if older_than_hours < RETENTION_HOURS and not force:
            raise ValueError(f"retention below {RETENTION_HOURS} hours needs force=True")
        now = now or dt.datetime.now(dt.timezone.utc)
        oldest = self._version_at(now - dt.timedelta(hours=older_than_hours))
        state = self._state(upto=oldest)
        expired = state.expired
        if oldest <= expired:
            return max(expired, 1)
        self.fold(oldest)
        self._record(oldest, "EXPIRE", None, None, True, now, state.changes, state.key_bytes)
        stale = self.commits().where(F.col("version").between(expired, oldest) & (F.col("operation") != "EXPIRE"))
        for version, is_base in stale.select("version", "is_base").distinct().collect():
            if not is_base:
                self._empty(self._feed_schema(), f"changes/_commit_version={version}")
            elif version < oldest:
                self._empty(self.schema, f"base/_version={version}")
        return oldest

    def _empty(self, schema: T.StructType, folder: str) -> None:
        columns = [f for f in schema.fields if f.name != "_commit_version"]
        nothing = self.spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in columns])
        nothing.write.mode("overwrite").parquet(f"{self.path}/{folder}")


def sync_copy(source: DataFrame | ChangeTable, copy: ChangeTable) -> int:
    """Bring an independent full copy up to date; the first run copies everything.

    A copy of a change table then only looks at the keys that changed since the last
    run, unless the source has expired since; any other source is compared as a whole.
    """
    if isinstance(source, DataFrame):
        return copy.replace_with(source, operation="CLONE")
    seen = copy.commits().where("operation = 'CLONE'").agg(F.max("batch")).first()[0]
    newest = source.version()
    if seen is None or seen < source._state().expired:  # what changed since is no longer known
        changes = diff_changes(copy.current(), source.current(), copy.keys)
    else:
        changes = copy.net_changes(source.current(), source.touched(seen, newest))
    return copy.commit(changes, "CLONE", writer="clone", batch=newest)


def lost_rows(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Distinct rows of one version that another no longer has."""
    return older.subtract(newer)
