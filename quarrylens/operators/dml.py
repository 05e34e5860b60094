"""Tables that change: inserts, updates, deletes and merges write the parts of a table that they touch, then a new version's list of parts.

A version is a list of Parquet folders that are never changed, each of one part of the table's layout (ranges, hashes, lists or both). An insert adds
folders; the other statements rewrite only the parts that have rows they change. Readers see the version before or after a statement, former versions stay
readable by name or by time, and a statement whose version another writer has overtaken fails rather than lose what that one wrote.
Triggers see a statement's rows as they were and as they are to be.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..plans.cut import row_numbers, settled
from ..sources import runs

DELETE, INSERT, UPDATE = "DELETE", "INSERT", "UPDATE"


class ConcurrentChange(RuntimeError):
    """Another writer has made a version since this statement read the table."""


# -- layouts ------------------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Layout:
    """The part of a row, from its columns: a text of letters, digits and a few signs."""

    part: Callable[[], Column]

    def of(self) -> Column:
        return F.regexp_replace(F.coalesce(self.part().cast("string"), F.lit("null")), "[^A-Za-z0-9.-]", "_")


def by_list(column: str) -> Layout:
    return Layout(lambda: F.col(column))


def by_range(column: str, bounds: list | None = None, interval: str | int | None = None) -> Layout:
    """Ranges up to given bounds (VALUES LESS THAN; the last is open), or of an interval: a number, or a unit of time such as month."""
    if interval is None:
        below = lambda: reduce(lambda a, b: a + b, [F.coalesce((F.col(column) >= F.lit(b)).cast("int"), F.lit(0)) for b in bounds], F.lit(0))
        return Layout(lambda: F.when(F.col(column).isNotNull(), below()))
    if isinstance(interval, str):
        return Layout(lambda: F.date_format(F.date_trunc(interval, F.col(column)), "yyyy-MM-dd"))
    return Layout(lambda: F.floor(F.col(column) / interval) * interval)


def by_hash(columns: list[str], parts: int) -> Layout:
    return Layout(lambda: F.pmod(F.xxhash64(*columns), F.lit(parts)))


def composite(outer: Layout, inner: Layout) -> Layout:
    return Layout(lambda: F.concat(outer.of(), F.lit("-"), inner.of()))


WHOLE = Layout(lambda: F.lit("all"))


def bucketed(rows: DataFrame, name: str, columns: list[str], buckets: int, path: str) -> DataFrame:
    """rows as a table of hash buckets: tables of equal buckets join on those columns without an exchange."""
    rows.write.bucketBy(buckets, *columns).sortBy(*columns).option("path", path).mode("overwrite").saveAsTable(name)
    return rows.sparkSession.table(name)


# -- triggers -----------------------------------------------------------------------------------------------------------------
@dataclass
class Trigger:
    """What happens around statements; any timing point may be left out. Points of one trigger share `state`, which is new for each statement.

    Rows are expressions: old("c") and new("c") are columns, null where there is none. before_row gives new values by column; check
    gives (condition, message), and a row for which a condition is true refuses the whole statement; after_row gives the columns of a row for `into`.
    """

    events: frozenset[str] = frozenset({DELETE, INSERT, UPDATE})
    of: tuple[str, ...] = ()  # an update counts only if one of these columns changes
    when: Callable[..., Column] | None = None
    before_statement: Callable[[dict], None] | None = None
    before_row: Callable[..., dict[str, Column]] | None = None
    check: Callable[..., list[tuple[Column, str]]] | None = None
    after_row: Callable[..., dict[str, Column]] | None = None
    into: ChangingTable | None = None
    after_statement: Callable[[dict, DataFrame], None] | None = None

    def fires(self) -> Column:
        out = F.col("op").isin(*self.events)
        if self.of:
            changed = reduce(lambda a, b: a | b, [~_old(c).eqNullSafe(_new(c)) for c in self.of])
            out = out & ((F.col("op") != UPDATE) | changed)
        return out if self.when is None else out & F.coalesce(self.when(_old, _new), F.lit(False))


def _old(name: str) -> Column:
    return F.col(f"old.{name}")


def _new(name: str) -> Column:
    return F.col(f"new.{name}")


# -- tables -------------------------------------------------------------------------------------------------------------------
class ChangingTable:
    def __init__(self, spark: SparkSession, root: str, name: str, layout: Layout = WHOLE, triggers: list[Trigger] | None = None):
        self.spark, self.root, self.name, self.layout, self.triggers = spark, root.rstrip("/"), name, layout, triggers if triggers is not None else []
        self.folder = f"{self.root}/{self.name}"

    # versions
    def history(self) -> list[dict]:
        """All versions, oldest first: n, run_version, schema, folders ([part, path] each) and notes."""
        fs, path = runs._fs(self.spark, self.folder)
        if not fs.exists(path(f"{self.folder}/log")):
            return []
        rows = self.spark.read.text(f"{self.folder}/log/*.json", wholetext=True).collect()  # a line for each version
        return sorted((json.loads(r.value) for r in rows), key=lambda v: v["n"])

    def _version(self, version: str | None = None, as_of: datetime | None = None) -> dict:
        if version is None and as_of is None:  # the log's last entry; latest.json may be behind where a writer broke off
            fs, path = runs._fs(self.spark, self.folder)
            log = path(f"{self.folder}/log")
            names = [s.getPath().toString() for s in fs.listStatus(log)] if fs.exists(log) else []
            if not names:
                raise FileNotFoundError(f"no version of {self.name} below {self.root}")
            return json.loads(self.spark.read.text(max(names), wholetext=True).first().value)
        at = [v for v in self.history() if (v["run_version"] == version if version else v["run_version"] <= runs.run_version(as_of))]
        if not at:
            raise LookupError(f"{self.name} has no version {version or as_of}")
        return at[-1]

    def _commit(self, before: dict | None, folders: list[list[str]], schema: StructType, **notes) -> str:
        """The next version, made only if none has been made since `before`: the log's entry is moved into place, which fails if it is there."""
        n, version = (before["n"] + 1 if before else 0), runs.run_version()
        entry = {"n": n, "run_version": version, "schema": schema.json(), "folders": folders, "notes": notes}
        fs, path = runs._fs(self.spark, self.folder)
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        new, final = path(f"{self.folder}/new/{version}"), path(f"{self.folder}/log/{n:010d}.json")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        fs.mkdirs(final.getParent())
        none = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        none[0] = jvm.Options.Rename.NONE
        try:
            jvm.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(new, final, none)
        except Exception as taken:
            if not fs.exists(final):
                raise
            raise ConcurrentChange(f"{self.name} has a newer version than {before and before['run_version']}") from taken
        runs.point(self.spark, self.folder, {"stage": self.name, "run_version": version, "tables": {self.name: schema.json()}, "version": entry})
        return version

    def _rows(self, version: dict, parts: set[str] | None = None, without: set[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(version["schema"]))
        paths = [p for part, p in version["folders"] if (parts is None or part in parts) and p not in (without or ())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _written(self, rows: DataFrame) -> list[list[str]]:
        """rows as new folders, one for each part that they have."""
        at = f"{self.folder}/data/{runs.run_version()}"
        if self.layout is WHOLE:
            rows.write.parquet(at)
            return [["all", at]]
        rows.withColumn("_part", self.layout.of()).hint("rebalance", "_part").write.partitionBy("_part").parquet(at)
        fs, path = runs._fs(self.spark, at)
        return [[s.getPath().getName().removeprefix("_part="), s.getPath().toString()] for s in fs.listStatus(path(at)) if s.isDirectory()]

    def write(self, rows: DataFrame, **notes) -> str:
        """Makes rows the table's newest version; its name."""
        try:
            before = self._version()
        except FileNotFoundError:
            before = None
        return self._commit(before, self._written(rows), rows.schema, **notes)

    def read(self, version: str | None = None, as_of: datetime | None = None) -> DataFrame:
        """The newest version, a former one by name, or the one of a time (flashback)."""
        return self._rows(self._version(version, as_of))

    def changes_between(self, first: str, last: str, key: list[str]) -> DataFrame:
        """(op, old, new): the rows that differ between two versions, by key; only folders that one of them lacks are read. Null keys are keys."""
        a, b = self._version(first), self._version(last)
        both = {p for _, p in a["folders"]} & {p for _, p in b["folders"]}
        old, new = (self._rows(v, without=both).select(F.struct("*").alias(side), *[F.col(k).alias(f"_{side}{i}") for i, k in enumerate(key)]) for v, side in ((a, "old"), (b, "new")))
        same = reduce(lambda x, y: x & y, [F.col(f"_old{i}").eqNullSafe(F.col(f"_new{i}")) for i in range(len(key))])
        j = old.withColumn("_o", F.lit(True)).join(new.withColumn("_n", F.lit(True)), same, "full")
        op = F.when(F.col("_o").isNull(), INSERT).when(F.col("_n").isNull(), DELETE).otherwise(UPDATE)
        columns = [c for c in StructType.fromJson(json.loads(b["schema"])).names if c in StructType.fromJson(json.loads(a["schema"])).names]
        differs = F.col("_o").isNull() | F.col("_n").isNull() | reduce(lambda x, y: x | y, [~_old(c).eqNullSafe(_new(c)) for c in columns])
        return j.filter(differs).select(op.alias("op"), "old", "new")

    def versions_between(self, first: str, last: str, key: list[str]) -> DataFrame:
        """VERSIONS BETWEEN: (version, op, row's columns) for each change of a row, of the version that made it; deleted rows as they were."""
        entries = [v["run_version"] for v in self.history() if first <= v["run_version"] <= last]
        steps = [self.changes_between(a, b, key).select(F.lit(b).alias("version"), "op", F.when(F.col("op") == DELETE, F.col("old")).otherwise(F.col("new")).alias("row")) for a, b in zip(entries, entries[1:], strict=False)]
        if not steps:
            return self.read(first).limit(0).select(F.lit("").alias("version"), F.lit("").alias("op"), "*")
        return reduce(lambda a, b: a.unionByName(b), steps).select("version", "op", "row.*")

    # statements
    def _statement(self, before: dict, changes: DataFrame, kept: DataFrame | None, parts: set[str]) -> tuple[str, DataFrame]:
        """Triggers, then rows: parts are rewritten from what is kept of them and the new rows. changes: (op, old, new)."""
        states = [{} for _ in self.triggers]
        schema = StructType.fromJson(json.loads(before["schema"]))
        for t, state in zip(self.triggers, states, strict=True):
            if t.before_statement:
                t.before_statement(state)
        for t, state in zip(self.triggers, states, strict=True):
            if t.before_row:
                given = t.before_row(_old, _new, state)
                new = F.struct(*[F.when(t.fires(), given[f.name]).otherwise(_new(f.name)).cast(f.dataType).alias(f.name) if f.name in given else _new(f.name).alias(f.name) for f in schema.fields])
                changes = changes.withColumn("new", F.when(F.col("op") != DELETE, new))
        if self.triggers:
            changes = settled(changes)
        for t, state in zip(self.triggers, states, strict=True):
            for bad, message in t.check(_old, _new, state) if t.check else []:
                if not changes.filter(t.fires() & F.coalesce(bad, F.lit(False))).isEmpty():
                    raise ValueError(message)
        rows = changes.filter(F.col("op") != DELETE).select("new.*")
        written = self._written(rows if kept is None else kept.unionByName(rows))
        version = self._commit(before, [f for f in before["folders"] if f[0] not in parts] + written, schema)
        for t, state in zip(self.triggers, states, strict=True):
            if t.after_row:
                made = t.after_row(_old, _new, state)
                t.into.insert(changes.filter(t.fires()).select(*[c.alias(n) for n, c in made.items()]))
            if t.after_statement:
                t.after_statement(state, changes)
        return version, changes

    def _struct(self, values: dict[str, Column], schema: StructType) -> Column:
        return F.struct(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])

    def _touched(self, rows: DataFrame) -> set[str]:
        if self.layout is WHOLE:
            return set() if rows.isEmpty() else {"all"}
        return {r[0] for r in rows.select(self.layout.of()).distinct().collect()}  # a row for each part

    def insert(self, rows: DataFrame, defaults: dict[str, Column] | None = None) -> str:
        """Rows are added in folders of their own; columns they lack take their default, else null."""
        before, defaults = self._version(), defaults or {}
        schema = StructType.fromJson(json.loads(before["schema"]))
        new = rows.select(*[(F.col(f.name) if f.name in rows.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schema.fields])
        whole = F.struct("*")
        return self._statement(before, new.select(F.lit(INSERT).alias("op"), F.lit(None).cast(schema).alias("old"), whole.alias("new")), None, set())[0]

    def update(self, changes: dict[str, Column], where: Column) -> tuple[str, DataFrame]:
        """Sets columns where the condition is true; the version and the changed rows as they are now."""
        before, hit = self._version(), F.coalesce(where, F.lit(False))
        now = self._rows(before)
        parts = self._touched(now.filter(hit))
        at = self._rows(before, parts)
        changed = at.filter(hit).select(F.lit(UPDATE).alias("op"), F.struct("*").alias("old"), self._struct(changes, now.schema).alias("new"))
        version, done = self._statement(before, changed, at.filter(~hit), parts)
        return version, done.select("new.*")

    def delete(self, where: Column) -> str:
        """Rows where the condition is null stay."""
        before, hit = self._version(), F.coalesce(where, F.lit(False))
        now = self._rows(before)
        parts = self._touched(now.filter(hit))
        at = self._rows(before, parts)
        gone = at.filter(hit).select(F.lit(DELETE).alias("op"), F.struct("*").alias("old"), F.lit(None).cast(now.schema).alias("new"))
        return self._statement(before, gone, at.filter(~hit), parts)[0]

    def truncate(self) -> str:
        before = self._version()
        return self._commit(before, [], StructType.fromJson(json.loads(before["schema"])))

    def add_column(self, name: str, kind: str, default: Column | None = None) -> str:
        """Without a default only the version's columns change: rows written before have null. With one, rows are written anew."""
        before = self._version()
        schema = StructType([*StructType.fromJson(json.loads(before["schema"])).fields, *StructType.fromDDL(f"{name} {kind}").fields])
        if default is None:
            return self._commit(before, before["folders"], schema)
        return self._commit(before, self._written(self._rows(before).withColumn(name, default.cast(kind))), schema)

    def merge(self, source: DataFrame, on: list[str], matched: dict[str, Column] | None = None, not_matched: dict[str, Column] | None = None, delete_where: Column | None = None) -> str:
        """Columns of the table are named t.x and those of the source s.x. Null keys match nothing.

        Two source rows for one row of the table are an error, as it would not be clear which counts. Parts without a matched row stay as they are.
        """
        before = self._version()
        now = self._rows(before)
        same = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])
        twice = source.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").join(now.select(*on), on, "left_semi")
        if not twice.isEmpty():
            raise ValueError("the source has several rows for one row of the table")
        parts = self._touched(now.join(source.select(*on), on, "left_semi"))
        j = self._rows(before, parts).alias("t").join(source.withColumn("_s", F.lit(True)).alias("s"), same, "left")
        old = F.struct(*[F.col(f"t.{f.name}").alias(f.name) for f in now.schema.fields])
        values = lambda given, plain: F.struct(*[given.get(f.name, plain(f.name)).cast(f.dataType).alias(f.name) for f in now.schema.fields])
        gone = F.lit(False) if delete_where is None else F.coalesce(delete_where, F.lit(False))
        kept = j.filter("_s is null").select("t.*")
        changes = j.filter("_s is not null").select(F.when(gone, DELETE).otherwise(UPDATE).alias("op"), old.alias("old"), F.when(~gone, values(matched or {}, lambda c: F.col(f"t.{c}"))).alias("new"))
        if not_matched is not None:
            alone = source.alias("s").join(now.select(*on).alias("t"), same, "left_anti")
            changes = changes.unionByName(alone.select(F.lit(INSERT).alias("op"), F.lit(None).cast(now.schema).alias("old"), values(not_matched, lambda c: F.lit(None)).alias("new")))
        return self._statement(before, changes, kept, parts)[0]


@dataclass
class GroupedView:
    """A materialized view: base's rows by group, kept in a table of its own. A refresh computes the groups that changed since the last, and no others."""

    base: ChangingTable
    key: list[str]
    group: list[str]
    measures: list[Column]
    table: ChangingTable
    refreshed: list[DataFrame] = field(default_factory=list)

    def _computed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.group).agg(*self.measures)

    def refresh(self) -> str:
        version = self.base._version()["run_version"]
        entries = self.table.history()
        if not entries:
            return self.table.write(self._computed(self.base.read(version)), base=version)
        last = entries[-1]["notes"]["base"]
        changed = self.base.changes_between(last, version, self.key)
        sides = [changed.filter(F.col(side).isNotNull()).select(*[F.col(f"{side}.{g}").alias(f"_{g}") for g in self.group]) for side in ("old", "new")]
        groups = settled(sides[0].unionByName(sides[1]).distinct())
        self.refreshed.append(groups)
        same = lambda df: reduce(lambda a, b: a & b, [df[g].eqNullSafe(groups[f"_{g}"]) for g in self.group])
        rows = self.base.read(version)
        new = self._computed(rows.join(groups, same(rows), "left_semi"))
        before = self.table._version()
        now = self.table._rows(before)
        parts = self.table._touched(groups.select(*[F.col(f"_{g}").alias(g) for g in self.group]))
        at = self.table._rows(before, parts)
        kept = at.join(groups, same(at), "left_anti")
        written = self.table._written(kept.unionByName(new.select(*now.columns)))
        return self.table._commit(before, [f for f in before["folders"] if f[0] not in parts] + written, now.schema, base=version)


def insert_each(rows: DataFrame, targets: list[tuple[ChangingTable, Column | None]], first: bool = False) -> None:
    """Conditional insert into several tables: every one whose condition holds, or only the first; None is always. The source is read once."""
    hits = [F.lit(True) if where is None else F.coalesce(where, F.lit(False)) for _, where in targets]
    judged = settled(rows.withColumn("_hits", F.array(*hits)))
    for k, (table, _) in enumerate(targets):
        hit = F.array_position("_hits", True) == k + 1 if first else F.col("_hits")[k]
        table.insert(judged.filter(hit).drop("_hits"))


def insert_logging(table: ChangingTable, rows: DataFrame, checks: dict[str, Column], key: str) -> DataFrame:
    """Inserts the rows that pass all checks; the others come back as (entity_key, error_message), one for the first check that fails."""
    failed = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in checks.items()])
    judged = rows.withColumn("_failed", failed)
    table.insert(judged.filter("_failed is null").drop("_failed"))
    return judged.filter("_failed is not null").select(F.col(key).cast("string").alias("entity_key"), F.col("_failed").alias("error_message"))


def select_into(rows: DataFrame, key: str, value: str, asked: DataFrame | None = None) -> DataFrame:
    """(key, value, outcome): the single value of each key, or why there is none: TOO_MANY_ROWS, or NO_DATA_FOUND for keys of `asked` without a row."""
    one = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first(value).alias("v"))
    if asked is not None:
        found = asked.select(key).distinct().join(one, key, "left")
        outcome = F.when(F.col("n") == 1, "FOUND").when(F.col("n").isNull(), "NO_DATA_FOUND").otherwise("TOO_MANY_ROWS")
        return found.select(key, F.when(F.col("n") == 1, F.col("v")).alias(value), outcome.alias("outcome"))
    return one.select(key, F.when(F.col("n") == 1, F.col("v")).alias(value), F.when(F.col("n") == 1, "FOUND").otherwise("TOO_MANY_ROWS").alias("outcome"))


def fetch_batches(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """rows with `batch`, from 1: what each FETCH ... BULK COLLECT LIMIT along an order would get. Ranges are numbered apart, so no task holds all rows."""
    numbered = row_numbers(rows, order, "_place")
    return numbered.withColumn("batch", (F.floor((F.col("_place") - 1) / limit) + 1).cast("bigint")).drop("_place")


def put_lines(rows: DataFrame, where: Column, line: Column, order: list[Column]) -> DataFrame:
    """DBMS_OUTPUT.PUT_LINE in a set-based job: (number, line) for the rows of where, in order; a null is an empty line."""
    said = row_numbers(rows.filter(F.coalesce(where, F.lit(False))), order, "number")
    return said.select(F.col("number").cast("bigint").alias("number"), F.coalesce(line.cast("string"), F.lit("")).alias("line"))


def linked_table(spark: SparkSession, url: str, table: str, split_on: str | None = None, lower: int = 0, upper: int = 0, parts: int = 8, **options: str) -> DataFrame:
    """A table of another database over JDBC; with split_on it is read in `parts` ranges of that column, each in a task."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_on:
        reader = reader.option("partitionColumn", split_on).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts)
    return reader.load()
