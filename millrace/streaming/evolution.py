"""A stream whose schema changes on the way.

Rows and schema-change events share one ordered stream. Each micro-batch is cut at its events: the rows before an
event are written under the old schema first, then the event takes effect. Rows are kept per schema version with numbered
columns; reading brings older versions up to date by number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.envelope import SEQ, quoted
from millrace.operators.evolve import (
    AddColumn,
    ColumnEvent,
    DropColumn,
    ModifyColumn,
    RenameColumn,
    evolved_schema,
)
from millrace.session import list_paths
from millrace.storage import CommitLog, remove

_BATCH = "batch"

# The event names in messages.
EVENT_TYPES = {
    "ADD": AddColumn,
    "DROP": DropColumn,
    "MODIFY": ModifyColumn,
    "RENAME": RenameColumn,
}


def event_message(event: ColumnEvent) -> str:
    """A schema-change event as a message."""
    name = next(name for name, kind in EVENT_TYPES.items() if isinstance(event, kind))
    return json.dumps({"schema_change": {"event": name, **asdict(event)}})


def parse_event(message: str) -> ColumnEvent:
    body = json.loads(message)["schema_change"]
    return EVENT_TYPES[body.pop("event")](**body)


def is_event(value: Column) -> Column:
    """True for messages that are schema changes, not rows."""
    return F.get_json_object(value, "$.schema_change").isNotNull()


@dataclass(frozen=True)
class Numbered:
    """A column and the number it keeps for life: through renames, new types and places. A dropped column's number is not
    given again, nor is it that of a later column of the same name."""

    name: str
    number: int
    type: T.DataType

    @property
    def stored(self) -> str:
        return f"c{self.number}"


class Versions:
    """The columns of every schema version, and what happened to each number on the way."""

    def __init__(self, first: T.StructType, events: Sequence[ColumnEvent], spark: SparkSession):
        self.schemas = [first]
        self.columns = [[Numbered(f.name, i, f.dataType) for i, f in enumerate(first.fields)]]
        self.types: dict[int, list[tuple[int, T.DataType]]] = {}  # number: versions that gave it a type
        self.defaults: dict[int, object] = {}
        count = len(first.fields)
        for version, event in enumerate(events, 1):
            schema = evolved_schema(self.schemas[-1], [event], spark)
            numbers = {c.name: c.number for c in self.columns[-1]}
            if isinstance(event, RenameColumn):
                numbers[event.to] = numbers.pop(event.name)
            elif isinstance(event, AddColumn):
                numbers[event.name], self.defaults[count] = count, event.default
                self.types[count] = [(version, schema[event.name].dataType)]
                count += 1
            elif isinstance(event, ModifyColumn):
                self.types.setdefault(numbers[event.name], []).append((version, schema[event.name].dataType))
            self.schemas.append(schema)
            self.columns.append([Numbered(f.name, numbers[f.name], f.dataType) for f in schema.fields])

    def stored(self, version: int) -> T.StructType:
        """How rows of a version lie in files: by number, with their place in the stream."""
        fields = [T.StructField(c.stored, c.type) for c in self.columns[version]]
        return T.StructType([*fields, T.StructField(SEQ, T.LongType())])

    def newest(self, rows: DataFrame, version: int) -> DataFrame:
        """Stored rows of a version under the newest schema: one projection, whatever happened in between."""
        had = {c.number: c for c in self.columns[version]}
        out = []
        for column in self.columns[-1]:
            if column.number in had:
                value = F.col(column.stored)
            else:
                value = F.lit(self.defaults[column.number])
            # Every type on the way counts: a number that was a text for a while is not the text it would be now.
            for since, kind in self.types.get(column.number, ()):
                if since > version:
                    value = value.cast(kind)
            out.append(value.alias(column.name))
        return rows.select(*out, SEQ)


class EvolvingTable:
    """Rows by schema version under ``path``, their columns named by number, so that reading brings any version up to date in
    one projection. A commit per micro-batch holds the events and the last finished batch: rows of a batch that is not
    finished are not read, and a finished batch is left alone. ``compact`` rewrites what there is under the newest version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.first_schema = spark, path.rstrip("/"), schema
        self.commits = CommitLog(spark, f"{self.path}/commits")

    def _state(self) -> tuple[int, dict]:
        """``events``: place and message of each; ``versions``: those with rows; ``finished``: the last batch; ``base``: the
        compacted rows, their version and the last batch in them."""
        number, state = self.commits.newest()
        return number, state or {"events": [], "versions": [], "finished": -1, "base": None}

    def _versions(self, state: dict) -> Versions:
        return Versions(self.first_schema, [parse_event(message) for _, message in state["events"]], self.spark)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch of messages ``(value, __seq)``; safe to repeat.

        A row belongs to the version in force at its place in the stream: that of the last event with a smaller
        ``__seq``, also when it arrives in a later batch than that event. A message that is no row of its version raises.
        """
        number, state = self._state()
        if batch_id <= state["finished"]:
            return
        marked = batch.select("value", SEQ, is_event(F.col("value")).alias("is_event"))
        # A handful of DDL statements.
        new = [[row[SEQ], row["value"]] for row in marked.where("is_event").orderBy(SEQ).collect()]
        known = len(state["events"])
        if new and known and new[0][0] < state["events"][-1][0]:
            raise ValueError(f"a schema change at {new[0][0]} arrived after the one at {state['events'][-1][0]}")
        state["events"] += new
        versions = self._versions(state)
        # An event takes effect behind the row that has its own number.
        cuts = [seq for seq, _ in state["events"]]
        # The micro-batch is read once, however many versions its rows have.
        data = marked.where(~F.col("is_event")).persist()
        try:
            for version in range(len(versions.schemas)):
                part = data
                if version > 0:
                    part = part.where(F.col(SEQ) > cuts[version - 1])
                if version < len(cuts):
                    part = part.where(F.col(SEQ) <= cuts[version])
                if version >= known or not part.isEmpty():
                    self._write(part, versions, version, batch_id)
                    state["versions"] = sorted({*state["versions"], version})
        finally:
            data.unpersist()
        state["finished"] = batch_id
        self.commits.commit(number + 1, state)

    def _write(self, rows: DataFrame, versions: Versions, version: int, batch_id: int) -> None:
        row = F.from_json("value", versions.schemas[version], {"mode": "FAILFAST"})
        broken = F.raise_error(F.concat(F.lit("not a row: "), F.coalesce(F.col("value"), F.lit("NULL"))))
        checked = F.when(F.json_object_keys("value").isNull(), broken).otherwise(F.col("value"))
        parsed = rows.withColumn("value", checked).select(row.alias("row"), SEQ)
        named = [F.col("row").getField(c.name).alias(c.stored) for c in versions.columns[version]]
        parsed.select(*named, SEQ).write.mode("overwrite").parquet(f"{self.path}/rows/version={version}/batch={batch_id}")

    def read(self) -> DataFrame:
        """All rows under the newest schema: one path is opened for each version, whatever the number of batches."""
        _, state = self._state()
        return self._rows(state, self._versions(state))

    def _rows(self, state: dict, versions: Versions) -> DataFrame:
        base, parts = state["base"], []
        if base:
            stored = self.spark.read.schema(versions.stored(base["version"])).parquet(f"{self.path}/{base['path']}")
            parts.append(versions.newest(stored, base["version"]))
        after = base["through"] if base else -1
        for version in state["versions"]:
            schema = versions.stored(version).add(_BATCH, "long")
            # Batches are folders of the version: the bounds leave folders out, not rows.
            stored = self.spark.read.schema(schema).parquet(f"{self.path}/rows/version={version}")
            done = stored.where((F.col(_BATCH) > after) & (F.col(_BATCH) <= state["finished"])).drop(_BATCH)
            parts.append(versions.newest(done, version))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*versions.schemas[-1].fields, T.StructField(SEQ, T.LongType())]))
        return reduce(DataFrame.unionByName, parts)

    def compact(self) -> None:
        """Rewrite all rows under the newest version, as one base. Folders that the base before this one replaced are
        deleted; those that this one replaces stay until the next, for readers that still use them."""
        number, state = self._state()
        versions, old = self._versions(state), state["base"]
        rows, path = self._rows(state, versions), f"rows/base={uuid.uuid4().hex}"
        columns = [F.col(quoted(c.name)).alias(c.stored) for c in versions.columns[-1]]
        rows.select(*columns, SEQ).write.parquet(f"{self.path}/{path}")
        version = len(versions.schemas) - 1
        state["base"] = {"path": path, "version": version, "through": state["finished"], "before": old["path"] if old else None}
        state["versions"] = []
        self.commits.commit(number + 1, state)
        if old:
            if old["before"]:
                remove(self.spark, f"{self.path}/{old['before']}")
            for folder in list_paths(self.spark, f"{self.path}/rows/version=*/batch=*"):
                if int(folder.rsplit("=", 1)[1]) <= old["through"]:
                    remove(self.spark, folder)
