"""The row envelope (reserved columns) and sets of tables.

A changelog row is an ordinary DataFrame row with a few reserved columns beside the payload; many tables travel as
a :class:`TableSet`, never as one ragged DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

KIND = "__kind"
TABLE = "__table"
EVENT_MS = "__event_ms"
DELAY_MS = "__delay_ms"
PARTITION = "__partition"
SEQ = "__seq"
RESERVED = (KIND, TABLE, EVENT_MS, DELAY_MS, PARTITION, SEQ)

# The row kinds and their long names.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"
KIND_NAMES = {
    "+I": "INSERT",
    "-U": "UPDATE_BEFORE",
    "+U": "UPDATE_AFTER",
    "-D": "DELETE",
}


def payload_columns(df: DataFrame) -> list[str]:
    """Data columns: everything that is not part of the envelope."""
    return [name for name in df.columns if name not in RESERVED]


def envelope_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name in RESERVED]


def quoted(name: str) -> str:
    """Back-ticked column reference, so that dotted field names resolve."""
    return "`" + name.replace("`", "``") + "`"


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what}: no such input field {missing}; fields are {df.columns}")


def refuse_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    clash = [name for name in names if name in df.columns]
    if clash:
        raise ValueError(f"{what}: output field {clash} already exists")


@dataclass(frozen=True)
class TablePath:
    """``database[.schema].table``."""

    table: str
    database: str | None = None
    schema: str | None = None

    @staticmethod
    def parse(text: str, schema_first: bool = False) -> "TablePath":
        parts = text.split(".")
        if len(parts) == 1:
            return TablePath(parts[0])
        if len(parts) == 2:
            head, table = parts
            return TablePath(table, schema=head) if schema_first else TablePath(table, database=head)
        if len(parts) == 3:
            return TablePath(parts[2], database=parts[0], schema=parts[1])
        raise ValueError(f"a table path has one to three parts: {text!r}")

    def __str__(self) -> str:
        return ".".join(part for part in (self.database, self.schema, self.table) if part)


@dataclass(frozen=True)
class TableMeta:
    """Facts about a table that a DataFrame does not carry."""

    primary_key: tuple[str, ...] = ()
    unique_keys: tuple[tuple[str, ...], ...] = ()
    partition_keys: tuple[str, ...] = ()
    comment: str | None = None

    def after(self, columns: Iterable[str]) -> "TableMeta":
        """What survives a projection: a key survives only if all its columns do."""
        kept = set(columns)

        def alive(key: tuple[str, ...]) -> bool:
            return bool(key) and kept.issuperset(key)

        return replace(
            self,
            primary_key=self.primary_key if alive(self.primary_key) else (),
            unique_keys=tuple(key for key in self.unique_keys if alive(key)),
            partition_keys=tuple(key for key in self.partition_keys if key in kept),
        )


@dataclass(frozen=True)
class TableSet(Mapping):
    """Ordered tables by path, each a DataFrame with its own schema."""

    frames: dict[TablePath, DataFrame]
    metas: dict[TablePath, TableMeta] = field(default_factory=dict)

    @staticmethod
    def of(tables: Mapping[str, DataFrame], metas: Mapping[str, TableMeta] | None = None) -> "TableSet":
        return TableSet(
            {TablePath.parse(name): df for name, df in tables.items()},
            {TablePath.parse(name): meta for name, meta in (metas or {}).items()},
        )

    def __getitem__(self, path: TablePath | str) -> DataFrame:
        return self.frames[TablePath.parse(path) if isinstance(path, str) else path]

    def __iter__(self) -> Iterator[TablePath]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)

    def meta(self, path: TablePath) -> TableMeta:
        return self.metas.get(path, TableMeta())

    def map(self, fn: Callable[[TablePath, DataFrame], DataFrame]) -> "TableSet":
        frames = {path: fn(path, df) for path, df in self.frames.items()}
        metas = {path: self.meta(path).after(payload_columns(df)) for path, df in frames.items()}
        return TableSet(frames, metas)

    def rekey(self, fn: Callable[[TablePath], TablePath]) -> "TableSet":
        frames: dict[TablePath, DataFrame] = {}
        metas: dict[TablePath, TableMeta] = {}
        for path, df in self.frames.items():
            target = fn(path)
            if target in frames:
                raise ValueError(f"two tables would be named {target}")
            frames[target], metas[target] = df, self.meta(path)
        return TableSet(frames, metas)

    def keep(self, test: Callable[[TablePath], bool]) -> "TableSet":
        frames = {path: df for path, df in self.frames.items() if test(path)}
        return TableSet(frames, {path: self.meta(path) for path in frames})
