"""Jobs as data: named datasets from sources, through transforms, to sinks.

A spec is a mapping with lists ``source``, ``transform`` and ``sink``. Each entry has a ``plugin_name``, its options,
and names: ``plugin_output`` is what the entry makes, ``plugin_input`` what it reads. Without names an entry reads the
output before it. One output may feed many entries. Building the DataFrames is lazy; each sink is one Spark action.

``env`` may hold ``parallelism``, ``job.mode`` (``BATCH``, the default, or ``STREAMING``) and ``checkpoint.interval`` in
milliseconds. A streaming job reads ``FileStream`` sources; its sinks need a ``checkpoint`` folder each. With an
interval its queries run until they are stopped, without one they take what is there and end. ``DataValidator`` with
``row_error_handle_way: ROUTE_TO_TABLE`` names its error rows by ``error_output``; with ``read_once`` its input is judged
and written by route when the job is built, and both outputs read that.

A dataset may be a set of tables: ``Tables`` (a list ``tables_configs``), ``CatalogTables`` (a ``pattern``) and
``MessageTables`` (change messages of many tables, in both modes) give one. ``TableFilter``, ``TableRename`` and
``TableMerge`` work on the set, any other transform on its tables (``table_match_regex``, ``table_transform``), and a sink
writes each table with its placeholders (``${table_name}`` and others) filled in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.envelope import TableSet
from millrace.operators import fields, jsonpath, messages, models, rowkind, sql, validate
from millrace.options import single_choice
from millrace.plans import table_flows
from millrace.plans.table_flows import StreamedTables
from millrace.plans.variables import substitute
from millrace.schema import schema_from_fields
from millrace.sinks import files as file_sinks, payloads, tables as table_sinks
from millrace.sinks.keyed import KeyedTable
from millrace.sources import files, generate, tables
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import run_to_end, stream_apply_changelog, stream_to_files

def _file_stream(spark: SparkSession, path: str, schema: Mapping[str, Any], **options: Any) -> DataFrame:
    return scan_stream(spark, path, schema=schema_from_fields(schema), **options)


SOURCES: dict[str, Callable[..., DataFrame]] = {
    "File": files.scan_file,
    "Table": tables.scan_table,
    "Generate": generate.generate,
    "Rows": generate.literal_rows,
    "FileStream": _file_stream,
    "Tables": tables.scan_many,
    "CatalogTables": tables.scan_tables,
    "MessageTables": table_flows.message_tables,
}
Dataset = DataFrame | TableSet | StreamedTables
TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "Copy": fields.copy_fields,
    "FieldMapper": fields.field_mapper,
    "Filter": fields.filter_fields,
    "FieldRename": fields.rename_fields,
    "Replace": fields.replace,
    "Split": fields.split_field,
    "RegexExtract": fields.regex_extract,
    "JsonPath": jsonpath.json_path,
    "Metadata": rowkind.add_metadata,
    "FilterRowKind": rowkind.filter_row_kind,
    "RowKindExtractor": rowkind.extract_row_kind,
    "DefineSinkType": rowkind.define_sink_type,
    "DataValidator": validate.validate,
    "Sql": sql.sql,
    "LLM": models.infer_column,
    "Embedding": models.embed_columns,
    "DynamicCompile": models.custom_rows,
    "DebeziumJson": messages.decode_debezium,
    "CanalJson": messages.decode_canal,
    "MaxwellJson": messages.decode_maxwell,
    "OggJson": messages.decode_ogg,
    "ConnectJson": messages.decode_connect_json,
}


def _assert_sink(df: DataFrame, **rules: Any) -> None:
    validate.require_assertions(validate.assert_table(df, **rules))


SINKS: dict[str, Callable[..., Any]] = {
    "File": file_sinks.write_files,
    "Table": table_sinks.save_table,
    "Console": payloads.console,
    "Assert": _assert_sink,
}


def _keyed_table(df: DataFrame, path: str, keys: Sequence[str], schema: Mapping[str, Any]) -> KeyedTable:
    return KeyedTable(df.sparkSession, path, keys=keys, schema=schema_from_fields(schema))


# Sinks of streams: they start a query.
STREAM_SINKS: dict[str, Callable[..., StreamingQuery]] = {
    "File": lambda df, path, checkpoint, interval_ms=None, **options: stream_to_files(
        df, path, checkpoint, interval_ms=interval_ms, **options
    ),
    "KeyedTable": lambda df, path, checkpoint, keys, schema, interval_ms=None, **options: stream_apply_changelog(
        df, _keyed_table(df, path, keys, schema), checkpoint, interval_ms=interval_ms, **options
    ),
}
JOB_MODES = ("BATCH", "STREAMING")
_NAMES = ("plugin_name", "plugin_input", "plugin_output", "parallelism", "error_output")


def _options(entry: Mapping[str, Any]) -> dict[str, Any]:
    return {key: value for key, value in entry.items() if key not in _NAMES}


def set_parallelism(df: DataFrame, n: int) -> DataFrame:
    """Read with at most ``n`` tasks: input splits are merged, never shuffled. More tasks come from smaller splits
    (``spark.sql.files.maxPartitionBytes``) or more JDBC partitions, not from a repartition."""
    return df.coalesce(n)


def _inputs(entry: Mapping[str, Any], datasets: Mapping[str, Dataset], last: Dataset | None) -> Dataset:
    names = entry.get("plugin_input")
    if not names:
        if last is None:
            raise ValueError(f"{entry['plugin_name']}: nothing to read")
        return last
    names = [names] if isinstance(names, str) else list(names)
    unknown = [name for name in names if name not in datasets]
    if unknown:
        raise ValueError(f"{entry['plugin_name']}: no dataset named {unknown}")
    df = datasets[names[0]]
    for name in names[1:]:
        if not isinstance(df, DataFrame) or not isinstance(datasets[name], DataFrame):
            raise ValueError(f"{entry['plugin_name']}: sets of tables are not put together: {names}")
        df = df.unionByName(datasets[name])
    return df


def _transformed(entry: Mapping[str, Any], df: Dataset, datasets: dict[str, Dataset]) -> Dataset:
    options = _options(entry)
    if entry["plugin_name"] in table_flows.TABLE_TRANSFORMS:
        if isinstance(df, DataFrame):
            raise ValueError(f"{entry['plugin_name']} takes a set of tables")
        return table_flows.TABLE_TRANSFORMS[entry["plugin_name"]](df, **options)
    if not isinstance(df, DataFrame):
        transform = _find(TRANSFORMS, entry)
        return table_flows.transform_tables(df, lambda own: lambda rows: transform(rows, **own), options)
    if entry["plugin_name"] == "DataValidator" and options.get("row_error_handle_way") == "ROUTE_TO_TABLE":
        del options["row_error_handle_way"]
        if "error_output" not in entry:
            raise ValueError("DataValidator: ROUTE_TO_TABLE needs an error_output")
        routed = validate.validate_route(df, **options)
        datasets[entry["error_output"]] = routed.errors
        return routed.valid
    return _find(TRANSFORMS, entry)(df, **options)


def _find(registry: Mapping[str, Callable], entry: Mapping[str, Any]) -> Callable:
    try:
        return registry[entry["plugin_name"]]
    except KeyError:
        raise ValueError(f"unknown plugin {entry.get('plugin_name')!r}; known are {sorted(registry)}") from None


def build_flow(
    spark: SparkSession, spec: Mapping[str, Any], variables: Mapping[str, str] | None = None
) -> tuple[dict[str, Dataset], list[Callable[[], Any]]]:
    """The named datasets and the (not yet run) sinks of a spec."""
    spec = substitute(spec, variables or {}, keep=frozenset(table_sinks.PLACEHOLDERS))
    env = spec.get("env") or {}
    parallelism, mode = env.get("parallelism"), str(env.get("job.mode", "BATCH")).upper()
    single_choice({"job.mode": mode}, "job.mode", JOB_MODES)
    interval = env.get("checkpoint.interval")
    datasets: dict[str, Dataset] = {}
    last: Dataset | None = None
    for entry in spec.get("source", ()):
        source, options = _find(SOURCES, entry), _options(entry)
        last = source(spark, **options, streaming=mode == "STREAMING") if entry["plugin_name"] == "MessageTables" else source(spark, **options)
        wanted = entry.get("parallelism", parallelism)
        if wanted and isinstance(last, DataFrame):
            last = set_parallelism(last, int(wanted))
        datasets[entry.get("plugin_output", f"source{len(datasets)}")] = last
    for entry in spec.get("transform", ()):
        last = _transformed(entry, _inputs(entry, datasets, last), datasets)
        datasets[entry.get("plugin_output", f"transform{len(datasets)}")] = last
    sinks = []
    for entry in spec.get("sink", ()):
        df, options = _inputs(entry, datasets, last), _options(entry)
        if isinstance(df, StreamedTables):
            if entry["plugin_name"] != "KeyedTable":
                raise ValueError(f"{entry['plugin_name']}: streamed tables go into keyed tables")
            sinks.append(lambda df=df, options=options: table_flows.start_keyed_tables(df, interval_ms=interval, **options))
            continue
        if isinstance(df, TableSet):
            write = _find(SINKS, entry)
            sinks.append(lambda df=df, write=write, options=options: table_flows.write_tables(df, write, options))
            continue
        if df.isStreaming != (mode == "STREAMING"):
            raise ValueError(f"{entry['plugin_name']}: a {mode} job cannot write {'a stream' if df.isStreaming else 'a table'}")
        if df.isStreaming:
            start = _find(STREAM_SINKS, entry)
            sinks.append(lambda df=df, start=start, options=options: start(df, interval_ms=interval, **options))
            continue
        write = _find(SINKS, entry)
        sinks.append(lambda df=df, write=write, options=options: write(df, **options))
    return datasets, sinks


def run_flow(
    spark: SparkSession, spec: Mapping[str, Any], variables: Mapping[str, str] | None = None
) -> dict[str, Dataset]:
    """Build a spec, run its sinks in order and return the datasets. The queries of a streaming job run side by side;
    those without an interval are waited for."""
    datasets, sinks = build_flow(spark, spec, variables)
    queries = [started for started in [sink() for sink in sinks] if isinstance(started, StreamingQuery)]
    if not (spec.get("env") or {}).get("checkpoint.interval"):
        for query in queries:
            run_to_end(query)
    return datasets
