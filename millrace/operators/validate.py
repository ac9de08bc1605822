"""Row validation with failure modes, and table assertions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import TablePath, TableSet, payload_columns, quoted, require_columns
from millrace.options import require, single_choice
from millrace.schema import spark_type
from millrace.session import scratch_dir

# Fixed value: the address form the built-in EMAIL check accepts (local part and domain lengths are checked apart).
EMAIL_PATTERN = r"^[a-zA-Z0-9_+&*-]+(?:\.[a-zA-Z0-9_+&*-]+)*@(?:[a-zA-Z0-9-]+\.)+[a-zA-Z]{2,7}$"


def is_email(value: Column) -> Column:
    """The built-in EMAIL check as an expression."""
    text = value.cast("string")
    return (
        text.rlike(EMAIL_PATTERN)
        & (F.length(text) <= 254)
        & (F.length(F.substring_index(text, "@", 1)) <= 64)
    )


def _show(bound: Any, low: bool, inclusive: bool) -> str:
    if bound is None:
        return "(-inf" if low else "+inf)"
    if low:
        return f"{'[' if inclusive else '('}{bound}"
    return f"{bound}{']' if inclusive else ')'}"


def _size(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.size(value)
    return F.length(value.cast("string") if not isinstance(kind, T.BinaryType) else value)


def _all(tests: Sequence[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def _rule(
    field: str, kind: T.DataType, rule: Mapping[str, Any], functions: Mapping[str, Callable[[Column], Column]]
) -> tuple[Column, Column]:
    """(passes, message). Only NOT_NULL rejects a NULL; every other rule lets it pass."""
    value = F.col(quoted(field))
    name = rule["rule_type"]
    single_choice(rule, "rule_type", ("NOT_NULL", "RANGE", "LENGTH", "REGEX", "UDF"))
    if name == "NOT_NULL":
        return value.isNotNull(), F.lit(f"Field '{field}' cannot be null")
    if name == "RANGE":
        low, high = rule.get("min_value"), rule.get("max_value")
        low_in, high_in = rule.get("min_inclusive", True), rule.get("max_inclusive", True)
        tests = []
        if low is not None:
            tests.append(value >= low if low_in else value > low)
        if high is not None:
            tests.append(value <= high if high_in else value < high)
        span = f"{_show(low, True, low_in)}, {_show(high, False, high_in)}"
        passes = _all(tests)
        message = F.concat(F.lit(f"Field '{field}' value "), value.cast("string"), F.lit(f" is not within range {span}"))
    elif name == "LENGTH":
        size = _size(value, kind)
        low, high, exact = rule.get("min_length"), rule.get("max_length"), rule.get("exact_length")
        tests = [test for bound, test in ((low, size >= low if low is not None else None),
                                          (high, size <= high if high is not None else None),
                                          (exact, size == exact if exact is not None else None)) if bound is not None]
        wanted = f"exactly {exact}" if exact is not None else f"{_show(low, True, True)}, {_show(high, False, True)}"
        passes = _all(tests)
        message = F.concat(F.lit(f"Field '{field}' length "), size.cast("string"), F.lit(f" is not {wanted}"))
    elif name == "REGEX":
        require(rule, "pattern")
        pattern = rule["pattern"]
        passes = value.cast("string").rlike(pattern if rule.get("case_sensitive", True) else f"(?i){pattern}")
        message = F.lit(f"Field '{field}' does not match pattern '{pattern}'")
    else:
        require(rule, "function_name")
        check = {"EMAIL": is_email, **functions}.get(rule["function_name"])
        if check is None:
            raise ValueError(f"validate: no check named {rule['function_name']!r}")
        passes = check(value)
        message = F.lit(f"Field '{field}' fails check {rule['function_name']}")
    return value.isNull() | passes, message


def _rules(df: DataFrame, field_rules: Sequence[Mapping[str, Any]], functions) -> list[tuple[str, Column, Column]]:
    """(field, passes, message) of every rule; a field's rules are nested (``rules=[...]``) or flat on the entry."""
    require_columns(df, [entry["field_name"] for entry in field_rules], "validate")
    found = []
    for entry in field_rules:
        field = entry["field_name"]
        for rule in entry.get("rules") or [entry]:
            passes, message = _rule(field, df.schema[field].dataType, rule, functions or {})
            if rule.get("custom_message"):
                message = F.lit(rule["custom_message"])
            found.append((field, passes, message))
    return found


def _valid(rules: Sequence[tuple[str, Column, Column]]) -> Column:
    """True when every rule passes. Plain comparisons joined by AND, which Catalyst pushes into the scan."""
    return _all([passes for _, passes, _ in rules])


def _errors(rules: Sequence[tuple[str, Column, Column]], fail_fast: bool) -> Column:
    """One array of ``{field_name, error_message}``; empty when the row is valid."""
    problems = [
        F.when(~F.coalesce(passes, F.lit(False)), F.struct(F.lit(field).alias("field_name"), message.alias("error_message")))
        for field, passes, message in rules
    ]
    errors = F.array_compact(F.array(*problems))
    return F.slice(errors, 1, 1) if fail_fast else errors


def validation_errors(
    df: DataFrame,
    *,
    field_rules: Sequence[Mapping[str, Any]],
    functions: Mapping[str, Callable[[Column], Column]] | None = None,
    fail_fast: bool = False,
) -> Column:
    """The errors of each row as one array column."""
    return _errors(_rules(df, field_rules, functions), fail_fast)


class Validated(NamedTuple):
    """Rows that pass, in the input's schema, and one error row per rejected row."""

    valid: DataFrame
    errors: DataFrame


def validate(
    df: DataFrame,
    *,
    field_rules: Sequence[Mapping[str, Any]],
    row_error_handle_way: str = "FAIL",
    functions: Mapping[str, Callable[[Column], Column]] | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """FAIL raises with the row's errors; SKIP drops invalid rows. For routing see :func:`validate_route`."""
    single_choice({"way": row_error_handle_way}, "way", ("FAIL", "SKIP"))
    rules = _rules(df, field_rules, functions)
    if row_error_handle_way == "SKIP":
        return df.where(_valid(rules))
    # The check sits in the filter, so it runs in whatever action reads the rows, whichever columns are read.
    message = F.concat(F.lit("validation failed: "), F.to_json(_errors(rules, fail_fast)))
    valid = F.coalesce(_valid(rules), F.lit(False))
    return df.where(F.when(valid, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def validate_route(
    df: DataFrame,
    *,
    field_rules: Sequence[Mapping[str, Any]],
    table: str | TablePath,
    functions: Mapping[str, Callable[[Column], Column]] | None = None,
    fail_fast: bool = False,
    create_time: Column | None = None,
    read_once: bool = False,
) -> Validated:
    """ROUTE_TO_TABLE: valid rows keep their schema, each rejected row becomes one row of the fixed error table.

    The two are filters of one input, each of which reads it. With ``read_once`` it is judged in one pass, here and now, and
    written by route to the scratch folder, from which both are read. For streams see :func:`route_each`."""
    path = TablePath.parse(table) if isinstance(table, str) else table
    rules = _rules(df, field_rules, functions)
    valid = _valid(rules)
    original = F.to_json(F.struct(*[F.col(quoted(n)) for n in payload_columns(df)]), {"ignoreNullFields": "false"})
    stamp = F.current_timestamp().cast("timestamp_ntz") if create_time is None else create_time
    # The messages are made for the rejected rows only.
    error = [
        F.lit(str(path)).alias("source_table_id"),
        F.lit(str(path)).alias("source_table_path"),
        original.alias("original_data"),
        F.to_json(_errors(rules, fail_fast)).alias("validation_errors"),
        stamp.alias("create_time"),
    ]
    passes = F.coalesce(valid, F.lit(False))
    if read_once:
        return _routed_once(df, passes, F.struct(*error))
    return Validated(df.where(valid), df.where(~passes).select(*error))


def _routed_once(df: DataFrame, passes: Column, error: Column) -> Validated:
    marked = df.select(
        F.when(passes, F.struct(*[F.col(quoted(n)) for n in df.columns])).alias("row"),
        F.when(~passes, error).alias("error"),
        F.when(passes, "valid").otherwise("rejected").alias("route"),
    )
    path = scratch_dir(df.sparkSession, "routed")
    marked.write.partitionBy("route").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Validated(stored.where("route = 'valid'").select("row.*"), stored.where("route = 'rejected'").select("error.*"))


def route_each(
    valid: Callable[[DataFrame, int], None], errors: Callable[[DataFrame, int], None], **options: Any
) -> Callable[[DataFrame, int], None]:
    """A handler of micro-batches that judges each batch once, by :func:`validate_route` with ``options``, and hands its
    valid rows and its error rows on, with the batch's id. Both must accept the same id twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = validate_route(batch, **options, read_once=True)
        valid(routed.valid, batch_id)
        errors(routed.errors, batch_id)

    return handle


def assert_table(
    df: DataFrame,
    *,
    row_rules: Sequence[Mapping[str, Any]] = (),
    field_rules: Sequence[Mapping[str, Any]] = (),
) -> DataFrame:
    """Check a whole table in one aggregation pass; one result row per rule: ``rule, field, ok, observed``.

    Row rules are MIN_ROW and MAX_ROW. A field rule names a field and may give ``field_type`` and ``field_value``
    rules NOT_NULL, MIN, MAX (on numbers), MIN_LENGTH, MAX_LENGTH, and ``equals_to`` for the one value all rows have.
    """
    checks: list[tuple[str, str, Column, Column]] = []
    total = F.count(F.lit(1))
    for rule in row_rules:
        single_choice(rule, "rule_type", ("MIN_ROW", "MAX_ROW"))
        bound = rule["rule_value"]
        ok = total >= bound if rule["rule_type"] == "MIN_ROW" else total <= bound
        checks.append((rule["rule_type"], "*", ok, total))
    for entry in field_rules:
        field = entry["field_name"]
        if entry.get("field_type"):
            actual = df.schema[field].dataType if field in df.columns else None
            same = actual == spark_type(entry["field_type"])
            # A literal inside an aggregate keeps the single pass.
            checks.append(("TYPE", field, F.lit(same), F.lit(0).cast("bigint")))
        if field not in df.columns:
            checks.append(("EXISTS", field, F.lit(False), F.lit(0).cast("bigint")))
            continue
        value = F.col(quoted(field))
        kind = df.schema[field].dataType
        tests = {
            "NOT_NULL": lambda _: value.isNotNull(),
            "MIN": lambda bound: value >= bound,
            "MAX": lambda bound: value <= bound,
            "MIN_LENGTH": lambda bound: _size(value, kind) >= bound,
            "MAX_LENGTH": lambda bound: _size(value, kind) <= bound,
        }
        for rule in entry.get("field_value", ()):
            if "equals_to" in rule:
                name, test = "EQUALS", value.eqNullSafe(F.lit(rule["equals_to"]).cast(kind))
            else:
                single_choice(rule, "rule_type", tests)
                name, test = rule["rule_type"], tests[rule["rule_type"]](rule.get("rule_value"))
            broken = F.count_if(~F.coalesce(test, F.lit(False)))
            checks.append((name, field, broken == 0, broken))
    if not checks:
        raise ValueError("assert_table: no rules")
    totals = df.agg(*[F.struct(ok.alias("ok"), seen.alias("observed")).alias(f"c{i}")
                      for i, (_, _, ok, seen) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.lit(field).alias("field"),
            F.col(f"c{i}.ok").alias("ok"),
            F.col(f"c{i}.observed").alias("observed"),
        )
        for i, (name, field, _, _) in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def assert_tables(tables: TableSet, *, tables_configs: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rules for several tables, each entry with a ``table_path``, row and field rules, and optionally the
    ``primary_key`` the table must have. The result of :func:`assert_table` with the table in front."""
    parts = []
    for entry in tables_configs:
        path = TablePath.parse(entry["table_path"])
        if path not in tables.frames:
            raise ValueError(f"assert_tables: no table {path}")
        rules = {key: entry[key] for key in ("row_rules", "field_rules") if entry.get(key)}
        df = tables[path]
        if rules:
            parts.append(assert_table(df, **rules).select(F.lit(str(path)).alias("table_path"), "*"))
        if entry.get("primary_key"):
            same = tuple(entry["primary_key"]) == tables.meta(path).primary_key
            known = df.sparkSession.createDataFrame(
                [(str(path), "PRIMARY_KEY", ",".join(entry["primary_key"]), same, 0)],
                "table_path string, rule string, field string, ok boolean, observed bigint",
            )
            parts.append(known)
    if not parts:
        raise ValueError("assert_tables: no rules")
    return reduce(DataFrame.unionByName, parts)


def require_assertions(results: DataFrame) -> None:
    """Raise if any rule of an :func:`assert_table` result failed (a handful of rows, one per rule)."""
    failed = results.where(~F.col("ok")).collect()
    if failed:
        raise AssertionError("; ".join(f"{r['rule']} on {r['field']}: observed {r['observed']}" for r in failed))
