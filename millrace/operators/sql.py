"""The SQL transform: one query over one input, planned by Catalyst."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, functions as F

from millrace.envelope import envelope_columns, quoted

# Views have session-wide names: two threads of one session must not analyse at the same time.
_VIEWS = threading.Lock()
_COMMENT = re.compile(r"\s+|--[^\n]*(?:\n|\Z)")
_SELECT = re.compile(r"select\b", re.IGNORECASE)


def register_functions(spark, functions: Mapping[str, Callable]) -> None:
    """Make user functions (pandas or plain UDFs with a declared type) callable from SQL."""
    for name, fn in functions.items():
        spark.udf.register(name, fn)


class QueryError(ValueError):
    """A query that cannot be parsed or analysed over its input; it names the query and Spark's error class."""


def _analysed(spark, query: str, args: Mapping[str, object] | None) -> DataFrame:
    try:
        return spark.sql(query, args=dict(args) if args else None)
    except (AnalysisException, ParseException) as error:
        raise QueryError(f"{error.getCondition() or 'query error'} in {query!r}: {error}") from error


def _start(query: str) -> int:
    """Where a query begins, behind blanks and comments; bracketed comments may be nested."""
    at = 0
    while True:
        blank = _COMMENT.match(query, at)
        if blank:
            at = blank.end()
        elif query.startswith("/*", at):
            depth, at = 1, at + 2
            while depth and at < len(query):
                opens, closes = query.startswith("/*", at), query.startswith("*/", at)
                depth += opens - closes
                at += 2 if opens or closes else 1
        else:
            return at


def _carrying(query: str, columns: list[str]) -> str:
    """A plain SELECT with more columns in front of its list."""
    found = _SELECT.match(query, _start(query))
    if not found:
        raise QueryError(f"carry_envelope needs a query that begins with SELECT: {query!r}")
    return f"{query[: found.end()]} {', '.join(quoted(name) for name in columns)}, {query[found.end() :]}"


def _single_select(result: DataFrame) -> None:
    """Raise unless a query is one SELECT whose rows are input rows: elsewhere a row has no envelope of its own."""
    plan = result._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Sort", "GlobalLimit", "LocalLimit", "Filter"):
        plan = plan.children().head()
    if plan.nodeName() != "Project":
        raise QueryError(f"carry_envelope needs a plain SELECT; this query is {plan.nodeName()}")


def sql(
    df: DataFrame,
    query: str,
    *,
    table_name: str = "dual",
    functions: Mapping[str, Callable] | None = None,
    args: Mapping[str, object] | None = None,
    carry_envelope: bool = False,
) -> DataFrame:
    """Run ``query`` with the input visible under ``table_name`` (and always as ``dual``).

    The whole of Spark SQL is open to the query; one that does not parse or resolve raises ``QueryError``. A temporary
    view of the caller with one of these names is back afterwards. With ``carry_envelope`` the reserved columns pass
    through a single SELECT even when the select list does not name them; DISTINCT, set operations, grouping and common
    table expressions are refused there.
    """
    spark = df.sparkSession
    register_functions(spark, functions or {})
    names = {table_name, "dual"}
    with _VIEWS:
        catalog = spark._jsparkSession.sessionState().catalog()
        theirs = {name: spark.table(quoted(name)) for name in names if catalog.getRawTempView(name).isDefined()}
        for name in names:
            df.createOrReplaceTempView(name)
        try:
            # spark.sql analyses the query before it returns, so the views are not needed afterwards.
            result = _analysed(spark, query, args)
            if carry_envelope:
                missing = [name for name in envelope_columns(df) if name not in result.columns]
                if missing:
                    _single_select(result)
                    wide = _analysed(spark, _carrying(query, missing), args)
                    result = wide.select(*[F.col(quoted(name)) for name in result.columns + missing])
        finally:
            for name in names:
                if name in theirs:
                    theirs[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)
    return result


def sql_steps(df: DataFrame, *queries: str) -> DataFrame:
    """A chain of SQL transforms, each over the result of the one before."""
    for query in queries:
        df = sql(df, query)
    return df

