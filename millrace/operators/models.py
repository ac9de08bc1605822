"""Columns computed by user code: model inference, embeddings, free-form row functions.

The callables get whole Arrow batches; any client, cache or retry policy is theirs. Nothing here opens a connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.envelope import payload_columns, quoted, refuse_columns, require_columns
from millrace.options import single_choice

# The output types a model column may have.
OUTPUT_TYPES = {
    "STRING": "string",
    "INT": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}

BatchModel = Callable[[str, pd.DataFrame], Sequence[str | None]]


def infer_column(
    df: DataFrame,
    *,
    prompt: str,
    model_fn: BatchModel,
    inference_columns: Sequence[str] | None = None,
    output_column: str = "llm_output",
    output_type: str = "STRING",
) -> DataFrame:
    """Append a column answered by ``model_fn(prompt, batch)``, one text per row, read as ``output_type``.

    Only the inference columns cross into Python. A raising callable fails the job; a text that does not parse as
    the type is NULL.
    """
    refuse_columns(df, [output_column], "infer_column")
    single_choice({"output_type": output_type}, "output_type", OUTPUT_TYPES)
    names = list(inference_columns or payload_columns(df))
    require_columns(df, names, "infer_column")

    @F.pandas_udf(T.StringType())
    def answer(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(list(model_fn(prompt, rows)), index=rows.index, dtype=object)

    text = answer(F.struct(*[F.col(quoted(name)) for name in names]))
    return df.withColumn(output_column, text.try_cast(OUTPUT_TYPES[output_type]))


def embed_columns(
    df: DataFrame,
    *,
    vectorization_fields: Mapping[str, str],
    model_fn: Callable[[pd.Series], Sequence[Sequence[float] | None]],
) -> DataFrame:
    """Append ``{output: field}`` vector columns; fields are text or binary payloads (such as images)."""
    refuse_columns(df, vectorization_fields, "embed_columns")
    require_columns(df, vectorization_fields.values(), "embed_columns")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vector(values: pd.Series) -> pd.Series:
        return pd.Series(list(model_fn(values)), index=values.index, dtype=object)

    return df.withColumns({out: vector(F.col(quoted(field))) for out, field in vectorization_fields.items()})


def custom_rows(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], *, out_columns: Mapping[str, str | T.DataType]
) -> DataFrame:
    """Run a user function over row batches; its columns are added, or overwrite those of the same name.

    ``fn`` returns as many rows as it gets, with at least ``out_columns`` (name to type).
    """
    kinds = {n: t if isinstance(t, T.DataType) else T.DataType.fromDDL(t) for n, t in out_columns.items()}
    schema = T.StructType(
        [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in df.schema.fields]
        + [T.StructField(name, kind) for name, kind in kinds.items() if name not in df.columns]
    )
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = fn(batch)
            yield batch.assign(**{name: made[name].to_numpy() for name in kinds})[names]

    return df.mapInPandas(run, schema)
