"""Column-wise transforms. All of them are projections: no shuffle, no Python in the data path."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.envelope import envelope_columns, payload_columns, quoted, refuse_columns, require_columns
from millrace.options import exactly_one, single_choice


def _col(name: str) -> Column:
    return F.col(quoted(name))


def _text(name: str) -> Column:
    return _col(name).cast("string")


def copy_fields(df: DataFrame, *, fields: Mapping[str, str]) -> DataFrame:
    """Append ``{new: source}`` copies in the order given."""
    require_columns(df, fields.values(), "copy_fields")
    refuse_columns(df, fields, "copy_fields")
    return df.withColumns({new: _col(source) for new, source in fields.items()})


def field_mapper(df: DataFrame, *, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only the listed fields, in that order, renamed ``{source: output}``; the envelope stays."""
    require_columns(df, mapping, "field_mapper")
    outputs = list(mapping.values())
    if len(set(outputs)) != len(outputs):
        raise ValueError(f"field_mapper: output names repeat in {outputs}")
    kept = [_col(source).alias(output) for source, output in mapping.items()]
    return df.select(*kept, *[_col(name) for name in envelope_columns(df) if name not in mapping])


def filter_fields(
    df: DataFrame, *, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None
) -> DataFrame:
    """Keep or drop columns; exactly one of the two lists is given. Kept fields follow the list's order."""
    chosen = exactly_one({"include": include, "exclude": exclude}, "include", "exclude")
    if chosen == "include":
        require_columns(df, include, "filter_fields")
        return df.select(*[_col(n) for n in include], *[_col(n) for n in envelope_columns(df) if n not in include])
    require_columns(df, exclude, "filter_fields")
    return df.select(*[_col(name) for name in df.columns if name not in set(exclude)])


def java_template(replacement: str) -> str:
    """A ``$1``-style replacement template as Python's ``re`` writes it (driver-side names only)."""
    return re.sub(r"\$(\d+)", r"\\g<\1>", replacement)


def renamed(
    name: str,
    *,
    convert_case: str | None = None,
    prefix: str = "",
    suffix: str = "",
    replacements: Sequence[Mapping] = (),
) -> str:
    """One name under the rename rules: replacements, then case, then prefix and suffix."""
    single_choice({"convert_case": convert_case}, "convert_case", ("UPPER", "LOWER"))
    for rule in replacements:
        if rule.get("is_regex", True):
            name = re.sub(rule["replace_from"], java_template(rule["replace_to"]), name)
        elif name == rule["replace_from"]:
            name = rule["replace_to"]
    if convert_case:
        name = name.upper() if convert_case == "UPPER" else name.lower()
    return f"{prefix}{name}{suffix}"


def rename_fields(
    df: DataFrame,
    *,
    convert_case: str | None = None,
    prefix: str = "",
    suffix: str = "",
    replacements_with_regex: Sequence[Mapping] = (),
    specific: Sequence[Mapping[str, str]] = (),
) -> DataFrame:
    """Rename payload columns by rule. A ``specific`` rule wins and skips the others for its field."""
    direct = {rule["field_name"]: rule["target_name"] for rule in specific}
    names = {
        name: direct.get(name)
        or renamed(
            name, convert_case=convert_case, prefix=prefix, suffix=suffix, replacements=replacements_with_regex
        )
        for name in payload_columns(df)
    }
    targets = list(names.values())
    if len(set(targets)) != len(targets):
        raise ValueError(f"rename_fields: names collide in {targets}")
    return df.select(*[_col(name).alias(names.get(name, name)) for name in df.columns])


# Java replaces every match; to touch the first only, the match also swallows the rest of the text, which the
# replacement puts back. The group comes last, so the caller's $1, $2 keep their numbers. The guard refuses a
# second, empty match at the very end.
_FIRST_ONLY = r"(?:(?!\G)|\A)(?:%s)(?s:(?<mrtail>.*))"


def replace(
    df: DataFrame,
    *,
    field: str,
    pattern: str,
    replacement: str,
    is_regex: bool = False,
    replace_first: bool = False,
) -> DataFrame:
    """Replace inside one field, in place; NULL stays NULL. ``replace_first`` applies to regex mode only."""
    require_columns(df, [field], "replace")
    if not is_regex:
        value = F.replace(_text(field), F.lit(pattern), F.lit(replacement))
    elif replace_first:
        value = F.regexp_replace(_text(field), _FIRST_ONLY % pattern, replacement + "${mrtail}")
    else:
        value = F.regexp_replace(_text(field), pattern, replacement)
    return df.withColumn(field, value.cast(df.schema[field].dataType))


def split_field(df: DataFrame, *, field: str, separator: str, output_fields: Sequence[str]) -> DataFrame:
    """Split on a regex into named columns: the last one takes the rest, missing parts are NULL."""
    require_columns(df, [field], "split_field")
    refuse_columns(df, output_fields, "split_field")
    parts = F.split(_text(field), separator, len(output_fields))
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(output_fields)})


def regex_extract(
    df: DataFrame,
    *,
    field: str,
    pattern: str,
    output_fields: Sequence[str],
    default_values: Sequence[str | None] | None = None,
) -> DataFrame:
    """Capture groups to columns; on no match or NULL the defaults (NULL when none are given)."""
    require_columns(df, [field], "regex_extract")
    refuse_columns(df, output_fields, "regex_extract")
    groups = re.compile(pattern).groups
    if groups != len(output_fields):
        raise ValueError(f"regex_extract: {groups} capture groups for {len(output_fields)} output fields")
    if default_values is not None and len(default_values) != len(output_fields):
        raise ValueError("regex_extract: as many default_values as output_fields are needed")
    defaults = default_values or [None] * groups
    source = _text(field)
    return df.withColumns(
        {
            name: F.when(source.rlike(pattern), F.regexp_extract(source, pattern, i + 1)).otherwise(
                F.lit(defaults[i]).cast("string")
            )
            for i, name in enumerate(output_fields)
        }
    )
