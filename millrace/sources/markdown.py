"""Markdown documents to one row per element.

Lines are split and classified on the JVM. A small Arrow function sees only the line classes (one small integer per
line, never the text) of a whole batch and finds, by arithmetic on the boundaries of runs, where each element starts and
ends and which heading it belongs to; the text is cut on the JVM again. Everything is local to the document's row, so
nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import quoted, require_columns

# Line classes; 1 to 6 are headings of that level.
_BLANK, _FENCE, _TILDES, _LIST, _TABLE, _DASHES, _RULE, _EQUALS, _OTHER = 0, 7, 8, 9, 10, 11, 12, 13, 14


def _line_class(line: Column) -> Column:
    hashes = F.length(F.regexp_extract(line, r"^ {0,3}(#{1,6})(?:[ \t]|$)", 1))
    # Most lines are plain text: one look at the first character settles them.
    return (
        F.when(~line.rlike(r"^\s*(?:[-#`~*+_=|0-9]|$)"), _OTHER)
        .when(line.rlike(r"^\s*$"), _BLANK)
        .when(hashes > 0, hashes)
        .when(line.rlike(r"^ {0,3}```"), _FENCE)
        .when(line.rlike(r"^ {0,3}~~~"), _TILDES)
        .when(line.rlike(r"^ {0,3}-{3,}[ \t]*$"), _DASHES)
        .when(line.rlike(r"^ {0,3}(\*{3,}|_{3,})[ \t]*$"), _RULE)
        .when(line.rlike(r"^ {0,3}=+[ \t]*$"), _EQUALS)
        .when(line.rlike(r"^[ \t]*([-*+]|\d{1,9}[.)])[ \t]+\S"), _LIST)
        .when(line.rlike(r"^ {0,3}\|"), _TABLE)
        .otherwise(_OTHER)
        .cast("int")
    )


# The element types.
TYPES = ["Heading", "Paragraph", "ListItem", "CodeBlock", "Table"]
_HEADING, _PARAGRAPH, _ITEM, _CODE, _TABLE_TYPE = range(len(TYPES))


# Stands for lines inside code, and for the line before a document and after it.
_NONE = -1


def _openings(kinds: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which fences open a block, and the fence that closes each (``len(kinds)`` where none does).

    A fence that opens is closed by the next one of its kind in its document, and the next fence after that opens again. So
    the opening ones are what is reached from each document's first by that step, found by doubling its length."""
    n = len(kinds)
    close, last = np.full(n + 1, n), docs * 2 + (kinds == _TILDES)
    order = np.argsort(last, kind="stable")
    same = last[order][1:] == last[order][:-1]
    close[order[:-1][same]] = order[1:][same]
    step = np.full(n + 1, n)
    after = close[:n] + 1
    ok = after < n
    ok[ok] &= docs[after[ok]] == docs[np.flatnonzero(ok)]
    step[:n][ok] = after[ok]
    reached = np.zeros(n + 1, dtype=bool)
    reached[:n] = np.append(True, docs[1:] != docs[:-1]) if n else False
    while (step[:n] < n).any():
        reached[step[reached]] = True
        step = step[step]
    return reached[:n], close[:n]


def _run_starts(mask: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The first place of the run each place of ``mask`` is in; ``joined`` tells which lines belong with the line before."""
    first = mask & ~(joined & np.append(False, mask[:-1]))
    return np.maximum.accumulate(np.where(first, np.arange(len(mask)), 0))


def outlines(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Elements of many documents from the classes of their lines, end to end: document, type, level or 0, first line counted
    from 1, line count, and the position of the heading above or 0. Everything is found from the boundaries of runs."""
    n = len(classes)
    doc, begin = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
    line = classes.astype(np.int64)
    # Code: from an opening fence to its closing one, or to the end of the document.
    fence = np.flatnonzero((line == _FENCE) | (line == _TILDES))
    opens, close = _openings(line[fence], doc[fence])
    code = fence[opens]
    end = (np.repeat(np.cumsum(sizes), sizes))[code] if n else code
    closing = close[opens]
    closed = closing < len(fence)
    end[closed] = fence[closing[closed]]
    inside = np.zeros(n + 1, dtype=np.int64)
    np.add.at(inside, code, 1)
    np.add.at(inside, np.minimum(end + closed, n), -1)
    line = np.where(np.cumsum(inside)[:n] > 0, _NONE, line)
    # Each line beside its neighbours in the document.
    joined = np.append(False, doc[1:] == doc[:-1])[:n]
    before = np.where(joined, np.append(_NONE, line[:-1])[:n], _NONE)
    other, equals = line == _OTHER, line == _EQUALS
    # A run of plain lines behind a list item belongs to it, and what underlines has no paragraph to underline there.
    text_start = _run_starts(other, joined)
    of_list = other & (before[text_start] == _LIST)
    text_before = np.append(False, (other & ~of_list)[:-1])[:n] & joined
    # Lines of equals signs take turns: one that underlines what is above, one that begins a paragraph.
    equals_start = _run_starts(equals, joined)
    turn = (np.arange(n) - equals_start) % 2 == 0
    underlines = equals & (turn == text_before[equals_start])
    begins = equals & ~underlines
    begun_before = np.append(False, begins[:-1])[:n] & joined
    dashes = (line == _DASHES) & (text_before | begun_before)
    # Where elements start.
    heading = (line >= 1) & (line <= 6)
    table = (line == _TABLE) & (before != _TABLE)
    item = line == _LIST
    paragraph = begins | (other & (before != _OTHER) & (before != _LIST) & ~begun_before)
    at = np.concatenate([np.flatnonzero(m) for m in (heading, table, item, paragraph)] + [code])
    kind = np.repeat([_HEADING, _TABLE_TYPE, _ITEM, _PARAGRAPH, _CODE], [heading.sum(), table.sum(), item.sum(), paragraph.sum(), len(code)])
    # A run ends before the next line that does not go on with it.
    goes_on = joined & ((other & ((before == _OTHER) | (before == _LIST) | begun_before)) | ((line == _TABLE) & (before == _TABLE)))
    stops = np.append(np.flatnonzero(~goes_on), n)
    count = stops[np.searchsorted(stops, at, side="right")] - at if n else at
    first, level = at - begin[at] + 1, np.where(kind == _HEADING, line[at], 0)
    of_code = kind == _CODE
    first[of_code] += 1
    count[of_code] = end - code - 1
    # A paragraph with a line under it is a heading.
    under = np.minimum(at + count, max(n - 1, 0))
    drawn = (kind == _PARAGRAPH) & (at + count < n)
    drawn[drawn] &= (underlines | dashes)[under[drawn]] & (doc[under[drawn]] == doc[at[drawn]])
    level = np.where(drawn, np.where(equals[under] if n else False, 1, 2), level)
    kind = np.where(drawn, _HEADING, kind)
    order = np.argsort(at, kind="stable")
    kind, level, first, count, owner = (x[order] for x in (kind, level, first, count, doc[at]))
    return owner, kind, level, first, count, _parents(owner, level)


def _parents(doc: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The position in its document of the heading each element stands under, or 0: the last one before it, for a heading
    the last one of a smaller level. One running maximum for each level."""
    n, place = len(doc), np.arange(len(doc))
    start = np.searchsorted(doc, doc)
    parent = np.zeros(n, dtype=np.int64)
    for own in range(7):
        above = (level > 0) & (level < own) if own else level > 0
        last = np.maximum.accumulate(np.where(above, place, -1))
        last = np.append(-1, last[:-1])[:n]
        mine = (level == own) & (last >= start)
        parent[mine] = last[mine] - start[mine] + 1
    return parent


_FIELDS = ("type", "level", "first", "count", "parent")
_OUTLINE = T.ArrayType(
    T.StructType(
        [T.StructField(name, T.IntegerType()) for name in _FIELDS]
        + [T.StructField("children", T.ArrayType(T.IntegerType()))]
    )
)


@F.arrow_udf(_OUTLINE)
def _outline(classes: pa.Array) -> pa.Array:
    sizes = np.asarray(classes.value_lengths().fill_null(0)).astype(np.int64)
    owner, *columns = outlines(classes.flatten().to_numpy(zero_copy_only=False), sizes)
    flat = np.stack(columns, axis=1).astype(np.int32)
    counts = np.bincount(owner, minlength=len(sizes))
    ends = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(ends[:-1], counts)
    # Children grouped by their parent, in document order.
    below = np.flatnonzero(flat[:, 4])
    above = starts[below] + flat[below, 4] - 1
    order = np.argsort(above, kind="stable")
    child_ends = np.concatenate([[0], np.cumsum(np.bincount(above, minlength=len(flat)))])
    children = pa.ListArray.from_arrays(
        pa.array(child_ends.astype(np.int32)), pa.array((below - starts[below] + 1)[order].astype(np.int32))
    )
    elements = pa.StructArray.from_arrays(
        [*[pa.array(column) for column in flat.T], children], names=[*_FIELDS, "children"]
    )
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), elements)


def _clean(text: Column, kind: Column) -> Column:
    heading = F.regexp_replace(F.regexp_replace(text, r"^ {0,3}#{1,6}(?:[ \t]+|$)", ""), r"(?:^|[ \t]+)#+[ \t]*$", "")
    item = F.regexp_replace(text, r"^[ \t]*(?:[-*+]|\d{1,9}[.)])[ \t]+", "")
    return F.when(kind == _HEADING, F.trim(heading)).when(kind == _ITEM, item).otherwise(text)


def _element_id(kind: Column, position: Column) -> Column:
    names = F.array(*[F.lit(name.lower() + "_") for name in TYPES])
    return F.concat(F.get(names, kind), position.cast("string"))


def markdown_elements(df: DataFrame, *, text_col: str = "text", page_number: int = 1) -> DataFrame:
    """Every other column of the input, then ``element_id, element_type, heading_level, text, page_number,
    position_index, parent_id, child_ids`` (comma-separated), one row per element in document order."""
    require_columns(df, [text_col], "markdown_elements")
    kept = [F.col(quoted(name)) for name in df.columns if name != text_col]
    text, newline = F.col(quoted(text_col)).cast("string"), F.lit("\n")
    for ending in ("\r\n", "\r"):
        text = F.replace(text, F.lit(ending), newline)
    lines = df.withColumn("__lines", F.split(text, "\n"))
    outlined = lines.withColumn("__outline", _outline(F.transform("__lines", _line_class)))
    names = F.array(*[F.lit(name) for name in TYPES])

    def member(position: Column) -> Column:
        return _element_id(F.get("__outline", position - 1)["type"], position)

    def row(e: Column, index: Column) -> Column:
        position = (index + 1).cast("int")
        raw = F.array_join(F.slice("__lines", e["first"], e["count"]), "\n")
        return F.struct(
            _element_id(e["type"], position).alias("element_id"),
            F.get(names, e["type"]).alias("element_type"),
            F.when(e["level"] > 0, e["level"]).alias("heading_level"),
            _clean(raw, e["type"]).alias("text"),
            F.lit(page_number).alias("page_number"),
            position.alias("position_index"),
            F.when(e["parent"] > 0, member(e["parent"])).alias("parent_id"),
            F.array_join(F.transform(e["children"], member), ",").alias("child_ids"),
        )

    # Inside the document's own row: an exploded row would carry a copy of all its lines.
    return outlined.select(*kept, F.inline(F.transform("__outline", row)))
