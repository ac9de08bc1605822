"""Outlines of markdown documents against a reader that goes line by line."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.sources import markdown
from millrace.sources.markdown import (
    _CODE,
    _DASHES,
    _EQUALS,
    _FENCE,
    _HEADING,
    _ITEM,
    _LIST,
    _OTHER,
    _PARAGRAPH,
    _TABLE,
    _TABLE_TYPE,
    _TILDES,
)


def outline(classes) -> list[tuple[int, int, int, int, int]]:
    """Elements of one document from its line classes: (type, level or 0, first line counted from 1, line count,
    position of the heading above or 0)."""
    elements: list[tuple[int, int, int, int, int]] = []
    opened: list[tuple[int, int]] = []  # headings above the current line: (level, position)

    def add(kind: int, first: int, count: int, level: int = 0) -> None:
        if level:
            while opened and opened[-1][0] >= level:
                opened.pop()
        elements.append((kind, level, first, count, opened[-1][1] if opened else 0))
        if level:
            opened.append((level, len(elements)))

    at, total = 0, len(classes)
    while at < total:
        kind, start = classes[at], at
        at += 1
        if 1 <= kind <= 6:
            add(_HEADING, start + 1, 1, kind)
        elif kind in (_FENCE, _TILDES):
            while at < total and classes[at] != kind:
                at += 1
            add(_CODE, start + 2, at - start - 1)
            at += 1
        elif kind == _TABLE:
            while at < total and classes[at] == _TABLE:
                at += 1
            add(_TABLE_TYPE, start + 1, at - start)
        elif kind in (_LIST, _OTHER, _EQUALS):
            while at < total and classes[at] == _OTHER:
                at += 1
            if kind != _LIST and at < total and classes[at] in (_EQUALS, _DASHES):
                add(_HEADING, start + 1, at - start, 1 if classes[at] == _EQUALS else 2)
                at += 1
            else:
                add(_ITEM if kind == _LIST else _PARAGRAPH, start + 1, at - start)
    return elements


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, *range(7, 15)]), max_size=14), max_size=5))
def test_outlines(documents):
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    flat = np.array([c for d in documents for c in d], dtype=np.int32)
    found = [[] for _ in documents]
    for doc, *element in zip(*(x.tolist() for x in markdown.outlines(flat, sizes))):
        found[doc].append(tuple(element))
    assert found == [outline(d) for d in documents]
