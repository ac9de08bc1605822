"""Benchmark decontamination: a prefix-filtered set join between document shingles and benchmark windows.

An item is cut into windows of ``window`` consecutive words (a shorter item is one window). A document contains a window
when those words stand in it in a row. For exact containment every shingle of the window must occur in the document, so
one of them, the prefix, is necessary: the one expected to be rarest. Only prefixes are joined to the shingles of the
documents; what passes the length and positional bounds is compared word by word.

Neighbouring windows mostly share their prefix, so the prefix table has one row for each run of windows with the same
prefix, and carries the few words that verification needs. It is broadcast if its measured size is below
``max_broadcast_bytes``; then one pass over the documents explodes, probes and verifies without shuffling any text, and
only verified hits and one marker row per document are grouped. A larger benchmark is joined by a shuffle of hashes,
and candidates are joined back to the words of their documents; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.text import folded_words, let, unused
from millrace.session import written

WINDOW = 10
SHINGLE = 5
MAX_BROADCAST_BYTES = 32 << 20
MARKER = -1  # the hash of the row every document sends along; told from a shingle by its place


def _shingle_hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + j) for j in range(k)])


def prefix_table(benchmark: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """One row for each run of windows that share a prefix: hash ``h`` of ``k`` words at place ``q`` of the item, window
    starts ``first`` to ``last``, window length ``len``, and ``span``, the item's words from ``first`` on.

    The order is by expected rarity, the sum of the logarithms of the words' counts in the benchmark, then by hash: a
    total order, which is all that completeness of the prefix filter needs. Counting the shingles in the documents
    would cost a second pass over all texts."""
    items = written(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"),
            F.col(f"`{item_col}`").alias("item_id"),
            folded_words(F.col(f"`{text_col}`")).alias("words"),
        )
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumns({"len": F.least("n", F.lit(window)), "k": F.least("n", F.lit(shingle))}),
        "benchmark-items",
    )
    spread = items.select("item", "n", "len", "k", F.posexplode("words").alias("q", "word"))
    counts = spread.groupBy("word").agg(F.log(F.count(F.lit(1)).cast("double")).alias("ln"))
    ahead = Window.partitionBy("item").orderBy("q")
    scored = spread.join(counts, "word").withColumn(
        "score", F.sum("ln").over(ahead.rowsBetween(Window.currentRow, shingle - 1))
    )
    # A shingle starts where k words remain; a window starts where len words remain.
    scored = scored.where("q <= n - k").withColumn(
        "prefix",
        F.min(F.struct("score", "word", "q")).over(ahead.rowsBetween(Window.currentRow, window - shingle))["q"],
    )
    runs = (
        scored.where("q <= n - len")
        .groupBy("item", F.col("prefix").alias("q"))
        .agg(F.min("q").alias("first"), F.max("q").alias("last"))
    )
    table = runs.join(items, "item")
    hashes = F.lit(None).cast("long")
    for k in range(1, shingle + 1):
        hashes = F.when(F.col("k") == k, _shingle_hash(F.col("words"), F.col("q"), k)).otherwise(hashes)
    span = F.slice("words", F.col("first") + 1, F.col("last") - F.col("first") + F.col("len"))
    return table.select(hashes.alias("h"), "k", "q", "first", "last", "len", span.alias("span"), "item_id")


def _sizes(n: Column, ks: list[int]) -> list[Column]:
    return [F.greatest(n - (k - 1), F.lit(0)) for k in ks]


def _shingles(docs: DataFrame, ks: list[int], mark: bool) -> DataFrame:
    """``docs`` (row, id, words, n) exploded to ``place`` and ``h``: the shingles of each length in turn, then the
    marker."""

    def run(ws: Column, k: int) -> Column:
        starts = F.greatest(F.size(ws) - (k - 1), F.lit(0))
        return F.transform(
            F.slice(ws, F.lit(1), starts),
            lambda w, i: F.xxhash64(F.lit(k), w, *[F.get(ws, i + j) for j in range(1, k)]),
        )

    def hashes(ws: Column) -> Column:
        runs = [run(ws, k) for k in ks]
        marker = [F.array(F.lit(MARKER).cast("long"))] if mark else []
        return F.struct(ws.alias("words"), F.concat(*runs, *marker).alias("h"))

    both = docs.select("row", "id", let(folded_words(F.col("text")), hashes).alias("both"))
    split = both.select("row", "id", F.col("both.words").alias("words"), F.col("both.h").alias("hs"))
    return split.select("row", "id", "words", F.size("words").alias("n"), F.posexplode_outer("hs").alias("place", "h"))


def _placed(candidates: DataFrame, ks: list[int]) -> DataFrame:
    """``candidates`` with ``p``, the shingle's place in the document (null for a shingle of another length), and the
    window starts ``lo`` to ``hi`` whose windows would lie inside the document."""
    at, offset = F.lit(None).cast("int"), F.lit(0)
    for k, size in zip(ks, _sizes(F.col("n"), ks)):
        p = F.col("place") - offset
        at = F.when((F.col("k") == k) & (p >= 0) & (p < size), p).otherwise(at)
        offset = offset + size
    return candidates.withColumn("p", at).withColumns(
        {
            "lo": F.greatest(F.col("first"), F.col("q") - F.col("p")),
            "hi": F.least(F.col("last"), F.col("q") - F.col("p") + F.col("n") - F.col("len")),
        }
    )


# Length and positional bounds.
POSSIBLE = "p IS NOT NULL AND n >= len AND lo <= hi"


def _cut(found: DataFrame) -> DataFrame:
    """Candidates with ``here``, the document words of the windows in question, in place of all words: a long document
    may have many candidates, and each must stay small."""
    width = F.col("hi") - F.col("lo") + F.col("len")
    here = F.slice("words", F.col("p") - F.col("q") + F.col("lo") + 1, width)
    return found.select(
        "row", "id", "n", "item_id", "len", (F.col("p") - F.col("q") + F.col("lo")).alias("at"), here.alias("here"),
        F.slice("span", F.col("lo") - F.col("first") + 1, width).alias("there"),
    )


def _verified() -> Column:
    """The document words ``from`` up to ``to`` that verified windows cover, null if none of them is there. All windows
    of a run contain its prefix, so what they cover has no gap."""
    last = F.least(F.size("here"), F.size("there")) - F.col("len")
    same = F.filter(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda s: F.slice("here", s + 1, F.col("len")) == F.slice("there", s + 1, F.col("len")),
    )
    return let(
        same,
        lambda s: F.when(
            F.size(s) > 0,
            F.struct(
                (F.col("at") + F.array_min(s)).alias("from"), (F.col("at") + F.array_max(s) + F.col("len")).alias("to")
            ),
        ),
    )


def _covered(intervals: Column) -> Column:
    return F.aggregate(
        F.sort_array(intervals),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["to"] - F.greatest(x["from"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["to"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``hits`` (sorted word intervals), ``n_hit``, ``item_ids`` (sorted as
    strings), ``n_items``, ``contaminated``.

    A null or empty text has no words and no hits; items without words match nothing. Repeated documents are judged
    each for themselves; repeated items count once by id. An item without an id makes words hit but cannot be listed.
    Without documents there are no rows, without items no hits. Other columns play no part.
    """
    prefixes = written(prefix_table(benchmark, item_id_col, item_text_col, window, shingle), "benchmark-prefixes")
    size = prefixes.agg(
        F.sum(F.octet_length(F.array_join("span", "")) + 16 * F.size("span") + 80).alias("bytes"),
        F.collect_set("k").alias("ks"),  # at most `shingle` values
    ).first()
    ks = sorted(size["ks"], reverse=True) or [shingle]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    if (size["bytes"] or 0) <= max_broadcast_bytes:
        hits = _fused(rows, prefixes, ks)
    else:
        hits = _shuffled(written(rows, "decontaminate-rows"), prefixes, ks)
    out = hits.groupBy("row", "id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.collect_set("hit").alias("hits"),
        F.collect_set(F.when(F.col("hit").isNotNull(), F.col("item_id").cast("string"))).alias("item_ids"),
    )
    out = out.withColumns({"hits": F.sort_array("hits"), "item_ids": F.sort_array("item_ids")})
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "hits",
        _covered(F.col("hits")).cast("long").alias("n_hit"),
        "item_ids",
        F.size("item_ids").cast("long").alias("n_items"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def _fused(rows: DataFrame, prefixes: DataFrame, ks: list[int]) -> DataFrame:
    """Hits and one marker row per document, in one pass: explode, probe the broadcast prefixes, verify."""
    marker = prefixes.sparkSession.range(1).select(F.lit(MARKER).cast("long").alias("h"))
    probes = F.broadcast(prefixes.unionByName(marker, allowMissingColumns=True))
    total = F.lit(0)
    for size in _sizes(F.col("n"), ks):
        total = total + size
    is_marker = F.col("k").isNull() & (F.col("place") == total)
    found = _placed(_shingles(rows, ks, mark=True).join(probes, "h"), ks).where(is_marker | F.expr(POSSIBLE))
    # No filter on the verdict here: Spark would evaluate it inside the join, which then carries all words of a document
    # with every candidate. What is not verified has a null hit, which the grouping leaves out.
    return _cut(found).select("row", "id", "n", "item_id", _verified().alias("hit"))


def _shuffled(rows: DataFrame, prefixes: DataFrame, ks: list[int]) -> DataFrame:
    """The same rows by shuffles: hashes meet prefixes, then candidates meet the words of their document."""
    found = _placed(_shingles(rows, ks, mark=False).drop("words").join(prefixes, "h"), ks).where(POSSIBLE)
    words = rows.select("row", folded_words(F.col("text")).alias("words"))
    cut = _cut(found.join(words, "row"))
    hits = cut.select("row", "id", "n", "item_id", _verified().alias("hit")).where("hit IS NOT NULL")
    everyone = rows.select("row", "id", F.size(folded_words(F.col("text"))).alias("n"))
    return hits.unionByName(everyone, allowMissingColumns=True)


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their own columns.

    Documents are told apart by id: rows that share an id (a null id counts as one) go if one of them is contaminated.
    The ids to drop are broadcast if all of them stay below ``MAX_BROADCAST_BYTES``, else joined by a shuffle.
    """
    bad = contamination(docs, benchmark, id_col, **options).where("contaminated")
    hidden = unused(docs, "bad_id")
    bad = written(bad.select(F.col(f"`{id_col}`").alias(hidden)).distinct(), "contaminated-ids")
    if bad.count() * 32 <= MAX_BROADCAST_BYTES:
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(f"`{id_col}`").eqNullSafe(F.col(hidden)), "left_anti")
