"""Quality rules: a table of thresholds compiled into one projection, evaluated without user functions.

Everything is per document and row-local: no shuffle, no state beyond one document. The long texts cost what their
length costs; arrays of one document are the largest thing held.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import let, plain_words, unused

# Characters counted as symbols, and frequent function words of four languages.
SYMBOLS = "[#*$%&|<>]"
STOP_WORDS = (
    "the be to of and that have with is in it for as was on are this an by or from at not "
    "le la les de des du et un une que qui est en pour dans sur avec au par "
    "der die das und ist nicht ein eine zu im von sich den mit auf für "
    "el los las una y es por con para del como más su al lo se"
).split()

# A stop word counts in lower case, capitalised or in capitals.
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Keep a document only if ``low <= metric <= high``; a bound of None is open. ``metric`` names an entry of
    ``metric_columns``. A metric that has no value (a ratio over nothing) passes, and so does a text of fewer than
    ``min_words`` words, where a share of words or lines says little."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# The base conditions: enough words, and not mainly repetition (percent of words in repeated windows).
BASE_RULES = (
    Rule("enough words", "n_words", low=10),
    Rule("little repetition", "repeat_percent", high=20),
)

# Further production thresholds.
RULES = (
    Rule("word length", "mean_word_chars", low=1.5, high=15),
    Rule("few symbols", "symbols_per_word", high=0.1),
    Rule("function words", "stop_word_ratio", low=0.01, min_words=50),
    Rule("repeated lines", "dup_line_ratio", high=0.5, min_words=50),
    Rule("cut-off lines", "ellipsis_line_ratio", high=0.3),
    Rule("list lines", "bullet_line_ratio", high=0.9),
    Rule("capitals", "upper_char_ratio", high=0.4),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def with_counts(df: DataFrame, text_col: str, prefix: str) -> DataFrame:
    """``df`` with the counts of one text in columns called ``prefix`` + name.

    ``prefix`` must not begin any column of ``df``. The window count is exact: hashes only decide whether a text can
    have a repeated window at all (equal windows always have equal hashes); the windows of those that can are compared
    as text.
    """
    p = prefix

    def c(name: str) -> Column:
        return F.col(f"`{p}{name}`")

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    def of_words(ws: Column) -> Column:
        starts = F.greatest(F.size(ws) - (WINDOW - 1), F.lit(0))
        grams = F.transform(
            F.slice(ws, F.lit(1), starts),
            lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, WINDOW)]),
        )
        return F.struct(
            ws.alias("words"),
            F.size(F.filter(ws, lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop"),
            grams.alias("grams"),
        )

    step = df.withColumns(
        {
            f"{p}of_words": let(plain_words(text), of_words),
            f"{p}lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            f"{p}n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            f"{p}n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
        }
    )
    step = step.withColumns(
        {
            f"{p}words": c("of_words")["words"],
            f"{p}grams": c("of_words")["grams"],
            f"{p}n_stop": c("of_words")["n_stop"],
            f"{p}n_words": F.size(c("of_words")["words"]).cast("long"),
            f"{p}word_chars": F.char_length(F.array_join(c("of_words")["words"], "")).cast("long"),
            f"{p}n_lines": F.size(c("lines")).cast("long"),
            f"{p}n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            f"{p}n_ellipsis": F.size(F.filter(c("lines"), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*\z"))).cast("long"),
            f"{p}n_bullet": F.size(F.filter(c("lines"), lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•‣][\x20\x09-\x0D]"))).cast("long"),
        }
    )
    step = step.withColumn(f"{p}may_repeat", F.size(F.array_distinct(c("grams"))) < F.size(c("grams")))
    # A sort key for each window: 34 bits of its hash, then its place. Windows that may be equal stand side by side.
    key = lambda h, i: F.shiftleft(h, 30).bitwiseOR(i.cast("long"))
    step = step.withColumn(f"{p}keys", F.when(c("may_repeat"), F.sort_array(F.transform(c("grams"), key))))
    near = lambda x, k: F.coalesce(F.shiftright(F.get(c("keys"), k), 30) == F.shiftright(x, 30), F.lit(False))
    step = step.withColumn(
        f"{p}places",
        F.transform(
            F.filter(c("keys"), lambda x, k: near(x, k - 1) | near(x, k + 1)),
            lambda x: x.bitwiseAND(F.lit(2**30 - 1)).cast("int"),
        ),
    )
    window = F.transform(
        c("places"),
        lambda i: F.struct(
            F.concat_ws(" ", *[F.get(c("words"), i + k) for k in range(WINDOW)]).alias("g"), i.alias("at")
        ),
    )
    step = step.withColumn(f"{p}sorted", F.sort_array(window))
    equal = lambda k, other: F.get(c("sorted"), k)["g"] == F.get(c("sorted"), other)["g"]
    found = F.filter(
        F.transform(
            c("sorted"),
            lambda x, k: F.when(
                F.coalesce(equal(k, k - 1), F.lit(False)) | F.coalesce(equal(k, k + 1), F.lit(False)), x["at"]
            ),
        ),
        lambda at: at.isNotNull(),
    )
    covered = F.aggregate(
        F.sort_array(found),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), at + WINDOW - acc["end"])).alias("n"), (at + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    step = step.withColumn(f"{p}n_repeat_words", F.when(c("may_repeat"), covered).otherwise(0).cast("long"))
    return step.drop(*[f"{p}{n}" for n in ("of_words", "words", "lines", "grams", "may_repeat", "keys", "places", "sorted")])


def metric_columns(prefix: str) -> dict[str, Column]:
    """The metrics rules may name, over the counts of ``with_counts``."""
    c = {n: F.col(f"`{prefix}{n}`") for n in COUNTS}
    return {
        "n_words": c["n_words"],
        "n_lines": c["n_lines"],
        "repeat_percent": _ratio(100 * c["n_repeat_words"], c["n_words"]),
        "mean_word_chars": _ratio(c["word_chars"], c["n_words"]),
        "symbols_per_word": _ratio(c["n_symbols"], c["n_words"]),
        "stop_word_ratio": _ratio(c["n_stop"], c["n_words"]),
        "upper_char_ratio": _ratio(c["n_upper"], c["word_chars"]),
        "dup_line_ratio": _ratio(c["n_dup_lines"], c["n_lines"]),
        "ellipsis_line_ratio": _ratio(c["n_ellipsis"], c["n_lines"]),
        "bullet_line_ratio": _ratio(c["n_bullet"], c["n_lines"]),
    }


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_stop", "n_upper", "n_lines", "n_dup_lines", "n_ellipsis", "n_bullet",
    "n_repeat_words",
)


def failing(rules: tuple[Rule, ...], prefix: str) -> Column:
    """The names of the rules a document breaks, as an array, in the order of the table."""
    metrics = metric_columns(prefix)
    broken = []
    for rule in rules:
        value = metrics[rule.metric]
        breaks = F.lit(False)
        if rule.low is not None:
            breaks = breaks | F.coalesce(value < F.lit(rule.low), F.lit(False))
        if rule.high is not None:
            breaks = breaks | F.coalesce(value > F.lit(rule.high), F.lit(False))
        if rule.min_words:
            breaks = breaks & (metrics["n_words"] >= rule.min_words)
        broken.append(F.when(breaks, F.lit(rule.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull()) if broken else F.array().cast("array<string>")


def _pinned(counted: DataFrame, prefix: str) -> DataFrame:
    """``counted`` with its counts behind a projection Spark does not push conditions through. A condition on a count
    would otherwise be rewritten into the expressions of the count, many times over."""
    packed = F.struct(*[F.col(f"`{prefix}{n}`").alias(n) for n in COUNTS])
    # A row number is never negative, and never known to the optimizer.
    held = counted.select("id", F.when(F.monotonically_increasing_id() >= 0, packed).alias("counts"))
    return held.select("id", *[F.col(f"counts.{n}").alias(f"{prefix}{n}") for n in COUNTS])


def quality_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per row of ``docs``: the id, all counts, ``base_failed``, ``failed`` (names of broken rules) and ``kept``.

    A null or empty text has no words and is rejected; a null id is returned as null; repeated rows are judged each for
    themselves; an empty table gives no rows. Other columns of ``docs``, whatever they are called, play no part.
    """
    p = "q_"
    only = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counted = _pinned(with_counts(only, "text", p), p)
    base, rest = failing(BASE_RULES, p), failing(rules, p)
    return counted.select(
        F.col("id").alias(id_col),
        *[F.col(f"{p}{n}").alias(n) for n in COUNTS],
        (F.size(base) > 0).alias("base_failed"),
        F.concat(base, rest).alias("failed"),
        (F.size(F.concat(base, rest)) == 0).alias("kept"),
    )


def keep_by_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with their own columns. See ``quality_report`` for nulls and ties."""
    p = unused(docs, "q_")
    while any(c.lower().startswith(p.lower()) for c in docs.columns):
        p = f"_{p}"
    # Spark would push the condition through the projections below and so repeat their expressions many times over; a
    # condition on a row number stays where it is.
    pin = f"{p}pin"
    counted = with_counts(docs, text_col, p).withColumn(pin, F.monotonically_increasing_id())
    ok = F.size(F.concat(failing(BASE_RULES, p), failing(rules, p))) == 0
    return counted.where((F.col(f"`{pin}`") >= 0) & ok).select(*[F.col(f"`{c}`") for c in docs.columns])
