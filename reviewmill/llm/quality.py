"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source.

Each signal of a document is compared with an upper fence, Q3 + reach * max(Q3 - Q1, spread), and
for word length also with the mirrored lower fence. Quartiles are read from KLL sketches, which combine on
the map side. A group with fewer than ``least`` rows takes the sketch merged over its language, and
a language with fewer takes the one merged over all. Everything is built-in Spark SQL.

Defined results: a null text is empty and fails the base rules; null languages and sources are groups
of their own; repeated rows are judged alike; an empty table gives no rows; other columns, whatever
their names, pass through ``keep_quality`` untouched. Two rows with one id keep their own verdicts, since
``judge`` works on rows and joins on language and source alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import SPACE_CHARS, text_of, unused, words
from reviewmill.session import keep

#: Sketch size: quantiles are off by about 0.4 % of the ranks at most.
SKETCH_K = 800


@dataclass(frozen=True)
class Signal:
    name: str
    value: str
    spread: float
    both_sides: bool = False


SIGNALS = (
    Signal("symbol_rate", "n_symbols / n_words", 0.05),
    Signal("dup_line_rate", "n_dup_lines / n_lines", 0.2),
    Signal("repeat_rate", "n_repeat_words / n_words", 0.1),
    Signal("word_length", "word_chars / n_words", 0.7, both_sides=True),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``q`` in place of the text (and of a ``q`` it had): counts that the rules use."""
    body = "body"
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    # Packed, so that no column of the caller meets a working column.
    frame = docs.select(F.struct(*rest, F.lit(None).alias(unused(docs.columns, "nothing"))).alias("rest"), text_of(text).alias(body))
    frame = frame.withColumns({"_w": words(F.col(body)), "_lines": _lines_with_word(F.col(body))})
    frame = frame.withColumn("_n", F.size("_w"))
    frame = frame.withColumn("_bits", F.expr("int(coalesce(ceil(log2(_n + 1)), 1))"))
    # One number a window: as many bits of its hash as fit above the bits of its place.
    frame = frame.withColumn(
        "_windows",
        F.expr(
            "sort_array(case when _n < 3 then cast(array() as array<bigint>) else transform(sequence(0, _n - 3), "
            "i -> shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), _bits) | i) end)"
        ),
    )
    same = (
        "(shiftright(_windows[{a}], _bits) = shiftright(_windows[{b}], _bits)"
        " and _w[int({x})] = _w[int({y})] and _w[int({x}) + 1] = _w[int({y}) + 1] and _w[int({x}) + 2] = _w[int({y}) + 2])"
    )
    place = "(_windows[{i}] & (shiftleft(1L, _bits) - 1))"
    here, before, after = (place.format(i=i) for i in ("j", "j - 1", "j + 1"))
    twice = (
        f"(j > 0 and {same.format(a='j', b='j - 1', x=here, y=before)})"
        f" or (j < size(_windows) - 1 and {same.format(a='j', b='j + 1', x=here, y=after)})"
    )
    frame = frame.withColumn(
        "_places",
        F.expr(f"sort_array(transform(filter(_windows, (w, j) -> {twice}), w -> w & (shiftleft(1L, _bits) - 1)))"),
    )
    # A window adds the words that the one before it has not covered, three at most.
    covered = F.expr(
        "aggregate(_places, named_struct('n', 0L, 'last', -3L), "
        "(a, p) -> named_struct('n', a.n + least(3L, p - a.last), 'last', p), a -> a.n)"
    )
    counts = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        _chars_without(F.col(body), SPACE_CHARS).alias("word_chars"),
        (F.length(body) - _chars_without(F.col(body), "#*$%&|<>")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )
    kept = [F.col(f"rest.`{c}`") for c in docs.columns if c not in (text, "q")]
    return frame.select(*kept, counts.alias("q"))


def _chars_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def _lines_with_word(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")


def base_failed() -> Column:
    """The fixed rules: under 50 words, or over half of the words in repeated windows."""
    return (F.col("q.n_words") < 50) | (100 * F.col("q.n_repeat_words") > 50 * F.col("q.n_words"))


def _signal(signal: Signal) -> Column:
    top, bottom = signal.value.split(" / ")
    return F.when(F.col(f"q.{bottom}") > 0, F.col(f"q.{top}") / F.col(f"q.{bottom}"))


def fences(measured: DataFrame, least: int = 50, reach: float = 3.0) -> DataFrame:
    """One row per language and source, with the lower and upper fence of each signal."""
    sketches = measured.select("lang", "source", *(_signal(s).alias(s.name) for s in SIGNALS)).groupBy("lang", "source")
    own = sketches.agg(
        F.count("*").alias("rows"),
        *(F.kll_sketch_agg_double(s.name, F.lit(SKETCH_K)).alias(s.name) for s in SIGNALS),
    )

    def merged(keys: list[str]) -> DataFrame:
        wide = own.groupBy(*keys).agg(
            F.sum("rows").alias("rows"),
            *(F.kll_merge_agg_double(s.name, F.lit(SKETCH_K)).alias(s.name) for s in SIGNALS),
        )
        return wide.select(*keys, F.struct("rows", *(s.name for s in SIGNALS)).alias("wider" if keys else "widest"))

    by_lang, over_all = merged(["lang"]).withColumnRenamed("lang", "_lang"), merged([])
    found = own.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    # One row stands on the right.
    found = found.crossJoin(F.broadcast(over_all))
    columns = []
    for s in SIGNALS:
        sketch = (
            F.when(F.col("rows") >= least, F.col(s.name))
            .when(F.col("wider.rows") >= least, F.col(f"wider.{s.name}"))
            .otherwise(F.col(f"widest.{s.name}"))
        )
        quartile = [
            F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p)))
            for p in (0.25, 0.75)
        ]
        columns += [quartile[0].alias(f"{s.name}_q1"), quartile[1].alias(f"{s.name}_q3")]
    found = found.select("lang", "source", *columns)
    limits = []
    for s in SIGNALS:
        q1, q3 = F.col(f"{s.name}_q1"), F.col(f"{s.name}_q3")
        width = reach * F.greatest(q3 - q1, F.lit(s.spread))
        limits.append((q3 + width).alias(f"{s.name}_most"))
        if s.both_sides:
            limits.append((q1 - width).alias(f"{s.name}_least"))
    return found.select("lang", "source", F.struct(*limits).alias("fence"))


def judge(measured: DataFrame, least: int = 50, reach: float = 3.0, seen: DataFrame | None = None) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``: inside all fences of its language and source.

    ``seen`` is the measured table that the fences are learnt from, where that is not ``measured``.
    """
    # A few dozen bytes per language and source, staged: Spark knows its size before it plans the join, and
    # broadcasts it only if it is small. Else the wide rows would be on their way before it is known.
    limits = keep(fences(measured if seen is None else seen, least, reach), "fences")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    outside = F.lit(False)
    for s in SIGNALS:
        value = _signal(s)
        outside |= F.coalesce(value > F.col(f"fence.{s.name}_most"), F.lit(False))
        if s.both_sides:
            outside |= F.coalesce(value < F.col(f"fence.{s.name}_least"), F.lit(False))
    joined = measured.join(limits, same, "left").drop("_lang", "_source")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~outside)


def keep_quality(docs: DataFrame, least: int = 50, reach: float = 3.0) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they came with.

    The text is measured once for the fences, of which only small sketches stay, and once for the
    verdict: no text is shuffled or staged.
    """
    packed = unused(["text", "lang", "source", "q"], "row")
    rows = docs.select("text", "lang", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(packed))
    narrow = measure(docs.select("text", "lang", "source"))
    judged = judge(measure(rows), least, reach, seen=narrow)
    # A condition that the optimiser may not move: below the join it would repeat the measurements many times.
    return judged.filter(F.when(F.monotonically_increasing_id() >= 0, F.col("kept"))).select(f"{packed}.*")
