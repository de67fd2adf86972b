"""Quality rules whose limits follow the corpus: fences from quantile sketches per language and source.

A sketch counts each different text of a language and source once, so copies move no limit. A fence starts from the
median and takes its spread from the half of the texts on the other side, which outliers beyond the fence do not
reach while they are fewer than half: with a third of them, the fence stays within what the other texts have.
What a fence allows besides, where spreads are small, comes from sketches too: from the tails on the other side, as
the median of a second sketch in which each group counts once, so that no group sets it, and from how much
one more thing counts in a text of the group's median size. No limit is a number of this module.

The sketch of a rate is a histogram over whole numbers with 32 buckets to each power of two (exact below
64, within 3 % above). Histograms merge by adding counts, so they are built with map-side partial sums
however large a group is, are the same in any order, and the sketches of all sources of a language add up
to the language's. A group of any size has limits: its sketch is blended with `PRIOR_ROWS` texts spread
evenly over the sketch of its language, and that with as many from the whole corpus, so limits move
smoothly as a group grows. The limits are joined back and filter the rows.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermend.llm.shingling import parts_of_column, text_bytes
from ledgermend.llm.store import free_name, written
from ledgermend.llm.text_stats import STATS, text_stats

MIN_WORDS = 50
"""Base rule: shorter documents fail, and so do those with more than half of their words repeated."""

PRIOR_ROWS = 50
"""How many texts the sketch of the next coarser group counts as in a group's own."""

HALF_SPREADS = 7
"""A fence lies so many distances between the median and the other half's quartile from the median."""

TAILS = 8
"""It lies beyond that by so many distances between median and the other tail's tenth, as most groups have them, at least .."""

THINGS, SIZE_SHARE = 5, 4
""".. or by so many things in a text of the group's median size; for a size, by the SIZE_SHARE-th part of its median."""

#: Rates: factor, counted, out of.
RATES = {
    "symbols": (1000, "n_symbols", "word_chars"),
    "capitals": (1000, "n_upper", "word_chars"),
    "dup_lines": (1000, "n_dup_lines", "n_lines"),
    "twice": (1000, "n_twice", "n_words"),
    "word_length": (10, "word_chars", "n_words"),
}
SIZES = ("word_length",)
"""Rates that measure a size; they are fenced from below too."""

TOTALS = ("word_chars", "n_lines", "n_words")
"""Text sizes, which are sketched beside the rates."""

QUANTILES = {"q10": (1, 10), "q1": (1, 4), "q2": (1, 2), "q3": (3, 4), "q90": (9, 10)}

LIMITS = [f"{name}_max" for name in RATES] + [f"{name}_min" for name in SIZES]


def stats_of(text: Column) -> Column:
    """A struct of the counts of text_stats and a digest of the text.

    Null counts as empty: both have no words, lines or symbols. Whole texts of any length are counted; equal texts have equal
    counts and digests.
    """

    @F.arrow_udf("struct<" + ",".join(f"{name}:bigint" for name in STATS) + ",digest:binary>")
    def stats(texts: pa.Array) -> pa.Array:
        parts, digests = [], []
        for part in parts_of_column(texts):
            parts.append(text_stats(part))
            data, offsets = text_bytes(part)
            digests += [blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        counts = {name: np.concatenate([np.zeros(0, np.int64), *(part[name] for part in parts)]) for name in STATS}
        columns = [pa.array(counts[name]) for name in STATS]
        return pa.StructArray.from_arrays([*columns, pa.array(digests, pa.binary())], names=[*STATS, "digest"])

    return stats(F.coalesce(text.cast("string"), F.lit("")))


def rate(name: str, stats: str) -> Column:
    """A rate over a struct column of counts, as a whole number."""
    factor, counted, total = RATES[name]
    return F.expr(f"{factor} * {stats}.{counted} div greatest({stats}.{total}, 1)")


def bucket(value: str) -> Column:
    """The lowest number of a value's histogram bucket."""
    return F.expr(f"shiftleft(shiftright({value}, greatest(length(bin({value})) - 6, 0)), greatest(length(bin({value})) - 6, 0))")


def distinct_texts(rows: DataFrame, stats: str) -> DataFrame:
    """(lang, source, counts): each different text of a group once; map-side partial steps drop most copies."""
    counts = F.struct(*[F.col(f"{stats}.{name}").alias(name) for name in STATS])
    return (
        rows.select(group_key("lang"), group_key("source"), F.col(f"{stats}.digest").alias("digest"), counts.alias("counts"))
        .groupBy("lang", "source", "digest")
        .agg(*[F.min(f"counts.{name}").alias(name) for name in STATS])
        .select("lang", "source", F.struct(*STATS).alias("counts"))
    )


def sketches(rows: DataFrame, stats: str) -> DataFrame:
    """(lang, source, rate, low, rows): the histogram of each rate, and of each text size as of_<size>, in each group."""
    values = {**{name: rate(name, stats) for name in RATES}, **{f"of_{name}": F.col(f"{stats}.{name}") for name in TOTALS}}
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), value.alias("value")) for name, value in values.items()]))
    return (
        rows.select(group_key("lang"), group_key("source"), pairs.alias("p"))
        .select("lang", "source", "p.rate", bucket("p.value").alias("low"))
        .groupBy("lang", "source", "rate", "low")
        .agg(F.count("*").alias("rows"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Histograms of coarser groups: the counts of the finer ones added."""
    return sketch.groupBy(*keys, "rate", "low").agg(F.sum("rows").alias("rows"))


def placed(sketch: DataFrame, *keys: str) -> DataFrame:
    """The histograms with the count up to each bucket and the whole one."""
    group = Window.partitionBy(*keys, "rate")
    return sketch.select("*", F.sum("rows").over(group.orderBy("low")).alias("upto"), F.sum("rows").over(group).alias("total"))


def prior(sketch: DataFrame, *keys: str) -> DataFrame:
    """Histograms of PRIOR_ROWS texts, spread evenly over those given."""
    upto = [f"(2 * {PRIOR_ROWS} * {rows} + total) div (2 * total)" for rows in ("upto", "(upto - rows)")]
    return placed(sketch, *keys).select(*keys, "rate", "low", F.expr(f"{upto[0]} - {upto[1]}").alias("rows")).where("rows > 0")


def histograms(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, buckets): each histogram as one array, which has at most some hundred buckets."""
    return sketch.groupBy(*keys).agg(F.collect_list(F.struct("low", "rows")).alias("buckets"))


def quantiles(buckets: str) -> Column:
    """A struct of the quantiles of a histogram, in which a bucket may occur more than once."""
    none = ", ".join(f"cast(null as bigint) AS {name}" for name in QUANTILES)
    step = ", ".join(f"coalesce(a.{name}, CASE WHEN (a.upto + x.rows) * {d} >= a.total * {n} THEN x.low END) AS {name}" for name, (n, d) in QUANTILES.items())
    return F.expr(
        f"""aggregate(array_sort({buckets}), struct(0L AS upto, aggregate({buckets}, 0L, (t, x) -> t + x.rows) AS total, {none}),
            (a, x) -> struct(a.upto + x.rows AS upto, a.total AS total, {step}))"""
    )


def _fences(found: DataFrame, *keys: str) -> DataFrame:
    """(keys, <rate>_max, <rate>_min): the limits of each group, from the quantiles (keys, rate, q10, ..) of all groups."""
    sides = F.explode(F.expr("array(struct('max' AS side, q2 - q10 AS tail), struct('min' AS side, q90 - q2 AS tail))"))
    tails = found.select("rate", sides.alias("t")).select("rate", "t.side", bucket("t.tail").alias("low"))
    usual = histograms(tails.groupBy("rate", "side", "low").agg(F.count("*").alias("rows")), "rate", "side").select("rate", "side", quantiles("buckets").q2.alias("tail"))
    usual = usual.groupBy("rate").agg(*[F.max(F.when(F.col("side") == side, F.col("tail"))).alias(f"tail_{side}") for side in ("max", "min")])
    values = F.struct("q1", "q2", "q3", "tail_max", "tail_min")
    group = found.join(usual, "rate").groupBy(*keys).agg(
        *[F.max(F.when(F.col("rate") == name, values)).alias(name) for name in RATES],
        *[F.max(F.when(F.col("rate") == f"of_{name}", F.col("q2"))).alias(f"of_{name}") for name in TOTALS],
    )

    def allowed(name: str, side: str) -> str:
        factor, _, total = RATES[name]
        least = f"{name}.q2 div {SIZE_SHARE}" if name in SIZES else f"{THINGS * factor} div greatest(of_{total}, 1)"
        return f"greatest({TAILS} * {name}.tail_{side}, {least})"

    above = [f"{n}.q2 + {HALF_SPREADS} * ({n}.q2 - {n}.q1) + {allowed(n, 'max')} AS {n}_max" for n in RATES]
    below = [f"{n}.q2 - {HALF_SPREADS} * ({n}.q3 - {n}.q2) - {allowed(n, 'min')} AS {n}_min" for n in SIZES]
    return group.selectExpr(*keys, *above, *below)


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, <rate>_max, <rate>_min): the limits of each group from its own sketch."""
    found = histograms(sketch, *keys, "rate").select(*keys, "rate", quantiles("buckets").alias("q"))
    return _fences(found.select(*keys, "rate", "q.*"), *keys)


def limits(rows: DataFrame, stats: str) -> DataFrame:
    """(lang, source, limits) for every group."""
    by_source = written(sketches(rows, stats), "sketches")
    by_lang = merged(by_source, "lang")
    overall = prior(merged(by_lang.withColumn("all", F.lit(1)), "all"), "all").drop("all")  # PRIOR_ROWS rows a rate at most
    of_lang = by_lang.select("lang").distinct().join(F.broadcast(overall))
    of_lang = histograms(prior(merged(by_lang.unionByName(of_lang), "lang"), "lang"), "lang", "rate").withColumnRenamed("buckets", "before")
    # One row for each rate of a group, whose own buckets and those of its language lie in one array.
    blended = histograms(by_source, "lang", "source", "rate").join(of_lang, ["lang", "rate"])
    found = blended.select("lang", "source", "rate", F.concat("buckets", "before").alias("buckets")).select("lang", "source", "rate", quantiles("buckets").alias("q"))
    found = written(found.select("lang", "source", "rate", "q.*"), "quantiles")
    return _fences(found, "lang", "source").select("lang", "source", F.struct(*LIMITS).alias("limits"))


def base_failed(stats: str) -> Column:
    n = F.col(f"{stats}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * n)


def within(stats: str, found: str) -> Column:
    """Whether no rate lies beyond its limit."""
    ok = F.lit(True)
    for name in RATES:
        ok = ok & (rate(name, stats) <= F.col(f"{found}.{name}_max"))
    for name in SIZES:
        ok = ok & (rate(name, stats) >= F.col(f"{found}.{name}_min"))
    return ok


def group_key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def judged(rows: DataFrame, stats: str, kept: str) -> DataFrame:
    """The rows with a boolean column `kept`, by the counts in their struct column `stats`.

    rows have lang and source, of which null counts as the empty name. Limits come from the different texts
    of all rows that pass the base rule; a row stays if it passes too and lies within its group's limits. Texts
    without words fail the base rule. Repeated rows are judged alike; an empty table gives no rows.
    """
    lang, source, found = (free_name(rows, name) for name in ("of_lang", "of_source", "limits"))
    passing = distinct_texts(rows.where(~base_failed(stats)), stats)
    by_group = limits(passing, "counts").select(F.col("lang").alias(lang), F.col("source").alias(source), F.col("limits").alias(found))
    # Written, so that Spark knows its size before it decides whether to shuffle the rows.
    by_group = written(by_group, "limits")
    of_row = (group_key("lang") == F.col(lang)) & (group_key("source") == F.col(source))
    return rows.join(by_group, of_row, "left").withColumn(kept, ~base_failed(stats) & within(stats, found)).drop(lang, source, found)
