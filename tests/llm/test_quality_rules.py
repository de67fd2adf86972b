from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermend.llm.quality_rules import LIMITS, RATES, base_failed, bucket, distinct_texts, fences, judged, limits, merged, rate, sketches, stats_of
from ledgermend.llm.store import written
from ledgermend.llm.text_stats import text_stats

SPACE = r"[^\x20\x09-\x0D]"


def brute_stats(text: str | None) -> dict[str, int]:
    text = text or ""
    words = re.findall(SPACE + "+", text)
    lines = [line for line in text.split("\n") if re.search(SPACE, line)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_twice": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        "n_different": len(set(words)),
    }


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab#B \n\t\x0bé漢\x1c\x85", max_size=60)), max_size=6))
def test_counts(texts):
    got = text_stats(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert {name: int(got[name][k]) for name in brute_stats(text)} == brute_stats(text)


def test_odd_rows(odd, odd_rows):
    rows = odd.withColumn("counts", stats_of(F.col("text")))
    got = judged(rows, "counts", "good").collect()
    assert len(got) == len(odd_rows) and set(got[0].asDict()) == {*odd.columns, "counts", "good"}
    for row in got:
        want = brute_stats(row.text)
        assert {name: row.counts[name] for name in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert row.good is not None and not (failed and row.good)


def test_no_rows(none):
    rows = none.withColumn("counts", stats_of(F.col("text")))
    assert judged(rows, "counts", "good").collect() == []


def test_limits_follow_the_group(spark):
    """What is usual in one source is an outlier in another; few rows take the language's limits."""
    chooser = random.Random(5)

    def text(symbols: int) -> str:
        words = [f"word{chooser.randrange(10**6)}" for _ in range(100)]
        return " ".join(words[:-symbols] + ["#" * 9] * symbols if symbols else words)

    rows = [("en", "plain", text(0)) for _ in range(300)] + [("en", "tables", text(18 + k % 5)) for k in range(300)]
    rows += [("en", "plain", text(20)), ("de", "few", text(0))]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    got = judged(docs.withColumn("counts", stats_of(F.col("text"))), "counts", "good").collect()
    assert [r.doc_id for r in got if not r.good] == [600]


def test_sketches_merge_and_bound_the_error(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123_456_789]
    lows = [r.low for r in spark.createDataFrame([(v,) for v in values], "v long").select(bucket("v").alias("low")).collect()]
    assert lows[:4] == [0, 1, 63, 64] and all(low <= v < low + max(1, low / 32) + 1e-9 for low, v in zip(lows, values, strict=True))
    zeros = {name: 0 for name in ("n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_twice", "n_words")}
    fields = ", ".join(f"{n} as {n}" for n in zeros)
    rows = spark.range(1000).selectExpr("'l' as lang", "id % 2 as source", f"named_struct({', '.join(f'{n!r}, 0L' for n in zeros)}, 'word_chars', id) as counts")
    assert fields
    whole = sketches(rows.withColumn("source", F.lit("one")), "counts")
    parts = merged(sketches(rows, "counts"), "lang")
    key = ["rate", "low", "rows"]
    assert sorted(whole.select(key).collect()) == sorted(parts.select(key).collect())
    assert fences(parts, "lang").count() == 1 and limits(rows, "counts").count() == 2 and RATES


def _bucket(v: int) -> int:
    shift = max(v.bit_length() - 6, 0)
    return v >> shift << shift


def _quantile(histogram: Counter, n: int, d: int) -> int:
    total, upto = sum(histogram.values()), 0
    for low in sorted(histogram):
        upto += histogram[low]
        if upto * d >= total * n:
            return low
    raise AssertionError


def _spread(histogram: Counter, rows: int = 50) -> Counter:
    """So many texts spread evenly over a histogram."""
    total, upto, out = sum(histogram.values()), 0, Counter()
    for low in sorted(histogram):
        before, upto = upto, upto + histogram[low]
        out[low] = (2 * rows * upto + total) // (2 * total) - (2 * rows * before + total) // (2 * total)
    return +out


def brute_verdicts(rows: list[tuple]) -> list[bool]:
    """The rule in plain Python for (text, lang, source)."""
    factors = {name: rate[0] for name, rate in RATES.items()}
    counted, groups = [], {}
    for text, lang, source in rows:
        s = brute_stats(text)
        values = {name: factors[name] * s[of] // max(s[total], 1) for name, (_, of, total) in RATES.items()}
        failed = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        counted.append((failed, values, (lang or "", source or "")))
        if not failed:
            groups.setdefault((lang or "", source or ""), {})[text] = {**values, **{f"of_{t}": s[t] for t in ("word_chars", "n_lines", "n_words")}}
    names = [*RATES, "of_word_chars", "of_n_lines", "of_n_words"]
    own = {(g, n): Counter(_bucket(v[n]) for v in texts.values()) for g, texts in groups.items() for n in names}
    overall = {n: _spread(sum((own[g, n] for g in groups), Counter())) for n in names} if groups else {}
    langs = {g[0] for g in groups}
    of_lang = {(lang, n): _spread(sum((own[g, n] for g in groups if g[0] == lang), Counter()) + overall[n]) for lang in langs for n in names}
    quant = {}
    for g in groups:
        for n in names:
            blended = own[g, n] + of_lang[g[0], n]
            quant[g, n] = {q: _quantile(blended, *f) for q, f in {"q10": (1, 10), "q1": (1, 4), "q2": (1, 2), "q3": (3, 4), "q90": (9, 10)}.items()}
    verdicts = []
    for failed, values, g in counted:
        ok = not failed
        for n, (factor, _, total) in RATES.items() if ok else ():
            q = quant[g, n]
            up = _quantile(Counter(_bucket(quant[h, n]["q2"] - quant[h, n]["q10"]) for h in groups), 1, 2)
            down = _quantile(Counter(_bucket(quant[h, n]["q90"] - quant[h, n]["q2"]) for h in groups), 1, 2)
            least = q["q2"] // 4 if n == "word_length" else 5 * factor // max(quant[g, f"of_{total}"]["q2"], 1)
            ok = ok and values[n] <= q["q2"] + 7 * (q["q2"] - q["q1"]) + max(8 * up, least)
            if n == "word_length":
                ok = ok and values[n] >= q["q2"] - 7 * (q["q3"] - q["q2"]) - max(8 * down, least)
        verdicts.append(ok)
    return verdicts


def test_verdicts_are_those_of_the_rule(spark, data_root, odd_rows):
    given = [(r.text, r.lang, r.source) for r in spark.read.parquet(str(data_root / "sf0.01" / "documents.parquet")).collect()]
    for rows in (given, [r[1:4] for r in odd_rows]):
        docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
        got = {r.doc_id: r.good for r in judged(docs.withColumn("counts", stats_of(F.col("text"))), "counts", "good").collect()}
        assert [got[k] for k in range(len(rows))] == brute_verdicts(rows)


def test_limits_differ_between_groups(spark, data_root):
    """No rate has one limit everywhere, and more than one rejects."""
    docs = spark.read.parquet(str(data_root / "sf0.1" / "documents.parquet"))
    rows = written(docs.select("doc_id", "lang", "source", stats_of(F.col("text")).alias("counts")), "stats").where(~base_failed("counts"))
    found = limits(distinct_texts(rows, "counts"), "counts").select("lang", "source", "limits.*")
    kinds = found.agg(*[F.countDistinct(name).alias(name) for name in LIMITS]).first()
    assert all(kinds[name] > 1 for name in LIMITS), kinds
    joined = rows.join(found, ["lang", "source"])
    beyond = joined.agg(*[F.count_if(rate(name, "counts") > F.col(f"{name}_max")).alias(name) for name in RATES]).first()
    assert sum(beyond[name] > 0 for name in RATES) >= 2, beyond
