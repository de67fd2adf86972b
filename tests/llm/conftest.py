"""Tables for the corpus operators: ordinary texts and every odd case."""

from __future__ import annotations

import random

import pytest

WORDS = "river stone amber field quiet lantern harbor winter copper garden shadow thunder meadow silver forest candle".split()


def prose(seed: int, words: int) -> str:
    chooser = random.Random(seed)
    out = []
    for k in range(words):
        word = "".join(chooser.sample(WORDS, 2)) if chooser.random() < 0.5 else chooser.choice(WORDS)
        out.append(word.capitalize() + "." if k % 9 == 8 else word)
    return " ".join(out)


def edited(text: str, seed: int, every: int) -> str:
    chooser = random.Random(seed)
    return " ".join(f"changed{chooser.randrange(10**6)}" if k % every == every - 1 else word for k, word in enumerate(text.split(" ")))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, and columns whose names clash with those of the operators)."""
    base = prose(1, 400)
    texts = [
        base,
        base,  # an exact copy
        base.replace(" ", "  "),  # longer, equal without white space
        edited(base, 2, 150),  # a near copy
        edited(base, 3, 6),  # a distant one
        None,
        "",
        " \t\n ",
        "one",
        "one two",
        "ONE TWO",
        prose(4, 30_000),  # very long
        "x" * 200_000,  # one very long word
        " " * 100_000 + "tail",
        "Éa ßü 漢字 🙂 \x1c\x85 ’quoted’ <|endoftext|>",
        "licence: CC-BY 4.0 and all rights reserved; GNU General Publik Licence",
        "All rights reserved. all RIGHTS\nreserved General Public License",
        "| a | b |\n" * 60,
        "again again " * 100,
    ]
    rows = [(k, t, "en", f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [(100 + k, prose(100 + k, 120), "de" if k % 4 else None, "hot" if k % 3 else None) for k in range(60)]
    rows += [rows[0], rows[0], (None, base, "en", "s0"), (None, prose(7, 80), None, None), (None, None, None, None)]
    return [(*row, None if row[1] is None else len(row[1]), 1, "a", 2.0, True) for row in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, stats int, label string, score double, kept boolean"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True, scope="module")
def no_index_tables_stay(spark):
    """Takes the index tables that a module's tests left open out of the catalog, which all modules share."""
    yield
    for left in spark.catalog.listTables():
        if left.name.startswith("digest_index_"):
            spark.sql(f"DROP TABLE {left.name}")
