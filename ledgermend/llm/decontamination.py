"""Benchmark decontamination: a broadcast hash set of benchmark windows, with DataFrame functions only.

Words are runs of letters, digits and characters beyond ASCII, lower-cased in A-Z. Every benchmark item gives
its windows of `width` consecutive words, a shorter one itself as only window. All windows of a document's words
are hashed where the document lies and looked up in the broadcast set of window hashes, so that only hits and one
row per document leave the scan. Hits are then verified: texts that have any are cut into words again, each text once however
many documents have it, and the words at each place are compared with the window's. Overlapping windows make
spans, which can be removed, or the documents with them.

Sets of items that hold a window, and combinations of such sets within texts, are looked up once each, so that
a passage of many items in many documents costs neither items times documents nor a hot task.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermend.llm.store import free_name, written

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
"""A character between words."""

WIDTH = 10
BROADCAST_WINDOWS = 1 << 21
"""Up to so many different windows, or ids of texts with hits, are broadcast; more are joined by a shuffle."""


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; null has none. (regexp_extract_all would copy the text for each match.)"""
    return F.array_remove(F.split(F.translate(text_of(text), ascii_uppercase, ascii_lowercase), BETWEEN + "+"), "")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text_of(text)))


def gram_at(words: str, at: str, n: str) -> str:
    """The n words from place `at` on, element by element: slice() would copy the whole array each time."""
    return f"transform(sequence(0, {n} - 1), k -> get({words}, int({at}) + k))"


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(hash, n, gram, items_id), each different window once, and (items_id, items), the sets of items that hold one.

    Items with equal words are handled as one until their ids are needed. An item without words has no window; one without
    item_id has windows, but no set names it.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    classes = items.where(F.size("words") > 0).groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    n = F.least(F.lit(width), F.size("words"))
    sized = classes.select("words", "ids", n.alias("n"))
    grams = F.expr(f"explode_outer(transform(sequence(0, size(words) - n), at -> {gram_at('words', 'at', 'n')}))")
    placed = sized.select("n", grams.alias("gram"), "ids")
    grams = placed.groupBy("n", "gram").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    named = grams.select(
        F.xxhash64("n", "gram").alias("hash"), "n", "gram", F.unhex(F.md5(F.concat_ws("\n", "items"))).alias("items_id"), "items"
    )
    named = written(named, "windows")
    return named.drop("items"), named.groupBy("items_id").agg(F.first("items").alias("items"))


def _small(rows: DataFrame, count: int) -> DataFrame:
    return F.broadcast(rows) if count <= BROADCAST_WINDOWS else rows


def scanned(documents: DataFrame, windows: DataFrame, count: int) -> DataFrame:
    """(doc_id, digest, n_words, at, n, hash): a row for each place of a window's hash, and one without n for each document."""
    lengths = sorted((row.n for row in windows.select("n").distinct().collect()), reverse=True)  # at most `width` numbers
    words = documents.select(F.col("doc_id"), digest_of(F.col("text")).alias("digest"), words_of(F.col("text")).alias("words"))

    def hashes(n: int) -> Column:
        # Equals the hash of n and the array of the words.
        every = F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda at: F.xxhash64(F.lit(n), *[F.get("words", at + k) for k in range(n)]))
        return F.when(F.size("words") >= n, every).otherwise(F.expr("array()").cast("array<bigint>"))

    # The last element stands for the document itself; its hash keeps documents apart where the join is a shuffle.
    last = F.array(F.xxhash64("digest", F.size("words")))
    hashed = words.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), F.concat(*map(hashes, lengths), last).alias("hashes"))
    # The outer form, as Spark would test the other one's arrays for emptiness below, and make them once more for it.
    exploded = hashed.select("doc_id", "digest", "n_words", F.posexplode_outer("hashes").alias("place", "hash"))
    found = exploded.join(_small(windows.select("hash", "n").distinct(), count), "hash", "left")
    at, before = F.lit(None).cast("long"), F.lit(0)
    for n in lengths:
        at = F.when(F.col("n") == n, F.col("place") - before).otherwise(at)
        before = before + F.greatest(F.col("n_words") - (n - 1), F.lit(0))
    document = F.col("place") == before
    return found.where(document | F.col("n").isNotNull()).select(
        "doc_id",
        "digest",
        "n_words",
        F.when(~document, at).cast("long").alias("at"),
        F.when(~document, F.col("n")).alias("n"),
        F.when(~document, F.col("hash")).alias("hash"),
    )


def verified(documents: DataFrame, hits: DataFrame, windows: DataFrame, count: int) -> DataFrame:
    """(digest, at, n, items_id): the places whose words are those of the window, for each different text.

    Of equal texts the one with the smallest doc_id is read again. While the texts with hits are few enough their ids are
    broadcast, so that only these texts are shuffled.
    """
    places = written(hits.groupBy("digest").agg(F.min("doc_id").alias("reader"), F.collect_set(F.struct("at", "n", "hash")).alias("places")), "places")
    readers = places.select("digest", "reader")
    texts = documents.select(F.col("doc_id").alias("reader"), digest_of(F.col("text")).alias("digest"), "text").alias("t")
    same = F.expr("t.digest = r.digest AND t.reader <=> r.reader")
    read = texts.join(_small(readers, places.count()).alias("r"), same, "left_semi").select("digest", "text").dropDuplicates(["digest"])
    words = read.join(places, "digest").select("digest", "places", words_of(F.col("text")).alias("words"))
    found = F.expr(f"explode_outer(transform(places, p -> struct(p.at, p.n, p.hash, {gram_at('words', 'p.at', 'p.n')} AS gram)))")
    grams = words.select("digest", found.alias("p")).select("digest", "p.*")
    return grams.join(_small(windows, count), ["hash", "n", "gram"]).select("digest", "at", "n", "items_id")


def _spans(places: DataFrame) -> DataFrame:
    """(digest, n_hit, spans, sets): words inside any window, their maximal spans, and the sets of items."""
    inside = Window.partitionBy("digest").orderBy("at", "n")
    before = F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    marked = places.select("digest", "at", "n", "items_id", (F.col("at") + F.col("n")).alias("end")).withColumn("begins", before.isNull() | (F.col("at") > before))
    numbered = marked.withColumn("span", F.sum(F.col("begins").cast("int")).over(inside))
    spans = numbered.groupBy("digest", "span").agg(F.min("at").alias("start"), F.max("end").alias("end"), F.collect_set("items_id").alias("sets"))
    return spans.groupBy("digest").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sets")))).alias("sets"),
    )


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, spans, items) for each row of documents (doc_id, text).

    spans are the maximal runs (start, end) of words inside any occurrence of a window of benchmark (item_id, text),
    n_hit their words, items the sorted ids, as strings, of the items with a window in the text. Null, empty and wordless
    texts have no words and no hits; items without words have no windows, and those without id are in no list. Repeated rows get
    equal results, a row each; equal texts are verified once. Extra columns are ignored. An empty table gives no rows, an empty benchmark no hits.
    A row's words are held in memory, so a text must be well below the 2 GB of a cell.
    """
    windows, sets = benchmark_windows(benchmark, width)
    count = windows.count()
    scan = written(scanned(documents, windows, count), "scan")
    texts = written(_spans(verified(documents, scan.where("n IS NOT NULL"), windows, count)), "spans")
    combined = (
        texts.select("sets").distinct().select("sets", F.explode("sets").alias("items_id")).join(sets, "items_id")
        .groupBy("sets").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    results = written(texts.join(combined, "sets").drop("sets"), "hits")
    none = {"n_hit": "0L", "spans": "cast(array() as array<struct<start:bigint,end:bigint>>)", "items": "cast(array() as array<string>)"}
    return scan.where("n IS NULL").select("doc_id", "digest", "n_words").join(results, "digest", "left").select(
        "doc_id", "digest", "n_words", *[F.expr(f"coalesce({name}, {empty})").alias(name) for name, empty in none.items()]
    )


def _hit_texts(found: DataFrame, digest: str, spans: str) -> DataFrame:
    return found.where("n_hit > 0").select(F.col("digest").alias(digest), F.col("spans").alias(spans)).dropDuplicates([digest])


def without_documents(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of documents, with all their columns, whose text has no hit in found, the result of `contamination`."""
    digest, spans = free_name(documents, "digest"), free_name(documents, "spans")
    kept = documents.withColumn(digest, digest_of(F.col("text")))
    return kept.join(_hit_texts(found, digest, spans), digest, "left_anti").select(*documents.columns)


def without_spans(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of documents with hit words cut out of their texts, each with what follows it up to the next word.

    Texts without hits, null ones too, stay as they are.
    """
    digest, spans = free_name(documents, "digest"), free_name(documents, "spans")
    rows = documents.withColumn(digest, digest_of(F.col("text"))).join(_hit_texts(found, digest, spans), digest, "left")
    text = text_of(F.col("text"))
    head = F.regexp_extract(text, f"^{BETWEEN}*", 0)
    pieces = F.split(F.substr(text, F.length(head) + 1), f"(?<={BETWEEN})(?!{BETWEEN})(?=.)")
    kept = F.filter(pieces, lambda _, at: ~F.exists(spans, lambda s: (s["start"] <= at) & (at < s["end"])))
    cut = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(head, F.array_join(kept, "")))
    return rows.withColumn("text", cut).select(*documents.columns)
