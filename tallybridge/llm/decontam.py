"""Benchmark passages in training text, by a positional inverted index of its tokens.

DataFrame operations only. The index holds a posting (term, document, position) for each
training token that occurs in the benchmark at all. Every benchmark window is looked up by
its rarest terms first: their posting lists, each shifted by the term's place in the item,
are intersected, which leaves alignments of an item with a document. These few are then held
against the lists of all other terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Tables of up to this many narrow rows are sent to every task; larger ones are shuffled.
SENT_ROWS = 1_000_000
DOC = ["doc_id", "text_hash"]


def words(text: str) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    found = F.array_remove(F.split(F.translate(F.col(text).cast("string"), UPPER, LOWER), SEPARATORS), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of one id with different texts stay apart by the hash of the text."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_column).cast("string")).alias("text_hash"),
        words(text_column).alias("words"),
    )


def sent(df: DataFrame) -> DataFrame:
    """``df``, marked to be sent to every task if it is small enough."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def item_words(benchmark: DataFrame, *, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, item, at, term, n): every word of every item, with a number for each distinct
    word and the words of the item. ``item`` tells texts of one item id apart."""
    rows = (
        benchmark.select(F.col(id_column).alias("item_id"), words(text_column).alias("words"))
        .dropna(subset=["item_id"])
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "words"))
    )
    split = rows.select("item_id", "item", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    terms = stored(split.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    return stored(split.join(terms, "word"), "item-words")


def build_index(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The stored postings (term, doc_id, text_hash, at) of all words that some item has."""
    terms = sent(items.select("word", "term").distinct())
    tokens = _documents(docs, id_column, text_column).select(*DOC, F.posexplode("words").alias("at", "word"))
    return stored(tokens.join(terms, "word").select("term", *DOC, "at"), "postings")


def _windows(items: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(item, start, length, at, term, rank): the words of each window by rising frequency.

    Windows with a word that no document has are left out.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("postings"))
    known = items.join(counts, "term", "left").withColumn("length", F.least("n", F.lit(window)))
    first = F.greatest(F.lit(0), F.col("at") - F.col("length") + 1)
    rows = known.select(
        "item", "at", "term", "length", "postings",
        F.explode(F.sequence(first, F.least("at", F.col("n") - F.col("length")))).alias("start"),
    )
    of_window = Window.partitionBy("item", "start")
    rows = rows.withColumn("full", F.count("postings").over(of_window)).filter(F.col("full") == F.col("length"))
    return rows.withColumn("rank", F.row_number().over(of_window.orderBy("postings", "at"))).drop("full", "postings")


def alignments(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, item, shift) where the rarest two terms of a window both occur in
    place; ``shift`` is where the item's first word would stand in the document."""
    ranked = _windows(items, index, window).filter("rank <= 2")
    one, two = (ranked.filter(F.col("rank") == n).select("item", "start", "length", F.col("at").alias(f"at{n}"), F.col("term").alias(f"term{n}")) for n in (1, 2))
    pairs = stored(
        one.join(two.drop("length"), ["item", "start"], "left").select("item", "at1", "term1", "at2", "term2").distinct(), "rarest"
    )

    def shifted(n: int) -> DataFrame:
        seeds = pairs.filter(f"term{n} is not null").select("item", "at1", "at2", F.col(f"term{n}").alias("term"))
        return index.join(sent(seeds), "term").select(*DOC, "item", "at1", "at2", (F.col("at") - F.col(f"at{n}")).alias("shift"))

    first, second = shifted(1), shifted(2)
    alone = first.filter("at2 is null").select(*DOC, "item", "shift")
    a, b = first.filter("at2 is not null").alias("a"), second.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) if c == "doc_id" else F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*DOC, "item", "at1", "at2", "shift")]
    condition = same[0]
    for more in same[1:]:
        condition &= more
    both = a.join(b, condition, "left_semi").select(*DOC, "item", "shift")
    return stored(both.union(alone).distinct(), "alignments")


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, item_id, start, length): maximal runs of document words that equal
    consecutive item words, at least ``window`` of them or the whole of a shorter item."""
    found = alignments(index, items, window)
    candidates = sent(found.select(*DOC).distinct().withColumnsRenamed({c: f"c_{c}" for c in DOC}))
    here = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("text_hash") == F.col("c_text_hash"))
    lists = index.join(candidates, here, "left_semi")
    wanted = found.join(sent(items), "item").select(*DOC, "item", "item_id", "n", "shift", "at", "term")
    wanted = wanted.withColumn("pos", F.col("shift") + F.col("at"))
    l, w = lists.withColumnRenamed("at", "pos").alias("l"), wanted.alias("w")
    equal = F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))
    for c in ("text_hash", "pos", "term"):
        equal &= F.col(f"l.{c}") == F.col(f"w.{c}")
    # Copies of a row give a posting each; one will do.
    matched = w.join(l, equal, "left_semi")
    run = Window.partitionBy(*DOC, "item", "shift").orderBy("at")
    runs = matched.withColumn("island", F.col("at") - F.row_number().over(run))
    return (
        runs.groupBy(*DOC, "item", "item_id", "shift", "island", "n")
        .agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length"))
        .filter(F.col("length") >= F.least("n", F.lit(window)))
        .select(*DOC, "item_id", "start", "length")
    )


def _same_text(left: str, right: str) -> Column:
    """Whether two aliased frames speak of the same document."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def _met(asked: DataFrame, lists: DataFrame, by: list[str], slop: int) -> DataFrame:
    """The rows of ``asked`` that have a row of ``lists``, equal in ``by``, within ``slop`` places of where it is ``due``.

    Places are cut into buckets of the range's width, of which a range touches one or two, so it is an equi join
    and a frequent word of a long text does not meet all its places.
    """
    width = 2 * slop + 1
    bucket = lambda place: F.floor(place / F.lit(width))
    touched = F.array_distinct(F.array(bucket(F.col("due") - slop), bucket(F.col("due") + slop)))
    a, l = asked.withColumn("bucket", F.explode(touched)).alias("a"), lists.withColumn("bucket", bucket(F.col("there"))).alias("l")
    equal = _same_text("a", "l") & F.col("l.there").between(F.col("a.due") - slop, F.col("a.due") + slop)
    for c in (*by, "bucket"):
        equal &= F.col(f"a.{c}") == F.col(f"l.{c}")
    return a.join(l, equal, "left_semi").drop("bucket").distinct()


def proximity_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 2) -> DataFrame:
    """(doc_id, text_hash, item_id, start): windows whose words all stand within ``slop``
    places of where the rarest one puts them; ``start`` is that word's position.

    The lists of the rarest two terms are intersected first; the others are only looked up
    where these two are near enough.
    """
    ranked = stored(_windows(items, index, window), "windows")
    one, two = (ranked.filter(F.col("rank") == n).select("item", "start", "length", F.col("at").alias(f"at{n}"), F.col("term").alias(f"term{n}")) for n in (1, 2))
    windows = stored(one.join(two.drop("length"), ["item", "start"], "left").withColumnRenamed("start", "w"), "near-windows")
    pairs = windows.filter("at2 IS NOT NULL").select("item", "at1", "term1", "at2", "term2").distinct()

    def postings(n: int, place: str) -> DataFrame:
        seeds = pairs.select("item", "at1", "at2", F.col(f"term{n}").alias("term"))
        return index.join(sent(seeds), "term").select(*DOC, "item", "at1", "at2", F.col("at").alias(place))

    first = postings(1, "pos").withColumn("due", F.col("pos") + F.col("at2") - F.col("at1"))
    near = stored(_met(first, postings(2, "there"), ["item", "at1", "at2"], slop).drop("due"), "near")
    found = near.join(sent(windows.select("item", "at1", "at2", "w", "length")), ["item", "at1", "at2"])
    others = ranked.filter("rank > 2").select("item", F.col("start").alias("w"), "at", "term")
    asked = found.join(sent(others), ["item", "w"]).withColumn("due", F.col("pos") + F.col("at") - F.col("at1"))
    candidates = sent(near.select(*DOC).distinct()).alias("c")
    lists = index.withColumnRenamed("at", "there").alias("i").join(candidates, _same_text("i", "c"), "left_semi")
    met = _met(asked, lists, ["term"], slop).groupBy(*DOC, "item", "w", "length", "pos").agg(F.count("*").alias("met"))
    alone = windows.filter("at2 IS NULL").select("item", F.col("term1").alias("term"))
    whole = [
        met.filter(F.col("met") == F.col("length") - 2).select(*DOC, "item", "pos"),
        found.filter("length = 2").select(*DOC, "item", "pos"),
        index.join(sent(alone), "term").select(*DOC, "item", F.col("at").alias("pos")),
    ]
    names = sent(items.select("item", "item_id").distinct())
    near_ones = whole[0].union(whole[1]).union(whole[2]).join(names, "item")
    return near_ones.select(*DOC, "item_id", F.col("pos").alias("start")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, slop: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """For every row: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated and, if ``slop`` is given, n_near.

    A word is hit if it stands inside any occurrence of a window, ``window`` consecutive words of an
    item or all words of a shorter one. ``n_near`` counts the items with a window whose words all stand
    within ``slop`` places of where the rarest one puts them; it takes no part in ``contaminated``. Items without words or id match nothing, null and
    empty texts have no words, repeated rows stay repeated with equal results. An empty
    benchmark leaves everything clean. Extra columns are not read.
    """
    items = item_words(benchmark)
    index = build_index(docs, items, id_column=id_column, text_column=text_column)
    runs = stored(phrase_matches(index, items, window), "phrases")
    words_hit = (
        runs.select(*DOC, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_hit"))
    )
    # A document's items are at most the benchmark's.
    hit_items = runs.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    rows = _documents(docs, id_column, text_column).select(*DOC, F.size("words").cast("long").alias("n_words"))
    parts = {"h": words_hit, "i": hit_items}
    if slop is not None:
        near = stored(proximity_matches(index, items, window, slop), "proximity")
        parts["p"] = near.groupBy(*DOC).agg(F.count_distinct(F.col("item_id").cast("string")).alias("n_near"))
    for name, part in parts.items():
        part = part.withColumnsRenamed({c: f"{name}_{c}" for c in DOC})
        here = F.col("doc_id").eqNullSafe(F.col(f"{name}_doc_id")) & (F.col("text_hash") == F.col(f"{name}_text_hash"))
        rows = rows.join(part, here, "left").drop(*[f"{name}_{c}" for c in DOC])
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        *DOC, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        *([] if slop is None else [F.coalesce("n_near", F.lit(0)).alias("n_near")]),
    )
