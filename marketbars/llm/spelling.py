"""Spelling variants of frequent words, by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one into
the other. Of a pair, the smaller word contributes two disjoint chunks, its two
halves of q = length // 2 code points, and the other all its positional grams of
that q. One edit touches at most one of two disjoint chunks, so the other is a gram
of the partner, shifted by one place at most. Hence an equality join on the
length, the gram and its place, with each chunk entered at its place and one to
either side, meets every near pair; exact edit distance then decides.

Occurrences are counted by a grouped sum that combines before its shuffle, so
neither a frequent word nor a document with a third of all words meets in one task.
Only the vocabulary, which grows far slower than the text, enters the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import kept

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6  # code points
LEAST_COUNT = 5  # occurrences
RATIO = 5  # how much more frequent a form is than its variant
DAMAGED = 199  # one run in so many loses a code point


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (word) for each occurrence of a word of ``LEAST_LENGTH`` code points.

    A run whose checksum with its document's id divides by ``DAMAGED`` loses a
    code point first. The id of a row without one counts as empty text.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("found"),
    )
    # What is too short stays too short.
    long_runs = runs.where(F.length("found") >= LEAST_LENGTH).select(
        "id", F.translate("found", UPPER, LOWER).alias("run")
    )
    check = F.crc32(F.concat_ws(":", "id", "run"))
    place = F.col("check") % F.length("run")
    without = F.concat(
        F.substring(F.col("run"), F.lit(1), place.cast("int")),
        F.substring(F.col("run"), (place + 2).cast("int"), F.length("run")),
    )
    hit = long_runs.withColumn("check", check).select(
        F.when(F.col("check") % DAMAGED == 0, without).otherwise(F.col("run")).alias("word")
    )
    return hit.where(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of at least ``LEAST_COUNT`` occurrences over all documents: (word, n)."""
    counted = words(docs, id_col, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _chunks() -> Column:
    """A word's two halves, each at its place and one place to either side."""
    q = F.expr("CAST(size DIV 2 AS INT)")
    entries = [
        F.struct((start + shift).alias("place"), F.substring(F.col("word"), start + 1, q).alias("gram"))
        for start in (F.lit(0), q)
        for shift in (-1, 0, 1)
    ]
    return F.filter(F.array(*entries), lambda e: e["place"] >= 0)


def _grams(change: int) -> Column:
    """All grams of a word, of the q of partners longer by ``change``."""
    q = F.expr(f"CAST((size + {change}) DIV 2 AS INT)")
    return F.transform(
        F.sequence(F.lit(0), F.col("size") - q),
        lambda place: F.struct(
            place.alias("place"), F.substring(F.col("word"), place + 1, q).alias("gram")
        ),
    )


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) with a < b of all words that one edit turns into each other."""
    sized = vocab.withColumn("size", F.length("word").cast("int"))
    chunked = sized.select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), "size", F.explode(_chunks()).alias("e")
    ).select("a", "n_a", "size", "e.place", "e.gram")
    grams = reduce(
        DataFrame.unionAll,
        (
            sized.select(
                F.col("word").alias("b"),
                F.col("n").alias("n_b"),
                (F.col("size") + change).alias("of_size"),
                F.explode(_grams(change)).alias("e"),
            )
            for change in (-1, 0, 1)
        ),
    ).select("b", "n_b", F.col("of_size").alias("size"), "e.place", "e.gram")
    met = chunked.join(grams, ["size", "place", "gram"])
    one_edit = F.levenshtein("a", "b", 1) == 1
    return met.where((F.col("a") < F.col("b")) & one_edit).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last by pointer doubling.

    A form is at least ``RATIO`` times as frequent as its word, so chains are as
    short as the logarithm of the largest count, and there are no loops.
    """
    state = kept(forms.select("word", F.col("form").alias("root")))
    while True:
        nxt = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = kept(
            state.join(nxt, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            )
        )
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every frequent word with its more frequent spelling.

    ``form`` is the near word of largest n, of equals the smallest in code-point
    order, where that n is ``RATIO`` times the word's or more; ``root`` is where
    forms of forms end, the word itself if it has none. Null and empty texts hold no
    words; repeated rows count as often as they come; other columns are not read.
    A very long run is one word. An empty table gives no rows.
    """
    vocab = kept(vocabulary(docs, id_col, text_col))
    pairs = kept(near_pairs(vocab))
    both = pairs.select(
        F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")
    ).unionAll(pairs.select("b", "a", "n_a"))
    nearest = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"),
    )
    formed = F.when(-F.col("top.less") >= RATIO * F.col("n"), F.col("top"))
    placed = kept(
        vocab.join(nearest, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            formed["near"].alias("form"),
            (-formed["less"]).alias("form_n"),
        )
    )
    roots = _roots(placed.where("form IS NOT NULL"))
    return placed.join(roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
