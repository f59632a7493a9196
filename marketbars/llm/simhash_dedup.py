"""Near-duplicates by SimHash fingerprints and pivot distance tables.

Fingerprints are made per text in Arrow batches. Distinct ones get a table of
Hamming distances to ``PIVOTS`` reference fingerprints. For two fingerprints the
difference of any coordinate is at most their own distance, so a pair whose
largest coordinate difference exceeds the limit cannot link, and what is left is
verified bit by bit.

Distances to whole references crowd around 32, so they tell pairs apart but
cannot bring them together in less than all pairs. The pairs to look at come
from distances to references confined to one of seven blocks of the bits: four
differing bits leave three blocks untouched, in which every such distance is
equal. A block's distances to the references that hold one of its bits spell
the block itself, so equal coordinates are an equality join on the bits of three
blocks (35 choices, 27 bits and more each). No pair is lost.

A dense group of near copies is not expanded into pairs: all of a bucket are
first tied to its smallest fingerprint, and only fingerprints of *different*
components that still share a bucket are compared.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import components, kept, unused

SHINGLE = 4
SEED = 42
LIMIT = 4  # differing bits of a link
BLOCKS = (9, 9, 9, 9, 9, 9, 10)
UNTOUCHED = len(BLOCKS) - LIMIT
PIVOTS = 16
PER_LONG = 8  # pivot distances of one byte each in a long


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def pivot_values() -> list[int]:
    """The reference fingerprints, as signed longs: fixed, spread over all bits."""
    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)
    return [_signed(int(v)) for v in drawn]


def block_masks() -> list[int]:
    """One mask for each choice of untouched blocks."""
    starts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]
    single = [((1 << width) - 1) << start for start, width in zip(starts, BLOCKS)]
    return [_signed(sum(c)) for c in itertools.combinations(single, UNTOUCHED)]


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of the word shingles; zero for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        prints = [_signed(fingerprint(text)) for text in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


def _pivot_columns() -> dict[str, Column]:
    """Distances to the references, PER_LONG of them in each column."""
    values = pivot_values()
    packed = {}
    for n in range(PIVOTS // PER_LONG):
        total = F.lit(0).cast("long")
        for k, value in enumerate(values[n * PER_LONG : (n + 1) * PER_LONG]):
            near = F.bit_count(F.col("fp").bitwiseXOR(F.lit(value))).cast("long")
            total = total.bitwiseOR(F.shiftleft(near, 8 * k))
        packed[f"d{n}"] = total
    return packed


def _may_link(a: str, b: str) -> Column:
    """No pivot coordinate of the two differs by more than the limit."""
    within = F.lit(True)
    for n in range(PIVOTS // PER_LONG):
        for k in range(PER_LONG):
            one, two = (
                F.shiftright(F.col(f"{side}.d{n}"), 8 * k).bitwiseAND(F.lit(255)) for side in (a, b)
            )
            within = within & (F.abs(one - two) <= LIMIT)
    return within


def _links(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= LIMIT


def _buckets(prints: DataFrame) -> DataFrame:
    """Each fingerprint once for every choice of untouched blocks."""
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks()))
    return prints.select("*", F.posexplode(keys).alias("choice", "bits"))


def fingerprint_roots(prints: DataFrame) -> DataFrame:
    """Distinct fp -> (fp, root) for those with a link; root names the component."""
    spread = _buckets(prints)
    shared = (
        spread.groupBy("choice", "bits")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("center"))
        .where("n > 1")
        .drop("n")
    )
    met = kept(
        spread.join(shared, ["choice", "bits"]).withColumns(_pivot_columns())
    )
    # First the stars around each bucket's smallest fingerprint,
    stars = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("center"))) <= LIMIT)
    tied = components(stars.select(F.col("fp").alias("a"), F.col("center").alias("b")))
    tied = tied.withColumnsRenamed({"id": "fp", "root": "star"})
    starred = kept(
        met.join(tied, "fp", "left").withColumn("star", F.coalesce("star", "fp")).drop("center")
    )
    # then what shares a bucket with another component than its own.
    mixed = (
        starred.groupBy("choice", "bits")
        .agg(F.min("star").alias("base"), F.max("star").alias("other"))
        .where("base <> other")
        .drop("other")
    )
    apart = starred.join(mixed, ["choice", "bits"])
    left, right = apart.where("star <> base").alias("l"), starred.alias("r")
    across = (
        left.join(
            right,
            (F.col("l.choice") == F.col("r.choice"))
            & (F.col("l.bits") == F.col("r.bits"))
            & (F.col("l.star") != F.col("r.star"))
            & _may_link("l", "r")
            & _links("l", "r"),
        )
        .select(F.col("l.star").alias("a"), F.col("r.star").alias("b"))
        .distinct()
    )
    joined = components(across).withColumnsRenamed({"id": "star", "root": "top"})
    return (
        starred.select("fp", "star")
        .distinct()
        .join(joined, "star", "left")
        .select("fp", F.coalesce("top", "star").alias("root"))
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint (16 hex digits) and component (smallest id reachable).

    Null text counts as empty: fingerprint zero, linked like any other. A row
    without an id gets the component of its fingerprint; a component of such
    rows only has a null name. Repeated rows give repeated results. Other
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    rows = kept(with_fingerprints(docs, id_col, text_col))
    prints = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = fingerprint_roots(prints.select("fp"))
    placed = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those linked to a document of smaller id, all columns.

    Rows that share an id stay or go together; rows without one stay.
    """
    own = unused(docs, "_gone")
    gone = (
        near_groups(docs, id_col, text_col)
        .where("doc_id > component_id")
        .select(F.col("doc_id").alias(own))
        .distinct()
    )
    return docs.join(gone, docs[id_col] == gone[own], "left_anti")
