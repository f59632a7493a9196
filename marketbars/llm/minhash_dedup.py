"""Near-duplicates by MinHash signatures: banding, verification, stars.

A document is the set of its distinct word shingles. Each distinct set gets
``BANDS * ROWS`` universal hash minima; sets that agree in all minima of a band
share a bucket. Of two sets at the least similarity that links, 0.85, the chance to
share no bucket is (1 - 0.85**6)**32, 3 in 10 million. One bit of each minimum makes
a sketch; pairs whose sketches differ in more bits than ``SKETCH_LIMIT`` go (a
linked pair does with a chance below 1 in a million). So do pairs whose parities
differ in too many bits: each shingle flips one of ``PARITIES`` bits, so two sets
differ in at least as many shingles as their parities do in bits, and no link is
lost by that. The full shingle sets of the others decide.

No bucket is expanded into its pairs. First all of a bucket are compared with its
most central member, the one that meets most others over all buckets; what links is
tied into components by alternating stars. Only members of *different* components
that still share a bucket are then compared with each other. Equal sets are one node
from the start, whatever their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import components, kept

SHINGLE = 5
PERCENT = 85  # least Jaccard similarity of a link, in hundredths
BANDS, ROWS = 32, 6
MINIMA = BANDS * ROWS
# Expected agreement of a bit at 0.85 is 0.925 of 192 bits, less six deviations.
SKETCH_LIMIT = 36
PARITIES = 1024
SEED = 42
CHUNK = 512  # shingles hashed at once, so that products stay in the processor's cache

SET_KIND = (
    "doc_id long, text_1 long, text_2 long, n_shingles long, set_1 long, set_2 long, "
    "bands array<long>, sketch array<long>"
)


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the multiply-shift family, the same everywhere."""
    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (2, count), dtype=np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


FACTORS, OFFSETS = _family(MINIMA)
# What a word's hash is multiplied by at each place of a shingle.
PLACES = np.random.default_rng(SEED + 1).integers(0, 1 << 63, 64, dtype=np.uint64) * 2 + 1


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text in UTF-8."""
    # On bytes, both take ASCII only: A-Z, and the six kinds of white space.
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    seen: dict[bytes, int] = {}
    for word in words:
        if word not in seen:
            seen[word] = xxhash.xxh3_64_intdigest(word, SEED)
    hashes = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed += hashes[k : k + count] * PLACES[k % 64]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, as 32-bit numbers."""
    keys = shingles & np.uint64(0xFFFFFFFF)
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(keys), CHUNK):
        part = keys[start : start + CHUNK]
        np.minimum(least, (FACTORS[:, None] * part + OFFSETS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(shingles: np.ndarray, least: np.ndarray) -> np.ndarray:
    """A bit of each minimum, then the parities, 64 bits to a number."""
    places = (shingles >> np.uint64(40)).astype(np.int64) % PARITIES
    odd = np.bincount(places, minlength=PARITIES) & 1
    bits = np.concatenate([least & 1, odd]).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _described(size: int):
    def describe(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), size)
                digest = xxhash.xxh3_128_digest(found.tobytes(), SEED)
                one, two = (int(v) for v in np.frombuffer(digest, np.int64))
                if not len(found):
                    rows.append((0, one, two, [], []))
                    continue
                least = minima(found)
                bands = [
                    xxhash.xxh3_64_intdigest(band.tobytes(), k)
                    for k, band in enumerate(least.reshape(BANDS, ROWS))
                ]
                rows.append(
                    (len(found), one, two, np.array(bands, np.uint64).view(np.int64),
                     sketch(found, least))
                )
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            made = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.record_batch(
                [*(batch.column(k) for k in ("doc_id", "text_1", "text_2")), *made],
                ["doc_id", "text_1", "text_2", "n_shingles", "set_1", "set_2", "bands", "sketch"],
            )

    return describe


def _linked(size: int, percent: int):
    """Of (a, b, text_a, text_b), the pairs whose full sets are similar enough."""

    def linked(batches):
        for batch in batches:
            found, last, one = [], None, None
            for a, b, text_a, text_b in zip(*(batch.column(k) for k in range(4))):
                if a != last:  # the smallest of a bucket is compared with many
                    last, one = a, shingle_set(text_a.as_py(), size)
                two = shingle_set(text_b.as_py(), size)
                common = len(np.intersect1d(one, two, assume_unique=True))
                found.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return linked


def _text_keys(text: Column) -> list[Column]:
    """Two hashes that together stand for a text."""
    return [F.xxhash64(text).alias("text_1"), F.xxhash64(text, F.lit(SEED)).alias("text_2")]


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sketches allow a link of the rows ``a`` and ``b`` with n_shingles."""

    def differing(first: int, last: int) -> Column:
        parts = [
            F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k]))
            for k in range(first, last)
        ]
        return sum(parts[1:], parts[0])

    signs = MINIMA // 64
    sizes = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    # |x - y| + |y - x| of linked sets is at most (100 - p) / (100 + p) of |x| + |y|.
    return (differing(0, signs) <= SKETCH_LIMIT) & (
        differing(signs, signs + PARITIES // 64) * (100 + percent) <= sizes * (100 - percent)
    )


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int):
    """Those of the (a, b) pairs of nodes that link on their full sets.

    Only texts of nodes in a pair are moved; the pairs of one node with many
    others are split over tasks by adaptive execution.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keyed = docs.select(F.xxhash64("doc_id").alias("at"), *_text_keys(F.col("text")), "text")
    named = nodes.join(wanted, "node").select(
        "node", F.xxhash64("low").alias("at"), "text_1", "text_2"
    )
    # Repeated rows would give a node its text more than once.
    texts = kept(
        keyed.join(named, ["at", "text_1", "text_2"])
        .groupBy("node")
        .agg(F.first(F.col("text").cast("binary")).alias("text"))
    )
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(_linked(size, percent), "a long, b long")


def set_nodes(described: DataFrame) -> DataFrame:
    """One node for each distinct set, with the row that shows its text."""
    shown = F.min(F.struct("doc_id", "text_1", "text_2"))
    grouped = described.groupBy("set_1", "set_2").agg(
        F.min("doc_id").alias("low"),
        shown.alias("shown"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_1", "text_2"))).alias("named"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    row = F.coalesce("named", "shown")
    return kept(
        grouped.select(
            F.monotonically_increasing_id().alias("node"),
            "set_1",
            "set_2",
            "low",
            row["text_1"].alias("text_1"),
            row["text_2"].alias("text_2"),
            "n_shingles",
            "bands",
            "sketch",
        )
    )


def node_roots(
    nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(node, root) of the nodes with a link; root names their component."""
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = kept(buckets.join(shared, "bucket"))
    sketches = nodes.select("node", "n_shingles", "sketch")
    # First the stars around each bucket's node that meets most others,
    meeting = met.groupBy("node").agg(F.sum("n").alias("met"))
    central = (
        met.join(meeting, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("met", "node"))["node"].alias("center"))
    )
    stars = (
        met.join(central, "bucket").where("node <> center").select("node", "center").distinct()
        .join(sketches, "node").alias("l")
        .join(sketches.withColumnRenamed("node", "other").alias("r"), F.expr("center = other"))
        .where(_may_link("l", "r", percent))
        .select(F.col("center").alias("a"), F.col("l.node").alias("b"))
    )
    tied = components(_confirmed(kept(stars), nodes, docs, size, percent))
    tied = kept(tied.withColumnsRenamed({"id": "node", "root": "star"}))
    starred = kept(
        met.join(tied, "node", "left").select(
            "bucket", "node", F.coalesce("star", "node").alias("star")
        )
    )
    # then what shares a bucket with another component than its own.
    mixed = (
        starred.groupBy("bucket")
        .agg(F.min("star").alias("base"), F.max("star").alias("other"))
        .where("base <> other")
        .drop("other")
    )
    apart = kept(starred.join(mixed, "bucket").join(sketches, "node"))
    across = kept(
        apart.where("star <> base").alias("l")
        .join(
            apart.alias("r"),
            (F.col("l.bucket") == F.col("r.bucket"))
            & (F.col("l.star") != F.col("r.star"))
            # both ways round but for the base component, which is on one side only
            & ((F.col("r.star") == F.col("r.base")) | (F.col("l.node") < F.col("r.node")))
            & _may_link("l", "r", percent),
        )
        .select(
            F.col("l.node").alias("a"),
            F.col("r.node").alias("b"),
            F.col("l.star").alias("star_a"),
            F.col("r.star").alias("star_b"),
        )
        .distinct()
    )
    bridges = _confirmed(across.select("a", "b").distinct(), nodes, docs, size, percent)
    joined = components(
        across.join(bridges, ["a", "b"]).select(
            F.col("star_a").alias("a"), F.col("star_b").alias("b")
        )
    ).withColumnsRenamed({"id": "star", "root": "top"})
    return tied.select("node", "star").union(
        joined.select(F.col("star").alias("node"), "star")
    ).distinct().join(joined, "star", "left").select(
        "node", F.coalesce("top", "star").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Every row's set size and component (smallest id reachable over links).

    A text of fewer words than a shingle is one shingle. Null and empty texts, and
    texts without words, have an empty set and link with nothing, not even each
    other. Rows of one set are linked, repeated rows too and those of equal id give
    a row each. A row without an id gets the smallest id of its component, null if
    there is none, and is not ``kept``. Other columns are not read; an empty table gives
    no rows. The chances above hold for ``percent`` of 85 and more.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = kept(
        rows.select("doc_id", *_text_keys(F.col("text")), F.col("text").cast("binary").alias("text"))
        .mapInArrow(_described(size), SET_KIND)
    )
    full = described.where("n_shingles > 0")
    nodes = set_nodes(full)
    roots = node_roots(nodes, rows, size, percent)
    placed = kept(
        nodes.select("node", "set_1", "set_2", "low")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    # Kept apart, so that joining it splits a large component over tasks.
    lowest = kept(placed.groupBy("root").agg(F.min("low").alias("component_id")))
    named = placed.join(lowest, "root").select("set_1", "set_2", "component_id")
    columns = [
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    ]
    alone = described.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return (
        full.join(named, ["set_1", "set_2"])
        .select(*columns)
        .unionAll(alone.select(*columns))
    )
