"""Alignment of two tokenizers' tokens by merge-path partitioning.

A text's A tokens and B tokens end at two sorted lists of byte offsets. Merging the
lists walks a path through their grid; cut by diagonals ``WORK`` ends apart, the path
falls into pieces of equal work, and a binary search along a diagonal finds a cut
without walking there. Each piece is a row of its own, so pieces of a very long text
spread over tasks. A piece emits the offsets at which tokens of both sides end;
pieces of one text are then stitched: their offsets, put behind each other, delimit
the groups, also those that cross a cut.

How many documents hold an id pair linked is a grouped sum over distinct pairs of
documents, combined per batch before its shuffle. The counts go back to the documents
as a lookup while there are at most ``PAIRS_SENT`` of them, and by a join beyond that.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm.common import kept
from marketbars.workspace import new_folder

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORK = 1 << 17  # token ends of both sides in a piece
PAIRS_SENT = 2_000_000  # counts sent to every task, 17 bytes each
ROWS_AT_ONCE = 256  # texts that are worked on before their results leave
SPACE = "▁"

LARGE_GROUP = 1 << 16  # links of a group that is counted by distinct ids

TEXTS_COUNTED = 2048  # texts whose pairs are counted together before they leave

# Tokens are ids of both sides; with ``TEXT_KIND`` the sizes of their groups, too.
PIECE_KIND = "row long, doc_id long, piece int, pieces int, a_at long, b_at long, tokens binary"
TEXT_KIND = "row long, doc_id long, tokens binary"
RESULT_KIND = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _schema(kind: str) -> pa.Schema:
    fields = (field.split() for field in kind.split(", "))
    return pa.schema([(name, ARROW[kind]) for name, kind in fields])


PIECE, RESULT = _schema(PIECE_KIND), _schema(RESULT_KIND)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """Byte for each character of a byte-level vocabulary: printable ones stand for
    themselves, the others in order for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _fast_encoder(tokenizer) -> Callable[[str], np.ndarray] | None:
    """The same byte-level BPE by ranks, where its merges are numbered in their order.

    None for a tokenizer that does anything else, such as normalizing.
    """
    import tiktoken

    from public_tokenizers import PATTERN

    spec = json.loads(tokenizer.to_str())
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = not spec["normalizer"] and split.get("type") == "ByteLevel" and model["type"] == "BPE"
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    if not plain or any(model.get(k) for k in options) or model.get("ignore_merges"):
        return None
    if split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    to_byte, vocab = _byte_of(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get("".join(m)) for m in merges]
    special = {token["content"] for token in spec["added_tokens"]}
    ranks = {
        bytes(to_byte[c] for c in entry): k for entry, k in vocab.items() if entry not in special
    }
    if made != sorted(set(made) - {None}) or len(ranks) != 256 + len(made):
        return None
    encoding = tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: encoding.encode_to_numpy(text, disallowed_special=())


class Sides:
    """Both tokenizers: ids of a text, and the bytes each id stands for."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.fast_a = _fast_encoder(self.a)
        self.b = SentencePieceProcessor(model_file=b_path)
        to_byte = _byte_of()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, k in vocab.items():
            known = all(c in to_byte for c in entry)
            self.a_bytes[k] = bytes(to_byte[c] for c in entry) if known else entry.encode()
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            if self.b.is_byte(k):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            self.b_bytes.append(piece.replace(SPACE, " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int32)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int32)

    def a_ids(self, text: str) -> Sequence[int]:
        if self.fast_a:
            return self.fast_a(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """A ids and B ids of a text; none if their bytes are not space+text."""
        a, b = (self.a_ids(" " + text), self.b.encode(text)) if text else ([], [])
        if not self._stand_for((" " + text).encode() if text else b"", a, b):
            a, b = [], []
        return np.array(a, np.int32), np.array(b, np.int32)

    def _stand_for(self, data: bytes, a: Sequence[int], b: list[int]) -> bool:
        # Ranks of all single bytes lose none, so only B is looked at then.
        if not self.fast_a and b"".join(map(self.a_bytes.__getitem__, a)) != data:
            return False
        return b"".join(map(self.b_bytes.__getitem__, b)) == data


@functools.cache
def sides(a_path: str, b_path: str) -> Sides:
    return Sides(a_path, b_path)


@functools.cache
def written_ids(vocabulary: int) -> list[str]:
    """Each id before each of the three marks of written groups."""
    return [f"{k}{mark}" for mark in ",|;" for k in range(vocabulary)]


def ends(sizes: np.ndarray, ids: np.ndarray, start: int = 0) -> np.ndarray:
    """Offsets at which the tokens end, the first of which starts at ``start``."""
    return start + sizes[ids].cumsum(dtype=np.int64)


def diagonal_cut(a_ends: np.ndarray, b_ends: np.ndarray, diagonal: int) -> int:
    """How many of the first ``diagonal`` ends in merged order are A's; A's first of equals."""
    low, high = max(0, diagonal - len(b_ends)), min(diagonal, len(a_ends))
    while low < high:
        middle = (low + high) // 2
        if a_ends[middle] <= b_ends[diagonal - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    return low


def cut_path(a_ends: np.ndarray, b_ends: np.ndarray, work: int) -> list[tuple[int, int]]:
    """Places (i, j) of the merge path on diagonals ``work`` apart, from start to end.

    A cut never parts an A end from the equal B end, so a common end lies in one piece.
    """
    total = len(a_ends) + len(b_ends)
    places = [(0, 0)]
    for diagonal in range(work, total, work):
        i = diagonal_cut(a_ends, b_ends, diagonal)
        j = diagonal - i
        if i and j < len(b_ends) and a_ends[i - 1] == b_ends[j]:
            j += 1
        if (i, j) != places[-1]:
            places.append((i, j))
    if places[-1] != (len(a_ends), len(b_ends)):
        places.append((len(a_ends), len(b_ends)))
    return places if len(places) > 1 else [(0, 0), (0, 0)]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of A and of B tokens up to each offset at which both sides end one."""
    if not len(a_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.searchsorted(a_ends, b_ends)
    j = np.flatnonzero(a_ends[np.minimum(place, len(a_ends) - 1)] == b_ends)
    return place[j] + 1, j + 1


def links(
    a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of all groups, as a << 32 | b, and how often each is linked."""
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a_from, b_from = np.append(0, a_cut[:-1]), np.append(0, b_cut[:-1])
    a_size, b_size = a_cut - a_from, b_cut - b_from
    large = np.flatnonzero(a_size * b_size > LARGE_GROUP)
    # Each A token meets its group's B tokens one by one.
    meets = np.repeat(b_size, a_size)
    first = np.repeat(b_from, a_size)
    for g in large:
        meets[a_from[g] : a_cut[g]] = 0
    before = meets.cumsum() - meets
    partner = np.repeat(first - before, meets) + np.arange(meets.sum())
    pairs, times = np.unique(
        np.repeat(a.astype(np.int64) << 32, meets) | b[partner], return_counts=True
    )
    for g in large:
        one, n_one = np.unique(a[a_from[g] : a_cut[g]].astype(np.int64), return_counts=True)
        two, n_two = np.unique(b[b_from[g] : b_cut[g]], return_counts=True)
        more = np.concatenate([pairs, (one[:, None] << 32 | two).ravel()])
        weight = np.concatenate([times, (n_one[:, None] * n_two).ravel()])
        pairs, at = np.unique(more, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, at, weight)
    return pairs, times


def written_groups(
    a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, written: list[str]
) -> str:
    """Groups as ``a1,a2|b1;a3|b2,b3``; ``written`` holds each id before each mark."""
    a_from, b_from = np.append(0, a_cut[:-1]), np.append(0, b_cut[:-1])
    ids = np.empty(len(a) + len(b), np.int64)
    vocabulary = len(written) // 3
    a_codes, b_codes = a.astype(np.int64), b.astype(np.int64)
    a_codes[a_cut - 1] += vocabulary  # the last of a side ends in another mark
    b_codes[b_cut - 1] += 2 * vocabulary
    ids[np.arange(len(a)) + np.repeat(b_from, a_cut - a_from)] = a_codes
    ids[np.arange(len(b)) + np.repeat(a_cut, b_cut - b_from)] = b_codes
    return "".join(map(written.__getitem__, ids.tolist()))[:-1]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers in one compressed value, so that rows stay small."""
    parts = [np.array([len(x) for x in arrays], np.int32), *(x.astype(np.int32) for x in arrays)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in parts))


def unpacked(data: bytes, count: int) -> list[np.ndarray]:
    numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)
    return np.split(numbers[count:], numbers[:count].cumsum()[:-1])


def packed_text(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> bytes:
    """Ids of both sides, and the sizes of their groups."""
    return packed(a, b, np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0))


def unpacked_text(data: bytes) -> tuple[np.ndarray, ...]:
    a, b, a_groups, b_groups = unpacked(data, 4)
    return a, b, a_groups.cumsum(), b_groups.cumsum()


def _batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that results of a large batch do not pile up."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _pieces(load: Callable[[], Sides], work: int):
    """Tokens of each text in pieces; a text of one piece has its overlaps already."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load()
        for batch in _few(batches, ROWS_AT_ONCE):
            rows = []
            for row, doc_id, text in zip(*(batch.column(k) for k in ("row", "doc_id", "text"))):
                a, b = both.ids(text.as_py())
                a_ends, b_ends = ends(both.a_size, a), ends(both.b_size, b)
                places = cut_path(a_ends, b_ends, work)
                key = row.as_py(), doc_id.as_py()
                if len(places) == 2:
                    rows.append((*key, 0, 1, 0, 0, packed_text(a, b, *overlaps(a_ends, b_ends))))
                    continue
                for k, ((i, j), (i_end, j_end)) in enumerate(itertools.pairwise(places)):
                    starts = (int(a_ends[i - 1]) if i else 0, int(b_ends[j - 1]) if j else 0)
                    ids = packed(a[i:i_end], b[j:j_end])
                    rows.append((*key, k, len(places) - 1, *starts, ids))
            yield _batch(rows, PIECE)

    return cut


def _met(a_size: np.ndarray, b_size: np.ndarray):
    """Each piece of a longer text with its overlaps, counted within the piece."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, ROWS_AT_ONCE):
            tokens = []
            for a_at, b_at, data in zip(*(batch.column(k).to_pylist() for k in (4, 5, 6))):
                a, b = unpacked(data, 2)
                cuts = overlaps(ends(a_size, a, a_at), ends(b_size, b, b_at))
                tokens.append(packed(a, b, *cuts))
            columns = [*(batch.column(k) for k in range(6)), pa.array(tokens, pa.binary())]
            yield pa.record_batch(columns, schema=PIECE)

    return meet


def _stitched(table: pa.Table) -> pa.Table:
    """The pieces of one text behind each other, their overlaps counted from its start."""
    whole = table.sort_by("piece")
    parts = [unpacked(data, 4) for data in whole["tokens"].to_pylist()]
    a_before, b_before = (np.cumsum([0, *(len(p[k]) for p in parts[:-1])]) for k in (0, 1))
    text = packed_text(
        np.concatenate([p[0] for p in parts]),
        np.concatenate([p[1] for p in parts]),
        np.concatenate([p[2] + n for p, n in zip(parts, a_before)]),
        np.concatenate([p[3] + n for p, n in zip(parts, b_before)]),
    )
    return whole.select(["row", "doc_id"]).slice(0, 1).append_column(
        "tokens", pa.array([text], pa.binary())
    )


def aligned_texts(
    docs: DataFrame,
    load: Callable[[], Sides],
    id_col: str = "doc_id",
    text_col: str = "text",
    work: int = WORK,
) -> DataFrame:
    """Each row's A and B ids with the sizes of their groups, packed.

    ``row`` numbers the rows, as ids may be missing or repeated. Pieces are written
    once to the shared folder, so texts are tokenized once.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    path = new_folder(spark, "alignment")
    rows.mapInArrow(_pieces(load, work), PIECE_KIND).write.parquet(path)
    pieces = spark.read.schema(PIECE_KIND).parquet(path)
    both = load()
    met = _met(both.a_size, both.b_size)  # tasks need the sizes only, not the tokenizers
    whole = pieces.where("pieces = 1").select("row", "doc_id", "tokens")
    # Only texts of more than one piece are shuffled, a text to a group.
    cut = pieces.where("pieces > 1").mapInArrow(met, PIECE_KIND)
    return whole.unionAll(cut.groupBy("row").applyInArrow(_stitched, TEXT_KIND))


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a batch each id pair is linked."""
    for batch in _few(batches, TEXTS_COUNTED):
        found = [np.empty(0, np.int64)]
        for data in batch.column("tokens"):
            found.append(links(*unpacked_text(data.as_py()))[0])
        pairs, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.record_batch([pa.array(pairs), pa.array(n)], ["pair", "n"])


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold an id pair linked; whether it is its A id's most."""
    counts = texts.mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")
    )
    # Of one A id there are at most as many pairs as B has ids.
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, F.shiftright("pair", 32) == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _measured(vocabulary: int, lookup):
    """Counts of each text; with ``lookup`` also what its pairs' counts add up to."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = written_ids(vocabulary)
        for batch in _few(batches, ROWS_AT_ONCE):
            rows = []
            for row, doc_id, data in zip(*(batch.column(k) for k in ("row", "doc_id", "tokens"))):
                a, b, a_cut, b_cut = unpacked_text(data.as_py())
                pairs, times = links(a, b, a_cut, b_cut)
                best = total = 0
                if lookup is not None:
                    keys, n, is_best = lookup.value
                    at = np.searchsorted(keys, pairs)
                    best, total = int(times @ is_best[at]), int(times @ n[at])
                digest = ""
                if len(a):
                    groups = written_groups(a, b, a_cut, b_cut, written)
                    digest = hashlib.sha256(groups.encode()).hexdigest()
                sizes = (len(a), len(b), len(a_cut), int(times.sum()))
                rows.append((row.as_py(), doc_id.as_py(), *sizes, best, total, digest))
            yield _batch(rows, RESULT)

    return measure


def _text_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, pair, times) of every text."""
    for batch in batches:
        for row, data in zip(batch.column("row"), batch.column("tokens")):
            pairs, times = links(*unpacked_text(data.as_py()))
            yield pa.record_batch(
                [pa.array(np.full(len(pairs), row.as_py())), pa.array(pairs), pa.array(times)],
                ["row", "pair", "times"],
            )


def _sent(spark: SparkSession, counts: DataFrame):
    """The counts as sorted arrays that every task can look up."""
    table = counts.toArrow()
    pairs, n, best = (table[k].to_numpy() for k in ("pair", "n", "best"))
    order = np.argsort(pairs)
    return spark.sparkContext.broadcast((pairs[order], n[order], best[order].astype(np.int64)))


def align(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    work: int = WORK,
    pairs_sent: int = PAIRS_SENT,
) -> DataFrame:
    """Per row: tokens of both sides, groups, links, and what the links' counts say.

    Texts that are null or empty, or whose joined A or B bytes are not space+text,
    have no tokens: zeros and an empty digest. Repeated rows count as documents of their
    own; a missing id stays null; other columns are not read. A text is in one task
    when it is tokenized and when its groups are digested, in pieces between. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    load = functools.partial(sides, a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE))
    texts = aligned_texts(docs, load, id_col, text_col, work)
    vocabulary = max(len(load().a_bytes), len(load().b_bytes))
    counts = kept(pair_counts(texts))
    if counts.count() <= pairs_sent:
        return texts.mapInArrow(_measured(vocabulary, _sent(spark, counts)), RESULT_KIND).drop("row")
    sums = (
        texts.mapInArrow(_text_pairs, "row long, pair long, times long")
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    measured = texts.mapInArrow(_measured(vocabulary, None), RESULT_KIND).drop("n_best", "count_sum")
    return measured.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
