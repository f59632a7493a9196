"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents become token ids in Arrow batches; what is longer than a sequence is
cut. Pieces are range-sorted by length, which gives each its rank among those of
its length. Lengths are small integers, so documents and gaps fall into at most
``size`` classes each. A round takes all pieces of one length, longest first:
a successor sweep over the gap classes finds the smallest gap that holds it,
the pieces contending for that class are dealt out by rank, the gaps shrink, and
the sweep repeats until the pieces are placed or new sequences are opened. What
passes through the driver are the classes' counts and the ranges of ranks that
were matched with ranges of sequences, never a piece; both depend on ``size``
and hardly on the corpus. Tasks then turn ranks into places.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import kept, ranked

SIZE = 2048
END_ID = 0
KNOWN_WORDS = 400_000  # words whose ids a task remembers
VOCABULARY = "word_bpe_49k.json"

# The tokenizer drops white space and never joins what white space parts, so a text's
# ids are those of its words. Words of these letters need no other normalisation than
# lower case and are already split where the tokenizer's own pattern would split them.
SIMPLE = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\\sa-z0-9\xdf-\xf6\xf8-\xff]+"
)
# White space to str.split, but not to the tokenizer.
ODD_BLANKS = re.compile("[\x1c-\x1f]")
SPECIAL = "<|"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def word_encoder(vocabulary: str):
    """Function word -> its ids as little-endian unsigned 32-bit numbers."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(vocabulary)
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tokenize = tokenizer.model.tokenize
    parts: dict[str, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_part(part: str) -> bytes:
        found = parts.get(part)
        if found is None:
            if len(parts) >= KNOWN_WORDS:
                parts.clear()
            shown = part if part.isascii() else as_bytes.pre_tokenize_str(part)[0][0]
            found = parts[part] = packed([t.id for t in tokenize(shown)])
        return found

    def of_word(word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return of_part(word.lower())
        if SIMPLE.fullmatch(word) and SPECIAL not in word:
            return b"".join(map(of_part, PARTS.findall(word.lower())))
        ids = tokenizer.encode(word, add_special_tokens=False).ids
        return packed(ids)

    return of_word


def text_encoder(vocabulary: str):
    """Function text -> bytes of its ids, the end id included."""
    of_word = word_encoder(vocabulary)
    known: dict[str, bytes] = {}
    end = struct.pack("<I", END_ID)

    def encode(text: str | None) -> bytes:
        text = text or ""
        words = re.split("[ \t\n\r]+", text) if ODD_BLANKS.search(text) else text.split()
        try:
            return b"".join(map(known.__getitem__, words)) + end
        except KeyError:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            for word in set(words):
                if word not in known:
                    known[word] = of_word(word)
            return b"".join(map(known.__getitem__, words)) + end

    return encode


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """Documents cut into pieces of at most ``size`` ids, with their check sums."""

    def run(batches):
        encode = text_encoder(vocabulary)
        for batch in batches:
            rows: list[list[int]] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text)
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    for column, value in zip(
                        rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    ):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(rows, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Ranges of matches: (length, first rank, first sequence, pieces in each, offset).

    Ranks count the pieces of one length from 0. A range goes on to the next one
    of its length; piece i of it, from 0, goes to sequence ``first + i // each``
    at ``offset + i % each * length``.
    """
    classes: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of (first sequence, how many)
    gaps: list[int] = []
    matches = []
    opened = 0

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in classes:
                classes[gap] = []
                bisect.insort(gaps, gap)
            classes[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, many = classes[gap].pop()
                if not classes[gap]:
                    del classes[gap], gaps[at]
            else:
                gap, first, many = size, opened, -(-left // (size // length))
                opened += many
            each = gap // length
            full = min(many, left // each)
            matches.append((length, rank, first, each, size - gap))
            leave(gap - each * length, first, full)
            taken = full * each
            if full < many and taken < left:
                leave(gap - (left - taken) * length, first + full, 1)
                full, taken = full + 1, left
            leave(gap, first + full, many - full)
            rank, left = rank + taken, left - taken
    return matches


def _places(matches: list[tuple[int, int, int, int, int]]):
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    for length in {m[0] for m in matches}:
        own = sorted(m[1:] for m in matches if m[0] == length)
        by_length[length] = tuple(np.array(c, dtype=np.int64) for c in zip(*own))
    return by_length


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE) -> DataFrame:
    """Every piece's place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty, which is one piece of the end id; a null doc_id is
    kept. Sequences are gapless from offset 0 and numbered from 0. Rows that
    repeat are packed each; other columns of ``docs`` are not read; an empty
    table gives no rows. Which of two pieces of one length comes first is
    settled by doc_id, piece and check sum, so reruns agree.
    """
    # Kept, as sampling the splitters would tokenize everything once more.
    cut = kept(pieces(docs, vocabulary or default_vocabulary(), size))
    order = [F.col(c) for c in ("length", "doc_id", "piece", "ids_crc32")]
    sorted_pieces = ranked(cut, *order)
    counts = sorted_pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")
    )
    rows = counts.collect()  # at most one per length
    lows = {r["length"]: r["first"] for r in rows}
    places = _places(plan({r["length"]: r["n"] for r in rows}, size))

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence = np.zeros(len(length), dtype=np.int64)
            offset = np.zeros(len(length), dtype=np.int64)
            for one in np.unique(length):
                here = length == one
                within = rank[here] - lows[int(one)]
                starts, first, each, base = places[int(one)]
                k = np.searchsorted(starts, within, side="right") - 1
                i = within - starts[k]
                sequence[here] = first[k] + i // each[k]
                offset[here] = base[k] + i % each[k] * one
            kept_columns = [batch.column(c) for c in range(5)]
            yield pa.record_batch(
                [*kept_columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return sorted_pieces.select(*columns).mapInArrow(
        run, f"{PIECES}, sequence_id long, offset long"
    )
