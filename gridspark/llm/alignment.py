"""Cross-tokenizer alignment (operator 13): tokens of two vocabularies over the
same bytes, grouped where both end.

The end offsets of A's and of B's tokens are two ascending lists. Merge-path
partitioning cuts their merge into pieces of equal work, whatever documents they
lie in: a binary search along each diagonal i + j = k * PIECE finds how many
ends of A and of B come before it. Pieces are merged on their own and emit the
ends that overlap; stitching adds those that a diagonal parted, and groups run
from one such end to the next.

Documents are tokenized and aligned in one narrow pass, which writes a row each
with its distinct linked id pairs. How many documents hold a pair is one
aggregation with map-side combining; the pairs met more than once go back to the
documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridspark.llm.bpe import byte_symbols
from gridspark.llm.common import in_small_batches, join_bounded, written
from gridspark.llm.tokencounts import BYTE_LEVEL, PIECES, balanced, byte_level_cuts, piece_cuts

#: Ends of A and B together that one piece merges.
PIECE = 1 << 15
#: Bytes of texts aligned together; a longer text makes a round of its own.
ROUND = 1 << 20
#: Tokens whose ids are hashed at once.
SLICE = 1 << 16
#: Links of a group from which it is counted by distinct ids, not link by link.
WIDE = 256
#: Units of texts that a worker keeps for each vocabulary, up to so many
#: characters long.
KNOWN, LONGEST = 200_000, 64
#: Rows of the table of pairs up to which it is broadcast (about 40 bytes each).
MOST_PAIRS = 1_000_000


def diagonals(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b come before each cut of their merge into pieces of
    `work` elements (the last may be shorter). Of equal elements a's goes first.
    All diagonals are halved at once."""
    n = len(a) + len(b)
    d = np.append(np.arange(0, n, work), n)
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        first = a[np.where(open_, mid, 0)] <= b[np.where(open_, d - mid - 1, 0)]
        low = np.where(open_ & first, mid + 1, low)
        high = np.where(open_ & ~first, mid, high)
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the elements that one piece has on both sides."""
    at = np.searchsorted(b, a)
    met = np.flatnonzero(at < len(b))
    met = met[b[at[met]] == a[met]]
    return met, at[met]


def common_ends(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b (ascending, without repeats) of all equal elements:
    pieces merged one by one, then stitched. A diagonal can part an equal pair,
    a's element being the last before it and b's the first after."""
    i, j = diagonals(a, b, work)
    found = []
    for k in range(len(i) - 1):
        x, y = overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        found.append((x + i[k], y + j[k]))
        if i[k + 1] > i[k] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            found.append((i[k + 1 : k + 2] - 1, j[k + 1 : k + 2]))
    return tuple(np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


#: Spaces beside white space: these texts are cut by the pattern, others at
#: every space.
_MIXED = regex.compile(r"\s | \s|▁")


def units(text: str) -> list[str]:
    """What stands between the spaces that no token of either vocabulary spans;
    such a space goes with the unit after it, and one stands before the text."""
    if not text:
        return []
    return PIECES.split(text) if text[0] == " " or text[-1] == " " or _MIXED.search(text) else text.split(" ")


class Side:
    """One vocabulary: ids of units, and the bytes of every id. Units are encoded
    by the library once and kept."""

    def __init__(self, path: str):
        self.known: dict[str, bytes | None] = {}
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
            from tokenizers import Tokenizer

            if byte_level_cuts(path) is not BYTE_LEVEL:
                raise ValueError("another kind of tokenizer file")
            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            t.no_truncation()
            t.no_padding()
            self.library = lambda own: [x.ids for x in t.encode_batch_fast([" " + u for u in own], add_special_tokens=False)]
            byte = {s: b for b, s in byte_symbols().items()}
            with open(path, encoding="utf-8") as f:
                vocab = json.load(f)["model"]["vocab"]
            self.raw = [b""] * (max(vocab.values()) + 1)
            for entry, i in vocab.items():
                self.raw[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        elif path.endswith(".model"):
            import sentencepiece

            s = sentencepiece.SentencePieceProcessor(model_file=path)
            if piece_cuts(s) is not PIECES:
                raise ValueError("another kind of model")
            self.library = lambda own: s.encode(own, num_threads=1)
            pieces = [s.id_to_piece(i) for i in range(s.get_piece_size())]
            self.raw = [bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        else:
            raise ValueError("a vocabulary file ends in .json or .model")
        self.size = np.array([len(x) for x in self.raw], np.int64)

    def _spelled(self, own: list[str]) -> Iterator[bytes | None]:
        """Ids of units as bytes, or None where their bytes are not a space and
        the unit."""
        for some in balanced([len(x) for x in own]):
            part = own[some.start : some.stop]
            for unit, ids in zip(part, self.library(part)):
                whole = b"".join(map(self.raw.__getitem__, ids)) == (" " + unit).encode()
                yield array("I", ids).tobytes() if whole else None

    def encode(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Ids of each text, given as units, or None where their bytes are not
        its own."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = list(set().union(*texts) - self.known.keys())
        self.known.update(zip(new, self._spelled(new)))
        out: list[np.ndarray | None] = []
        for own in texts:
            try:
                out.append(np.frombuffer(b"".join(map(self.known.__getitem__, own)), np.uint32))
            except TypeError:  # a None among them
                out.append(None)
        for u in new:
            if len(u) > LONGEST:
                del self.known[u]
        return out


@lru_cache(maxsize=1)
def sides(path_a: str, path_b: str) -> tuple[Side, Side, list[str]]:
    """Both vocabularies, and how each id is written: with a comma after it and
    with the sign that ends its side of a group."""
    a, b = Side(path_a), Side(path_b)
    return a, b, [f"{i}{s}" for side, end in ((a, "|"), (b, ";")) for i in range(len(side.raw)) for s in (",", end)]


def pairs_of(ids_a: np.ndarray, ids_b: np.ndarray, doc: np.ndarray, first_a: np.ndarray, n_a: np.ndarray, first_b: np.ndarray, n_b: np.ndarray, height: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, A id * width + B id, links) of the groups, links of a document
    summed by pair. Wide groups are counted by their distinct ids."""
    links = n_a * n_b
    g = np.flatnonzero(links <= WIDE)
    size = links[g]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    g = np.repeat(g, size)
    pair = ids_a[first_a[g] + at // n_b[g]] * width + ids_b[first_b[g] + at % n_b[g]]
    top = height * width
    key, times = np.unique(doc[g] * top + pair, return_counts=True)
    keys, all_times = [key], [times]
    for k in np.flatnonzero(links > WIDE):
        x, n = np.unique(ids_a[first_a[k] : first_a[k] + n_a[k]], return_counts=True)
        y, m = np.unique(ids_b[first_b[k] : first_b[k] + n_b[k]], return_counts=True)
        keys.append(doc[k] * top + (x[:, None] * width + y[None, :]).ravel())
        all_times.append((n[:, None] * m[None, :]).ravel())
    if len(keys) > 1:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.zeros(len(key), np.int64)
        np.add.at(times, at, np.concatenate(all_times))
    return key // top, key % top, times


def _aligned(texts: list[str], a: Side, b: Side, written_as: list[str]) -> list[pa.Array]:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of each text."""
    split = [units(t) for t in texts]
    found = list(zip(a.encode(split), b.encode(split)))
    del split
    own = [k for k, (x, y) in enumerate(found) if x is not None and y is not None]
    count = np.zeros((4, len(texts)), np.int64)
    for side in (0, 1):
        count[side, own] = [len(found[k][side]) for k in own]
    ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *(found[k][side] for k in own)]).astype(np.int64) for side in (0, 1))
    del found
    ends_a, ends_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])  # the texts one after another
    last_a, last_b = common_ends(ends_a, ends_b)
    first_a, first_b = (np.concatenate([[0], x[:-1] + 1]).astype(np.int64)[: len(x)] for x in (last_a, last_b))
    n_a, n_b = last_a - first_a + 1, last_b - first_b + 1
    doc = np.repeat(np.arange(len(texts)), count[0])[last_a]
    np.add.at(count[2], doc, 1)
    np.add.at(count[3], doc, n_a * n_b)
    of, pair, times = pairs_of(ids_a, ids_b, doc, first_a, n_a, first_b, n_b, len(a.raw), len(b.raw))

    # all ids as they are written: group by group, A's tokens and then B's
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    for ids, first, n, base, before in ((ids_a, first_a, n_a, 0, first_b), (ids_b, first_b, n_b, 2 * len(a.raw), last_a + 1)):
        own_code = base + 2 * ids
        own_code[first + n - 1] += 1
        code[np.arange(len(ids)) + np.repeat(before, n)] = own_code
    digest, at = [], 0
    for n in (count[0] + count[1]).tolist():
        sha = hashlib.sha256()
        for k in range(at, at + n, SLICE):
            text = "".join(map(written_as.__getitem__, code[k : min(k + SLICE, at + n)].tolist()))
            sha.update((text if k + SLICE < at + n else text[:-1]).encode())
        digest.append(sha.hexdigest() if n else "")
        at += n
    offsets = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pair, times)]
    return [*map(pa.array, count), pa.array(digest, pa.string()), *lists]


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def grouped(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's tokens aligned: (doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs, times), a pair being A's id times B's vocabulary size
    plus B's id, times the links that the document has of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = sides(path_a, path_b)
        for batch in batches:
            for rows in balanced(batch.column(1).to_pylist(), ROUND):
                texts = batch.column(2)[rows.start : rows.stop].to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows.start : rows.stop], *_aligned(texts, *how)], names=_NAMES)

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(whole).alias("n"), whole.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    for every row of docs.

    A's file sees a space and the text, B's adds the space itself; special
    strings are plain text. A link is an A and a B token of one group; a pair's
    count is the number of documents that hold it linked, count_sum the sum of
    counts over a document's links, n_best its links whose count is the highest
    of their A id in the whole corpus, ties included.

    A null or empty text, or one that either vocabulary doesn't spell byte by
    byte, has no tokens: zeros and an empty groups_sha256. Repeated rows and ids
    are documents of their own, a null id stays null; an empty table gives no
    rows; other columns are ignored whatever their names. A task holds the
    tokens of ROUND bytes of texts or of one longer text.
    """
    rows = grouped(docs, path_a, path_b, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "alignment-documents")
    width = len(sides(path_a, path_b)[1].raw)
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    best = F.col("count") == F.max("count").over(Window.partitionBy(F.expr(f"pair div {width}")))
    # a pair that is not here has one document and is not its A id's best
    counts = counts.withColumn("best", best).where("count > 1 or best")
    counts = written(counts, "alignment-pairs")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    links = join_bounded(links, counts.withColumnRenamed("pair", "pairs"), "pairs", "left", MOST_PAIRS)
    n_best = F.sum(F.when(F.coalesce("best", F.lit(False)), F.col("times")).otherwise(0)).alias("n_best")
    sums = links.groupBy("row").agg(n_best, F.sum(F.col("times") * F.coalesce("count", F.lit(1))).alias("count_sum"))
    out = rows.select("row", *_NAMES[:6]).join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
