"""Token counts (operator 12): texts are encoded in batches inside Arrow
functions and only lengths come back.

A batch holds parts of texts of about BATCH bytes together, so that a batch of
many short texts and one of a few long ones cost alike. Texts beyond PART
characters are cut at safe boundaries, places which no token spans whatever
stands around them, so that the parts' counts add up to the text's.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import in_small_batches

#: Bytes of text encoded together, and characters from which a text is cut.
BATCH, PART = 1 << 19, 1 << 16

#: Byte-level BPE splits a text into runs of letters, of digits, of other signs
#: and of white space, a space going with the run after it. Between a character
#: and the white space after it a run ends always; so it does between letters
#: (of scripts that all Unicode tables agree on) and these signs or digits.
BYTE_LEVEL = regex.compile(r"(?<=\S)[ \t\n]|(?<=[A-Za-z一-龥ぁ-ゖァ-ヺ가-힣])(?=[.,;:!?。、，！？；：0-9])|(?<=[0-9])(?=[A-Za-z])")
#: Pieces hold the space mark at their beginning alone, so none spans a space
#: between two other characters; the space itself is the next part's first mark.
PIECES = regex.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def cut(text: str, safe: regex.Pattern, skip: int = 0, most: int = PART) -> Iterator[str]:
    """Parts of a text, each up to the first safe place after `most` characters;
    `skip` characters at each place are left out. A text without such a place
    stays whole."""
    at = 0
    while len(text) - at > most and (found := safe.search(text, at + most)):
        yield text[at : found.start()]
        at = found.start() + skip
    yield text[at:]


def balanced(sizes: Sequence[int], most: int = BATCH) -> Iterator[range]:
    """Runs of neighbours whose sizes add up to at most `most`; a larger one is
    a run of its own."""
    at = total = 0
    for k, n in enumerate(sizes):
        if k > at and total + n > most:
            yield range(at, k)
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield range(at, len(sizes))


@lru_cache(maxsize=2)
def lengths_of(path: str) -> tuple[Callable[[list[str]], Iterable[int]], regex.Pattern, int]:
    """For a vocabulary file: the token counts of some texts by its library,
    special strings in texts as that handles them; where texts may be cut for
    it, and what is left out at a cut."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda texts: map(len, t.encode_batch_fast(texts, add_special_tokens=False)), byte_level_cuts(path), 0
    if path.endswith(".model"):
        import sentencepiece

        s = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: map(len, s.encode(texts, num_threads=1)), piece_cuts(s), 1
    raise ValueError("a vocabulary file ends in .json or .model")


#: A pattern that is found nowhere: texts stay whole.
NOWHERE = regex.compile(r"(?!)")


def byte_level_cuts(path: str) -> regex.Pattern:
    """BYTE_LEVEL where a file splits as it supposes and no special string has
    such a place in it, else nowhere."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec["normalizer"] is None
    plain = not any(x["lstrip"] or x["rstrip"] or x["single_word"] or BYTE_LEVEL.search(x["content"]) for x in spec["added_tokens"])
    return BYTE_LEVEL if usual and plain and spec["post_processor"] is None else NOWHERE


def piece_cuts(s) -> regex.Pattern:
    """PIECES if the model begins a text with a mark, changes nothing else in it
    and no piece has a mark after another character, else nowhere."""
    alike = "a  b\tcÅÅ"
    same = s.decode(s.encode(alike)) == alike and s.encode("ab")[0] == s.encode("x ab")[-len(s.encode("ab"))]
    return PIECES if same and not any("▁" in s.id_to_piece(i).lstrip("▁") for i in range(s.get_piece_size())) else NOWHERE


def token_counts(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: bytes of the whole
    text in UTF-8, its tokens by the vocabulary file's own library without
    tokens added at its ends, and whether these are more than `limit`.

    One narrow pass without a shuffle; a task holds one Arrow batch of texts and
    the encodings of BATCH bytes, or of one text where no cut is safe. Null
    text: as empty, no tokens. Repeated rows and ids give a row each, a null id
    stays null; an empty table gives no rows; other columns are ignored
    whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, safe, skip = lengths_of(path)
        for b in batches:
            sizes = b.column(1).to_pylist()
            counts = [0] * len(sizes)
            for rows in balanced(sizes):
                parts = [(k, x) for k in rows if sizes[k] for x in cut(b.column(2)[k].as_py(), safe, skip)]
                for some in balanced([len(x) for _, x in parts]):
                    for k, n in zip(some, lengths([parts[k][1] for k in some])):
                        counts[parts[k][0]] += n
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
