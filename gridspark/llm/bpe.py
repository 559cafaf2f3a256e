"""BPE by a tokenization automaton (operator 10).

compile() starts from one state with a loop for every symbol and applies the
merges in order, each as a gadget: for (u, v) -> uv, the state that u leads to
is replaced, for u alone, by a copy without its v arc, and every state with a u
arc gets a uv arc to where v led. A path of the finished automaton spells a
word's symbols in exactly one way, the one that BPE itself produces, so a word
is encoded by following table entries (state, token) -> state and emitting the
arcs' labels are what decoding writes.

A copy stores only the arc it lost and the state it was copied from; whether
an arc (state, token) exists is looked up along these once and then kept in
the transition table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import in_small_batches

#: White space of the tokenizer's patterns (Unicode White_Space).
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = regex.compile(f"[{_SPACES}]+")
#: str.split() also cuts at these four, which are no white space there.
_ODD = regex.compile("[\x1c-\x1f]")
#: Entries kept of words met and of table entries, each then emptied; words of
#: more characters are not kept, so that entries have a size.
CACHE, LONGEST = 100_000, 64


@lru_cache(maxsize=1)
def _pieces() -> regex.Pattern:
    """The pre-splitting pattern, its letters and numbers being those of
    unicodedata: the regex module's own are of a later Unicode."""
    classes = {"L": [], "N": []}
    for c in range(0x110000):
        if (own := classes.get(unicodedata.category(chr(c))[0])) is not None:
            if own and own[-1][1] == c - 1:
                own[-1][1] = c
            else:
                own.append([c, c])
    letter, number = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in classes[k]) for k in "LN")
    return regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{_SPACES}{letter}{number}]+")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: itself if it is visible Latin-1,
    else the next code point from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Automaton:
    """States are numbered: 0 is the start; the others are a gadget's copies."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        self.label = {i: t for t, i in vocab.items()}
        self.reach: dict[str, int] = {}  # of the first four symbols, the longest token so beginning
        for t in vocab:
            t = t.removesuffix(suffix)
            self.reach[t[:4]] = max(self.reach.get(t[:4], 0), len(t))
        n = max(vocab.values()) + 1
        self.target = [0] * n  # where an arc of this label leads
        self.base, self.gone, self.made = [0], [-1], [-1]  # of a state: copied from, arc lost, at which merge
        self.left, self.right, self.at = [-1] * n, [-1] * n, [-1] * n  # of a token: its parts, the merge that made it
        self.dead: set[int] = set()  # tokens whose merge found no place, so that no arc has them
        self.table: dict[int, int] = {}
        order: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            self.left[uv], self.right[uv], self.at[uv] = u, v, k
            if u in self.dead or v in self.dead or self._parted(order, u, v):
                self.dead.add(uv)
                continue
            order[u, v] = k
            q = self.target[u]
            self.target[uv] = self.target[v]
            self.base.append(q)
            self.gone.append(v)
            self.made.append(k)
            self.target[u] = len(self.base) - 1
        self._own: dict[int, dict[int, int]] = {}

    def _parted(self, order: dict[tuple[int, int], int], u: int, v: int) -> bool:
        """Whether no state that a u arc leads to has a v arc, seen from the
        merges so far: of the tokens that end u, with the time up to which their
        gadgets reached its state, and those that begin v, with the time from
        which its arc follows theirs no more."""
        until = 1 << 60
        while u >= 0:
            t, since = v, 1 << 60
            while t >= 0:
                k = order.get((u, t))
                if k is not None and k < until and k <= since:
                    return True
                since, t = self.at[t], self.left[t]
            until, u = self.at[u], self.right[u]
        return False

    def _lost(self, state: int) -> dict[int, int]:
        """Arcs that a state's gadgets took away: token to merge."""
        got = self._own.get(state)
        if got is None:
            got, s = {}, state
            while s:
                got[self.gone[s]] = self.made[s]
                s = self.base[s]
            if len(self._own) > 4096:
                self._own.clear()
            self._own[state] = got
        return got

    def step(self, state: int, token: int) -> int:
        """The table: the state after `token`, or -1 where no such arc is. An arc
        uv was given only to states that had a u arc when it was made."""
        key = state << 20 | token
        to = self.table.get(key)
        if to is None:
            lost, t, since, to = self._lost(state), token, 1 << 60, self.target[token]
            if token in self.dead:
                t, to = -1, -1
            while t >= 0:
                k = lost.get(t)
                if k is not None and k <= since:
                    to = -1
                    break
                since, t = self.at[t], self.left[t]
            if len(self.table) > CACHE:
                self.table.clear()
            self.table[key] = to
        return to

    def encode(self, word: str) -> list[int]:
        """Tokens of one pre-split word of byte symbols. Each position has one
        state at most, so that a position found dead is never tried again."""
        n, vocab, step, reach = len(word), self.vocab, self.step, self.reach
        path: list[tuple[int, int, int]] = []  # position, state, length tried
        out: list[int] = []
        dead = set()
        i, state, length = 0, 0, min(n, reach.get(word[:4], 3))
        while True:
            while length > 0:
                j = i + length
                if j not in dead:
                    t = vocab.get(word[i:j] if j < n else word[i:] + self.suffix)
                    if t is not None and (to := step(state, t)) >= 0:
                        break
                length -= 1
            else:
                dead.add(i)
                if not path:
                    raise ValueError("no path spells this word")
                i, state, length = path.pop()
                out.pop()
                length -= 1
                continue
            out.append(t)
            if j == n:
                return out
            path.append((i, state, length))
            i, state, length = j, to, min(n - j, reach.get(word[j : j + 4], 3))


class _Words(dict):
    """Chunks met: ids as little-endian bytes, for chunks up to LONGEST characters.
    When CACHE chunks are held, those not met since the last time go."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > LONGEST:
            return self.make(chunk)
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()
        got = self.old.pop(chunk, None)
        if got is None:
            got = self.make(chunk)
        self[chunk] = got
        return got


class Tokenizer:
    """A tokenizer file's normalizer, pre-splitter and automaton. Reads the
    files of this kind: NFC, white space runs to a space, lower case; words split
    by the pattern; bytes as symbols; a suffix at word ends; no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("another kind of tokenizer file")
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        labels = self.automaton.label | {i: t for t, i in self.special.items()}
        self.labels = [labels.get(i, "") for i in range(max(labels) + 1)]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        symbols = byte_symbols()
        self.symbols = {chr(b): s for b, s in symbols.items()}
        self.map = str.maketrans(self.symbols)
        self.words, self.pieces = _Words(self._chunk), _Words(self._piece)

    def _piece(self, piece: str) -> bytes:
        word = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.map)
        return array("I", self.automaton.encode(word)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.pieces[chunk]
        pieces = [chunk[:-1], chunk[-1]] if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?" else _pieces().findall(chunk)
        return b"".join([self.pieces[x] for x in pieces])

    def chunks(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by character
        low = text.lower()
        return [x for x in _SPLIT.split(low) if x] if _ODD.search(low) else low.split()

    def encoded(self, text: str) -> array:
        """The ids of a text, as an array of unsigned 32-bit integers."""
        out = array("I")
        if not self.cut or "<" not in text:
            out.frombytes(b"".join(map(self.words.__getitem__, self.chunks(text))))
            return out
        for span in self.cut.split(text):
            if span in self.special:
                out.append(self.special[span])
            else:
                out.frombytes(b"".join(map(self.words.__getitem__, self.chunks(span))))
        return out

    def encode(self, text: str) -> list[int]:
        return self.encoded(text).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """The arcs' labels, joined by spaces as where a file has no decoder."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, and the ids
    if asked for: a narrow pass over whole texts that holds one text's tokens at
    a time, however long it is. Null text: as empty, no tokens. Repeated rows and
    ids give a row each; an empty table gives none; other columns are ignored
    whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for b in batches:
            n, ids, back, raws = [], [], [], []
            for x in b.column(1).to_pylist():
                own = t.encoded(x or "")
                raw = own.tobytes()
                n.append(len(own))
                ids.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(t.decode(own).encode()).hexdigest())
                raws.append(raw if with_ids else b"")
            out = [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                offsets = pa.array(np.cumsum([0, *n]), pa.int32())
                out.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(raws), "<i4"))))
            yield pa.RecordBatch.from_arrays(out, names=[*names, "ids"] if with_ids else names)

    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            ids = pa.array([t.encode(x or "") for x in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    return in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            text = pa.array([t.decode(x or []) for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
