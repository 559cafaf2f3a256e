"""Secret scans by a linear-chain conditional random field (operator 8).

Three base patterns always count. Beyond them, words are tagged as secret
begin, inside or outside by a CRF over the word's shape, the words beside it
and what the whole file looks like, decoded by Viterbi. It is trained here, on a
bounded sample of the texts, so that it finds more than the patterns know:
generated secrets of public formats, and strings that only look like some, are
set into the texts, and the patterns' own spans are shown with and without the
features that tell of a keyword.

Scores depend on a word only through the bits below, so they are looked up in
a table for all words of a block at once. A text can hold a tagged span only
if some word's best score beats "outside" by more than all transitions could
cost; Viterbi runs on exactly those texts, and the others are outside
throughout, as Viterbi would find.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm import textops
from gridspark.llm.common import in_small_batches

#: Fixed patterns, with the least length of what counts and the group it is of.
BASE = (
    ("assign", re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I), 2, 8),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 32),
)
#: The hex pattern with its length in it finds the same runs, without stopping at each short one.
_HEX = re.compile(rb"[0-9a-f]{32,}")
KEYWORD = re.compile(rb"passw|secret|token|api_?key", re.I)

#: Texts that train the CRF, at most; windows of one text, and of all; words of a window.
SAMPLE, PER_TEXT, WINDOWS, WINDOW = 2_000, 20, 6_000, 24
SEED = 29
FEATURES = (
    "length >= 8", "length >= 16", "length >= 24", "length >= 32", "digit", "a quarter digits or more", "lower", "upper",
    "= or : inside", "other mark", "hex digits but for marks", "follows a keyword", "follows = or :", "holds a keyword",
    "letters and digits alternate", "upper and lower alternate", "@ or :// inside", "beyond ASCII",
    "text holds digits in 1 % of its bytes", "text holds = or :",
)
BITS = len(FEATURES)
#: Features that tell of a keyword; masked views lack them.
_TELLING = 1 << FEATURES.index("follows a keyword") | 1 << FEATURES.index("follows = or :") | 1 << FEATURES.index("holds a keyword")
#: Marks around a word that are no part of a secret.
_EDGES = b"\"'`,;:!?()[]{}<>|"

_DIGIT, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = _DIGIT + _LOWER + _LOWER.upper()


def _drawn(rng: random.Random, chars: str, n: int) -> str:
    return "".join(rng.choices(chars, k=n))


#: Formats of secrets that vendors document: the fixed part and what follows.
SECRETS = {
    "github": lambda r: "ghp_" + _drawn(r, _ALNUM, 36),
    "gitlab": lambda r: "glpat-" + _drawn(r, _ALNUM + "-_", 20),
    "sk": lambda r: "sk-" + _drawn(r, _ALNUM, 48),
    "stripe": lambda r: "sk_live_" + _drawn(r, _ALNUM, 24),
    "aws": lambda r: _drawn(r, _ALNUM + "+/", 40),
    "slack": lambda r: "-".join(["xoxb", _drawn(r, _DIGIT, 12), _drawn(r, _DIGIT, 12), _drawn(r, _ALNUM, 24)]),
    "google": lambda r: "AIza" + _drawn(r, _ALNUM + "-_", 35),
    "npm": lambda r: "npm_" + _drawn(r, _ALNUM, 36),
    "mail": lambda r: "SG." + _drawn(r, _ALNUM + "-_", 22) + "." + _drawn(r, _ALNUM + "-_", 43),
    "jwt": lambda r: "eyJ" + ".".join(_drawn(r, _ALNUM + "-_", n) for n in (33, 60, 43)),
    "base64": lambda r: _drawn(r, _ALNUM + "+/", 43) + "=",
    "hex": lambda r: _drawn(r, _DIGIT + "abcdef", r.choice((32, 40, 64))),
}
#: Strings that are long or odd, and no secrets.
HARMLESS = (
    lambda r: f"{_drawn(r, _LOWER, 8)}.{r.randint(1, 99)}@{_drawn(r, _LOWER, 6)}{r.randint(0, 9)}.example.com",
    lambda r: f"https://www.{_drawn(r, _LOWER, 9)}.org/{_drawn(r, _LOWER, 7)}/{r.randint(1990, 2030)}/{_drawn(r, _LOWER, 8)}-{_drawn(r, _LOWER, 5)}.html",
    lambda r: _drawn(r, _DIGIT, r.choice((7, 10, 12, 16, 20))),
    lambda r: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}Z",
    lambda r: ".".join(str(r.randint(0, 255)) for _ in range(4)),
    lambda r: "_".join(_drawn(r, _LOWER, r.randint(3, 9)) for _ in range(r.randint(2, 6))),
    lambda r: "".join(_drawn(r, _LOWER, r.randint(3, 9)).capitalize() for _ in range(r.randint(2, 6))),
    lambda r: "-".join(_drawn(r, _LOWER, r.randint(3, 9)) for _ in range(r.randint(2, 6))),
    lambda r: "/" + "/".join(_drawn(r, _LOWER, r.randint(2, 9)) for _ in range(r.randint(2, 6))) + ".txt",
    lambda r: _drawn(r, _LOWER, r.randint(16, 45)),
    lambda r: _drawn(r, _LOWER.upper(), r.randint(8, 30)),
    lambda r: f"{_drawn(r, _LOWER.upper(), 3)}-{r.randint(1990, 2030)}-{_drawn(r, _DIGIT, 6)}",
    lambda r: f"+{r.randint(1, 99)}-{_drawn(r, _DIGIT, 3)}-{_drawn(r, _DIGIT, 7)}",
    lambda r: _drawn(r, _DIGIT + "abcdef", 7),
    lambda r: f"v{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 99)}-rc{r.randint(1, 9)}",
    lambda r: f'href="/{_drawn(r, _LOWER, 8)}"',
    lambda r: f"{r.randint(0, 99)}.{r.randint(0, 99)}",
    lambda r: str(r.randint(0, 2100)),
    lambda r: f"{_drawn(r, _LOWER.upper(), 2)} {_drawn(r, _LOWER.upper(), 2)}-{_drawn(r, _LOWER.upper(), 2)} {r.randint(0, 9)}.{r.randint(0, 9)}",
)


def planted(raw: bytes, rng: random.Random, kinds: Sequence[str], most: int = 3) -> tuple[bytes, list[tuple[int, int]], list[int]]:
    """A text with up to `most` generated secrets and as many harmless strings
    set between its words; the spans of the secrets in bytes (without quotes and
    marks around), and where something was set in."""
    gaps = [m.end() for m in re.finditer(rb"[\x20\n]", raw)] or [0]
    put = [(rng.choice(gaps), True) for _ in range(rng.randint(1, most))] + [(rng.choice(gaps), False) for _ in range(rng.randint(1, most))]
    out, spans, places, size, at = [], [], [], 0, 0
    for gap, secret in sorted(put):
        value = SECRETS[rng.choice(kinds)](rng) if secret else rng.choice(HARMLESS)(rng)
        before, after = rng.choice((("", ""), ("", ""), ("", "."), ("", ","), ('"', '"'), ("(", ")"), ("key: ", ""), ("Bearer ", ""), ("id = ", "")))
        piece = f"{before}{value}{after} ".encode()
        out += [raw[at:gap], piece]
        size += gap - at
        if secret:
            spans.append((size + len(before), size + len(before) + len(value)))
        places.append(size)
        size, at = size + len(piece), gap
    return b"".join([*out, raw[at:]]), spans, places


def base_spans(raw: bytes, keyword: bool = True, hex_run: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, leftmost and non-overlapping per kind;
    matches that are too short are passed over. keyword, hex_run: False where
    it is known that none is there."""
    out = []
    for k, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "assign" and not keyword or kind == "hex" and not hex_run or kind == "access" and b"AKIA" not in raw:
            continue
        for m in (_HEX if kind == "hex" else pattern).finditer(raw):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: code (feature bits), start, end and text of each
    word, and of each text whether it may hold a keyword or a long hex run."""
    buf, starts, ends, doc = textops.words(texts)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    keyword, run = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
    n = ends - starts
    if not len(n):
        return n, starts, ends, doc, keyword, run
    kind = textops.KIND[buf]

    def count(mask: np.ndarray) -> np.ndarray:
        return textops.counts(mask, starts, ends)

    digit, lower, upper = count(kind == 2), count(kind == 0), count(kind == 1)
    joint = count((buf == 0x3D) | (buf == 0x3A))
    hexes = count((kind == 2) | ((buf >= 97) & (buf <= 102)))
    marks = n - digit - lower - upper
    step = np.r_[np.uint8(0), np.where(np.maximum(kind[1:], kind[:-1]) <= 2, kind[1:] ^ kind[:-1], 0)]  # between letters and digits
    turns, cases = count(step >= 2), count(step == 1)
    colon = (buf == 0x3A) & np.r_[buf[1:] == 0x2F, False] & np.r_[buf[2:] == 0x2F, False, False]
    address = count((buf == 0x40) | colon)
    whole = b"\n".join(texts)
    has_key = np.zeros(len(n), bool)
    at = [m.start() for m in KEYWORD.finditer(whole)] if re.search(rb"(?i)passw|secret|token|api_?key", whole) else []
    if at:
        w = np.searchsorted(starts, at, "right") - 1
        has_key[w] = True
        keyword[doc[w]] = True
    same = np.r_[False, doc[1:] == doc[:-1]]

    def after(flag: np.ndarray) -> np.ndarray:
        return same & np.r_[False, flag[:-1]]

    ends_joint = (buf[ends - 1] == 0x3D) | (buf[ends - 1] == 0x3A)
    near = after(has_key)
    near |= after(near & (joint > 0) & (n <= 2))
    size = np.diff(first)
    digits_of = np.bincount(doc, digit, len(texts)) * 100 >= size
    joint_of = np.bincount(doc, joint, len(texts)) > 0
    flags = (
        n >= 8, n >= 16, n >= 24, n >= 32, digit > 0, digit * 4 >= n, lower > 0, upper > 0, joint > 0, marks - joint > 0,
        hexes + marks == n, near, after(ends_joint), has_key, turns >= 4, cases >= 4, address > 0, count(buf >= 128) > 0,
        digits_of[doc], joint_of[doc],
    )
    code = np.zeros(len(n), np.int32)
    for k, flag in enumerate(flags):
        code |= flag.astype(np.int32) << k
    run[doc[(n >= 32) & (hexes >= 32)]] = True
    return code, starts - first[doc], ends - first[doc], doc, keyword, run


def _bits(code: np.ndarray) -> np.ndarray:
    return np.concatenate([(code[..., None] >> np.arange(BITS) & 1), np.ones((*code.shape, 1), np.int64)], -1).astype(np.float64)


class Crf:
    """States: 0 outside, 1 begin, 2 inside (which must follow begin or inside)."""

    FORBID = -30.0

    def __init__(self):
        self.unary = np.zeros((BITS + 1, 3))
        self.move = np.zeros((3, 3))

    def _moves(self) -> np.ndarray:
        move = self.move.copy()
        move[0, 2] = self.FORBID
        return move

    def train(self, code: np.ndarray, tag: np.ndarray, real: np.ndarray, rounds: int = 100, ridge: float = 1e-4) -> Crf:
        """Conditional likelihood over windows (n, length), by gradient ascent
        with scaled forward and backward sums; real is False for padding, at the end."""
        if not len(code):
            return self
        n, length = code.shape
        x = _bits(code).reshape(n * length, -1)
        gold = np.eye(3)[tag] * real[..., None]
        pairs = (real[:, 1:] & real[:, :-1]).astype(float)
        gold_move = sum((gold[:, t - 1] * pairs[:, t - 1, None]).T @ gold[:, t] for t in range(1, length))
        theta = [self.unary, self.move]
        m1, m2 = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        for r in range(1, rounds + 1):
            u = (x @ self.unary).reshape(n, length, 3)
            u[:, 0, 2] += self.FORBID
            e, move = np.exp(u - u.max(2, keepdims=True)), np.exp(self._moves())
            alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.ones((n, length, 1))
            alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
            for t in range(1, length):
                step = (alpha[:, t - 1] @ move) * e[:, t]
                scale[:, t] = step.sum(1, keepdims=True)
                alpha[:, t] = np.where(real[:, t, None], step / scale[:, t], alpha[:, t - 1])
            g2 = gold_move.copy()
            for t in range(length - 1, 0, -1):
                after = e[:, t] * beta[:, t] / scale[:, t]
                g2 -= (alpha[:, t - 1] * pairs[:, t - 1, None]).T @ after * move
                beta[:, t - 1] = np.where(real[:, t, None], after @ move.T, beta[:, t])
            p = alpha * beta
            p = p / p.sum(2, keepdims=True) * real[..., None]
            g1 = x.T @ (gold - p).reshape(n * length, 3) / n
            for k, g in enumerate((g1, g2 / n)):
                g = g - ridge * theta[k]
                m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.99 * m2[k] + 0.01 * g * g
                theta[k] += 0.2 * (m1[k] / (1 - 0.9**r)) / (np.sqrt(m2[k] / (1 - 0.99**r)) + 1e-8)
        return self

    def table(self) -> np.ndarray:
        """Scores of all codes, (2 ** BITS, 3)."""
        out = self.unary[-1:]
        for weights in self.unary[:-1]:
            out = np.concatenate([out, out + weights])
        return out

    def may_tag(self, table: np.ndarray) -> np.ndarray:
        """Of each code, whether a text of such words could leave "outside": a
        span gains at most its words' lead over outside, plus a transition's; a
        text's first word has none before it."""
        move = self._moves() - self.move[0, 0]
        lead = table[:, 1:].max(1) - table[:, 0]
        return lead + max(0.0, move[0, 1], move[1, 2], move[2, 2], move[1, 1], move[2, 1]) + max(0.0, move[1, 0], move[2, 0]) > 0

    def viterbi(self, u: np.ndarray) -> np.ndarray:
        """Best tags of one text; on a tie the lower state."""
        move = self._moves()
        back = np.zeros((len(u), 3), np.int8)
        score = u[0] + np.array([0.0, 0.0, self.FORBID])
        rows = move.T
        for t in range(1, len(u)):
            s = rows + score
            back[t] = s.argmax(1)
            score = s.max(1) + u[t]
        tags = np.zeros(len(u), np.int8)
        tags[-1] = score.argmax()
        for t in range(len(u) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


def _windows(raw: bytes, spans: list[tuple[int, int]], places: list[int], masked: bool, rng: random.Random, most: int) -> Iterator[tuple[list[int], list[int]]]:
    """(codes, tags) of up to `most` windows of a text, drawn from those around
    places (bytes) and spans; its first window where there are none. Words of a
    span are begin and inside; where the features that tell of a keyword are
    masked, only its last word is one."""
    code, start, end, *_ = describe([raw])
    if not len(code):
        return
    tag = np.zeros(len(code), np.int64)
    for s, e in spans:
        w = np.arange(np.searchsorted(end, s, "right"), np.searchsorted(start, e))[-1 if masked else 0 :]
        tag[w[1:]] = np.where(tag[w[1:]] == 0, 2, tag[w[1:]])
        tag[w[:1]] = np.maximum(tag[w[:1]], 1)
    if masked:
        code = code & ~_TELLING
    half = WINDOW // 2
    near = np.unique(np.r_[np.flatnonzero(tag), np.searchsorted(end, places, "right")].astype(np.int64))
    at = sorted({max(0, k // half - 1) * half for k in near.tolist()} or {0})
    for k in rng.sample(at, min(most, len(at))):
        yield code[k : k + WINDOW].tolist(), tag[k : k + WINDOW].tolist()


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, per_text: int = PER_TEXT, kinds: Sequence[str] = tuple(SECRETS), base: Sequence[str] = ("assign", "access", "hex")) -> Crf:
    """A CRF from about `sample` texts (2 x `sample` at most) drawn by a hash of
    the id, WINDOWS windows at most and `per_text` of a view of a text at most. Views: the
    text itself, where spans of the `base` patterns are the secrets, with all
    features or, for half of the texts, without those that tell of a keyword; and
    texts without such spans once more, with generated secrets of the `kinds`
    set in. Leaving out kinds, or patterns of `base` and the texts they match,
    is for testing on them."""
    total = docs.count()
    share = min(1.0, sample / max(1, total))
    h = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(SEED)), 11).cast("double") / float(1 << 53)
    some = in_small_batches(docs).where(h < share).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, codes, tags = [], [], []
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rng, raw = random.Random(f"{SEED}:{i}"), raw or b""
                own = [(s, e) for s, k, e in base_spans(raw) if BASE[k][0] in base]
                left = [(s, e) for s, k, e in base_spans(raw) if BASE[k][0] not in base]
                views = [] if left else [_windows(raw, own, [], rng.random() < 0.5, rng, per_text)]
                if not own and not left:
                    views.append(_windows(*planted(raw, rng, kinds), False, rng, per_text))
                for code, tag in (x for v in views for x in v):
                    ids.append(i)
                    codes.append(code)
                    tags.append(tag)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int64()))], names=["doc_id", "code", "tag"])

    rows = some.mapInArrow(run, "doc_id long, code array<int>, tag array<long>")
    rows = rows.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "code", "tag").limit(WINDOWS).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    code, tag, real = (np.zeros((len(rows), WINDOW), t) for t in (np.int64, np.int64, bool))
    for k, (c, t) in enumerate(zip(rows.code, rows.tag, strict=True)):
        code[k, : len(c)], tag[k, : len(c)], real[k, : len(c)] = c, t, True
    return Crf().train(code, tag, real)


def _trimmed(raw: bytes, s: int, e: int) -> tuple[int, int]:
    """A span without the marks around it."""
    while s < e and raw[s] in _EDGES:
        s += 1
    while s < e and raw[e - 1] in _EDGES + b".":
        e -= 1
    return s, e


def _beyond_base(raw: bytes, base: list[tuple[int, int, int]], tags: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the tags that overlap none of the base spans (sorted by start)."""
    begins, reach = np.array([s for s, _, _ in base]), np.maximum.accumulate([e for _, _, e in base] or [0])
    out = []
    for k in np.flatnonzero(tags == 1).tolist():
        last = k
        while last + 1 < len(tags) and tags[last + 1] == 2:
            last += 1
        s, e = _trimmed(raw, int(start[k]), int(end[last]))
        before = int(np.searchsorted(begins, e))
        if s < e and not (before and reach[before - 1] > s):
            out.append((s, len(BASE), e))
    return out


def scan(docs: DataFrame, crf: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): spans as array of (kind, start, end) in code points, end
    exclusive, by start and then kind; kind "crf" for those of the CRF that
    overlap none of the base ones, without quotes and marks around them.

    A narrow pass over whole texts, however long; work grows with the text. Null
    text: empty. Every row of docs gives a row, whatever its id and however often
    it is repeated; an empty table gives none; other columns are ignored.
    """
    unary, move = crf.unary, crf.move

    def spans_of(raw: bytes, tags: np.ndarray | None, start: np.ndarray, end: np.ndarray, keyword: bool, run: bool) -> list[dict]:
        found = base_spans(raw, keyword, run)
        if tags is not None:
            found = sorted(found + _beyond_base(raw, found, tags, start, end))
        if not found:
            return []
        names = [x[0] for x in BASE] + ["crf"]
        if not raw.isascii():  # bytes that go on with a character before them don't count
            place = np.r_[0, np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)]
            found = [(int(place[s]), k, int(place[e])) for s, k, e in found]
        return [{"kind": names[k], "start": s, "end": e} for s, k, e in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        own = Crf()
        own.unary, own.move = unary, move
        table = own.table()
        may = own.may_tag(table)
        for b in batches:
            out: list[list[dict]] = []
            for _, texts in textops.blocks([x or b"" for x in b.column(1).to_pylist()]):
                code, start, end, doc, keyword, run_ = describe(texts)
                tagged = np.zeros(len(texts), bool)
                tagged[doc[may[code]]] = True
                edge = np.searchsorted(doc, np.arange(len(texts) + 1))
                for k, raw in enumerate(texts):
                    w = slice(edge[k], edge[k + 1])
                    if not (tagged[k] or keyword[k] or run_[k] or b"AKIA" in raw):
                        out.append([])
                        continue
                    out.append(spans_of(raw, own.viterbi(table[code[w]]) if tagged[k] else None, start[w], end[w], keyword[k], run_[k]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def joined(spans, kinds: tuple[str, ...]):
    """Spans of the kinds as kind:start:end, comma-joined."""
    some = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
