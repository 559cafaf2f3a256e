"""Operators 11 to 13 against brute force and the libraries themselves."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from gridspark.llm import alignment, divergence, queries, tokencounts

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
BITS = ["a", "b", "'s", "don't", " ", "  ", "\n", "\t", "1", "23", "é", "世", "界", "。", "の", "<|endoftext|>", "<|endof", "<s>", "▁", "　", "\x1c", "\xa0", "\x00", "!", "..", "한", "🙂🙃", "́", "A", "\r\n", "ǅ", "²", "the cat", "Wörter"]


def mess(rng, n):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


# 11 ------------------------------------------------------------------------


def audit_by_hand(rows, least):
    """rows of (lang, source, text)."""
    words = [(a or "", b or "", Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")))) for a, b, t in rows]
    held, total = defaultdict(Counter), defaultdict(Counter)
    for a, _, c in words:
        held[a].update(c.keys())
        total[a].update(c)
    out = []
    for a in {x[0] for x in words}:
        kept = [t for t, n in held[a].items() if n >= least]
        own = defaultdict(Counter)
        for x, b, c in words:
            if x == a:
                own[b].update({t: c[t] for t in c if t in set(kept)})

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {b: share(own[b]) for b in own}, share(total[a])
        for b in own:
            pair = sorted(((-sum(abs(p[b][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != b))
            term = sorted((q[t] - p[b][t], t.encode(), t) for t in kept if own[b][t] and p[b][t] > q[t])[:50]
            for part, found in (("pair", pair), ("term", term)):
                out += [(a, b, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def audited(spark, rows, **how):
    df = spark.createDataFrame([(k, t, a, b, k % 2, "x", 1) for k, (a, b, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n int, term string, block int")
    return sorted(map(tuple, divergence.audit(df, **how).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_odd_rows(spark):
    rng = random.Random(11)
    vocab = ["the", "The", "ÉTÉ", "été", "x1y", "𝒳", "naïve", "a", "zz-top", "\x7fdel"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "z", None]), " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for _ in range(150)]
    rows += [("fr", "alone", "mot"), ("it", "a", None), ("it", "b", ""), ("en", "none", "123 !"), ("en", "none", None)] + [rows[0]] * 3
    assert audited(spark, rows, least_docs=4) == audit_by_hand(rows, 4)


def test_audit_long_text_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    rng = random.Random(12)
    rows = [("en", f"s{k % 3}", " ".join(f"w{chr(97 + rng.randint(0, 25))}" for _ in range(40))) for k in range(30)]
    rows.append(("en", "s1", "wa WB! " * 300_000 + "ü" * 5_000))
    assert audited(spark, rows, least_docs=2) == audit_by_hand(rows, 2)


def test_audit_ties_and_empty_table(spark):
    rows = [("en", s, "b a") for s in ("é", "z", "a", "𝒳") for _ in range(2)]  # all alike: ties by bytes
    got = audited(spark, rows, least_docs=1)
    assert [x[3] for x in sorted(got, key=lambda x: x[5]) if x[1] == "a"] == sorted(["é", "z", "𝒳"], key=str.encode)
    assert {x[4] for x in got} == {0}
    assert audited(spark, []) == []


def test_slices_keep_terms(monkeypatch):
    text = ("Été no1e_x " * 50 + "y" * 40).encode()
    want = [w for s in divergence.terms_of(text) for w in s]
    monkeypatch.setattr(divergence, "SLICE", 7)
    assert [w for s in divergence.terms_of(text) for w in s] == want


def test_gallop_and_shares():
    rng = np.random.default_rng(5)
    for _ in range(300):
        few, many = (np.sort(rng.choice(400, rng.integers(0, n), replace=False)) for n in (60, 300))
        assert divergence.gallop(few, many, int(rng.integers(1, 9))).tolist() == np.searchsorted(many, few).tolist()
    for total, v in ((0, 1), (10**6, 7), (8 * 10**15, 10**6)):
        count = np.array([0, 1, total // 3, total])
        assert divergence.shares(count, total, v).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5 * v) for c in count]


# 12 ------------------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTES, PIECES])
def test_counts_are_the_librarys(spark, path):
    rng = random.Random(13)
    texts = [None, "", " ", "a " * 70_000, "世界の。" * 30_000, "x" * 150_000, "a1" * 50_000] + [mess(rng, 60) for _ in range(200)]
    texts += texts[-5:]
    df = spark.createDataFrame([(k, t, 7, 8) for k, t in enumerate(texts)] + [(None, "a", 7, 8)], "doc_id long, text string, n_bytes int, n_tokens int")
    got = {r.doc_id: r for r in tokencounts.token_counts(df, path).collect()}
    assert len(got) == len(texts) + 1
    a, b = libraries()
    for k, t in [*enumerate(texts), (None, "a")]:
        n = len(a.encode(t or "", add_special_tokens=False).ids if path == BYTES else b.encode(t or ""))
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 512), t and t[:50]
    assert tokencounts.token_counts(df.limit(0), path).collect() == []


@pytest.mark.parametrize("path", [BYTES, PIECES])
def test_cuts_are_safe(path):
    rng = random.Random(14)
    lengths, safe, skip = tokencounts.lengths_of(path)
    cuts = 0
    for _ in range(3000):
        t = mess(rng, 40)
        parts = list(tokencounts.cut(t, safe, skip, rng.randint(1, 9)))
        assert (" " * skip).join(parts) == t
        assert sum(lengths(parts)) == list(lengths([t]))[0], parts
        cuts += len(parts) - 1
    assert cuts > 1000


def test_batches_are_balanced():
    rng = random.Random(15)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 30, 200]) for _ in range(rng.randint(0, 60))]
        runs = list(tokencounts.balanced(sizes, 100))
        assert [k for r in runs for k in r] == list(range(len(sizes)))
        assert all(len(r) == 1 or sum(sizes[k] for k in r) <= 100 for r in runs)


# 13 ------------------------------------------------------------------------


def aligned_by_hand(texts):
    t, s = libraries()
    t.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    out, links = [], []
    for x in texts:
        a = t.encode(" " + x, add_special_tokens=False).ids if x else []
        b = s.encode(x) if x else []
        raw_a = [bytes(of[c] for c in t.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [s.id_to_piece(i)]]
        if not x or b"".join(raw_a) != (" " + x).encode() or b"".join(raw_b) != (" " + x).encode():
            out.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        ends = [np.cumsum([len(r) for r in raw]).tolist() for raw in (raw_a, raw_b)]
        groups, own, i, j = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            own += [(p, q) for p in a[i:i2] for q in b[j:j2]]
            i, j = i2, j2
        out.append((len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    count = Counter(p for x in links for p in set(x))
    top = defaultdict(int)
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    return [(*o[:4], sum(count[x] == top[x[0]] for x in own), sum(count[x] for x in own), o[4]) for o, own in zip(out, links)]


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_alignment(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_PAIRS", most)
    rng = random.Random(16)
    texts = [None, "", " ", "a", "aé🙂" * 200, "word " * 3_000, "世界の。" * 300, "\n" * 700 + "z", "x" * 3_000] + [mess(rng, 50) for _ in range(150)]
    texts += texts[-5:]
    df = spark.createDataFrame([(k, t, 1, 2, "x") for k, t in enumerate(texts)] + [(None, "", 1, 2, "x")], "doc_id long, text string, row int, n_a int, pairs string")
    got = {r[0]: tuple(r)[1:] for r in alignment.align(df, BYTES, PIECES).collect()}
    assert len(got) == len(texts) + 1
    for k, want in enumerate(aligned_by_hand(texts)):
        assert got[k] == want, texts[k] and texts[k][:50]
    assert got[None] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.align(df.limit(0), BYTES, PIECES).collect() == []


def test_alignment_of_given_texts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op13_token_alignment"](spark, data).collect()}
    assert [got[k] for k in texts] == aligned_by_hand(list(texts.values()))


def test_pieces_are_of_equal_work_and_stitched():
    rng = np.random.default_rng(17)
    parted = 0
    for _ in range(2000):
        a, b = (np.sort(rng.choice(60, rng.integers(0, 40), replace=False)) for _ in range(2))
        work = int(rng.integers(1, 9))
        i, j = alignment.diagonals(a, b, work)
        size = np.diff(i) + np.diff(j)
        assert size.sum() == len(a) + len(b) and (size[:-1] == work).all()
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        assert [sum(1 for _, side in merged[: x + y] if side == 0) for x, y in zip(i, j)] == i.tolist()
        x, y = alignment.common_ends(a, b, work)
        assert sorted({*a} & {*b}) == a[x].tolist() == b[y].tolist()
        parted += sum(len(alignment.overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])[0]) for k in range(len(size))) < len(x)
    assert parted  # some ends were found by stitching alone


def test_wide_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(18)
    n_a, n_b = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    args = rng.integers(0, 5, n_a.sum()), rng.integers(0, 6, n_b.sum()), np.repeat(np.arange(8), 5), first_a, n_a, first_b, n_b, 5, 6
    want = [x.tolist() for x in alignment.pairs_of(*args)]
    monkeypatch.setattr(alignment, "WIDE", 6)
    assert [x.tolist() for x in alignment.pairs_of(*args)] == want
    assert sum(want[2]) == (n_a * n_b).sum()
