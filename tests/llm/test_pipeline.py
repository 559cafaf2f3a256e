"""The stages over the smallest tables, counted and by content."""

import hashlib
import itertools
import math
from collections import Counter

import public_tokenizers
from test_corpus_operators import lines_by_hand, simhash_by_hand, union_find

import corpus_pipeline as P
from gridspark.llm import quality, queries


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(P.STAGES):
        docs = P.written(stage(spark, docs, data), "test-stage")
        sizes.append(docs.count())
        if k < len(P.STAGES) - 1:
            assert docs.columns == P.COLUMNS
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2] and sizes[5] == sizes[4]
    assert P.run(spark, data).count() == sizes[-1]


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_on_odd_rows(spark, data):
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep int"
    rows = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (1, "", "en", "a", 0, 1), (2, "word " * 3000, None, None, 15000, 1), (3, "\n\n \t", "en", "a", 4, 1), (4, None, "en", "b", None, 1), (2**40, "a b c\nd e f", "en", "b", 11, 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for k, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, data)
            assert k == len(P.STAGES) - 1 or out.columns == P.COLUMNS
            assert out.count() <= 3 * len(some)


def copies_by_hand(docs):
    """doc_id: how often it is taken, from the contract's shares."""
    words = {r.doc_id: len((r.text or "").split()) for r in docs}
    size = Counter()
    for r in docs:
        size[r.source] += words[r.doc_id]
    names = sorted((s for s in size if s is not None), key=str.encode) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, float(sum(size.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * size[s]} or free
        for s in over:
            target[s] = min(3.0 * size[s], weight[s] * level)
        left -= sum(target[s] for s in over)
        free -= over
    out = {}
    for r in docs:
        rate = target[r.source] / size[r.source] if size[r.source] else 0.0
        u = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        out[r.doc_id] = math.floor(rate) + (u < rate - math.floor(rate))
    return out


def test_stages_by_content(spark, data):
    """Each stage's rows against its input, by the definitions."""
    from tokenizers import Tokenizer

    docs = [spark.read.parquet(f"{data}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        docs.append(P.written(stage(spark, docs[k], data), "test-stage"))
    rows = [d.collect() for d in docs]
    by_id = [{r.doc_id: r for r in x} for x in rows]

    labels = spark.read.parquet(f"{data}/labels.parquet")
    scored = quality.resample(docs[0], labels).collect()
    k = sum(r.kept for r in scored)
    top = sorted(scored, key=lambda r: (-r.gumbel_key, r.doc_id))[:k]
    assert by_id[1] == {r.doc_id: by_id[0][r.doc_id] for r in top} and 0 < k < len(scored)

    want = lines_by_hand({i: r.text for i, r in by_id[1].items()})
    assert {i: (r.text, r.n_chars, r.source) for i, r in by_id[2].items()} == {i: (t, len(t), by_id[1][i].source) for i, t in want.items()}

    ids = sorted(by_id[2])
    prints = [simhash_by_hand(by_id[2][i].text) for i in ids]
    links = [(a, b) for a, b in itertools.combinations(range(len(ids)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = union_find(len(ids), links)
    assert by_id[3] == {i: by_id[2][i] for n, i in enumerate(ids) if root[n] == n}

    assert Counter(r.doc_id for r in rows[4]) == Counter({i: n for i, n in copies_by_hand(rows[3]).items() if n})
    assert all(r == by_id[3][r.doc_id] for r in rows[4])

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    assert Counter(r.doc_id for r in rows[5]) == Counter(r.doc_id for r in rows[4])
    for r in rows[5]:
        own = t.encode(by_id[4][r.doc_id].text, add_special_tokens=False).ids
        assert list(r.ids) == own and r.decoded_sha256 == hashlib.sha256(t.decode(own, skip_special_tokens=False).encode()).hexdigest()
