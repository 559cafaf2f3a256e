"""Line dedup deletes every block that an earlier document has."""

import random

from gridspark.llm import linededup

P = ["the first line of the passage", "and its second line, as long"]
Q = ["quite another passage begins", "and ends on this line of it"]


def gone(a, b):
    return linededup.blocks(a, b)


def by_search(a, b, least=linededup.LEAST_CHARS):
    """All runs of b that a has, tried one by one."""
    has = {tuple(a[s:e]) for s in range(len(a)) for e in range(s + 1, len(a) + 1)}
    runs = [(s, e) for s in range(len(b)) for e in range(s + 1, len(b) + 1) if tuple(b[s:e]) in has and sum(map(len, b[s:e])) >= least]
    return sorted({k for s, e in runs for k in range(s, e)})


def test_passages_repeated_or_swapped():
    assert gone(["a0", *P, "a1"], ["b0", *P, "b1", *P, "b2"]) == [1, 2, 4, 5]
    assert gone(["a0", *P, "a1", *P, "a2"], ["b0", *P, "b1"]) == [1, 2]
    assert gone([*P, "-", *Q], ["x", *Q, *P]) == [1, 2, 3, 4]
    assert gone(["a", "b"], ["a", "b"]) == []


def test_patience_without_unique_lines():
    assert linededup.patience("xPQPQy", "zPQPQw") == [(k, k) for k in range(1, 5)]


def test_blocks_against_search():
    rng = random.Random(5)
    pool = ["", " ", "abc", "seven ch", "ten chars.", "nineteen characters", "twenty characters, 20", "a line of far more than twenty"]
    for _ in range(400):
        a, b = ([rng.choice(pool) for _ in range(rng.randint(0, 9))] for _ in "ab")
        assert gone(a, b) == by_search(a, b), (a, b)


def test_all_pairs_of_holders(spark):
    """Four and more holders, whose first one has only single short lines of a block."""
    rng = random.Random(11)
    pool = ["", "abc", "seven ch", "ten chars.", "eleven char", "nineteen characters", "a line of more than twenty", "and another one, long enough"]
    texts = {i: [rng.choice(pool) if rng.random() < 0.7 else f"own {i} {k} {rng.random()}" for k in range(rng.randint(1, 7))] for i in range(10, 60)}
    texts |= {0: ["ten chars."], 1: ["eleven char", "x"], **{i: [f"{i}", "ten chars.", "eleven char", f"-{i}"] for i in range(2, 8)}}
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    for b, lines in texts.items():
        lost = {k for a in texts if a < b for k in by_search(texts[a], lines)}
        assert got[b] == "\n".join(x for k, x in enumerate(lines) if k not in lost), b
    assert got[2] == "2\nten chars.\neleven char\n-2" and got[7] == "7\n-7"
