"""Order MinHash fingerprints (operator 5), in DataFrame functions only.

A text's word k-mers are numbered by occurrence, so that the j-th occurrence of
a k-mer is an item of its own. One hash of each item orders the items on a ring
(one permutation in place of one hash function per entry), which 64 marks cut
into equal arcs; for each mark the two items that come next are selected, put
back into the order they have in the text and hashed as a tuple. Where a text
has few items, marks borrow from the arcs that follow, so that every entry has
two items and thus an order. Two texts agree in an entry only if they have the
same items in the same order there, which edits of any kind disturb. All of it
is array work within a row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import SPACE, written

K, BINS_LOG2 = 3, 6
POS = 24  # low bits of a packed item: its place in the text
MIN_ID = -(1 << 63)


def with_signature(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """df and a column `name`: array of int, mark << 24 | tuple hash, one for each
    of the marks in turn. Equal texts have equal arrays; a text without words
    has none; one of fewer than k words has one item, all its words.

    Places in the text are kept modulo 2 ** 24: beyond so many words (16.7
    million) two items' order is that of the remainders."""
    low = F.lit((1 << POS) - 1)
    high = F.lit(-(1 << POS))
    hashes, items, last = f"__h_{name}", f"__i_{name}", f"__l_{name}"

    def packed(value: Column, pos: Column) -> Column:
        return value.bitwiseAND(high).bitwiseOR(pos.cast("long").bitwiseAND(low))

    def kmer(x: Column, i: Column) -> Column:
        return packed(F.xxhash64(x, *[F.get(F.col(hashes), i + j) for j in range(1, k)]), i)

    def same(x: Column, at: Column) -> Column:
        return F.shiftright(F.get(F.col(items), at), POS) == F.shiftright(x, POS)

    def item(x: Column, i: Column) -> Column:
        steps = F.array(*[F.lit(1 << b) for b in range(POS - 1, -1, -1)])
        # the run of equal k-mers that x ends, by halving steps: its length is the occurrence's number
        run = F.aggregate(steps, F.lit(0), lambda n, s: F.when((i - n - s >= 0) & same(x, F.greatest(i - n - s, F.lit(0))), n + s).otherwise(n))
        number = F.when((i > 0) & same(x, F.greatest(i - 1, F.lit(0))), run).otherwise(0)
        return packed(F.xxhash64(F.shiftright(x, POS), number), x.bitwiseAND(low))

    def arc(x: Column) -> Column:
        return F.shiftright(x, 64 - BINS_LOG2) + F.lit(1 << BINS_LOG2 - 1)

    def tuple_of(x: Column, y: Column) -> Column:
        a, b = F.shiftright(x, POS), F.shiftright(y, POS)
        pair = F.when(x.bitwiseAND(low) < y.bitwiseAND(low), F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))
        return F.when(F.size(last) == 1, F.xxhash64(a)).otherwise(pair).bitwiseAND(F.lit((1 << 24) - 1))

    def entries(marks: Column, value: Column) -> Column:
        return F.transform(marks, lambda m: F.shiftleft(m, 24).bitwiseOR(value).cast("int"))

    def entry(x: Column, i: Column) -> Column:
        # the marks after the item before x, up to x
        y = F.get(F.col(last), F.when(i + 1 < F.size(last), i + 1).otherwise(0))
        before = F.when(i == 0, F.lit(-1)).otherwise(arc(F.get(F.col(last), F.greatest(i - 1, F.lit(0)))))
        return F.when(before < arc(x), entries(F.sequence(before + 1, F.greatest(arc(x), before + 1)), tuple_of(x, y)))

    n = F.size(hashes)
    df = df.withColumn(hashes, F.transform(F.array_remove(F.split(F.col(text), SPACE), ""), lambda w: F.xxhash64(w)))
    whole = F.array(packed(F.xxhash64(F.col(hashes)), F.lit(0)))
    kmers = F.when(n >= k, F.transform(F.slice(F.col(hashes), 1, F.greatest(n - (k - 1), F.lit(0))), kmer))
    kmers = kmers.when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(items, F.sort_array(kmers))
    df = df.withColumn(last, F.sort_array(F.transform(F.col(items), item)))
    top, first = F.lit((1 << BINS_LOG2) - 1), F.get(F.col(last), F.lit(0))
    end = arc(F.element_at(F.col(last), -1))
    around = F.when(end < top, entries(F.sequence(F.least(end + 1, top), top), tuple_of(first, F.coalesce(F.get(F.col(last), F.lit(1)), first))))
    found = F.flatten(F.array_compact(F.concat(F.transform(F.col(last), entry), F.array(around))))
    df = df.withColumn(name, F.when(F.size(last) > 0, found).otherwise(F.array().cast("array<int>")))
    return df.drop(hashes, items, last)


def fingerprint(signature: Column) -> Column:
    """The signature as text: eight hex digits an entry."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the entries that agree; 1 if neither text has any, 0 if one has none."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / most)


def next_ids(ids: DataFrame) -> DataFrame:
    """ids with a column next: the k that follows in descending order, the first
    after the last. A range sort numbers the rows within partitions; one count
    per partition makes the numbers dense, and each row joins its successor."""
    rows = ids.orderBy(F.col("k").desc()).withColumn("at", F.monotonically_increasing_id())
    rows = written(rows, "omh-order")
    part = rows.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    part = part.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # one row per partition of the sort
    rows = rows.join(F.broadcast(part), F.shiftright("at", 33) == F.col("part"))
    rows = rows.withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "at")
    total = rows.count()
    follows = rows.select(((F.col("rank") + total - 1) % total).alias("rank"), F.col("k").alias("next")) if total else rows.select("rank", F.col("k").alias("next"))
    return rows.join(follows, "rank").drop("rank")


def order_minhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """One row per row of docs: doc_id, n_chars (code points), edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document in descending doc_id, the first
    following the last. Null text: empty. Null doc_id: the last in order. Where
    rows share a doc_id, each is edited on its own, and the next document's text
    is the least of those that the cut leaves. Words, and so k-mers, are cut at
    ASCII white space. Texts of any length are taken whole (see with_signature);
    an empty table gives no rows; other columns are ignored whatever their names.
    The id -2 ** 63 stands for null here and comes back as null.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(MIN_ID)).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    ids = written(texts.groupBy("k").agg(F.max(half).alias("want")), "omh-ids")
    follows = written(next_ids(ids), "omh-next")
    heads = texts.join(follows.select(F.col("next").alias("k"), F.col("k").alias("to"), "want"), "k")
    heads = heads.select(F.col("to").alias("k"), F.left("text", F.col("want")).alias("head")).groupBy("k").agg(F.min("head").alias("head"))
    both = texts.join(heads, "k").withColumn("n_chars", F.char_length("text"))
    cut = F.floor(F.col("n_chars") / 2).cast("int")
    both = both.withColumn("edited", F.concat(F.left("text", F.col("n_chars") - cut), F.left("head", cut))).drop("head")
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    both = with_signature(with_signature(both, "text", "sig", k).drop("text"), "edited", "edited_sig", k).drop("edited")
    rows = written(both, "omh-signatures")
    after = rows.groupBy("k").agg(F.min("sig").alias("next_sig"))
    after = follows.select("k", "next").join(after.withColumnRenamed("k", "next"), "next").select("k", "next_sig")
    out = rows.join(after, "k")
    return out.select(
        F.nullif("k", F.lit(MIN_ID)).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
