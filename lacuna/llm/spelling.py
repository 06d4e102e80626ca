"""Spelling variant grouping by asymmetric q-chunks: words one edit apart, and the common form of each.

Of two words that differ by one edit the shorter (or either, if equally long) is cut into two
disjoint chunks, halves; the edit leaves one of them whole. The other word contributes its positional
grams of the chunks' lengths. As the words' lengths tell the shift (none, or one behind an inserted
code point), only the grams at a chunk's own place within that shift can match, so a word sends
two grams for partners of its length, which are its own chunks too, and two for partners one shorter.
Words that meet at a chunk are verified by their edit distance. A pair that keeps both chunks
counts at the first only.

A chunk at which more than ``CROWD`` words meet forms no pairs that way. There the words already agree on the
chunk, so their rests differ by one edit, and each word sends its rest with one code point left
out: words that meet again agree in all but that place. Such a group holds at most one word
for each letter of the alphabet, however many share the chunk, so nothing is quadratic or dropped.

Rows: null, empty and word-free texts have no words; repeated rows count again; a null doc_id counts
as an empty one in the choice of the misspelt runs. Of near words with equal n the smallest in
code-point order is the form. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lacuna.session import cut_lineage

CROWD = 32
FLUSH = 400_000  # distinct words that a task adds up before it hands them on

# Latin-1 bytes: A-Z become a-z, what is no letter becomes a space
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def misspelt(doc_id, run: bytes, every: int) -> bytes:
    """``run`` (Latin-1), less one code point if ``every`` divides the CRC-32 of doc_id and run."""
    return _misspelt(zlib.crc32(_name(doc_id)), run, every)


def _name(doc_id) -> bytes:
    return b":" if doc_id is None else b"%d:" % doc_id


def _misspelt(prefix: int, run: bytes, every: int) -> bytes:
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """word, n: the runs of letters of all texts, lower-cased in A-Z, of at least ``least`` code points
    after the misspelling of one run in ``every``."""
    def run(batches):
        found: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(_name(doc_id))
                words = text.encode("latin-1", "replace").translate(_LETTERS).split()
                for w, n in Counter(w for w in words if len(w) >= least).items():
                    w = _misspelt(prefix, w, every)
                    if len(w) >= least:
                        found[w] += n
                if len(found) >= FLUSH:
                    yield _table(found)
                    found.clear()
        yield _table(found)

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _table(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in found], pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])


def _part(word: Column, start, length) -> Column:
    return F.substring(word, F.lit(start) if isinstance(start, int) else start, length)


def _grams(words: DataFrame) -> DataFrame:
    """word, n, ``shift``, ``part``, ``gram`` and ``size``: what a word sends to partners of ``size`` = its length less ``shift``."""
    word, length = F.col("word"), F.length("word")
    sent = []
    for shift in (0, 1):
        size = length - shift
        half = (size / 2).cast("int")
        for part, gram in ((0, _part(word, 1, half)), (1, _part(word, half + 1 + shift, size - half))):
            sent.append(F.struct(size.alias("size"), F.lit(part).alias("part"), gram.alias("gram"), F.lit(shift).alias("shift")))
    return words.select("word", "n", F.inline(F.array(*sent))).filter("size >= 0")


def _once(first: Column, second: Column, size: Column, part: Column) -> Column:
    """Pairs that meet at the second part count there only if the first parts differ."""
    half = (size / 2).cast("int")
    return (part == 0) | (_part(first, 1, half) != _part(second, 1, half))


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """a, n_a, b, n_b: each pair of distinct words (word, n) that are one edit apart, once."""
    key = ["size", "part", "gram"]
    rows = _grams(words)
    met = rows.groupBy(*key).agg(F.count_if(F.col("shift") == 0).alias("chunks"), F.count(F.lit(1)).alias("all"))
    met = met.filter("chunks > 0 and all > 1").select(*key, (F.col("all") > crowd).alias("crowded"))
    rows = cut_lineage(rows.join(met, key))
    side = lambda df, w, n, *more: df.select(*key, F.col("word").alias(w), F.col("n").alias(n), *more)
    few = rows.filter(~F.col("crowded"))
    pairs = (side(few.filter("shift = 0"), "a", "n_a").join(side(few, "b", "n_b", "shift"), key)
             .filter((F.col("shift") == 1) | (F.col("a") < F.col("b")))
             .filter(F.levenshtein("a", "b", 1) == 1)
             .filter(_once(F.col("a"), F.col("b"), F.col("size"), F.col("part"))))
    out = ["a", "n_a", "b", "n_b"]
    return pairs.select(*out).unionByName(_crowded_pairs(rows.filter("crowded")).select(*out))


def _crowded_pairs(rows: DataFrame) -> DataFrame:
    """The same for words that share a crowded chunk: they meet again at the rest without one code point."""
    half = (F.col("size") / 2).cast("int")
    rest = F.when(F.col("part") == 0, _part(F.col("word"), half + 1, F.length("word"))).otherwise(_part(F.col("word"), 1, half + F.col("shift")))
    key = ["size", "part", "gram", "left", "place"]
    without = lambda i: F.concat(_part(F.col("rest"), 1, i - 1), _part(F.col("rest"), i + 1, F.length("rest")))
    places = F.sequence(F.lit(1), F.length("rest"))
    item = lambda left, place: F.struct(left.alias("left"), place.alias("place"))
    # place 0: the whole rest of the shorter word; a longer word may lose any code point to equal it
    sent = F.when(F.col("shift") == 1, F.array_distinct(F.transform(places, lambda i: item(without(i), F.lit(0))))) \
        .otherwise(F.concat(F.array(item(F.col("rest"), F.lit(0))),
                            F.when(F.length("rest") > 0, F.transform(places, lambda i: item(without(i), i))).otherwise(F.array())))
    sent = rows.withColumn("rest", rest).filter("shift = 0 or length(rest) > 0").select("size", "part", "gram", "shift", "word", "n", F.inline(sent))
    a = sent.filter("shift = 0").select(*key, F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = sent.select(*key, "shift", F.col("word").alias("b"), F.col("n").alias("n_b"))
    return (a.join(b, key).filter((F.col("shift") == 1) | ((F.col("place") > 0) & (F.col("a") < F.col("b"))))
            .filter(_once(F.col("a"), F.col("b"), F.col("size"), F.col("part"))))


def variants(words: DataFrame, ratio: int = 10, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (distinct word, n): the number of
    words one edit away; the one of them with the largest n, if that is at least ``ratio`` times the
    word's; and the last word that following forms leads to."""
    words = cut_lineage(words.select("word", F.col("n").cast("long").alias("n")))
    pairs = cut_lineage(near_pairs(words, crowd))
    better = lambda w, n: F.struct((-F.col(n)).alias("less"), F.col(w).alias("word"))
    seen = (words.select("word", "n", F.lit(None).cast("struct<less: bigint, word: string>").alias("other"))
            .unionByName(pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), better("b", "n_b").alias("other")))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), better("a", "n_a").alias("other"))))
    best = seen.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), F.min("other").alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    best = cut_lineage(best.select("word", "n", "n_near", F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = last_forms(best.filter("form is not null").select("word", "form"))
    return best.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """word, ``root``: the end of each chain of ``forms`` (word, form), by doubling the step. n grows along
    a chain by the ratio, so chains are short and free of cycles."""
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut_lineage(step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = 7, every: int = 31, twice: int = 2, ratio: int = 10) -> DataFrame:
    """``variants`` of the words of all texts of ``docs`` (doc_id, text) that occur at least ``twice`` times."""
    return variants(word_counts(docs, least, every).filter(F.col("n") >= twice), ratio)
