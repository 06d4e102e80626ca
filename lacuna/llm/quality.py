"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a text whose value lies above a cutoff. The cutoffs of all rules are certified
together on labelled rows: for a stratum and a step of the ladder (a cutoff for each rule), k of the n good
rows would be rejected by any rule, and P(Binomial(n, risk) <= k) is the exact p-value of "more than
that share of good texts is rejected". From lenient to strict, steps are certified until the first that
fails (a fixed sequence needs no correction); across strata the level is divided by their
number (Bonferroni). So with probability ``1 - level`` no stratum loses more than ``risk`` of its good
texts to all rules together. A stratum without enough labelled rows gets no cutoff and loses none.

Rows: a null text has no words. A null language is a stratum of its own. A doc_id's labels count
once, as bad if any is; null labels don't count. Repeated rows get equal results. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lacuna.llm.laws import ln_choose
from lacuna.session import cut_lineage

BLANK = " \t\n\x0b\f\r"
RISK, LEVEL = 0.02, 0.05
MAX_STRATA = 10_000

# value that a rule compares, and its ladder of cutoffs from lenient to strict; step i takes the i-th of each, or its last
LADDERS = {
    "symbols_per_word": [2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02],
    "dup_line_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15],
    "repeat_word_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15],
    "long_words": [14.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.75, 6.5, 6.25, 6.0],
    "short_words": [-1.5, -2.0, -2.5, -3.0, -3.25, -3.5, -3.75, -4.0, -4.25],
}


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _repeat_words(words: Column, triples: Column) -> Column:
    """Words inside a triple that occurs twice or more."""
    placed = F.sort_array(F.transform(triples, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(triples)) == F.size(triples), F.lit(0)).otherwise(_covered(placed))


def _covered(placed: Column) -> Column:
    twins = F.zip_with(placed, F.slice(placed, F.lit(2), F.size(placed)),
                       lambda a, b: F.when(a.t == b.t, F.array(a.i, b.i)))
    at = F.flatten(F.filter(twins, lambda x: x.isNotNull()))
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))


def features(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the counts of every whole text."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANK))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("stratum"), text.alias("text"),
                       F.when(trimmed == "", F.array().cast("array<string>"))
                       .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("words"))
    rows = rows.select("doc_id", "stratum", "text", "words",
                       F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "").alias("lines"),
                       F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
                                   lambda w, i: F.concat(w, F.lit(" "), F.get(F.col("words"), i + 1), F.lit(" "), F.get(F.col("words"), i + 2))).alias("triples"))
    count = lambda c, name: c.cast("long").alias(name)
    return rows.select("doc_id", "stratum", count(F.size("words"), "n_words"),
                       count(F.char_length(F.array_join("words", "")), "word_chars"),
                       count(F.regexp_count("text", F.lit(r"[#*$%&|<>]")), "n_symbols"),
                       count(F.size("lines"), "n_lines"),
                       count(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
                       count(_repeat_words(F.col("words"), F.col("triples")), "n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def values() -> dict[str, Column]:
    n = F.col("n_words")
    mean = _share(F.col("word_chars"), n)
    return {"symbols_per_word": _share(F.col("n_symbols"), n), "dup_line_share": _share(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_word_share": _share(F.col("n_repeat_words"), n), "long_words": mean, "short_words": -mean}


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed downward from k; 1 where k is at the mean or above."""
    log_term = ln_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p)
    least = F.greatest(F.lit(0), k - F.floor(100 + 40 * F.sqrt(n * p))).cast("long")
    total = F.aggregate(
        F.sequence(k.cast("long"), least, F.lit(-1).cast("long")),
        F.struct(F.exp(log_term).alias("term"), F.lit(0.0).alias("sum")),
        lambda s, i: F.struct((s.term * i / (n - i + 1) * ((1 - p) / p)).alias("term"), (s.sum + s.term).alias("sum")),
        lambda s: s.sum)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def certified(known: DataFrame, risk: float = RISK, level: float = LEVEL, ladders: dict = LADDERS) -> DataFrame:
    """stratum and a column for each rule: its cutoff at the strictest certified step or null.

    ``known``: a row for each labelled text that passed the base rules, with its counts and ``quality``.
    """
    value, vectors = values(), steps(ladders)
    tried = [F.struct(F.lit(i).alias("step"), F.count_if(reduce(or_, (value[r] > c for r, c in v.items()))).alias("k")) for i, v in enumerate(vectors)]
    good = known.filter("quality = 1").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*tried).alias("steps"))
    rows = good.select("stratum", "n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("strata"), "steps")
    rows = rows.select("stratum", "n", "strata", F.inline("steps"))
    passed = binomial_cdf(F.col("k"), F.col("n"), risk) <= level / F.col("strata")
    rows = rows.withColumn("passed", passed)
    ladder = Window.partitionBy("stratum").orderBy("step")
    rows = rows.withColumn("reached", F.min(F.col("passed").cast("int")).over(ladder) == 1)
    at = rows.groupBy("stratum").agg(F.max(F.when(F.col("reached"), F.col("step"))).alias("at"))
    return at.select("stratum", *[F.get(F.array(*[F.lit(v[r]) for v in vectors]), F.col("at")).alias(f"cut_{r}") for r in ladders])


def steps(ladders: dict = LADDERS) -> list[dict[str, float]]:
    """The cutoffs of all rules at each step."""
    most = max(map(len, ladders.values()))
    return [{r: float(ladder[min(i, len(ladder) - 1)]) for r, ladder in ladders.items()} for i in range(most)]


def quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the rules that rejected, of every row."""
    counted = cut_lineage(features(docs).withColumn("base_failed", base_failed()))
    marks = (labels.filter("doc_id is not null and quality in (0, 1)")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    one = F.struct("stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "quality")
    known = (counted.filter(~F.col("base_failed")).join(marks, "doc_id")
             .groupBy("doc_id").agg(F.min(one).alias("one")).select("one.*"))
    cuts = cut_lineage(certified(known, risk, level)).withColumnRenamed("stratum", "of")
    if cuts.count() <= MAX_STRATA:  # a few numbers for each stratum
        cuts = F.broadcast(cuts)
    judged = counted.join(cuts, counted["stratum"].eqNullSafe(cuts["of"]), "left")
    rejected = F.array_compact(F.array(*[F.when(v > F.col(f"cut_{r}"), F.lit(r)) for r, v in values().items()]))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size(rejected) == 0)).alias("kept"),
                         F.array_join(rejected, ",").alias("rejected_by"))
