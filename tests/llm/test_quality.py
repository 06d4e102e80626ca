import math

import pytest
from pyspark.sql import functions as F

from lacuna.llm import quality as Q
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same


def brute(text):
    text = text or ""
    for c in "\t\x0b\f\r":
        flat = text if c == "\t" else flat  # noqa: F821
        flat = flat.replace(c, " ")
    words = [w for w in flat.replace("\n", " ").split(" ") if w]
    grams = list(zip(words, words[1:], words[2:]))
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else None
    covered = {i + j for i, g in enumerate(grams) if twice and g in twice for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(Q.BLANK)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, odd_docs):
    texts = ["a b c a b c", "a b c x a b c a b c", "a a a a a", "a a a", "x\ny\nx\n\n \n \n", "# * $ <a|b> é%é", "a\x0bb\x0cc\rd", "no split here a",
             "a|b c", "a b|c", "x " * 60, None, "", "p q r s p q r s t"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r) for r in Q.features(docs).orderBy("doc_id").select(names).collect()] == [brute(t) for t in texts]


@pytest.mark.parametrize("n,p", [(1, 0.004), (50, 0.1), (1000, 0.004), (5000, 0.02), (200_000, 0.004)])
def test_binomial_cdf(spark, n, p):
    ks = sorted({0, 1, 2, int(n * p / 2), max(0, int(n * p) - 1), int(n * p) + 5} & set(range(n + 1)))
    got = spark.createDataFrame([(k, n) for k in ks], "k long, n long").select("k", Q.binomial_cdf(F.col("k"), F.col("n"), p).alias("c")).collect()
    for r in got:
        want = 1.0 if r.k >= n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(r.k + 1))
        assert r.c == pytest.approx(want, rel=1e-7)


def test_ladder_stops_at_the_first_failure(spark):
    """2000 good rows; 0, 0, 60, 0 of them beyond the cutoffs 4 > 3 > 2 > 1 is impossible, so counts grow: the third fails."""
    ladders = {"symbols_per_word": [4.0, 3.0, 2.0, 1.0], "dup_line_share": [0.9]}
    row = lambda i: ("en", 100, 500, 250 if i < 60 else 0, 10, 0, 0, 1)
    known = spark.createDataFrame([row(i) for i in range(2000)] + [("de", 100, 500, 0, 10, 0, 0, 1)] * 20,
                                  "stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, quality int")
    cuts = {r.stratum: r for r in Q.certified(known, 0.02, 0.05, ladders).collect()}
    assert cuts["en"].cut_symbols_per_word == 3.0 and cuts["en"].cut_dup_line_share == 0.9
    assert cuts["de"].cut_symbols_per_word is None  # too few labels to certify anything


def made(spark):
    rows, labels = [], []
    for i in range(6000):
        bad = i % 5 == 0
        words = [f"w{(i * 31 + j * 17) % 977}x{j}" for j in range(60)]
        rows.append((i, " ".join(w + ("###" if bad and i % 2 else "") for w in words) if not (bad and i % 2 == 0) else "\n".join([f"a{i} b c d e"] * 30), ["en", "en", "de", None][i % 4]))
        labels.append((i, 0 if bad else 1, 0))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_certified_rules_equal_sql_and_keep_good_texts(spark):
    docs, labels = made(spark)
    found = Q.quality(docs, labels)
    same(found, duck({"documents": docs, "labels": labels}, ORACLE["op1_quality_rules"]))
    rows = found.join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    en = [r for r in rows if r.quality == 0 and r.rejected_by]
    assert en and "symbols_per_word" in {x for r in en for x in r.rejected_by.split(",")}


def test_odd_rows(odd_docs, odd_labels, no_docs):
    found = Q.quality(odd_docs, odd_labels)
    assert found.count() == odd_docs.count()
    same(found, duck({"documents": odd_docs, "labels": odd_labels}, ORACLE["op1_quality_rules"]))
    assert Q.quality(no_docs, odd_labels).count() == 0
    assert Q.quality(odd_docs, odd_labels.limit(0)).filter("not base_failed and not kept").count() == 0


def test_two_hundred_labels_certify_all_rules_together(spark):
    """217 good labels without a rejection suffice for four strata: (1 - 0.02)^217 is below 0.05 / 4."""
    row = lambda lang: (lang, 100, 500, 0, 10, 0, 0, 1)
    known = spark.createDataFrame([row("a")] * 217 + [row("b")] * 216 + [row("c"), row("d")],
                                  "stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, quality int")
    cuts = {r.stratum: r for r in Q.certified(known).collect()}
    assert cuts["a"].cut_symbols_per_word == 0.02 and cuts["a"].cut_dup_line_share == 0.15 and cuts["a"].cut_short_words == -4.25
    assert all(cuts[s].cut_symbols_per_word is None for s in "bcd")
