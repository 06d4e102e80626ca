import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lacuna.llm import spelling as S
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts: dict[str, int], ratio: int = 10) -> list[tuple]:
    others = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(others[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def counted(docs, least=7, every=31) -> dict[str, int]:
    out: dict[str, int] = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                out[run] = out.get(run, 0) + 1
    return out


def got(words_df, **k):
    return sorted(map(tuple, S.variants(words_df, **k).select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("crowd", [0, 4, 32])
def test_equals_brute_force(spark, crowd):
    r = random.Random(7)
    words = {"".join(r.choice("abñ") for _ in range(r.randint(7, 10))): r.choice([2, 3, 30, 400, 5000]) for _ in range(900)}
    words.update({"abab" + c + d + "xyz": r.choice([2, 20, 200]) for c in "abcdefghij" for d in "klmnop"})  # a crowded chunk
    assert got(spark.createDataFrame(list(words.items()), "word string, n long"), crowd=crowd) == brute(words)


@pytest.mark.parametrize("crowd", [0, 32])
def test_short_words(spark, crowd):
    r = random.Random(8)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 5))): r.randint(1, 60) for _ in range(150)}
    assert got(spark.createDataFrame(list(words.items()), "word string, n long"), crowd=crowd) == brute(words)


def test_each_pair_comes_once(spark):
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaabaaa", "aaabaaa", "baaaaaa", "aaaaaab"]
    for crowd in (0, 32):
        pairs = S.near_pairs(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), crowd).select("a", "b").collect()
        assert sorted(tuple(sorted(p)) for p in pairs) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


def test_chain_of_forms(spark):
    words = {"abcdefg": 2, "abcdefh": 20, "abcdezh": 200, "abcyezh": 2000, "abxyezh": 20_000, "awxyezh": 200_000}
    found = {w: root for w, _, root, *_ in got(spark.createDataFrame(list(words.items()), "word string, n long"))}
    assert set(found.values()) == {"awxyezh"}


def test_words_of_texts(spark):
    r = random.Random(9)
    pool = ["".join(r.choice("abcdefgñéÀ×ÿ") for _ in range(r.randint(5, 12))) for _ in range(60)]
    docs = [(i, r.choice([" ", "-", "\n", "1", "日", "_"]).join(r.choice(pool).upper() if r.random() < .2 else r.choice(pool) for _ in range(60))) for i in range(80)]
    docs += [(None, "lettered Lettered LETTERED"), (3, None), (4, ""), (5, "12 日本 ."), (6, "É" * 9 + " Straße" * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {x.word: x.n for x in S.word_counts(df).collect()} == counted(docs)
    want = brute({w: n for w, n in counted(docs).items() if n >= 2})
    assert sorted(map(tuple, S.spelling_variants(df).collect())) == want
    assert S.misspelt(1, b"lettered", 1) != b"lettered"


def test_flushed_counts_add_up(spark, monkeypatch):
    df = spark.createDataFrame([(i, "morning evening " * (i + 1)) for i in range(9)], "doc_id long, text string").coalesce(1)
    want = {x.word: x.n for x in S.word_counts(df, every=1 << 40).collect()}
    monkeypatch.setattr(S, "FLUSH", 1)
    assert {x.word: x.n for x in S.word_counts(df, every=1 << 40).collect()} == want == {"morning": 45, "evening": 45}


def test_odd_rows(odd_docs, no_docs):
    rows = [(x.doc_id, x.text) for x in odd_docs.collect()]
    want = brute({w: n for w, n in counted(rows).items() if n >= 2})
    assert sorted(map(tuple, S.spelling_variants(odd_docs).collect())) == want
    assert S.spelling_variants(no_docs).collect() == []
    assert S.word_counts(odd_docs.withColumn("word", F.lit(1))).count() == len(counted(rows))


def test_equals_sql(spark, odd_docs):
    r = random.Random(12)
    pool = ["".join(r.choice("abcñé") for _ in range(r.randint(7, 9))) for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(r.choice(pool) if r.random() < .8 else r.choice(pool)[:-1] + "x" for _ in range(200))) for i in range(40)], "doc_id long, text string")
    for df in (docs, odd_docs.select("doc_id", "text")):
        same(S.spelling_variants(df), duck({"documents": df}, ORACLE["op13_spelling_variants"]))
