import random
import re
from collections import Counter

import pytest

from lacuna.llm import licenses as L
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same


def words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, phrases=L.PHRASES, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    """All places of a text, each block against each template."""
    found, out = words(text), []
    for label, phrase in phrases:
        p = words(phrase)
        out += [(label, i, i + len(p), 1.0, True) for i in range(len(found) - len(p) + 1) if p and found[i:i + len(p)] == p]
    for label, template in templates:
        t = Counter(words(template))
        m = sum(t.values())
        if not m:
            continue
        s, start = 8, 0
        while s < m:
            s *= 2
        while start == 0 or start + s < len(found):
            both = sum((Counter(found[start:start + 2 * s]) & t).values())
            if both >= threshold * m - 1e-9:
                out.append((label, start, min(start + 2 * s, len(found)), both / m, False))
            start += s
    return sorted(out)


def got(df, *a, **k):
    return sorted((x.doc_id, x.n_words, sorted(map(tuple, x.places))) for x in L.scan(df, *a, **k).collect())


def texts(r, templates, n=120):
    pool = [w for _, t in templates for w in t.split()] + "the of a to in License été 日本".split()
    for i in range(n):
        out = [r.choice(pool) if r.random() < .5 else f"w{r.randint(0, 400)}" for _ in range(r.choice([0, 3, 20, 300]))]
        for _ in range(r.randint(0, 3)):
            t = r.choice(templates)[1].split()
            t = [x for x in t if r.random() > .06] + [f"x{i}"] * r.randint(0, 5)
            at = r.randint(0, len(out))
            out[at:at] = t
        yield r.choice([" ", "\n", " -- "]).join(out)


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.9, 1.0])
def test_equals_brute_force(spark, threshold):
    rows = list(enumerate(texts(random.Random(int(threshold * 10)), L.TEMPLATES)))
    want = sorted((i, len(words(t)), brute(t, threshold=threshold)) for i, t in rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold) == want
    assert any(p for _, _, p in want)


def test_notices_anywhere_in_long_texts(spark):
    r = random.Random(2)
    filler = lambda n: " ".join(r.choice("the of and any this is software rights file".split()) for _ in range(n))
    rows = [(i, filler(r.randint(0, 3000)) + " " + text + " " + filler(r.randint(0, 3000))) for i, (_, text) in enumerate(L.TEMPLATES)]
    for (i, n, places), (label, _) in zip(got(spark.createDataFrame(rows, "doc_id long, text string")), L.TEMPLATES):
        assert any(p[0] == label and p[3] == 1.0 and not p[4] for p in places)


def test_own_templates_in_groups(spark, monkeypatch):
    monkeypatch.setattr(L, "GROUP_WORDS", 4)
    templates = (("one", "alpha beta"), ("two", "gamma"), ("none", "?!"), ("three", "alpha alpha beta delta epsilon zeta"), ("one", "beta beta beta"))
    rows = [(1, "alpha beta gamma"), (2, "beta, beta; BETA"), (3, "zeta epsilon delta beta alpha alpha"), (4, "alpha"), (5, None), (None, "gamma")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kw = {"phrases": (("p", "beta beta"),), "templates": templates, "threshold": 0.8}
    order = lambda t: str(t)
    found = sorted(((x.doc_id, x.n_words, sorted(map(tuple, x.places))) for x in L.scan(df, **kw).collect()), key=order)
    assert found == sorted(((i, len(words(t)), brute(t, **kw)) for i, t in rows), key=order)
    assert got(df.filter("doc_id is not null"), phrases=(), templates=()) == [(i, len(words(t)), []) for i, t in rows if i]


def test_texts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 7)
    rows = list(enumerate(texts(random.Random(5), L.TEMPLATES, 20))) + [(90, "a" * 9000 + " MIT License " + "b" * 50), (91, " " * 40)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted((i, len(words(t)), brute(t)) for i, t in rows)


def test_phrases(spark):
    rows = [(1, "Under the MIT\nlicense, mit-license; CC-BY. GNU General Public License"), (2, "mit licenses éapache license"), (3, "mit"), (4, "license mit license mit")]
    df = L.digests(L.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    found = {x.doc_id: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.score) for x in df.collect()}
    assert found == {1: (12, 4, 2, 8, "cc-by,gpl,mit", 1.0), 2: (4, 0, None, None, "", 0.0), 3: (1, 0, None, None, "", 0.0), 4: (4, 1, 1, 1, "mit", 1.0)}


def test_odd_rows(odd_docs, no_docs):
    found = sorted(((x.doc_id, x.n_words, x.places) for x in L.scan(odd_docs).collect()), key=str)
    assert found == sorted(((x.doc_id, len(words(x.text)), brute(x.text)) for x in odd_docs.collect()), key=str)
    assert L.digests(L.scan(no_docs)).collect() == []
    same(L.digests(L.scan(odd_docs)), duck({"documents": odd_docs}, ORACLE["op11_license_scan"]))


def test_equals_sql(spark):
    df = spark.createDataFrame(list(enumerate(texts(random.Random(6), L.TEMPLATES, 200))), "doc_id long, text string")
    same(L.digests(L.scan(df)), duck({"documents": df}, ORACLE["op11_license_scan"]))
