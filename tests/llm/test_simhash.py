import random

import xxhash

from lacuna.llm import simhash as S


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(points):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def test_fingerprints_equal_brute_force(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, brute_fingerprint(r.text)) for r in rows)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fp % (1 << 64)) for r in S.fingerprints(odd_docs).collect())
    assert got == want


def test_bits_split_over_slices(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000)).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_SLICE", 37)
    assert S.fingerprint(text) == whole


def clustered(seed, around, spread):
    """Random points and crowded neighbourhoods, so that buckets of every size occur."""
    r = random.Random(seed)
    points = {r.getrandbits(64) for _ in range(150)}
    for _ in range(3):
        centre = r.getrandbits(64)
        for _ in range(around):
            p = centre
            for _ in range(r.randint(0, spread)):
                p ^= 1 << r.randrange(64)
            points.add(p)
    return sorted(p - (1 << 64) if p >> 63 else p for p in points)


def check_components(spark, points, **kw):
    nodes = spark.createDataFrame([(p,) for p in points], "fp long")
    edges = S.links(nodes, **kw)
    assert all(bin((e.a ^ e.b) % (1 << 64)).count("1") <= 2 for e in edges.collect())
    got = {p: p for p in points}
    got.update({r.node: r.root for r in S.components(edges).collect()})
    unsigned = {p % (1 << 64): p for p in points}
    want = brute_roots(sorted(unsigned))
    groups = lambda of: sorted(sorted(p for p in of if of[p] == x) for x in set(of.values()))
    assert groups(got) == groups({unsigned[p]: unsigned[x] for p, x in want.items()})


def test_links_and_components_equal_brute_force(spark):
    check_components(spark, clustered(1, 120, 3))


def test_small_bucket_limit_and_other_segments(spark):
    check_components(spark, clustered(2, 60, 4), bucket=3)
    check_components(spark, clustered(3, 60, 4), bucket=1000, segments=7)


def test_chain_of_links_is_one_component(spark):
    points, p = [], 0
    for i in range(0, 60, 2):
        points.append(p - (1 << 64) if p >> 63 else p)
        p ^= 3 << i
    check_components(spark, points)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)}  # no words
    assert by[5] == by[6] and next(iter(by[5]))[1] == 5
    assert len(by[None]) == 2
    assert S.near_duplicates(no_docs).count() == 0


def test_crowded_fingerprints(spark, monkeypatch):
    rows = [(i, "one two three four" if i % 3 else f"w{i} x{i} y{i} z{i}") for i in range(300)] + [(None, "one two three four")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, S.near_duplicates(df).collect()), key=str)
    monkeypatch.setattr(S, "CROWDED", 4)
    assert sorted(map(tuple, S.near_duplicates(df).collect()), key=str) == want and len(want) == 305
    assert {w[2] for w in want if w[0] is None} == {1}


def test_representatives(odd_docs, no_docs):
    kept = S.representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and 2 not in ids and 1 in ids and ids.count(None) == 1
    assert S.representatives(no_docs).count() == 0


def test_representatives_lose_no_text(spark):
    rows = [(1, "alpha beta gamma delta", "a"), (1, "other words stand here", "a"), (2, "other words stand here", "b"), (None, "third text has these words", "c"),
            (None, "third text has these words", "d"), (3, "alpha beta gamma delta", "e"), (4, "same row here now", "f"), (4, "same row here now", "f"), (None, None, None), (9, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, S.representatives(df).collect()), key=str)
    assert [g[:2] for g in got] == sorted([(1, "alpha beta gamma delta"), (1, "other words stand here"), (4, "same row here now"), (9, ""), (None, "third text has these words")], key=str)
    again = S.representatives(df.repartition(7, "source"))
    assert sorted(map(tuple, again.collect()), key=str) == got
