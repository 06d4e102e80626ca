import base64
import hashlib

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from lacuna.llm import birnn, mixing, secrets, toxicity
from tests.llm.test_simhash import brute_fingerprint, brute_roots


def test_stages_equal_brute_force(spark, odd_docs, odd_labels, tmp_path):
    good = spark.createDataFrame([(i, f"text {i} with a few words " + (f"key AKIA{i:016d}" if i % 7 == 0 else "of its own"), "en", f"s{i % 4}", 0) for i in range(100, 160)],
                                 "doc_id long, text string, lang string, source string, n_chars long").withColumn("n_chars", F.char_length("text"))
    docs = odd_docs.select(C.COLUMNS).unionByName(good)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    odd_labels.write.parquet(str(tmp_path / "labels.parquet"))
    at, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in C.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        before, at = at, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, at)
        assert name == "encoding" or at.columns == C.COLUMNS
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)

    before, after = seen["toxicity"]
    model = toxicity.fit(before, odd_labels)
    score = birnn.Scorer(toxicity._unpack(model)) if model else lambda texts: [0.0] * len(texts)
    assert rows(after) == [r for r in rows(before) if score([r[1]])[0] < toxicity.THRESHOLD]

    before, after = seen["near_duplicates"]
    roots = brute_roots(sorted({brute_fingerprint(r[1]) for r in rows(before)}))
    first = {}
    for r in rows(before):
        root, place = roots[brute_fingerprint(r[1])], (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
        first[root] = min(first.get(root, (place, r[0], r[1])), (place, r[0], r[1]), key=lambda t: t[0])
    assert sorted((r[:2] for r in rows(after)), key=repr) == sorted((t[1:] for t in first.values()), key=repr)

    before, after = seen["secrets"]
    by = {(r[0], *r[2:4]): r[1] for r in rows(before)}
    assert len(by) == before.count() == after.count()
    for r in rows(after):
        text = by[(r[0], *r[2:4])]
        assert (r[1] == text) == (not secrets.scan(text))
        assert r[1] is None or (not secrets.find(r[1]) and r[4] == len(r[1]))

    before, after = seen["mixing"]
    copies = {(r.doc_id, r.size): r.copies for r in mixing.mixture(before).collect()}
    count = {}
    for r in rows(after):
        count[r] = count.get(r, 0) + 1
    assert all(count.get(r, 0) == copies[r[0], len((r[1] or "").split())] for r in rows(before))

    before, after = seen["encoding"]
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))})
    want = []
    for r in rows(before):
        ids = enc.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest(), r[3]))
    assert rows(after.drop("ids")) == sorted(want, key=repr)


def test_empty_tables(spark, odd_docs, odd_labels, tmp_path):
    odd_docs.select(C.COLUMNS).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    odd_labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
