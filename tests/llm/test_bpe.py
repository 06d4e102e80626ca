import base64
import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from lacuna.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)


def test_codec_equals_tiktoken(codec, reference):
    r = random.Random(3)
    texts = ["", " ", "a", "Hello  world's 123!\n\n x", "<|endoftext|>", "日本語🙂 é", "\t\r\n ", "aaa" * 40]
    texts += ["".join(r.choice("abcdefgh .,'\né日0") for _ in range(r.randint(1, 300))) for _ in range(60)]
    ids = codec.encode(texts)
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in codec.decode(ids).to_pylist()] == texts


def test_long_words(codec, reference):
    r = random.Random(4)
    texts = ["a" * 2000, "ab" * 400 + "é" * 200, "".join(r.choice("abc") for _ in range(1500)),
             "".join(r.choice("thequickbrownfox") for _ in range(2500)), "日本" * 300, "the" * 300]
    assert codec.encode(texts).to_pylist() == [reference.encode_ordinary(t) for t in texts]


def test_long_and_short_queries_agree(codec):
    r = random.Random(6)
    words = ["".join(r.choice("abcdeghinorst") for _ in range(r.randint(2, 200))).encode() for _ in range(80)]
    assert codec._contract(bpe.CONTRACT, words).to_pylist() == codec._contract(bpe.CONTRACT_LONG, words).to_pylist()


def test_ranks_where_new_pairs_are_lower():
    """A vocabulary in which a merge creates a pair of a lower rank, so that occurrences can't go together."""
    tokens = [bytes([i]) for i in range(256)]
    tokens += [b"cd", b"abcd", b"aba", b"ab", b"abab", b"xy"]
    ranks = [(t, i) for i, t in enumerate(tokens)]
    codec, enc = bpe.Codec(ranks, r"\S+"), tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=dict(ranks), special_tokens={})
    r = random.Random(1)
    words = ["".join(r.choice("abcdxy") for _ in range(n)) for n in [*range(1, 60), 300, 400]] + ["ab" * 200]
    assert codec.encode(words).to_pylist() == [enc.encode_ordinary(w) for w in words]
    words = [w for w in words if w.encode() not in codec.ranks]
    assert codec._contract(bpe.CONTRACT_LONG, [w.encode() for w in words]).to_pylist() == [enc.encode_ordinary(w) for w in words]


def test_forgets_words_beyond_its_bound(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT", 3)
    codec = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    for t in ("one two three four five", "six seven eight nine", "one two ten"):
        assert codec.encode([t]).to_pylist() == [reference.encode_ordinary(t)]
    assert len(codec.words.codes) <= 9


def test_words_of_the_span_before_are_taken_over(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT", 3)
    codec = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    codec.encode(["zqone zqtwo zqthree zqfour"])
    learnt = []
    monkeypatch.setattr(codec, "_learn", lambda words, f=codec._learn: (learnt.extend(words), f(words)))
    text = "zqone zqfive zqfour zqfour"
    assert codec.encode([text]).to_pylist() == [reference.encode_ordinary(text)] and learnt == [" zqfive"]


def test_tokens_of_any_length(reference):
    """Bytes come back from pieces of seven: tokens of 1 to 60 bytes, with zero bytes in them."""
    ranks = [(bytes([i]), i) for i in range(256)] + [(b"\0" * n, 254 + n) for n in range(2, 61)] + [(b"ab" * n, 400 + n) for n in range(1, 20)]
    codec = bpe.Codec(ranks, r"\S+")
    ids = [[r for _, r in ranks], [], [255, 0, 314, 314, 419, 97], [0]]
    table = dict((r, b) for b, r in ranks)
    assert codec.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == [b"".join(table[i] for i in x) for x in ids]


def test_query_on_odd_rows(odd_docs, no_docs, reference):
    found = bpe.digests(bpe.round_trip(odd_docs, PATH, P.PATTERN)).collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in odd_docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), digest(" ".join(map(str, ids)).encode()), digest((r.text or "").encode())))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0


def test_encode_then_decode(odd_docs):
    coded = bpe.encode(odd_docs, PATH, P.PATTERN)
    back = {(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(coded, PATH).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd_docs.collect()}


def test_groups_never_cut_a_row():
    sizes = [5, 2_000_000, 1, 1, 999_999, 3]
    runs = list(bpe._groups(sizes))
    assert [x for lo, hi in runs for x in range(lo, hi)] == list(range(6))
    assert pa.array(sizes)[1].as_py() > bpe.GROUP


def test_segments_of_a_text(monkeypatch, codec, reference):
    monkeypatch.setattr(bpe, "SEGMENT", 3)
    texts = ["", "one two three four five six seven", "", "one", "a b c", "a b c d", "日本語🙂 é " * 9, ""]
    ids = codec.encode(texts)
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in codec.decode(ids).to_pylist()] == texts
    assert codec.decode(ids.slice(1, 4)).to_pylist() == [t.encode() for t in texts[1:5]]
    assert codec.encode([]).to_pylist() == codec.encode(["", ""])[:0].to_pylist() == []
    assert codec.encode(["", ""]).to_pylist() == [[], []] and codec.decode(codec.encode(["", ""])).to_pylist() == [b"", b""]


def test_text_of_ten_million_words(codec):
    n = 10_000_000
    one = codec.encode([" the quick brown fox"])[0].as_py()
    ids = codec.encode([" the quick brown fox" * (n // 4), "end"])
    assert len(ids[0]) == n // 4 * len(one) and ids.flatten()[:8].to_pylist() == one * 2
    back = codec.decode(ids)
    assert back[0].as_py() == b" the quick brown fox" * (n // 4) and back[1].as_py() == b"end"


def test_words_learnt_in_slices(monkeypatch, reference):
    for name, n in (("SEGMENT", 5), ("GROUP", 20), ("KEPT", 10)):
        monkeypatch.setattr(bpe, name, n)
    codec = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    text = " ".join(f"zq{i}xv{i % 7}" for i in range(300))
    assert codec.encode([text, "x", text]).to_pylist() == [reference.encode_ordinary(t) for t in (text, "x", text)]
    assert len(codec.words.codes) < 100
