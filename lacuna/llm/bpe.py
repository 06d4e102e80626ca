"""Byte-level BPE encoding and decoding by DuckDB queries inside Spark tasks.

Spark deals the documents out; each task cuts its texts into words by the tokenizer's pattern and
runs DuckDB over bounded groups of them. A word's bytes are token-position rows. A recursive query
joins each row and its successor with the merge table and contracts, in every word at once, the
leftmost pair of the lowest rank, until no word has a pair left. Ordered aggregation puts the words'
ids together, and a second query decodes the ids of a text by an ordered aggregation of their bytes.
Texts are looked up and decoded in segments, which are joined again, so DuckDB's memory does not grow
with a text.

Words over ``LONG`` bytes contract, per step, all occurrences of their lowest pair from left to right,
where no pair that this creates has a lower rank still, which gives the same ids in fewer steps;
otherwise only the leftmost.

Rows: a null text counts as empty; an empty text has no ids and decodes to no bytes. Repeated rows
get equal results. The tokenizer file is a parameter; its rows (1 MB) are read by the driver and
broadcast. A worker process keeps the ids of
up to ``KEPT`` words and those of the ``KEPT`` before, of which it takes over what it meets again. The rows of a group, at least one whole text, its words and
its ids are held in memory by the task.
"""

from __future__ import annotations

import base64
from itertools import chain, repeat

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

KEPT, GROUP, LONG, SEGMENT = 300_000, 500_000, 256, 100_000

# one row per token at the place of its last byte but for the start, where tokens are bytes. Each row knows its
# successor; key, the rank of the two and both places in one number, is null where they are no token
CONTRACT = """
WITH RECURSIVE step(w, pos, id, next_pos, next_id, key, done) AS (
  SELECT w, pos, s.id, next_pos, next_id, (m.id << 18) | (pos << 9) | next_pos, false
  FROM start s LEFT JOIN merges m ON m.pair = (s.id << 20) | s.next_id
  UNION ALL
  (WITH lowest AS (SELECT w, min(key) AS best FROM step WHERE NOT done GROUP BY w),
   pairs AS (SELECT w, best, best >> 18 AS token, (best >> 9) & 511 AS lhs, best & 511 AS rhs FROM lowest),
   merged AS (SELECT s.w, pos, CASE WHEN pos = rhs THEN token ELSE id END AS id,
                CASE WHEN next_pos = lhs THEN rhs ELSE next_pos END AS next_pos,
                CASE WHEN next_pos = lhs THEN token ELSE next_id END AS next_id,
                key, pos = rhs OR next_pos = lhs AS changed, best IS NULL AS done
              FROM step s JOIN pairs p ON s.w = p.w WHERE NOT s.done AND (best IS NULL OR pos <> lhs))
   SELECT w, pos, t.id, next_pos, next_id, CASE WHEN changed THEN (m.id << 18) | (pos << 9) | next_pos ELSE key END, done
   FROM merged t LEFT JOIN merges m ON m.pair = CASE WHEN changed THEN (t.id << 20) | t.next_id END))
SELECT w, list(id::INT ORDER BY pos) AS ids FROM step WHERE done GROUP BY w ORDER BY w
"""

# the same fixpoint for long words: a step emits the changed rows only; id -1 marks a row that was merged away
CONTRACT_LONG = """
WITH RECURSIVE step(w, pos, id) USING KEY (w, pos) AS (
  SELECT w, pos, id FROM start
  UNION
  (WITH pairs AS (
     SELECT s.*, m.id AS rank
     FROM (SELECT *, row_number() OVER o AS n, lead(id) OVER o AS next, lead(pos) OVER o AS next_pos,
                  lead(id, 2) OVER o AS after, lag(id) OVER o AS prior
           FROM recurring.step WHERE id >= 0 WINDOW o AS (PARTITION BY w ORDER BY pos)) s
     JOIN merges m ON m.pair = s.id * 1048576 + s.next
     WHERE (SELECT count(*) FROM step) > 0),
   best AS (SELECT w, min(rank) AS best FROM pairs GROUP BY w),
   found AS (SELECT p.*, p.n - row_number() OVER (PARTITION BY p.w ORDER BY p.pos) AS run
             FROM pairs p JOIN best b ON p.w = b.w AND p.rank = b.best),
   apart AS (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS k, min(pos) OVER (PARTITION BY w) AS first
             FROM found),
   lower AS (SELECT DISTINCT t.w FROM apart t
             LEFT JOIN merges a ON a.pair = t.prior * 1048576 + t.rank
             LEFT JOIN merges b ON b.pair = t.rank * 1048576 + t.after
             LEFT JOIN merges c ON c.pair = t.rank * 1048576 + t.rank
             WHERE a.id < t.rank OR b.id < t.rank OR c.id < t.rank),
   merged AS (SELECT t.* FROM apart t LEFT JOIN lower l ON l.w = t.w WHERE k % 2 = 1 AND (l.w IS NULL OR pos = first))
   SELECT w, pos, rank FROM merged UNION ALL SELECT w, next_pos, -1 FROM merged))
SELECT w, list(id::INT ORDER BY pos) AS ids FROM step WHERE id >= 0 GROUP BY w ORDER BY w
"""

# a token's bytes are numbers of up to seven each, with their count on top, as ordered lists of numbers are cheap
DECODE = """
SELECT doc, list(bytes ORDER BY seq * {parts} + part) AS bytes FROM places JOIN tokens USING (id) GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """(token's bytes, rank) of a rank file, one base64 token and its rank to a line."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, f) if a]


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens (left id times 2^20 plus right id) whose joined bytes are a token, with that token's id."""
    rows = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks]
    cols = np.array(rows, np.int64).reshape(-1, 3).T
    return pa.table({"pair": cols[0] * 1048576 + cols[1], "id": cols[2]})


class Words:
    """Ids of numbered words: a dictionary of numbers, and the ids of all words in one growing array."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.ends, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0

    def add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.codes)
        self.codes.update(zip(words, range(n, n + len(words))))
        self.ends, self.flat = _room(self.ends, n + len(words) + 1), _room(self.flat, self.used + len(ids))
        self.ends[n + 1:n + len(words) + 1] = self.used + np.cumsum(sizes)
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the words has, and all their ids in order."""
        first = self.ends[codes]
        sizes = self.ends[codes + 1] - first
        return sizes, self.flat[np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class Codec:
    """DuckDB with one tokenizer's tables, one thread and bounded memory; spills nowhere."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str, memory: str = "400MB"):
        self.ranks, self.pattern = dict(ranks), regex.compile(pattern)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        merges = merge_table(self.ranks)  # noqa: F841
        self._load("merges", merges)
        rows = [(r, part, _packed(b[at:at + 7])) for b, r in ranks for part, at in enumerate(range(0, len(b), 7))]
        self._load("tokens", pa.table({"id": pa.array([r for r, _, _ in rows], pa.int32()), "part": pa.array([p for _, p, _ in rows], pa.int32()),
                                       "bytes": pa.array([x for _, _, x in rows], pa.int64())}))
        self.decode_sql = DECODE.format(parts=max((p for _, p, _ in rows), default=0) + 1)
        self.byte_ids = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.words, self.before = Words(), Words()

    def _load(self, name: str, table: pa.Table) -> None:
        self.con.register("incoming", table)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def _ask(self, sql: str, **tables: pa.Table) -> pa.Table:
        for name, table in tables.items():
            self.con.register(name, table)
        out = self.con.sql(sql).to_arrow_table()
        for name in tables:
            self.con.unregister(name)
        return out

    def _contract(self, sql: str, words: list[bytes]) -> pa.ChunkedArray:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        pos = np.arange(len(ids)) - np.repeat(ends - sizes, sizes)
        last = np.zeros(len(ids), bool)
        last[ends - 1] = True
        start = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos, "id": ids,
                          "next_pos": pa.array(pos + 1, mask=last), "next_id": pa.array(np.append(ids[1:], -1), mask=last)})
        return self._ask(sql, start=start).column("ids")

    def _learn(self, words: list[str]) -> None:
        """Adds words, all new and distinct, to those known."""
        whole, short, long = [], [], []
        for w in words:
            b = w.encode("utf-8")
            if b in self.ranks:  # a token as it stands
                whole.append((w, self.ranks[b]))
            else:
                (short if len(b) <= LONG else long).append((w, b))
        self.words.add([w for w, _ in whole], np.ones(len(whole), np.int64), np.array([r for _, r in whole], np.int32))
        short.sort(key=lambda x: len(x[1]))  # words of one length take about as many steps
        for sql, some in ((CONTRACT, short), (CONTRACT_LONG, long)):
            if some:
                ids = self._contract(sql, [b for _, b in some]).combine_chunks()
                self.words.add([w for w, _ in some], np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy())

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Ids of each whole text."""
        cut = [self.pattern.findall(t) for t in texts]
        words, counts = list(chain.from_iterable(cut)), np.fromiter(map(len, cut), np.int64, len(cut))
        del cut
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for lo in range(0, len(words), 4 * SEGMENT):
            codes = self._numbers(words[lo:lo + 4 * SEGMENT])  # may begin a new span of words
            n, found = self.words.ids(codes)
            sizes.append(n)
            ids.append(found)
        upto = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])[np.concatenate([[0], np.cumsum(counts)])]
        return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(np.concatenate(ids)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers among those known."""
        if len(self.words.codes) > KEPT:  # the words of the last span stay, those not seen since go
            self.words, self.before = Words(), self.words
        found = np.fromiter(map(self.words.codes.get, words, repeat(-1)), np.int32, len(words))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            missing = list(dict.fromkeys(words[i] for i in unknown))
            seen = self.before.codes
            old = [w for w in missing if w in seen]
            if old:
                self.words.add(old, *self.before.ids(np.array([seen[w] for w in old], np.int64)))
            new, held = [], 0
            for w in missing:
                if w not in seen:
                    new.append(w)
                    held += len(w)
                    if held >= GROUP:
                        self._learn(new)
                        new, held = [], 0
            self._learn(new)
            codes = self.words.codes
            found[unknown] = [codes[words[i]] for i in unknown]
        return found

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that the ids stand for."""
        sizes, flat = np.diff(ids.offsets.to_numpy()).astype(np.int64), ids.flatten()
        upto, at, parts, lengths = np.cumsum(sizes), 0, [b""], np.zeros(len(sizes) + 1, np.int64)
        while at < len(flat):  # about 4 * SEGMENT ids of any texts at a time
            end = min(len(flat), at + 4 * SEGMENT)
            docs = np.repeat(np.arange(len(sizes), dtype=np.int32), np.diff(np.clip(upto, at, end), prepend=at))
            out = self._ask(self.decode_sql, places=pa.table({"doc": docs, "seq": np.arange(end - at, dtype=np.int32), "id": flat.slice(at, end - at)}))
            for doc, lists in zip(_chunks(out.column("doc")), _chunks(out.column("bytes"))):
                data, sums = _unpacked(lists)
                parts.append(data)
                lengths[doc.to_numpy() + 1] += sums
            at = end
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.cumsum(lengths).astype(np.int32)), pa.py_buffer(b"".join(parts))])


def _packed(b: bytes) -> int:
    return len(b) << 56 | int.from_bytes(b, "little")


def _unpacked(lists: pa.ListArray) -> tuple[bytes, np.ndarray]:
    """The bytes of all lists of packed numbers in order, and how many each list has."""
    numbers = lists.flatten().to_numpy()
    rows = numbers.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8)
    counts = rows[:, 7]
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return rows.ravel()[(np.arange(8, dtype=np.uint8) < counts[:, None]).ravel()].tobytes(), np.diff(ends[at])


def _chunks(column) -> list:
    return column.chunks if isinstance(column, pa.ChunkedArray) else [column]


def _groups(sizes: list[int]):
    """(from, to) of runs of rows of about GROUP code points; a row is never cut."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= GROUP or i + 1 == len(sizes):
            yield at, i + 1
            at, held = i + 1, 0


_CODECS: dict = {}


def _codec(ranks: list[tuple[bytes, int]], pattern: str) -> Codec:
    """The worker process's codec of this tokenizer; its words stay known from task to task."""
    key = (pattern, len(ranks), hash(tuple(ranks)))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def _ids(part) -> pa.Array:
    return part.cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids``, the token ids of every row's whole text."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        codec = _codec(ranks.value, pattern)
        for b in batches:
            for lo, hi in _groups(pc.utf8_length(b.column(1)).to_pylist()):
                ids = codec.encode(b.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), ids], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) and ``decoded``, the bytes that the ids stand for."""
    ranks = tokens.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        codec = _codec(ranks.value, r"\S+")
        for b in batches:
            for lo, hi in _groups(pc.list_value_length(b.column(1)).to_pylist()):
                ids = _ids(b.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), ids, codec.decode(ids)], ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``ids``, ``decoded`` and the columns ``keep`` of every row: encoded, and the ids decoded, in one task."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    names = ["doc_id", "ids", "decoded", *keep]

    def run(batches):
        codec = _codec(ranks.value, pattern)
        for b in batches:
            for lo, hi in _groups(pc.utf8_length(b.column(1)).to_pylist()):
                doc_id, texts, *rest = (c.slice(lo, hi - lo) for c in b.columns)
                ids = codec.encode(texts.to_pylist())
                yield pa.RecordBatch.from_arrays([doc_id, ids, codec.decode(ids), *rest], names)

    rows = _texts(docs, keep)
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                                              T.StructField("decoded", T.BinaryType()), *(rows.schema[c] for c in keep)]))


def _texts(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keep)


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, the SHA-256 of the ids (decimal, joined by spaces) and of the decoded bytes, and the columns ``more``."""
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), *more)
