"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each task.

The distinct words (matches of the split pattern) of a task's documents are cut into bytes, a row
for each token position. A recursive query joins neighbours with the merge table and contracts each
word's leftmost pair of the lowest rank until no pair can be merged; ordered aggregation makes the
ids of each word. A word that is itself in the vocabulary is its id. What is remembered of words is
bounded. Decoding knows ids only: a row for each position joins the vocabulary, and ordered
aggregation puts each document's bytes together.

In very long words, all places of the lowest pair are contracted at once where no merge with the
new token can rank lower, which gives the same ids in fewer steps.

Null and empty texts have no ids. An empty table gives an empty result; repeated rows are encoded
alike; other columns are ignored. Null lists of ids and lists that hold a null or an id without a
token have no bytes and no text (null); an empty list has empty ones. Bytes that are no UTF-8, as where a
list ends inside a character, become replacement characters in the text and stay in the bytes.
"""

from __future__ import annotations

import base64
import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import chunks, texts, worker_state
from .tokens import Remembered, blank_pieces

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LONG_WORD = 96  # bytes; a place in a shorter word fits seven bits

#: One contraction in each word and step. A position is one number: word * 128 + place in the word;
#: of each position the last turn is kept.
LEFTMOST = """
WITH RECURSIVE step(k, id, turn) USING KEY (k) AS (
  SELECT word << 7 | place, id, 0 FROM start
  UNION ALL
  SELECT s.k - (s.k > spot)::BIGINT, CASE WHEN s.k = spot THEN made ELSE s.id END, s.turn + 1
  FROM step s JOIN (
    SELECT word, (word << 7) | (best & 127) AS spot, (best >> 7)::INT AS made FROM (
      SELECT a.k >> 7 AS word, min((m.rank << 7) | (a.k & 127)) AS best
      FROM step a JOIN step b ON b.k = a.k + 1 JOIN merges m ON m.pair = ((a.id::BIGINT << 16) | b.id)
      GROUP BY a.k >> 7
    )
  ) ON word = s.k >> 7
  WHERE s.k <> spot + 1
)
SELECT k >> 7 AS word, k, id, turn FROM step
"""

#: All places of the lowest pair at once if its token is safe, else the leftmost one.
ALL_PLACES = """
WITH RECURSIVE step(word, pos, id, turn) AS (
  SELECT word, place::INT, id, 0 FROM start
  UNION ALL
  SELECT word, row_number() OVER (PARTITION BY word ORDER BY pos)::INT, CASE WHEN pick THEN best ELSE id END::INT, turn
  FROM (
    SELECT *, lag(pick, 1, FALSE) OVER (PARTITION BY word ORDER BY pos) AS swallowed FROM (
      SELECT *, hit AND CASE WHEN safe THEN (row_number() OVER (PARTITION BY word, hit, streak ORDER BY pos)) % 2 = 1
        ELSE pos = min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word) END AS pick
      FROM (
        SELECT *, pos - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS streak FROM (
          SELECT *, coalesce(rank = best, FALSE) AS hit FROM (
            SELECT s.word, s.pos, s.id, s.turn + 1 AS turn, m.rank, m.safe, min(m.rank) OVER (PARTITION BY s.word) AS best
            FROM (SELECT *, lead(id) OVER (PARTITION BY word ORDER BY pos) AS following FROM step) s
            LEFT JOIN merges m ON m.pair = ((s.id::BIGINT << 16) | s.following)
          ) WHERE best IS NOT NULL
        )
      )
    )
  ) WHERE NOT swallowed
)
SELECT word, (word << 32) | pos AS k, id, turn FROM step
"""

#: The last turn of each word holds its tokens. One thread aggregates rows in the order of the sort,
#: which is cheaper than a sort in each group.
AGGREGATE = """
WITH ends AS (SELECT word, max(turn) AS turn FROM tokens GROUP BY word)
SELECT word, list(id) AS ids FROM (
  SELECT word, t.id FROM tokens t JOIN ends USING (word, turn) ORDER BY t.k
) GROUP BY word ORDER BY word
"""

#: The tokens of each document in order; `bad` tells of ids without a token.
DECODE = """
SELECT doc, list(token) AS tokens, bool_or(token IS NULL) AS bad FROM (
  SELECT p.doc, v.token FROM places p LEFT JOIN vocabulary v ON v.id = p.id ORDER BY p.pos
) GROUP BY doc ORDER BY doc
"""


class DuckBpe:
    """The vocabulary of a rank file as DuckDB tables, and what words have become."""

    def __init__(self, path: str, pattern: str, memory: str = "300MB", limit: int = 400_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.own = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.made = Remembered(self.words, limit)
        self._load()
        self.first = Remembered(lambda ps: self._pieces(ps), limit // 4)
        self.later = Remembered(lambda ps: self._pieces([" " + p for p in ps]), limit)

    def _load(self) -> None:
        merges, below = [], set()
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    merges.append((a, b, rank))
                    below.update(x for x in (a, b) if x > rank)  # a merge with x ranks lower than x
        a, b, rank = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        safe = pa.array([m[2] not in below for m in merges])
        pairs = pa.table({"pair": a << 16 | b, "rank": rank, "safe": safe})  # noqa: F841
        ids = pa.array(list(self.ranks.values()), pa.int32())
        entries = pa.table({"id": ids, "token": pa.array(list(self.ranks), pa.binary())})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM entries")

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        out = list(map(self.own.get, words))
        open_ = [i for i, x in enumerate(out) if x is None]
        for long in (False, True):
            some = [i for i in open_ if (len(words[i]) > LONG_WORD) == long]
            for part in range(0, len(some), 20_000):
                now = some[part : part + 20_000]
                for i, x in zip(now, self._merge([words[i] for i in now], long), strict=True):
                    out[i] = x
        return out

    def _merge(self, words: list[bytes], long: bool) -> list[bytes]:
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        start = pa.table({
            "word": np.repeat(np.arange(len(words), dtype=np.int64), sizes),
            "place": np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + 1,
            "id": self.byte_ids[np.frombuffer(b"".join(words), np.uint8)],
        })
        self.db.register("start", start)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE tokens AS {ALL_PLACES if long else LEFTMOST}")
        self.db.unregister("start")
        ids = self.db.sql(AGGREGATE).to_arrow_table().combine_chunks()["ids"].chunk(0)
        flat = ids.flatten().to_numpy().astype("<u4").tobytes()
        cuts = (4 * ids.offsets.to_numpy().astype(np.int64)).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that end where a match of the pattern ends."""
        return self.made.join([[w.encode("utf-8", "surrogatepass") for w in self.pattern.findall(p)] for p in pieces])

    def encode(self, docs: list[str]) -> list[bytes]:
        """Ids of each document."""
        split = [blank_pieces(t) for t in docs]
        heads = self.first.join([[t] if s is None else s[:1] for t, s in zip(docs, split, strict=True)])
        tails = self.later.join([[] if s is None else s[1:] for s in split])
        return [h + t for h, t in zip(heads, tails, strict=True)]

    def decode(self, docs: list[bytes]) -> list[bytes | None]:
        """The bytes of each document's ids, None for one that holds an id without a token."""
        out: list[bytes | None] = [b""] * len(docs)
        sizes = [len(x) // 4 for x in docs]
        if not sum(sizes):
            return out
        places = pa.table({
            "doc": np.repeat(np.arange(len(docs), dtype=np.int32), sizes),
            "pos": np.arange(sum(sizes), dtype=np.int64),
            "id": np.frombuffer(b"".join(docs), "<u4").astype(np.int64),
        })
        self.db.register("places", places)
        made = self.db.sql(DECODE).to_arrow_table().combine_chunks()
        self.db.unregister("places")
        tokens = made["tokens"].chunk(0)
        flat = tokens.values.cast(pa.large_binary())
        ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        data, cuts = memoryview(flat.buffers()[2] or b""), ends[tokens.offsets.to_numpy()].tolist()
        for doc, bad, a, b in zip(made["doc"].to_pylist(), made["bad"].to_pylist(), cuts, cuts[1:], strict=False):
            out[doc] = None if bad else bytes(data[a:b])
        return out


def _coder(path: str, pattern: str) -> DuckBpe:
    """The worker's coder of a file, loaded once."""
    loaded = worker_state()
    if ("duck", path, pattern) not in loaded:
        loaded["duck", path, pattern] = DuckBpe(path, pattern)
    return loaded["duck", path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids for every row of doc_id, text."""

    def run(batches):
        coder = _coder(path, pattern)
        for batch in chunks(batches):
            made = coder.encode(texts(batch))
            ends = np.cumsum([0, *(len(x) // 4 for x in made)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(made), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes, text for every row of doc_id, ids (``encode`` made them, or anything else)."""

    def run(batches):
        coder = _coder(path, pattern)
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            lists = batch.column("ids").to_pylist()
            sound = [x is not None and None not in x and min(x, default=0) >= 0 for x in lists]
            given = [np.array(x if ok else [], "<u4").tobytes() for x, ok in zip(lists, sound, strict=True)]
            made = [x if ok else None for x, ok in zip(coder.decode(given), sound, strict=True)]
            shown = [None if x is None else x.decode("utf-8", "replace") for x in made]
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array(made, pa.binary()), pa.array(shown, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "bytes", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary, text string")


def encode_and_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """RESULT for every row of doc_id, text; the decoded bytes are made from the ids."""

    def run(batches):
        coder = _coder(path, pattern)
        for batch in chunks(batches):
            ids = coder.encode(texts(batch))
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array([len(i) // 4 for i in ids]),
                      pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                      pa.array([hashlib.sha256(b).hexdigest() for b in coder.decode(ids)])]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in RESULT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
