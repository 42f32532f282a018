"""Byte-level BPE by recursive queries of DuckDB inside each partition.

A worker splits its texts by the vocabulary's pattern and gathers the distinct pieces that it has not
met. Their bytes become rows ``(word, place, token, next token, rank of the pair)``. A recursive query
contracts the leftmost pair of least rank of every word at once, row by row: the pair's first row takes
the merged token, its second row goes, the rows around it learn their new neighbour and join the merge
table for its rank. A word without a pair in the table is at its fixpoint. Ordered aggregation gives the
words' ids. Decoding takes the bytes of each id from the vocabulary, an Arrow array by id.

Memory is bounded: a query has ``WORDS`` words of at most ``STEPS`` steps, and goes on from its last
rows where words need more; a worker keeps the ids of ``KEPT`` pieces. A piece of over ``LONG`` bytes
goes alone through a query that contracts, in one step, every occurrence of its least pair from the
left, where no pair with the merged token has a lesser rank (else, the first only), which is the same
sequence of merges in fewer steps.

The result is that of the tiktoken library on the same ranks and pattern, without special tokens. Null
and empty texts have no ids. Repeated rows and null ids of rows are kept. An empty table gives no rows.
Only ``doc_id`` and ``text`` (``ids``) are read, so further columns make no difference.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import exact, steps, texts_of

WORDS = 20_000
STEPS = 32
LONG = 256
KEPT = 700_000
MEMORY_MB = 256
#: Rows that all steps of one query over a long word keep, and memory for each byte of a word that is longer.
ROWS = 500_000
BYTES_PER_ROW = 256

#: One contraction in every word; ``{step}`` is the recursion's body for rows ``t``. Last rows of each word come out.
_RECURSION = """
WITH RECURSIVE t(w, p, tok, nxt, rank, step) AS (
  SELECT s.w, s.p, s.tok, s.nxt, m.id, 0
  FROM s LEFT JOIN merges m ON m.pair = s.tok::BIGINT * 65536 + s.nxt
  UNION ALL
  {step}
)
SELECT t.w, t.p, t.tok, t.nxt, t.rank
FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) last ON t.w = last.w AND t.step = last.step
"""

_LEFTMOST = """
  SELECT u.w, u.p, u.tok, u.nxt, CASE WHEN u.same THEN u.rank ELSE m.id END, u.step
  FROM (
    SELECT t.w,
      CASE WHEN t.p > b.p THEN t.p - 1 ELSE t.p END AS p,
      CASE WHEN t.p = b.p THEN b.id ELSE t.tok END AS tok,
      CASE WHEN t.p = b.p THEN b.after WHEN t.p = b.p - 1 THEN b.id ELSE t.nxt END AS nxt,
      t.p <> b.p AND t.p <> b.p - 1 AS same, t.rank, t.step + 1 AS step
    FROM t JOIN (
      SELECT a.w, (a.least & 4294967295)::INTEGER AS p, (a.least >> 32)::INTEGER AS id, x.nxt AS after
      FROM (
        SELECT w, min((rank::BIGINT << 32) | p) AS least FROM t
        WHERE rank IS NOT NULL AND step < {steps} GROUP BY w
      ) a JOIN t x ON x.w = a.w AND x.p = (a.least & 4294967295) + 1
    ) b ON t.w = b.w
    WHERE t.p <> b.p + 1
  ) u LEFT JOIN merges m ON m.pair = CASE WHEN u.same THEN NULL ELSE u.tok::BIGINT * 65536 + u.nxt END
"""

_ALL = """
  SELECT v.w, v.p, v.tok, v.nxt, m.id, v.step
  FROM (
    SELECT w, (row_number() OVER o - 1)::INTEGER AS p, tok, coalesce(lead(tok) OVER o, -1) AS nxt, step + 1 AS step
    FROM (
      SELECT w, p, step, CASE WHEN hit THEN least ELSE tok END AS tok,
        coalesce(lag(hit) OVER (PARTITION BY w ORDER BY p), false) AS gone
      FROM (
        SELECT *, rank = least AND (run & 1) = 1 AND (every OR p = min(CASE WHEN rank = least THEN p END) OVER (PARTITION BY w)) AS hit
        FROM (
          SELECT *, row_number() OVER (PARTITION BY w, rank = least, p - nth ORDER BY p) AS run
          FROM (
            SELECT x.*, coalesce(e.every, true) AS every,
              row_number() OVER (PARTITION BY x.w, x.rank = x.least ORDER BY x.p) AS nth
            FROM (SELECT *, min(rank) OVER (PARTITION BY w) AS least FROM t WHERE step < {steps}) x
            LEFT JOIN single e ON e.id = x.least
            WHERE x.least IS NOT NULL
          )
        )
      )
    ) WHERE NOT gone
    WINDOW o AS (PARTITION BY w ORDER BY p)
  ) v LEFT JOIN merges m ON m.pair = v.tok::BIGINT * 65536 + v.nxt
"""

_IDS = "SELECT w, list(tok ORDER BY p) AS ids FROM finished GROUP BY w ORDER BY w"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one vocabulary, with a database of its own in memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ranks = regex.compile(pattern), ranks
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        pairs = [
            (ranks[t[:i]] << 16 | ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        pair, merged = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        # Tokens that a lesser rank can follow from: their occurrences are contracted one at a time.
        part = np.concatenate([pair >> 16, pair & 65535])
        single = np.unique(part[np.concatenate([merged, merged]) < part])
        by_id = {r: t for t, r in ranks.items()}
        self.vocabulary = pa.array([by_id.get(i, b"") for i in range(len(ranks))], pa.binary())
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{MEMORY_MB}MB", "temp_directory": ""})
        self.db.execute("SET preserve_insertion_order = false")
        for name, columns in {
            "merges": {"pair": pa.array(pair), "id": pa.array(merged.astype(np.int32))},
            "single": {"id": pa.array(single.astype(np.int32)), "every": pa.array(np.zeros(len(single), bool))},
        }.items():
            self.db.register("given", pa.table(columns))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _query(self, sql: str, **tables: pa.Table) -> pa.Table:
        for name, rows in tables.items():
            self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            for name in tables:
                self.db.unregister(name)

    def _merged(self, words: list[bytes], body: str, steps: int = STEPS) -> list[bytes]:
        """Ids of words, as little-endian unsigned 32-bit bytes; a query makes ``steps`` contractions, and keeps them all."""
        data = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(x) for x in words])
        end = np.cumsum(size)
        tok = self.byte[data]
        nxt = np.append(tok[1:], -1).astype(np.int32)
        nxt[end - 1] = -1
        rows = pa.table(
            {
                "w": np.repeat(np.arange(len(words), dtype=np.int32), size),
                "p": (np.arange(len(data)) - np.repeat(end - size, size)).astype(np.int32),
                "tok": tok,
                "nxt": nxt,
            }
        )
        out: list[bytes] = [b""] * len(words)
        while rows.num_rows:
            state = self._query(_RECURSION.format(step=body.format(steps=steps)), s=rows)
            # Words that have a pair left after all steps go on from here.
            going = pc.is_in(state["w"], pc.unique(state.filter(pc.is_valid(state["rank"]))["w"]))
            lists = self._query(_IDS, finished=state.filter(pc.invert(going)))
            ids = lists["ids"].combine_chunks()
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4")
            for w, a, b in zip(lists["w"].to_pylist(), offsets, offsets[1:]):
                out[w] = flat[a:b].tobytes()
            rows = state.filter(going).select(["w", "p", "tok", "nxt"])
        return out

    def _long(self, word: bytes) -> bytes:
        """Ids of a long word, by fewer steps at once the longer it is; beyond a million bytes it takes more memory."""
        wanted = max(MEMORY_MB, len(word) * BYTES_PER_ROW >> 20)
        self.db.execute(f"SET memory_limit = '{wanted}MB'")
        try:
            return self._merged([word], _ALL, max(1, min(STEPS, ROWS // len(word))))[0]
        finally:
            self.db.execute(f"SET memory_limit = '{MEMORY_MB}MB'")

    def _learn(self, pieces: list[str]) -> None:
        short, data = [], []
        for piece in pieces:
            x = piece.encode()
            if x in self.ranks:
                self.known[piece] = np.array([self.ranks[x]], "<u4").tobytes()
            elif len(x) > LONG:
                self.known[piece] = self._long(x)
            else:
                short.append(piece)
                data.append(x)
        for a in range(0, len(short), WORDS):
            self.known.update(zip(short[a : a + WORDS], self._merged(data[a : a + WORDS], _LEFTMOST)))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of texts, as little-endian unsigned 32-bit bytes."""
        if len(self.known) > KEPT:
            self.known = {}
        collecting = gc.isenabled()
        gc.disable()  # nothing here has cycles, and walking the lists of pieces costs time
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: Iterable[str]) -> list[bytes]:
        split = [self.pattern.findall(t) for t in texts]
        found, new = [], set()
        for pieces in split:
            ids = list(map(self.known.get, pieces))
            found.append(ids)
            new.update([p for p, x in zip(pieces, ids) if x is None])
        self._learn(sorted(new))
        return [
            b"".join([self.known[p] if x is None else x for p, x in zip(pieces, ids)]) for pieces, ids in zip(split, found)
        ]

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The bytes that ids stand for; an id outside the vocabulary raises."""
        size = np.array([len(x) // 4 for x in rows], np.int64)
        ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int32)
        if not len(ids):
            return [b""] * len(rows)
        if ids.min() < 0 or ids.max() >= len(self.ranks):
            raise ValueError("an id is not in the vocabulary")
        parts = self.vocabulary.take(pa.array(ids))
        # The bytes of all ids lie one after the other in one buffer.
        offsets = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(ids) + 1]
        data = memoryview(parts.buffers()[2] or b"")
        end = np.cumsum(size)
        return [bytes(data[a:b]) for a, b in zip(offsets[end - size].tolist(), offsets[end].tolist())]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit bytes) of every whole text."""
    return _mapped(docs, ranks, pattern, back=False)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encode`` and the bytes decoded from its ids, ``decoded``, in one worker."""
    return _mapped(docs, ranks, pattern, back=True)


def _mapped(docs: DataFrame, ranks: str, pattern: str, back: bool) -> DataFrame:
    names = ["doc_id", "n_tokens", "ids", *["decoded"] * back]

    def run(batches):
        own = codec(ranks, pattern)
        for batch in steps(batches, "text"):
            ids = own.encode(texts_of(batch.column("text")))
            columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if back:
                columns.append(pa.array(own.decode(ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = exact(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", decoded binary" * back)


def decode(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` for rows of ``encode``; null ids decode to nothing."""

    def run(batches):
        own = codec(ranks, pattern)
        for batch in steps(batches, "ids"):
            data = own.decode([x or b"" for x in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
