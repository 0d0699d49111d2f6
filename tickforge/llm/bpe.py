"""Byte-level BPE encoding and decoding with DuckDB queries per partition.

A chunk's distinct pre-tokens become (word, position, pair) rows, a pair being
a token and its right neighbour.  A recursive query joins them with the merge
table and contracts each word's leftmost pair of minimum rank until no pair is
left; decoding joins ids with the vocabulary and concatenates in order of
position.
"""

from __future__ import annotations

import base64
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import chunks, prepare

#: Bytes of text handled at once.
CHUNK_BYTES = 2 << 20
#: Encoded pre-tokens a worker keeps between chunks; others are encoded anew.
CACHE_ENTRIES = 100_000
#: Bytes of words in one query.
SLICE_BYTES = 250_000

#: Right neighbour of a word's last token.
NO_TOKEN = 0xFFFFFFFF

#: One step: ``best`` has each word's lowest rank and, within it, the leftmost
#: position ``at``.  That row goes; the next one, whose right neighbour stays,
#: takes its place with the merged token, which the row before gets as its
#: neighbour; later positions move up.  A word without a mergeable pair is
#: given out as no longer live and takes no further step.
CONTRACT = """
WITH RECURSIVE step(live, word, pos, pair) AS (
    SELECT true, word, pos, pair FROM words
  UNION ALL
    SELECT best.at IS NOT NULL, s.word,
           CASE WHEN s.pos > best.at THEN s.pos - 1 ELSE s.pos END,
           CASE WHEN s.pos = best.at + 1 THEN (best.merged << 32) | (s.pair & 4294967295)
                WHEN s.pos = best.at - 1 THEN ((s.pair >> 32) << 32) | best.merged
                ELSE s.pair END
    FROM step s LEFT JOIN (
        SELECT word, (min(choice) & 4294967295)::INT AS at, min(choice) >> 32 AS merged
        FROM (SELECT l.word, (m.rank << 32) | l.pos AS choice
              FROM step l JOIN merges m ON m.pair = l.pair)
        GROUP BY word) best ON best.word = s.word
    WHERE s.live AND (best.at IS NULL OR s.pos <> best.at)
)
SELECT word, pos, (pair >> 32)::INT AS token FROM step WHERE NOT live ORDER BY word, pos
"""

#: Words of more bytes are contracted by CONTRACT_EQUAL.
LONG_WORD = 256
#: Rows a pass over long words keeps in its steps, about.
STEP_ROWS = 1_000_000

#: The same contraction for long words, several in a step.  Once the leftmost
#: pair of minimum rank is contracted, the next one of that rank (``k`` skips
#: overlapping ones) is the word's leftmost minimum, unless a new pair beside
#: the merged token has a lower rank: the step's contractions end there.
#: A pass ends after ``{steps}`` steps; ``live`` words go through another one.
CONTRACT_EQUAL = """
WITH RECURSIVE step(depth, word, pos, token) AS (
    SELECT 0, word, pos, token FROM words
  UNION ALL
    SELECT depth + 1, word, (row_number() OVER (PARTITION BY word ORDER BY pos) - 1)::INT, token
    FROM (
        SELECT s.depth, s.word, s.pos, coalesce(c.merged, s.token) AS token,
               lag(c.merged) OVER (PARTITION BY s.word ORDER BY s.pos) IS NULL AS stays,
               count(c.merged) OVER (PARTITION BY s.word) AS hits
        FROM step s LEFT JOIN (
            SELECT k.word, k.pos, k.merged
            FROM (SELECT word, pos, merged, after,
                         CASE WHEN lag(pos) OVER (PARTITION BY word ORDER BY pos) = pos - 2
                              THEN merged ELSE before END AS before
                  FROM (SELECT *, min(pos) OVER (PARTITION BY word, run) AS head
                        FROM (SELECT *, pos - row_number() OVER (PARTITION BY word ORDER BY pos) AS run
                              FROM (SELECT w.word, w.pos, w.before, w.after, m.rank::INT AS merged
                                    FROM (SELECT word, pos, token,
                                                 lag(token) OVER line AS before, lead(token) OVER line AS other,
                                                 lead(token, 2) OVER line AS after
                                          FROM step WINDOW line AS (PARTITION BY word ORDER BY pos)) w
                                    JOIN merges m ON m.pair = ((w.token::BIGINT << 32) | w.other)
                                    QUALIFY m.rank = min(m.rank) OVER (PARTITION BY w.word))))
                  WHERE (pos - head) % 2 = 0) k
            LEFT JOIN merges a ON a.pair = ((k.before::BIGINT << 32) | k.merged)
            LEFT JOIN merges b ON b.pair = ((k.merged::BIGINT << 32) | k.after)
            QUALIFY k.pos <= coalesce(min(CASE WHEN least(a.rank, b.rank) < k.merged THEN k.pos END)
                                      OVER (PARTITION BY k.word), k.pos)) c
        ON c.word = s.word AND c.pos = s.pos
        WHERE s.depth < {steps})
    WHERE stays AND hits > 0
)
SELECT s.word, s.pos, s.token, s.depth = {steps} AS live
FROM step s JOIN (SELECT word, max(depth) AS depth FROM step GROUP BY word) l USING (word, depth)
ORDER BY s.word, s.pos
"""

DECODE = """
SELECT pos, token FROM ids JOIN vocabulary USING (id) ORDER BY pos
"""


class Codec:
    """A DuckDB connection with the merge table and vocabulary of a rank file."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import pyarrow as pa

        from tickforge.llm.pretokens import Splitter, classify_by_tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pairs, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '250MB'")
        self.db.execute("SET temp_directory = ''")  # nothing is spilled; SLICE_BYTES bounds a query
        self.load("merges", {"pair": pa.array(pairs, pa.int64()), "rank": pa.array(merged, pa.int64())})
        self.load("vocabulary", {"id": pa.array(ranks.values(), pa.int32()),
                                 "token": pa.array(ranks, pa.binary())})
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.splitter = Splitter(pattern, classify_by_tiktoken(pattern))
        self.cache: dict[str, bytes] = {}
        #: Cached words that were asked for again after they were encoded.
        self.again: set[str] = set()

    def load(self, name: str, columns: dict) -> None:
        import pyarrow as pa
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def clear(self) -> None:
        """Drop the tables of the last chunk."""
        for name in ("words", "ids"):
            self.db.execute(f"DROP TABLE IF EXISTS {name}")

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        import pyarrow as pa
        raw = [w.encode() for w in words]
        if any(len(w) > LONG_WORD for w in raw):
            rest = iter(self.encode_words([w for w, r in zip(words, raw) if len(r) <= LONG_WORD]))
            return [self.encode_long(r) if len(r) > LONG_WORD else next(rest) for r in raw]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        if len(raw) > 1 and ends[-1] > SLICE_BYTES:
            cuts = np.unique(np.searchsorted(ends, np.arange(SLICE_BYTES, ends[-1], SLICE_BYTES)))
            return [x for part in np.split(np.arange(len(raw)), cuts) if len(part)
                    for x in self.encode_words(words[part[0]:part[-1] + 1])]
        word = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        pos = (np.arange(len(word)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        token = self.first[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
        after = np.roll(token, -1)
        after[ends - 1] = NO_TOKEN
        self.load("words", {"word": pa.array(word), "pos": pa.array(pos), "pair": pa.array(token << 32 | after)})
        out = self.db.sql(CONTRACT).to_arrow_table()
        ids = out.column("token").to_numpy().astype("<u4").tobytes()
        cut = np.searchsorted(out.column("word").to_numpy(), np.arange(len(raw) + 1)) * 4
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode_long(self, word: bytes) -> bytes:
        """Ids of one long word, in passes that each hold about STEP_ROWS rows."""
        import pyarrow as pa
        token, live = self.first[np.frombuffer(word, np.uint8)], True
        self.db.execute("SET memory_limit = '1GB'")  # a word is whole in one query
        while live:
            self.load("words", {"word": pa.array(np.zeros(len(token), np.int32)),
                                "pos": pa.array(np.arange(len(token), dtype=np.int32)),
                                "token": pa.array(token)})
            out = self.db.sql(CONTRACT_EQUAL.format(steps=max(1, STEP_ROWS // len(token)))).to_arrow_table()
            token = out.column("token").to_numpy().astype(np.int32)
            live = out.column("live")[0].as_py()
        self.clear()
        self.db.execute("SET memory_limit = '250MB'")
        return token.astype("<u4").tobytes()

    def shrink(self, words: set[str]) -> None:
        """Cut the cache to CACHE_ENTRIES: words that came again stay before
        others, of which those of ``words``, the last ones met, fill the rest."""
        if len(self.again) > CACHE_ENTRIES:
            self.again = set(islice(self.again & words, CACHE_ENTRIES))
        rest = islice(words.difference(self.again), CACHE_ENTRIES - len(self.again))
        self.cache = {w: self.cache[w] for part in (self.again, rest) for w in part}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        out: list[list[bytes]] = [[] for _ in texts]
        pending: list[tuple[int, list[str]]] = []

        def settle():
            nonlocal pending
            words = set().union(*(p for _, p in pending))
            new = list(words.difference(self.cache))
            self.again.update(words.difference(new))
            if new:
                self.cache.update(zip(new, self.encode_words(new)))
            find = self.cache.__getitem__
            for i, piece in pending:
                out[i].append(b"".join(map(find, piece)))
            pending = []
            if len(self.cache) > CACHE_ENTRIES:
                self.shrink(words)

        for i, text in enumerate(texts):
            for piece in self.splitter.split(text) if text else ():
                pending.append((i, piece))
                if len(piece) >= 100_000:
                    settle()
        settle()
        return [b"".join(pieces) for pieces in out]

    def decode(self, ids: list[np.ndarray], at_once: int = 250_000) -> list[bytes]:
        """Bytes of each id sequence; long ones go through in slices."""
        import pyarrow as pa
        import pyarrow.compute as pc
        out = [b""] * len(ids)
        slices, held = [], 0

        def settle():
            nonlocal slices, held
            if not held:
                return
            line = np.concatenate([part for _, part in slices]).astype(np.int32)
            self.load("ids", {"pos": pa.array(np.arange(len(line), dtype=np.int32)), "id": pa.array(line)})
            found = self.db.sql(DECODE).to_arrow_table()
            cuts = np.searchsorted(found.column("pos").to_numpy(),
                                   np.cumsum([0] + [len(part) for _, part in slices]))
            pieces = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found.column("token").combine_chunks())
            for (i, _), text in zip(slices, pc.binary_join(pieces, b"").to_pylist()):
                out[i] += text
            slices, held = [], 0

        for i, seq in enumerate(ids):
            for a in range(0, len(seq), at_once):
                part = seq[a:a + at_once]
                slices.append((i, part))
                held += len(part)
                if held >= at_once:
                    settle()
        settle()
        return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a rank file."""
    key = (path, pattern)
    return _CODECS.get(key) or _CODECS.setdefault(key, Codec(path, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id",
           text_column: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_tokens, ids binary): ids as little-endian unsigned 32-bit integers.

    ``ranks`` is a tiktoken rank file present on every executor.  Null and
    empty texts have no ids; null document ids and repeated rows are kept; an
    empty table gives an empty result.  No shuffle."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import bpe as op
        own = op.codec(ranks, pattern)
        for batch in op.chunks(batches, "text", chunk_bytes):
            ids = own.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")
    return out.withColumnRenamed("doc_id", id_column)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids_column: str = "ids",
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``encoded`` with a column ``decoded`` (binary): the bytes of its ids.
    Null ids decode to no bytes.  No shuffle."""
    from pyspark.sql.types import BinaryType, StructField, StructType
    prepare(encoded.sparkSession)
    names = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*names)
    schema = StructType([*rows.schema.fields, StructField("decoded", BinaryType())])

    def run(batches):
        import numpy
        import pyarrow as pa

        from tickforge.llm import bpe as op
        own = op.codec(ranks, pattern)
        for batch in op.chunks(batches, ids_column, chunk_bytes):
            ids = [numpy.frombuffer(x or b"", "<u4") for x in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.decode(ids), pa.binary())],
                names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: str, pattern: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, its
    ids decoded, in one pass over a chunk; cases as in ``encode``."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")

    def run(batches):
        import hashlib

        import numpy
        import pyarrow as pa

        from tickforge.llm import bpe as op
        from tickforge.llm.common import trim
        own = op.codec(ranks, pattern)
        for batch in op.chunks(batches, "text", chunk_bytes):
            ids = own.encode(batch.column("text").to_pylist())
            back = own.decode([numpy.frombuffer(x, "<u4") for x in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x).hexdigest() for x in back])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.clear()
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
