"""Token counts by rank-synchronous array merging.

A batch of distinct pre-tokens is one ragged array: a flat array of symbol ids
and the sequence number of each.  Every round finds each sequence's lowest
pair rank and contracts all its (left-to-right, non-overlapping) occurrences
in all sequences at once; a sequence without a mergeable pair leaves the
batch and its surviving symbols are counted.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import CHUNK_BYTES, chunks, prepare

#: Pre-token counts a worker keeps between batches; others are counted anew.
CACHE_ENTRIES = 600_000
NONE = np.iinfo(np.int32).max


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for a byte:
    itself for printable Latin-1, else the next free one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class MergeTable:
    """Sorted (left, right) keys of a tokenizer file, their ranks and results."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from tickforge.llm.pretokens import Splitter, classify_by_tokenizer
        import public_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        pre = spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel"
                or pre["add_prefix_space"] or not pre["use_regex"] or model["ignore_merges"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        ids = model["vocab"]
        self.width = max(ids.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.result = np.array([ids[a + b] for a, b in pairs], np.int32)
        symbols = byte_symbols()
        self.first = np.array([ids[symbols[b]] for b in range(256)], np.int32)
        self.specials = sorted((t["content"] for t in added), key=len, reverse=True)
        self.splitter = Splitter(public_tokenizers.PATTERN,
                                 classify_by_tokenizer(Tokenizer.from_file(path)))
        self.cache: dict[str, int] = {}

    def ranks(self, left, right):
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)


def merged_lengths(words: list[bytes], table: MergeTable) -> np.ndarray:
    """Symbols that survive in each of ``words``."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = sizes.copy()
    sym = table.first[np.frombuffer(b"".join(words), np.uint8)]
    seq = np.repeat(np.arange(len(words)), sizes)
    while len(sym):
        rank = np.append(np.where(seq[1:] == seq[:-1], table.ranks(sym[:-1], sym[1:]), NONE), NONE)
        starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        lengths = np.diff(np.append(starts, len(seq)))
        low = np.minimum.reduceat(rank, starts)
        counts[seq[starts]] = lengths
        lowest = np.repeat(low, lengths)
        hit = (rank == lowest) & (rank != NONE)
        # neighbours that hit too overlap (aaa): every second of a run counts
        at = np.arange(len(hit))
        begins = hit & ~np.append(False, hit[:-1])
        run = np.maximum.accumulate(np.where(begins, at, 0))
        hit &= (at - run) % 2 == 0
        sym[hit] = table.result[rank[hit]]
        keep = ~np.append(False, hit[:-1]) & (lowest != NONE)
        sym, seq = sym[keep], seq[keep]
    return counts


_TABLES: dict[str, MergeTable] = {}


def count_batches(batches, path: str, limit: int, chunk_bytes: int):
    """Arrow batches (…, text) -> (…, n_tokens, over_limit); runs in tasks."""
    import pyarrow as pa
    import regex
    table = _TABLES.get(path) or _TABLES.setdefault(path, MergeTable(path))
    special = regex.compile("|".join(map(regex.escape, table.specials))) if table.specials else None
    for batch in chunks(batches, "text", chunk_bytes):
        totals = np.zeros(batch.num_rows, np.int64)
        known = table.cache
        pending: list[tuple[int, list[str]]] = []

        def settle():
            nonlocal pending
            new = list(set().union(*(p for _, p in pending)).difference(known))
            fresh: dict[str, int] = {}
            if new:
                fresh = dict(zip(new, merged_lengths([w.encode() for w in new], table).tolist()))
                if len(known) + len(fresh) <= CACHE_ENTRIES:
                    known.update(fresh)
                    fresh = {}
            find = known.__getitem__ if not fresh else (lambda w: known[w] if w in known else fresh[w])
            for i, piece in pending:
                totals[i] += sum(map(find, piece))
            pending = []

        for i, text in enumerate(batch.column("text").to_pylist()):
            if not text:
                continue
            parts = special.split(text) if special else [text]
            totals[i] += len(parts) - 1
            for part in parts:
                for piece in table.splitter.split(part) if part else ():
                    pending.append((i, piece))
                    if len(piece) >= 100_000:
                        settle()
        settle()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in range(batch.num_columns - 1)),
             pa.array(totals), pa.array(totals > limit)],
            names=[*batch.schema.names[:-1], "n_tokens", "over_limit"])


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512,
                 id_column: str = "doc_id", text_column: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_tokens, over_limit.

    ``vocabulary`` is a byte-level BPE file of the ``tokenizers`` library,
    present on every executor.  Special strings inside texts count as one
    token, as that library does by default.  A null or empty text has 0 bytes
    and 0 tokens; null ids and repeated rows are kept; other columns of
    ``docs`` play no part; an empty table gives an empty result.  No shuffle:
    rows stay in their partition.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"),
                       F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_column).alias("text"))

    def run(batches):
        from tickforge.llm import token_counts as op
        yield from op.count_batches(batches, vocabulary, limit, chunk_bytes)

    out = rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("doc_id", id_column)
