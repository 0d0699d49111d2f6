"""Removing repeated byte strings with a partitioned, sparse suffix array.

Every start position of a 400-byte string belongs to the anchor that the
smallest hash in its first bytes picks, so two equal strings have the same
anchor at the same offset.  The suffixes at anchors are keyed by leading
tokens, hashes of the bytes that all strings of the anchor's block share
(core) and of all bytes the block covers (whole).  Sampled splitters
range-partition the suffixes, each bucket sorts by multikey quicksort, and
neighbours are compared, also across the edges of buckets: a whole that occurs
again settles its block as repeated, a core that doesn't as not repeated.
Blocks in between are cut into smaller ones down to single strings.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickforge.llm.common import CHUNK_BYTES, dropped, hinted, prepare, saved

#: Bytes hashed for the choice of anchors, and the share of a string's start
#: positions that one anchor may serve.
GRAM = 8
#: Sizes into which unsettled blocks are cut, one after the other.
CUTS = (8, 1)
#: Keys of texts that take part are broadcast up to so many (16 bytes each).
SMALL_ROWS = 500_000
#: Contexts cut at once in a task.
CONTEXT_ROWS = 1000
#: Suffixes in a bucket, about.
BUCKET_ROWS = 400_000
SMALL_SORT = 2048


def reach(length: int) -> int:
    """Start positions an anchor may serve: its block's strings still share
    ``length - reach + 1`` bytes."""
    return max(1, min(256, length * 16 // 25))


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of rows of ``keys`` (tokens in columns): ternary partitions at one
    token after the other; short pieces are finished directly."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == keys.shape[1]:
            continue
        rows = order[low:high]
        if high - low <= SMALL_SORT:
            order[low:high] = rows[np.lexsort(keys[rows, depth:].T[::-1])]
            continue
        token = keys[rows, depth]
        pivot = np.sort(token[:: max(1, len(token) // 31)])[16 * len(token[:: max(1, len(token) // 31)]) // 33]
        less, more = token < pivot, token > pivot
        a, b = int(less.sum()), int(more.sum())
        order[low:high] = np.concatenate([rows[less], rows[~less & ~more], rows[more]])
        todo += [(low, low + a, depth), (low + a, high - b, depth + 1), (high - b, high, depth)]
    return order


def anchored_blocks(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int):
    """(anchor, low, high): blocks of start positions [low, high] of strings
    of ``length`` bytes within the texts [starts, ends) laid end to end."""
    width = reach(length)
    n = len(data)
    padded = np.concatenate([data, np.zeros(GRAM + width, np.uint8)])
    grams = np.ndarray((n + width,), "<u8", padded.tobytes(), strides=(1,))
    value = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) << np.uint64(32)
    value |= np.arange(n + width, dtype=np.uint64)
    step, have = 1, 1
    while have < width:
        step = min(have, width - have)
        value = np.minimum(value[:-step], value[step:])
        have += step
    size = ends - starts
    valid = np.zeros(n + 1, np.int8)
    long = size >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[:n]))
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    anchor = (value[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)))
    last = np.append(first[1:], len(at)) - 1
    return anchor[first], at[first], at[last]


def block_tokens(buffer, core_from: list, core_to: list, low: list, high: list):
    """Two signed 64-bit tokens of each block: of buffer[core_from:core_to],
    and of buffer[low:high] with the core's place in it."""
    from xxhash import xxh3_64_intdigest as digest
    view = memoryview(buffer)
    core = np.fromiter((digest(view[a:b]) for a, b in zip(core_from, core_to)), np.uint64, len(low))
    whole = np.fromiter((digest(view[a:b], c - a + 1) for a, b, c in zip(low, high, core_from)), np.uint64, len(low))
    return core.view(np.int64), whole.view(np.int64)


def suffix_batches(batches, length: int):
    """Texts -> (core, whole, key, low, high, anchor, done)."""
    import pyarrow as pa

    from tickforge.llm.common import chunks
    share = length - reach(length) + 1
    for batch in chunks(batches, "text", CHUNK_BYTES):
        raw = [t.encode() for t in batch.column("text").to_pylist()]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        joined = b"".join(raw)
        anchor, low, high = anchored_blocks(np.frombuffer(joined, np.uint8), ends, ends - sizes, length)
        text = np.searchsorted(ends, low, side="right")
        core, whole = block_tokens(joined, anchor.tolist(), (anchor + share).tolist(),
                                   low.tolist(), (high + length).tolist())
        base = (ends - sizes)[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(core), pa.array(whole), batch.column("key").take(pa.array(text)),
             pa.array(low - base), pa.array(high - base), pa.array(anchor - base),
             pa.array(np.zeros(len(low), bool))],
            names=["core", "whole", "key", "low", "high", "anchor", "done"])


def cut_batches(batches, length: int, size: int):
    """Contexts with the parts to cut -> tokens of their parts of ``size``
    start positions, counted from the anchor."""
    import pyarrow as pa
    for batch in (b.slice(k, CONTEXT_ROWS) for b in batches for k in range(0, b.num_rows, CONTEXT_ROWS)):
        out = {n: [] for n in ("core", "whole", "id", "low", "high", "done")}
        for own, anchor, context, parts in zip(*(batch.column(i).to_pylist() for i in range(4))):
            cores, ends, lows, highs, done = [], [], [], [], []
            for part in parts:
                top = anchor - (anchor - part["high"]) // size * size
                while top - size + 1 <= part["high"] or top >= part["low"]:
                    low, high = max(part["low"], top - size + 1), min(part["high"], top)
                    if low <= high:
                        cores.append(top)
                        ends.append(top - size + 1 + length)
                        lows.append(low)
                        highs.append(high)
                        done.append(part["done"])
                    if top < part["low"]:
                        break
                    top -= size
            core, whole = block_tokens(context, cores, ends, lows, [h + length for h in highs])
            for name, values in (("core", core), ("whole", whole), ("id", [own] * len(lows)),
                                 ("low", lows), ("high", highs), ("done", done)):
                out[name].extend(values)
        yield pa.RecordBatch.from_pydict(out, pa.schema(
            [("core", pa.int64()), ("whole", pa.int64()), ("id", pa.int64()),
             ("low", pa.int64()), ("high", pa.int64()), ("done", pa.bool_())]))


def bucket_flags(core, whole, done):
    """Order of a bucket, and for the sorted rows: core again, whole again,
    kept for the next cut, at an edge of the bucket."""
    order = multikey_quicksort(np.stack([core, whole], axis=1))
    c, w, d = core[order], whole[order], done[order]
    n = len(c)
    new_core = np.append(True, c[1:] != c[:-1])
    new_whole = new_core | np.append(True, w[1:] != w[:-1])
    run, kind = np.cumsum(new_core) - 1, np.cumsum(new_whole) - 1
    core_again = np.bincount(run)[run] > 1
    whole_again = np.bincount(kind)[kind] > 1
    open_run = np.bincount(run, weights=~(d | whole_again))[run] > 0
    open_run |= (run == 0) | (run == run[-1])  # it may go on in the next bucket
    kept = core_again & (~whole_again | new_whole) & open_run
    edge = np.zeros(n, bool)
    edge[[0, -1]] = True
    return order, core_again, whole_again, kept, edge


def classify(rows: DataFrame, n_rows: int, name: str) -> DataFrame:
    """``rows`` (core, whole, done, salt, …) with ``repeated`` (its whole is
    somewhere else too) and ``kept`` (must be cut further, or is a partner for
    one that must); other rows are left out."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in ("salt",)]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // BUCKET_ROWS + 1)
    # splitters are sampled from the stored rows; the salt splits equal suffixes
    ranged = rows.repartitionByRange(buckets, "core", "whole", "salt").select(*columns)

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import suffix_dedup as op
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        order, core_again, whole_again, kept, edge = op.bucket_flags(
            *(table.column(n).to_numpy() for n in ("core", "whole")),
            table.column("done").to_numpy(zero_copy_only=False))
        table = table.take(pa.array(order))
        for n, flags in (("core_again", core_again), ("repeated", whole_again), ("kept", kept), ("edge", edge)):
            table = table.append_column(n, pa.array(flags))
        for batch in table.filter(pa.array(whole_again | kept | edge)).combine_chunks().to_batches(10_000):
            yield batch

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    flagged = saved(ranged.mapInArrow(run, schema + ", core_again boolean, repeated boolean, kept boolean, edge boolean"),
                    f"suffix-{name}-flags")
    # two rows of each bucket: the first and last suffix against their neighbours
    along = Window.orderBy("core", "whole")
    edges = flagged.where("edge")
    for side in (F.lag, F.lead):
        n = side.__name__
        edges = edges.withColumn(f"{n}_core", side("core").over(along)).withColumn(f"{n}_whole", side("whole").over(along))
    next_core = F.coalesce((F.col("lag_core") == F.col("core")) | F.lit(False), F.lit(False)) | F.coalesce(
        F.col("lead_core") == F.col("core"), F.lit(False))
    next_whole = F.coalesce((F.col("lag_core") == F.col("core")) & (F.col("lag_whole") == F.col("whole")), F.lit(False)) | \
        F.coalesce((F.col("lead_core") == F.col("core")) & (F.col("lead_whole") == F.col("whole")), F.lit(False))
    edges = (edges.withColumn("repeated", F.col("repeated") | next_whole)
             .withColumn("kept", F.col("kept") | F.col("core_again") | next_core)
             .select(*flagged.columns))
    return (flagged.where("NOT edge").union(edges).where("repeated OR kept")
            .drop("core", "whole", "core_again", "edge"))


def text_key(text):
    """Sixteen bytes that stand for a text; equal texts share spans."""
    return F.unhex(F.md5(text.cast("binary")))


def cut_text(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``raw``, bytes removed, and maximal removed runs."""
    kept, at, removed, runs = [], 0, 0, 0
    end = -1
    for low, high in sorted(spans):
        if low > end:
            runs += 1
        if high > end:
            removed += high - max(low, end if end > 0 else 0)
            kept.append(raw[at:max(at, low)])
            at = end = high
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def removals(docs: DataFrame, length: int = 400, text_column: str = "text") -> DataFrame:
    """(key, kept binary, n_removed, n_spans) for the distinct texts that lose
    bytes: each byte covered by a string of ``length`` bytes that also starts
    somewhere else in the table."""
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    keyed = texts.where(F.octet_length("text") >= length).select(text_key(F.col("text")).alias("key"), "text")

    def run(batches):
        from tickforge.llm import suffix_dedup as op
        yield from op.suffix_batches(batches, length)

    rows = saved(keyed.mapInArrow(
        run, "core long, whole long, key binary, low long, high long, anchor long, done boolean").select(
        "core", "whole", "key", F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high"),
        F.col("anchor").cast("int").alias("anchor"), "done", F.rand(5).cast("float").alias("salt")), "suffix-rows")
    flagged = saved(classify(rows, rows.count(), "0").distinct(), "suffix-0")
    dropped(rows)
    spans = [flagged.where("repeated").select("key", "low", "high")]

    # the texts that take part, once each
    involved = saved(flagged.select("key").distinct(), "suffix-keys")
    taken = saved(keyed.join(hinted(involved, SMALL_ROWS), "key", "left_semi").dropDuplicates(["key"]), "suffix-texts")
    blocks = flagged.where("kept").groupBy("key").agg(F.collect_list(F.struct(
        "low", "high", "anchor", (F.col("done") | F.col("repeated")).alias("done"))).alias("blocks"))
    blocks = saved(blocks, "suffix-blocks")

    def contexts(batches):
        import pyarrow as pa

        from tickforge.llm.common import chunks
        for batch in chunks(batches, "text", CHUNK_BYTES):
            for key, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = text.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.binary()), pa.array([b["low"] for b in found], pa.int64()),
                     pa.array([b["anchor"] - b["low"] for b in found], pa.int64()),
                     pa.array([b["high"] - b["low"] for b in found], pa.int64()),
                     pa.array([b["done"] for b in found]),
                     pa.array([raw[b["low"]:b["high"] + length] for b in found], pa.binary())],
                    names=["key", "base", "anchor", "top", "done", "context"])

    held = saved(taken.join(blocks, "key").select("key", "text", "blocks").mapInArrow(
        contexts, "key binary, base long, anchor long, top long, done boolean, context binary").withColumn(
        "id", F.monotonically_increasing_id()), "suffix-contexts")
    parts = held.select("id", F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("top").alias("high"),
                                               "done")).alias("parts"), "anchor", "context")
    for size in CUTS:
        def cut(batches, size=size):
            from tickforge.llm import suffix_dedup as op
            yield from op.cut_batches(batches, length, size)

        rows = saved(parts.select("id", "anchor", "context", "parts").mapInArrow(
            cut, "core long, whole long, id long, low long, high long, done boolean").withColumn(
            "salt", F.rand(size).cast("float")), f"suffix-rows-{size}")
        flagged = saved(classify(rows, rows.count(), str(size)), f"suffix-{size}")
        dropped(rows)
        found = flagged.where("repeated AND NOT done").select("id", "low", "high")
        spans.append(found.join(held.select("id", "key", "base"), "id").select(
            "key", (F.col("base") + F.col("low")).cast("int").alias("low"),
            (F.col("base") + F.col("high")).cast("int").alias("high")))
        again = flagged.where("kept").groupBy("id").agg(F.collect_list(F.struct(
            "low", "high", (F.col("done") | F.col("repeated")).alias("done"))).alias("parts"))
        if size != CUTS[-1]:
            again = saved(again, f"suffix-parts-{size}")
            parts = held.select("id", "anchor", "context").join(again, "id")
    every = spans[0]
    for more in spans[1:]:
        every = every.union(more)
    merged = saved(every.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "suffix-spans")

    def remove(batches):
        import pyarrow as pa

        from tickforge.llm import suffix_dedup as op
        from tickforge.llm.common import chunks
        for batch in chunks(batches, "text", CHUNK_BYTES):
            out = [op.cut_text(t.encode(), [(s["low"], s["high"] + length) for s in spans])
                   for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k for k, _, _ in out], pa.binary()),
                 pa.array([n for _, n, _ in out], pa.int64()), pa.array([r for _, _, r in out], pa.int64())],
                names=["key", "kept", "n_removed", "n_spans"])

    return saved(taken.join(merged, "key").select("key", "text", "spans").mapInArrow(
        remove, "key binary, kept binary, n_removed long, n_spans long"), "suffix-removed")


def with_texts(found: DataFrame) -> DataFrame:
    """``removals`` with kept_text, what is left as text; a character that a
    cut splits is left out of it."""
    def run(batches):
        import pyarrow as pa

        from tickforge.llm import suffix_dedup as op
        from tickforge.llm.common import chunks
        for batch in chunks(batches, "kept", op.CHUNK_BYTES):
            texts = [k.decode("utf-8", "ignore") for k in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "kept_text"])

    return found.mapInArrow(run, "key binary, kept binary, n_removed long, n_spans long, kept_text string")


def repeated_bytes(docs: DataFrame, length: int = 400, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """Per row: the id, n_bytes, n_removed, n_spans, kept_sha256, text (what is
    left of it; a character that a cut splits is in the digest, not in text).

    A null or empty text has no bytes, loses none and is left as an empty text;
    every copy of a repeated string goes, in repeated rows too; null ids are
    kept; very long texts are cut whole; other columns play no part; an empty
    table gives an empty result.  Equality is that of two 64-bit hashes of the
    bytes."""
    found = with_texts(removals(docs, length, text_column))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    zero = F.lit(0).cast("long")
    # texts too short to hold a string meet no key: they pass by the join
    short = rows.where(F.col("n_bytes") < length).select(
        F.col("doc_id").alias(id_column), "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), "text")
    gone = found.select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256"), "kept_text")
    long = rows.where(F.col("n_bytes") >= length).withColumn("key", text_key(F.col("text"))).join(gone, "key", "left")
    return long.select(
        F.col("doc_id").alias(id_column), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("cut_sha256", F.sha2(F.col("text").cast("binary"), 256)).alias("kept_sha256"),
        F.coalesce("kept_text", "text").alias("text")).union(short)


def without_repeats(docs: DataFrame, length: int = 400, text_column: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text_column``; a character
    that a cut splits goes too.  Rows, order of columns and other columns stay,
    also where nothing of a text is left; a null text stays null; texts shorter
    than ``length`` bytes pass as they are."""
    texts = with_texts(removals(docs, length, text_column)).select("key", "kept_text").alias("cut")
    size = F.coalesce(F.octet_length(text_column), F.lit(0))
    long = docs.where(size >= length).alias("d")
    joined = long.join(texts, text_key(F.col(f"d.{text_column}")) == F.col("cut.key"), "left")
    return joined.select(*(
        F.coalesce("cut.kept_text", f"d.{c}").alias(c) if c == text_column else F.col(f"d.{c}")
        for c in docs.columns)).union(docs.where(size < length))
