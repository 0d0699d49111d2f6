"""Benchmark decontamination with SimHash windows and a multi-index.

Windows of the size of a benchmark item are cut from the documents where
enough of its word shingles stand, each gets a SimHash fingerprint, an index
over blocks of its bits finds every item fingerprint within the radius, and
the weighted (counted) shingles of each candidate are compared exactly.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import hinted, prepare, saved

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits in which the fingerprints of a window and an item may differ.  At the
#: least similarity of 0.8 seven to nine are expected, and 25 was the most of
#: 480,000 simulated windows; 31 makes blocks of two bits.
RADIUS = 31
#: Benchmark rows up to which their shingles, blocks and keys are broadcast.
SMALL_ROWS = 1_000_000

#: Bits set in more than half of an array of hashes: every long of ``sums``
#: counts bit j in its lower and bit j + 32 in its upper half.
SIMHASH = """
aggregate(transform(
    aggregate({h}, array_repeat(0L, 32), (sums, x) ->
        transform(sums, (v, j) -> v + (shiftrightunsigned(x, j) & 4294967297L))),
    (v, j) -> if(2 * (v & 4294967295L) > size({h}), shiftleft(1L, j), 0L)
            | if(2 * shiftrightunsigned(v, 32) > size({h}), shiftleft(1L, j + 32), 0L)),
    0L, (a, b) -> a | b)
"""

#: Shingles two arrays share, with their counts.
OVERLAP = """
if(size(array_distinct({a})) = size({a}) OR size(array_distinct({b})) = size({b}),
   size(array_intersect({a}, {b})),
   aggregate(array_intersect({a}, {b}), 0, (n, x) ->
       n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x)))))
"""


def words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def shingles(found, size: int):
    """Hashes of the runs of ``size`` words, in order; none for fewer words."""
    n = F.size(found)
    return F.when(n >= size, F.transform(
        F.sequence(F.lit(0), n - size),
        lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(size))))).otherwise(
        F.array().cast("array<long>"))


def bit_blocks(fingerprint, radius: int):
    """(block, bits) of ``radius + 1`` blocks: fingerprints within the radius
    agree in one at least."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*(F.struct(
        F.lit(k).alias("block"),
        F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))))


def needed(a, b, least: float):
    """Shared shingles without which sizes a and b can't reach the similarity."""
    return F.ceil(F.lit(least) / (1 + least) * (a + b) - F.lit(1e-9)).cast("int")


def matches_of(keyed: DataFrame, items: DataFrame, size: int, least: float, radius: int) -> DataFrame:
    """(key, item_id, window_start, window_words, similarity) for items of
    shingles of ``size`` words."""
    spark = keyed.sparkSession
    index = items.select("item_id", F.size("hashes").alias("m"), F.explode(F.array_distinct("hashes")).alias("h"))
    spots = (keyed.select("key", shingles(F.col("words"), size).alias("hashes"))
             # outer: the optimizer would else compute the shingles twice, to drop empty arrays first
             .select("key", F.size("hashes").alias("n"), F.posexplode_outer("hashes").alias("pos", "h"))
             .join(hinted(index, SMALL_ROWS), "h")
             # positions of one text, once however many rows have it
             .groupBy("key", "item_id").agg(F.sort_array(F.collect_set("pos")).alias("at"),
                                            F.first("n").alias("n"), F.first("m").alias("m")))
    width, need = F.least("n", "m"), needed(F.col("m"), F.least("n", "m"), least)
    starts = (spots.withColumn("width", width).withColumn("need", need)
              .where("width >= need AND size(at) >= need")
              .withColumn("start", F.explode(F.array_distinct(F.expr(
                  "flatten(transform(at, p -> sequence(greatest(0, least(p, n - width) - (width - need)), least(p, n - width))))"))))
              .where("size(filter(at, p -> p >= start AND p < start + width)) >= need"))
    windows = saved(starts.select("key", "m", "width", "start").distinct(), "leak-windows")
    keys = windows.select("key").distinct()
    texts = saved(keyed.join(hinted(keys, SMALL_ROWS), "key", "left_semi").dropDuplicates(["key"])
                  .select("key", shingles(F.col("words"), size).alias("hashes")), "leak-texts")
    cut = saved(windows.join(texts, "key").select(
        "key", "m", "start", "width", F.slice("hashes", F.col("start") + 1, F.col("width")).alias("window"))
        .withColumn("print", F.expr(SIMHASH.format(h="window"))), "leak-prints")
    known = saved(items.select("item_id", F.size("hashes").alias("m"), "hashes",
                               F.expr(SIMHASH.format(h="hashes")).alias("item_print")), "leak-items")
    blocks = known.select("item_id", "m", "item_print", F.explode(bit_blocks(F.col("item_print"), radius)).alias("b"))
    near = (cut.select("key", "m", "start", "print", F.explode(bit_blocks(F.col("print"), radius)).alias("b"))
            .join(hinted(blocks, SMALL_ROWS), ["m", "b"])
            .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
            .select("key", "m", "start", "item_id").distinct())
    both = (near.join(cut, ["key", "m", "start"])
            .join(hinted(known.select("item_id", "hashes"), SMALL_ROWS), "item_id")
            .withColumn("shared", F.expr(OVERLAP.format(a="window", b="hashes"))))
    alike = both.withColumn("similarity", F.col("shared") / (F.col("width") + F.col("m") - F.col("shared")))
    best = (alike.where(F.col("similarity") >= least).groupBy("key", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "width")).alias("best")))
    return best.select("key", "item_id", (-F.col("best.back")).cast("long").alias("window_start"),
                       (F.col("best.width") + (size - 1)).cast("long").alias("window_words"),
                       F.col("best.similarity").alias("similarity"))


def text_matches(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, least: float = 0.8,
                 radius: int = RADIUS, text_column: str = "text") -> DataFrame:
    """(key, item_id, window_start, window_words, similarity) by ``text_key``."""
    prepare(docs.sparkSession)
    found = benchmark.select("item_id", words(F.coalesce(F.col("text"), F.lit(""))).alias("words")) \
        .withColumn("size", F.least(F.size("words"), F.lit(shingle_words))).where("size > 0")
    found = saved(found.distinct(), "leak-benchmark")
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # at most shingle_words
    keyed = docs.where(F.col(text_column).isNotNull()).select(
        text_key(F.col(text_column)).alias("key"), words(F.col(text_column)).alias("words"))
    out = docs.sparkSession.createDataFrame([], T.StructType([
        T.StructField("key", T.StringType()), found.schema["item_id"],
        T.StructField("window_start", T.LongType()), T.StructField("window_words", T.LongType()),
        T.StructField("similarity", T.DoubleType())]))
    for size in sizes:
        items = found.where(F.col("size") == size).select(
            "item_id", shingles(F.col("words"), size).alias("hashes"))
        out = out.union(matches_of(keyed, items, size, least, radius))
    return out


def text_key(text):
    """Stands for a text; equal texts share matches."""
    return F.md5(text.cast("binary"))


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, least: float = 0.8,
                 radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, item_id, window_start, window_words, similarity): for each row and
    each benchmark item the window most like it (the first of equal ones), if
    their counted word shingles are alike by ``least`` or more.

    Words are runs of ASCII letters and digits and of other characters beyond
    ASCII, in lower case.  An item of fewer words than a shingle is one
    shingle; a text of fewer shingles than an item is one window; items
    without words and null or empty texts match nothing.  Null ids and
    repeated rows are kept; an empty table on either side gives an empty
    result; other columns play no part."""
    found = text_matches(docs, benchmark, shingle_words, least, radius, text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_key(F.col(text_column)).alias("key"))
    return rows.join(found, "key").select(F.col("doc_id").alias(id_column), "item_id", "window_start",
                                          "window_words", "similarity")


def clean(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, least: float = 0.8,
          radius: int = RADIUS, text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns as they are, that hold no benchmark item;
    null and empty texts stay."""
    found = saved(text_matches(docs, benchmark, shingle_words, least, radius, text_column)
                  .select(F.col("key").alias("leak_key")).distinct(), "leak-keys")
    leaks = hinted(found, SMALL_ROWS)
    return docs.join(leaks, text_key(F.col(text_column)) == leaks["leak_key"], "left_anti")


def oracle(shingle_words: int = 5, least: float = 0.8) -> str:
    """DuckDB SQL for ``contaminated``: all windows with a shared shingle."""
    shingle = (f"CASE WHEN len(w) >= k THEN list_transform(range(1, len(w) - k + 2), "
               f"lambda i: array_to_string(w[i:i + k - 1], ' ')) ELSE []::VARCHAR[] END")
    return rf"""
        WITH iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM benchmark),
        i AS (SELECT item_id, least(len(w), {shingle_words}) AS k, w FROM iw WHERE len(w) > 0),
        ih AS (SELECT item_id, k, {shingle} AS hs FROM i),
        ic AS (SELECT item_id, k, len(hs) AS m, h, count(*) AS c
               FROM (SELECT item_id, k, hs, unnest(hs) AS h FROM ih) GROUP BY ALL),
        dw AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents WHERE text IS NOT NULL),
        dk AS (SELECT doc_id, k, w FROM dw, (SELECT DISTINCT k FROM i)),
        dh AS (SELECT doc_id, k, {shingle} AS hs FROM dk),
        dp AS (SELECT doc_id, k, len(hs) AS n, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS pos FROM dh),
        hit AS (SELECT doc_id, item_id, k, h, pos, n, m, c, least(n, m) AS width FROM dp JOIN ic USING (k, h)),
        s AS (SELECT DISTINCT doc_id, item_id, unnest(range(greatest(0, pos - width + 1),
                     least(pos, n - width) + 1)) AS start FROM hit),
        o AS (SELECT doc_id, item_id, start, h, least(count(*), any_value(c)) AS shared,
                     any_value(m) AS m, any_value(width) AS width, any_value(k) AS k
              FROM s JOIN hit USING (doc_id, item_id) WHERE pos >= start AND pos < start + width
              GROUP BY doc_id, item_id, start, h),
        v AS (SELECT doc_id, item_id, start, any_value(width) AS width, any_value(k) AS k,
                     sum(shared)::DOUBLE / (any_value(width) + any_value(m) - sum(shared)) AS similarity
              FROM o GROUP BY doc_id, item_id, start),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS rank
              FROM v WHERE similarity >= {least})
        SELECT doc_id, item_id, start::BIGINT AS window_start, (width + k - 1)::BIGINT AS window_words, similarity
        FROM r WHERE rank = 1"""
