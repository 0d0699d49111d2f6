"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are cut into tiles of equal population counts (of the
upper and the lower half).  Hamming distance is at least the sum of the two
differences, so only tile pairs within the radius are compared, each with
numpy exclusive-or and bit counts; every pair of fingerprints within the
radius is found.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import CHUNK_BYTES, hinted, prepare, saved

#: Fingerprints in a tile, about.
TILE_ROWS = 2048
#: Fingerprints of the most rows get their component by a broadcast of at most so many.
HOT_PRINTS = 1000
#: Shingle hashes turned into bits at once.
BITS_AT_ONCE = 1 << 18


def fingerprint_batch(texts: list, size: int, seed: int) -> np.ndarray:
    """Fingerprints (uint64) of texts: a bit is set if it is set in over half
    of the XXH64 hashes of the word shingles, repeats included."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        last = ends[size - 1:] if len(words) >= size else ends[-1:]
        starts = np.append(0, ends[:-1] + 1)[:len(last)]
        ones = np.zeros(64, np.int64)
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed)
                              for a, b in zip(starts.tolist(), last.tolist())), np.uint64, len(last))
        for a in range(0, len(hashes), BITS_AT_ONCE):
            part = hashes[a:a + BITS_AT_ONCE]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > len(hashes)).view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3, seed: int = 42,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp long): the fingerprint of every whole text; null and wordless
    texts have fingerprint zero.  No shuffle."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import simhash as op
        from tickforge.llm.common import chunks
        for batch in chunks(batches, "text", CHUNK_BYTES):
            found = op.fingerprint_batch(batch.column("text").to_pylist(), shingle_words, seed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view("int64"))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def linked_pairs(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """The links between two tiles, as stars: every pair within the radius is
    compared, and each fingerprint of a group so linked is paired with the
    group's smallest."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    left, right = a.view(np.uint64), b.view(np.uint64)
    block = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), block):
        far = np.bitwise_count(left[at:at + block, None] ^ right[None, :])
        i, j = np.nonzero(far <= radius)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for x, y in zip(a[i].tolist(), b[j].tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
    return [(x, root(x)) for x in parent if root(x) != x]


def tile_links(distinct: DataFrame, rows: int, radius: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links between the ``rows`` distinct fingerprints ``fp`` at ``radius`` bits
    or fewer, as stars for each tile pair."""
    halves = distinct.select(
        "fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"))
    # at most 33 x 33 cells
    cells = saved(halves.groupBy("hi", "lo").count().select(
        "hi", "lo", F.ceil(F.col("count") / tile_rows).alias("parts")), "simhash-cells", rows=33 * 33)
    tiles = saved(
        halves.join(F.broadcast(cells), ["hi", "lo"])
        .groupBy("hi", "lo", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part"))
        .agg(F.collect_list("fp").alias("fps")), "simhash-tiles", rows=rows)
    near = F.array(*(F.struct(F.lit(h).alias("h"), F.lit(w).alias("w"))
                     for h in range(radius + 1) for w in range(h - radius, radius - h + 1)
                     if h > 0 or w >= 0))
    # tile ids first: each tile with the tiles of every cell near enough
    ids = (tiles.select("hi", "lo", "part", F.explode(near).alias("n"))
           .select(F.col("hi").alias("a_hi"), F.col("lo").alias("a_lo"), F.col("part").alias("a_part"),
                   (F.col("hi") + F.col("n.h")).alias("hi"), (F.col("lo") + F.col("n.w")).alias("lo"))
           .join(F.broadcast(cells), ["hi", "lo"])
           .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
           .drop("parts")
           .where("a_hi <> hi OR a_lo <> lo OR a_part <= part"))
    left = tiles.select(F.col("hi").alias("a_hi"), F.col("lo").alias("a_lo"),
                        F.col("part").alias("a_part"), F.col("fps").alias("a"))
    pairs = (ids.join(left, ["a_hi", "a_lo", "a_part"])
             .join(tiles.withColumnRenamed("fps", "b"), ["hi", "lo", "part"])
             .select("a", "b", ((F.col("a_hi") == F.col("hi")) & (F.col("a_lo") == F.col("lo"))
                                & (F.col("a_part") == F.col("part"))).alias("same")))

    def run(batches):
        import numpy
        import pyarrow as pa

        from tickforge.llm import simhash as op
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (numpy.array(batch.column(c)[k].values, dtype="int64") for c in (0, 1))
                found = op.linked_pairs(a, b, batch.column(2)[k].as_py(), radius)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x for x, _ in found], pa.int64()),
                         pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): connected components of ``edges`` (a, b) by alternating
    large-star and small-star rounds; root is a component's smallest node.

    Each round is written to the shared folder.  ``max_rounds`` is a guard
    that raises; about log2 of the longest path is needed."""
    raw = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("v"),
                                             F.least("a", "b").alias("u")), "cc-edges")
    rows = raw.count()
    now = saved(raw.distinct(), "cc-0", rows)

    def settled(df):
        """Every node is in one edge as a leaf, or a root only."""
        sides = df.select(F.col("v").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).union(
            df.select("u", F.lit(0), F.lit(1)))
        return sides.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).where(
            "leaf > 1 OR leaf = 1 AND root = 1").isEmpty()

    for k in range(max_rounds):
        if settled(now):
            return now.select(F.col("v").alias("node"), F.col("u").alias("root"))
        both = now.union(now.select("u", "v")).toDF("n", "m")
        lowest = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        large = saved(both.join(lowest, "n").where("m > n")
                      .select(F.col("m").alias("v"), F.col("low").alias("u")).distinct(), f"cc-large-{k}", rows)
        lowest = large.groupBy("v").agg(F.min("u").alias("low"))
        joined = large.join(lowest, "v")
        now = saved(joined.where("u <> low").select(F.col("u").alias("v"), F.col("low").alias("u"))
                    .union(lowest.select("v", F.col("low").alias("u"))).distinct(), f"cc-small-{k}", rows)
    raise RuntimeError("connected components did not settle")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, radius: int = 3, seed: int = 42,
                    id_column: str = "doc_id", text_column: str = "text",
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per row: the id, fingerprint (16 hexadecimal digits), component_id (the
    smallest id reachable over links of ``radius`` bits or fewer).

    Null and wordless texts have fingerprint zero and link like any other;
    repeated rows and ids are kept; a null id is returned as null and is the
    component's id only if it has no other; an empty table gives an empty
    result.  Only ids, fingerprints and links are shuffled, each distinct
    fingerprint is compared once, however many rows have it."""
    prints = saved(fingerprints(docs, shingle_words, seed, id_column, text_column), "simhash-prints")
    rows = prints.count()
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies")),
                     "simhash-distinct", rows)
    roots = components(tile_links(distinct, rows, radius, tile_rows))
    nodes = roots.union(roots.select("root", "root")).distinct()
    lows = nodes.join(distinct.withColumnRenamed("fp", "node"), "node")
    least = lows.groupBy("root").agg(F.min("low").alias("component_id"))
    linked = lows.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    known = saved(distinct.join(linked, "fp", "left").select(
        "fp", "copies", F.coalesce("component_id", "low").alias("component_id")), "simhash-known", rows)
    # at most HOT_PRINTS fingerprints have over rows / HOT_PRINTS rows each
    hot = F.col("copies") > rows / HOT_PRINTS
    often = F.broadcast(known.where(hot).select("fp", F.col("component_id").alias("often")))
    flagged = prints.join(often, "fp", "left")
    done = flagged.where("often IS NOT NULL").withColumnRenamed("often", "component_id")
    rest = flagged.where("often IS NULL").select("doc_id", "fp").join(
        known.where(~hot | F.col("component_id").isNull()).select("fp", "component_id"), "fp")
    return (done.unionByName(rest)
            .select(F.col("doc_id").alias(id_column),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


#: Rows to leave out (an id and a text digest each) broadcast up to so many.
SMALL_ROWS = 500_000


def one_per_group(docs: DataFrame, shingle_words: int = 3, radius: int = 3, seed: int = 42,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns as they
    are: the one with the smallest id (then text digest; ids that are null come
    last).  Equal rows are one group, whatever their number."""
    digest = F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))
    name = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), digest.alias("md5"))
    groups = saved(near_duplicates(docs.select(name.alias("row"), F.col(text_column).alias("text")),
                                   shingle_words, radius, seed, "row", "text").select("row", "component_id"),
                   "simhash-groups")
    lose = saved(groups.where(F.col("row") != F.col("component_id")).select("row").distinct(), "simhash-lose")
    again = saved(groups.where(F.col("row") == F.col("component_id")).groupBy("row").count().where("count > 1")
                  .select("row"), "simhash-again")

    def meets(other):
        return (F.col(id_column).eqNullSafe(other["row"]["id"])) & (digest == other["row"]["md5"])

    small = hinted(lose, SMALL_ROWS)
    kept = docs.join(small, meets(small), "left_anti")
    if again.isEmpty():
        return kept
    more = hinted(again, SMALL_ROWS)
    return kept.join(more, meets(more), "left_anti").union(
        kept.join(more, meets(more), "left_semi").dropDuplicates([id_column, text_column]))
