"""Merkle manifest of a table: sixteen-fold trees, proofs by a recursive climb.

Each group of rows (a source) is a tree over the hashes of its rows, and the
groups' roots are the leaves of one more tree.  The built levels are stored as
node rows, each with the digests of its children and a link to its parent; a
Spark recursive query then climbs from every leaf at once, adding a row for
the siblings of each level and folding the claimed hash into the parent's.

A node of an upper level serves every leaf below it.  Its row is repeated for
each block of ``LEAF_BLOCK`` leaves, so the climb joins at most that many
leaves to one row, and a hot group is as many keys as it has blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import prepare, saved
from tickforge.llm.ranks import positions, text_key
from tickforge.operators.joins import join_small

FAN = 16
LEAF_BLOCK = FAN ** 3
#: Number of the tree over the groups' roots.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def of_children(kids: Column) -> Column:
    """Digest of a node from its children's digests, one after the other."""
    return digest(F.lower(F.hex(kids)))


def row_text(values: list[Column]) -> Column:
    """Each value as its byte count, a colon and its text; ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


@dataclass
class Manifest:
    """Stored tables: ``leaves`` (tree, i, n, id, leaf, claimed), ``nodes``
    (tree, level, idx, n, kids, digest), ``trees`` (tree, n, subroot), and the
    root digest (None of an empty table)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: bytes | None
    top_height: int


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def height_column(n: Column, most: int) -> Column:
    """``height`` of a column, for heights up to ``most``."""
    out = F.lit(0)
    for j in range(most):
        out = out + (n > FAN ** j).cast("int")
    return out


def levels(bottom: DataFrame, most: int, name: str) -> DataFrame:
    """Node rows above ``bottom`` (tree, i, n, digest): every ``FAN``
    consecutive ones become a node while a tree has more than one."""
    found, now = None, bottom
    for level in range(1, most + 1):
        # n rows at the bottom are ceil(n / FAN^(level - 1)) here; trees of one node are done
        pairs = now.where(F.col("n") > FAN ** (level - 1)).groupBy(
            "tree", F.expr(f"i div {FAN}").alias("idx"), "n").agg(
            F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("own"))
        kids = pairs.select("tree", "idx", "n", F.expr("aggregate(own, X'', (a, k) -> concat(a, k.digest))").alias("kids"))
        here = saved(kids.select("tree", F.lit(level).alias("level"), "idx", "n", "kids",
                                 of_children(F.col("kids")).alias("digest")), f"{name}-{level}")
        found = here if found is None else found.union(here)
        now = here.select("tree", F.col("idx").alias("i"), "n", "digest")
    return found


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (key, id, leaf, claimed): a tree for each key,
    its leaves by id (equal ids by their hashes), keys in code point order."""
    prepare(rows.sparkSession)
    rows = saved(rows, "merkle-rows")
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))
    trees = saved(positions(counts, ["all"], ["key"], name="merkle-keys").select(
        "key", F.col("pos").alias("tree"), "n"), "merkle-trees")
    n_trees, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = saved(positions(join_small(rows, trees, "key").drop("key"), ["tree"], ["id", "leaf", "claimed"],
                             name="merkle-ranged").withColumnRenamed("pos", "i"), "merkle-leaves")
    low = levels(leaves.select("tree", "i", "n", F.col("leaf").alias("digest")), height(most), "merkle-level")
    lone = leaves.where("n = 1").select("tree", F.col("leaf").alias("subroot"))
    tops = lone if low is None else lone.union(low.where(
        F.col("level") == height_column(F.col("n"), height(most))).select("tree", "digest"))
    trees = saved(trees.drop("key").join(tops, "tree"), "merkle-subroots")
    high = levels(trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("i"),
                               F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("digest")),
                  height(n_trees), "merkle-top")
    if n_trees == 0:
        return Manifest(leaves, rows.sparkSession.createDataFrame(
            [], "tree long, level int, idx long, n long, kids binary, digest binary"), trees, None, 0)
    if high is None:
        root = trees.select("subroot").first()[0]
        nodes = low
    else:
        root = high.where(F.col("level") == height(n_trees)).select("digest").first()[0]
        nodes = high if low is None else low.union(high)
    if nodes is None:
        nodes = rows.sparkSession.createDataFrame(
            [], "tree long, level int, idx long, n long, kids binary, digest binary")
    return Manifest(leaves, nodes, trees, bytes(root), height(n_trees))


def linked(rows: DataFrame, level: Column, idx: Column, most: int, top_height: int) -> DataFrame:
    """``rows`` (tree, n, own) with the link to the parent: up_tree, up_level,
    up_idx (null above the root) and pos, the place among its children."""
    own = F.col("tree") != TOP
    inside = (own & (level < height_column(F.col("n"), most))) | (~own & (level < top_height))
    over = own & ~inside & F.lit(top_height > 0)
    place = F.when(inside, idx).when(over, F.col("own"))
    return rows.withColumns({
        "up_tree": F.when(inside, F.col("tree")).when(over, F.lit(TOP).cast("long")),
        "up_level": F.when(inside, level + 1).when(over, F.lit(1)),
        "up_idx": F.floor(place / FAN).cast("long"), "pos": (place % FAN).cast("int")})


CLIMB = """
    WITH RECURSIVE climb (own, block, i, id, leaf, step, up_tree, up_level, up_idx, pos, folded) AS (
        SELECT own, block, i, id, leaf, 0, up_tree, up_level, up_idx, pos, claimed FROM {leaves}
        UNION ALL
        SELECT c.own, c.block, c.i, NULL, NULL, c.step + 1, p.up_tree, p.up_level, p.up_idx, p.pos,
               unhex(sha2(CAST(lower(hex(concat(
                   substring(p.kids, 1, 32 * c.pos), c.folded, substring(p.kids, 32 * c.pos + 33)))) AS BINARY), 256))
        FROM climb c JOIN {ladder} p
          ON p.own = c.own AND p.block = c.block AND p.tree = c.up_tree AND p.level = c.up_level AND p.idx = c.up_idx)
    SELECT * FROM climb"""


SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def proofs(manifest: Manifest, digests: bool = False) -> DataFrame:
    """Per leaf, stored: tree, i, id, leaf, folded (the root that its claimed
    hash leads to) and siblings, the digests of the proof, level by level from
    the leaf to the root, left to right; with ``digests`` only the hash of
    their hex text, proof_sha256.

    Each step of the climb appends a row that names the siblings it passes (the
    parent's node row and the own place); their digests, fifteen a step, join
    at the end, dealt by block, where the rows of a leaf meet without a
    further shuffle."""
    spark = manifest.leaves.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # rows grow with the table; levels end the climb
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = height(manifest.trees.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    block = F.expr(f"i div {LEAF_BLOCK}")
    leaves = linked(manifest.leaves.withColumn("own", F.col("tree")), F.lit(0), F.col("i"), most, manifest.top_height)
    leaves = leaves.withColumn("block", block)
    inner = manifest.nodes.where(F.col("tree") != TOP).withColumn("own", F.col("tree"))
    wide = F.expr(f"CAST(power({FAN}, level) AS BIGINT)")
    inner = inner.withColumn("wide", wide).withColumn("block", F.explode(F.expr(
        f"sequence(idx * wide div {LEAF_BLOCK}, (least((idx + 1) * wide, n) - 1) div {LEAF_BLOCK})"))).drop("wide")
    upper = manifest.nodes.where(F.col("tree") == TOP)
    below = manifest.trees.select(F.col("tree").alias("own"), F.explode(F.expr(
        f"sequence(0L, (n - 1) div {LEAF_BLOCK})")).alias("block")).withColumn(
        "level", F.explode(F.sequence(F.lit(1), F.lit(max(manifest.top_height, 1))))).withColumn(
        "idx", F.expr(f"own div CAST(power({FAN}, level) AS BIGINT)"))
    upper = join_small(below, upper, ["level", "idx"]).select(*inner.columns)
    ladder = linked(inner.union(upper), F.col("level"), F.col("idx"), most, manifest.top_height).select(
        "own", "block", "tree", "level", "idx", "kids", "up_tree", "up_level", "up_idx", "pos")
    ladder = saved(ladder, "merkle-ladder")
    climbed = spark.sql(CLIMB, leaves=leaves, ladder=ladder).repartition(parts, "own", "block")
    held = ladder.select("own", "block", F.col("tree").alias("up_tree"), F.col("level").alias("up_level"),
                         F.col("idx").alias("up_idx"), "kids").repartition(parts, "own", "block")
    passed = F.concat(F.expr("substring(kids, 1, 32 * pos)"), F.expr("substring(kids, 32 * pos + 33)"))
    steps = climbed.join(held.hint("shuffle_hash"), ["own", "block", "up_tree", "up_level", "up_idx"], "left")
    path = F.array_sort(F.collect_list(F.struct("step", F.coalesce(passed, F.lit(b"")).alias("siblings"))))
    out = steps.groupBy(F.col("own").alias("tree"), "block", "i").agg(
        F.max("id").alias("id"), F.max("leaf").alias("leaf"), F.max_by("folded", "step").alias("folded"),
        path.alias("path")).withColumn("siblings", F.expr("aggregate(path, X'', (a, s) -> concat(a, s.siblings))"))
    if digests:
        out = out.withColumn("proof_sha256", F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256))
    out = out.select("tree", "i", "id", "leaf", "folded", "proof_sha256" if digests else "siblings")
    # tables dealt by (own, block) join on these and more columns as they lie; for this job only
    before = spark.conf.get(SUBSET_KEYS)
    spark.conf.set(SUBSET_KEYS, "false")
    try:
        return saved(out, "merkle-proofs")
    finally:
        spark.conf.set(SUBSET_KEYS, before)


def tampered_text(doc_id, text) -> Column:
    """A-Z lower-cased where 5 divides the checksum of the id; a null id never is."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, low).otherwise(text)


def verified(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (of the
    tampered row) and verified.

    Null values are ``-`` in a leaf, a null source is the first tree, null ids
    come first in their tree and are never tampered with, repeated rows are
    leaves of their own, other columns play no part, texts are hashed whole, an
    empty table gives an empty result."""
    own = [F.col(c) for c in COLUMNS]
    bent = [*own[:-1], tampered_text(F.col("doc_id"), F.col("text"))]
    rows = docs.select(text_key("source", null_first=True).alias("key"), F.col("doc_id").alias("id"),
                       digest(row_text(own)).alias("leaf"), digest(row_text(bent)).alias("claimed"))
    book = build(rows)
    root = F.lit(book.root.hex() if book.root else None).cast("string")
    out = join_small(proofs(book, digests=True), book.trees.select("tree", "subroot"), "tree")
    folded = F.lower(F.hex("folded"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"),
                      F.lower(F.hex("subroot")).alias("subroot"), root.alias("root"),
                      "proof_sha256", folded.alias("folded_root"), (folded == root).alias("verified"))


def oracle() -> str:
    """DuckDB SQL of op12's rows."""
    crc = """list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
                lambda ch: ord(ch)::UBIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0::UBIGINT for z in range(8)]),
                lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))"""

    def enc(text):
        return " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR END"
                           for v in (*COLUMNS[:-1], text))
    return f"""
        WITH RECURSIVE hashed AS MATERIALIZED (
            SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key, sha256({enc('text')}) AS leaf,
                   CASE WHEN coalesce(xor({crc}, 4294967295::UBIGINT) % 5 = 0, false) THEN sha256({enc("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
                        ELSE sha256({enc('text')}) END AS claimed
            FROM documents),
        leaves AS MATERIALIZED (
            SELECT doc_id, leaf, claimed, dense_rank() OVER (ORDER BY key) - 1 AS tree,
                   row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS i,
                   count(*) OVER (PARTITION BY key) AS n FROM hashed),
        nodes AS (
            SELECT 0 AS level, tree, i, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT level + 1, tree, i // {FAN}, n, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes
            WHERE n > power({FAN}, level) GROUP BY level, tree, i // {FAN}, n),
        subroots AS MATERIALIZED (SELECT tree, arg_max(digest, level) AS subroot FROM nodes GROUP BY tree),
        tops AS (
            SELECT 0 AS level, tree AS i, count(*) OVER () AS n, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, i // {FAN}, n, sha256(string_agg(digest, '' ORDER BY i)) FROM tops
            WHERE n > power({FAN}, level) GROUP BY level, i // {FAN}, n),
        root AS (SELECT arg_max(digest, level) AS root FROM tops),
        low AS MATERIALIZED (SELECT level, tree, i // {FAN} AS g, n, list(digest ORDER BY i) AS kids FROM nodes GROUP BY ALL),
        high AS MATERIALIZED (SELECT level, i // {FAN} AS g, n, list(digest ORDER BY i) AS kids FROM tops GROUP BY ALL),
        up AS (
            SELECT 0 AS level, tree, i, i AS idx, claimed AS folded, '' AS proof FROM leaves
            UNION ALL
            SELECT u.level + 1, u.tree, u.i, u.idx // {FAN},
                   sha256(array_to_string(list_transform(kids, lambda k, p: CASE WHEN p = u.idx % {FAN} + 1 THEN u.folded ELSE k END), '')),
                   u.proof || array_to_string(list_filter(kids, lambda k, p: p <> u.idx % {FAN} + 1), '')
            FROM up u JOIN low ON low.level = u.level AND low.tree = u.tree AND low.g = u.idx // {FAN}
            WHERE low.n > power({FAN}, u.level)),
        crossed AS MATERIALIZED (
            SELECT tree, i, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM up GROUP BY tree, i),
        over AS (
            SELECT 0 AS level, tree, i, tree AS idx, folded, proof FROM crossed
            UNION ALL
            SELECT o.level + 1, o.tree, o.i, o.idx // {FAN},
                   sha256(array_to_string(list_transform(kids, lambda k, p: CASE WHEN p = o.idx % {FAN} + 1 THEN o.folded ELSE k END), '')),
                   o.proof || array_to_string(list_filter(kids, lambda k, p: p <> o.idx % {FAN} + 1), '')
            FROM over o JOIN high ON high.level = o.level AND high.g = o.idx // {FAN} WHERE high.n > power({FAN}, o.level)),
        done AS (SELECT tree, i, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM over GROUP BY tree, i)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM leaves JOIN done USING (tree, i) JOIN subroots USING (tree), root"""
