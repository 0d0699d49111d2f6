"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks.

The words of a source, its documents one after the other, are cut into blocks
of ``BLOCK_WORDS``.  Blocks go to sources by the highest quotients
target / (2j + 1), each source's blocks to its shards (runs of about sqrt(n)
of its n blocks) by the same rule, and within a shard a seeded order of the
blocks fills its quota.  DataFrame functions only.

Only contested quotients are made and ranked: of S parties with votes of T in
all, the K-th highest quotient lies between T / (2K + S) and T / (2K - S), so
every quotient above wins and 2S to 4S rows decide the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import prepare, saved
from tickforge.llm.ranks import positions, text_key
from tickforge.operators.joins import join_small

WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, as a fraction of whole numbers.
SHARE = (3, 2)
#: Times that a source may be taken.
REPEATS = 2
BLOCK_WORDS = 32
WORD = r"[^\x20\x09-\x0D]+"


def weight(place, weights=WEIGHTS) -> Column:
    return F.element_at(F.array(*(F.lit(w) for w in weights)), (place % len(weights) + 1).cast("int"))


def targets(sources: DataFrame, share=SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (weight, words) with capped and target: ``share`` of all
    words dealt by weight; who would get more than ``repeats`` times its words
    stops there, and the excess goes to the others by weight, until no one is
    above.  One aggregate of the source table a round."""
    up, down = share
    cap = F.lit(repeats) * F.col("words")
    total, heft = sources.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    held, rest = 0, heft
    while rest:
        each = (up * total - down * held) / (float(down) * rest)
        over = cap < F.col("weight") * F.lit(each)
        now = sources.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                          F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if tuple(now) == (held, rest):
            break
        held, rest = now
    if not rest:
        return sources.withColumn("capped", F.lit(True)).withColumn("target", cap.cast("double"))
    return sources.withColumn("capped", over).withColumn(
        "target", F.when(over, cap.cast("double")).otherwise(F.lit(each) * F.col("weight")))


def contested(votes, total, parties, seats, most) -> tuple[Column, Column]:
    """Quotients that surely win, and those that may: each party's count of
    quotients, at most ``most``, above the two bounds (one row of margin)."""
    def above(bound):
        return F.greatest(F.lit(0).cast("long"), F.least(most, F.floor((votes * bound / total + 1) / 2).cast("long")))
    low = F.greatest(F.lit(0.0), 2.0 * seats - parties)
    return F.greatest(F.lit(0).cast("long"), above(low) - 1), F.least(most, above(2.0 * seats + 4.0 * parties) + 1)


def source_quotas(sources: DataFrame, block_words: int, repeats: int = REPEATS, share=SHARE) -> DataFrame:
    """``sources`` (place, words, capped, target) with n_blocks and quota."""
    up, down = share
    n_blocks = F.ceil(F.col("words") / block_words).cast("long")
    sized = sources.withColumn("n_blocks", n_blocks)
    free = sized.where("NOT capped AND n_blocks > 0")
    parties, fixed, total = sized.agg(
        F.count(F.when(~F.col("capped") & (F.col("n_blocks") > 0), 1)),
        F.coalesce(F.sum(F.when(F.col("capped"), repeats * F.col("words"))), F.lit(0)),
        F.coalesce(F.sum("words"), F.lit(0))).first()
    left = up * total - down * fixed  # in 1/down words
    seats = (2 * left + block_words * down) // (2 * block_words * down)
    sure, may = contested(F.col("target"), F.lit(max(left, 1) / down), F.lit(float(parties)),
                          F.lit(float(seats)), repeats * F.col("n_blocks"))
    bounds = saved(free.select("place", "target", sure.alias("sure"), may.alias("may")), "mix-bounds", rows=parties)
    needed = seats - (bounds.agg(F.coalesce(F.sum("sure"), F.lit(0))).first()[0])
    quotients = bounds.where("may > sure").select(
        "place", F.explode(F.expr("sequence(sure, may - 1)")).alias("j"), "target").select(
        F.lit(0).alias("all"), "place", "j", (-F.col("target") / (2 * F.col("j") + 1)).alias("below"))
    won = positions(quotients, ["all"], ["below", "place", "j"], name="mix-quotients").where(
        F.col("pos") < needed).groupBy("place").agg(F.count(F.lit(1)).alias("won"))
    zero = F.lit(0).cast("long")
    return sized.join(bounds.select("place", "sure"), "place", "left").join(won, "place", "left").withColumn(
        "quota", F.when(F.col("capped"), repeats * F.col("n_blocks")).otherwise(
            F.coalesce("sure", zero) + F.coalesce("won", zero))).drop("sure", "won")


def shard_quotas(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(place, shard, first, blocks, quota) of shards that take a block."""
    wide = F.ceil(F.sqrt(F.col("n_blocks").cast("double"))).cast("long")
    shards = sources.where("quota > 0").select("place", "n_blocks", F.col("quota").alias("seats"), wide.alias("wide"))
    shards = shards.withColumn("parties", F.ceil(F.col("n_blocks") / F.col("wide")).cast("long")).withColumn(
        "shard", F.explode(F.expr("sequence(0L, parties - 1)"))).withColumn("first", F.col("shard") * F.col("wide"))
    shards = shards.withColumn("blocks", F.least("wide", F.col("n_blocks") - F.col("first")))
    sure, may = contested(F.col("blocks"), F.col("n_blocks"), F.col("parties"), F.col("seats"), repeats * F.col("blocks"))
    shards = shards.withColumn("sure", sure).withColumn("may", may)
    whole = Window.partitionBy("place")
    shards = shards.withColumn("needed", F.col("seats") - F.sum("sure").over(whole))
    ranked = shards.withColumn("j", F.explode_outer(F.expr("CASE WHEN may > sure THEN sequence(sure, may - 1) END")))
    ranked = ranked.withColumn("rank", F.row_number().over(whole.orderBy(
        (-F.col("blocks") / (2 * F.col("j") + 1)).asc_nulls_last(), "shard", "j")))
    return ranked.groupBy("place", "shard", "first", "blocks").agg(
        (F.max("sure") + F.count(F.when(F.col("j").isNotNull() & (F.col("rank") <= F.col("needed")), 1))).alias("quota"))


def block_times(shards: DataFrame, seed: int) -> DataFrame:
    """(place, block, times): how often each block is taken, 0 left out; the
    remainder of a shard's quota goes to its first blocks in a seeded order."""
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards.where("quota > 0").repartition(parts, "place", "shard")
    blocks = dealt.withColumn("block", F.explode(F.expr("sequence(first, first + blocks - 1)")))
    draw = F.md5(F.concat_ws(":", F.lit(seed), "place", "block").cast("binary"))
    drawn = Window.partitionBy("place", "shard").orderBy(draw, "block")
    return blocks.withColumn("rank", F.row_number().over(drawn)).select(
        "place", "block", F.expr("quota div blocks + CAST(rank <= quota % blocks AS BIGINT)").alias("times")).where("times > 0")


def mixed(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = 13,
          id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """Per row: the id, size, source_size, target (of its source) and taken,
    the words that the mix takes of it, repeats counted.

    A null source is a source of its own, the last; a null or empty text has
    size 0 and nothing taken; null ids come first in their source; repeated
    rows count each; other columns play no part; an empty table gives an empty
    result.  Texts are counted whole.  The rows of a source are ordered by id
    and size, so every run takes the same words."""
    prepare(docs.sparkSession)
    size = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long")
    sized = saved(docs.select(F.col(id_column).alias("id"), text_key(source_column, null_first=False).alias("key"),
                              size.alias("size")), "mix-sizes")
    grouped = sized.groupBy("key").agg(F.sum("size").alias("words")).withColumn("all", F.lit(0))
    sources = positions(grouped, ["all"], ["key"], name="mix-sources").select(
        "key", F.col("pos").alias("place"), "words", weight(F.col("pos"), weights).cast("long").alias("weight"))
    sources = targets(saved(sources, "mix-weights"))
    sources = saved(source_quotas(sources, block_words), "mix-quotas")
    times = block_times(shard_quotas(sources), seed)
    rows = positions(join_small(sized, sources.select("key", "place", "words", "target"), "key").drop("key"),
                     ["place"], ["id", "size"], "size", name="mix-rows")
    # size 0 gives an empty list of blocks and one row without a block
    spans = rows.withColumn("block", F.explode_outer(F.expr(
        f"CASE WHEN size > 0 THEN sequence(before div {block_words}, (before + size - 1) div {block_words}) END")))
    shared = F.least((F.col("block") + 1) * block_words, F.col("before") + F.col("size")) - F.greatest(
        F.col("block") * block_words, F.col("before"))
    # a row for every block: never a broadcast, whatever the planner expects of the explode
    return spans.join(times.hint("merge"), ["place", "block"], "left").groupBy("place", "pos").agg(
        F.first("id").alias(id_column), F.first("size").alias("size"), F.first("words").alias("source_size"),
        F.first("target").alias("target"),
        F.coalesce(F.sum(shared * F.col("times")), F.lit(0)).cast("long").alias("taken")).drop("place", "pos")


def oracle(weights=WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = 13) -> str:
    """DuckDB SQL of op13's rows: every quotient is made and ranked."""
    b = block_words
    return f"""
        WITH RECURSIVE sized AS MATERIALIZED (
            SELECT doc_id, CASE WHEN source IS NULL THEN '>' ELSE '=' || source END AS key,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
        src AS MATERIALIZED (
            SELECT key, words, row_number() OVER (ORDER BY key) - 1 AS place,
                   {list(weights)}[((row_number() OVER (ORDER BY key) - 1) % {len(weights)} + 1)::INT]::BIGINT AS weight
            FROM (SELECT key, sum(size)::BIGINT AS words FROM sized GROUP BY key)),
        tot AS MATERIALIZED (SELECT sum(words)::BIGINT AS n FROM src),
        rounds AS (
            SELECT 0 AS step, 0::BIGINT AS held, (SELECT sum(weight)::BIGINT FROM src) AS rest
            UNION ALL
            SELECT any_value(r.step) + 1,
                   coalesce(sum(2 * words) FILTER (2 * words < weight * ((3 * n - 2 * held) / (2.0::DOUBLE * rest))), 0)::BIGINT,
                   coalesce(sum(weight) FILTER (NOT (2 * words < weight * ((3 * n - 2 * held) / (2.0::DOUBLE * rest)))), 0)::BIGINT
            FROM rounds r, src, tot WHERE r.step < 40 AND r.rest > 0 HAVING count(*) > 0),
        fin AS (SELECT held, rest FROM rounds ORDER BY step DESC LIMIT 1),
        goal AS MATERIALIZED (
            SELECT key, place, words, ceil(words / {b})::BIGINT AS n_blocks,
                   rest = 0 OR 2 * words < weight * ((3 * n - 2 * held) / (2.0::DOUBLE * rest)) AS capped,
                   CASE WHEN rest = 0 OR 2 * words < weight * ((3 * n - 2 * held) / (2.0::DOUBLE * rest))
                        THEN (2 * words)::DOUBLE ELSE ((3 * n - 2 * held) / (2.0::DOUBLE * rest)) * weight END AS target
            FROM src, tot, fin),
        seats AS (SELECT ((3 * n - 2 * held) + {b}) // {2 * b} AS k FROM tot, fin),
        quot AS (
            SELECT place, count(*) AS quota FROM (
                SELECT place, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, place, j) AS r
                FROM (SELECT place, target, unnest(range(2 * n_blocks)) AS j FROM goal WHERE NOT capped)), seats
            WHERE r <= k GROUP BY place),
        quota AS (
            SELECT g.*, CASE WHEN capped THEN 2 * n_blocks ELSE coalesce(quota, 0) END AS quota,
                   ceil(sqrt(n_blocks::DOUBLE))::BIGINT AS wide
            FROM goal g LEFT JOIN quot USING (place)),
        shard AS MATERIALIZED (
            SELECT place, quota, shard, shard * wide AS first, least(wide, n_blocks - shard * wide) AS blocks
            FROM (SELECT *, unnest(range(((n_blocks + wide - 1) // wide)::BIGINT)) AS shard FROM quota WHERE quota > 0)),
        held_seats AS (
            SELECT place, shard, count(*) AS quota FROM (
                SELECT place, shard, quota, row_number() OVER (
                    PARTITION BY place ORDER BY blocks::DOUBLE / (2 * j + 1) DESC, shard, j) AS r
                FROM (SELECT *, unnest(range(2 * blocks)) AS j FROM shard))
            WHERE r <= quota GROUP BY place, shard),
        times AS (
            SELECT place, block, h.quota // blocks + (row_number() OVER (
                       PARTITION BY place, shard ORDER BY md5(concat_ws(':', {seed}, place, block)), block)
                       <= h.quota % blocks)::BIGINT AS times
            FROM (SELECT *, unnest(range(first, first + blocks)) AS block FROM shard) JOIN held_seats h USING (place, shard)),
        rows_ AS (
            SELECT doc_id, size, place, words, target,
                   row_number() OVER w AS pos, (sum(size) OVER w)::BIGINT - size AS before
            FROM sized JOIN goal USING (key)
            WINDOW w AS (PARTITION BY place ORDER BY doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))
        SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(words) AS source_size,
               any_value(target) AS target,
               coalesce(sum((least((t.block + 1) * {b}, before + size) - greatest(t.block * {b}, before)) * times), 0)::BIGINT AS taken
        FROM rows_ r LEFT JOIN times t ON t.place = r.place AND size > 0
             AND t.block BETWEEN before // {b} AND (before + size - 1) // {b}
        GROUP BY r.place, pos"""
