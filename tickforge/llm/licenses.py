"""License scans: phrase places and an exact set-similarity join.

Every text block is a set of words: a line, a sentence (also one that runs over
line breaks), and for a template of several sentences as many neighbouring ones.
Words are ordered by frequency, rarest first; a block can only reach a template's
containment threshold if it shares a word of the template's prefix in this
order, has enough words, and has enough of them left from the shared place on.
What passes these filters is counted exactly.  DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import ascii_lower, prepare, saved

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices and their labels.
TEMPLATES = {
    "released under the MIT License": "mit",
    "licensed under the Apache License, Version 2.0": "apache-2.0",
    "licensed under the GNU General Public License, version 2": "gpl-2.0",
    "licensed under the GNU General Public License, version 3": "gpl-3.0",
    "licensed under the GNU Lesser General Public License": "lgpl",
    "licensed under the Mozilla Public License, version 2.0": "mpl-2.0",
    "released under the BSD 3-Clause License": "bsd-3-clause",
    "licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
    "released into the public domain under CC0 1.0 Universal": "cc0-1.0",
    "Copyright. All rights reserved. No part may be reproduced without permission": "no-reproduction",
}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = r"\n|[.!?;][ \t\r]+"
#: A sentence ends here or at a blank line, not where a line is wrapped.
SENTENCE = r"[.!?;][ \t\r\n]+|\n[ \t\r]*\n"


def has_any(text, parts):
    """The text holds one of the lower-case ASCII ``parts``, in any case."""
    low = F.lower(text)
    out = low.contains(parts[0])
    for part in parts[1:]:
        out = out | low.contains(part)
    return out


def words(text):
    """Words of a text, A-Z in lower case."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), 0)


def template_words(templates: dict) -> list[tuple[str, list[str]]]:
    """(label, distinct words in order) of each template."""
    return [(label, list(dict.fromkeys(re.findall(r"[a-z0-9]+", text.lower()))))
            for text, label in templates.items()]


def needed(size: int, threshold: float) -> int:
    """Words a block must share with a template of ``size`` distinct words."""
    n = int(size * threshold)
    return n if n >= size * threshold - 1e-9 else n + 1


def template_sentences(templates: dict) -> list[int]:
    """Sentences of each template, in the order of ``template_words``."""
    return [len(re.split(SENTENCE, text.strip())) for text in templates]


def places(found, phrase: str):
    """Positions at which the words of ``phrase`` stand one after the other."""
    parts = phrase.split()
    n = F.size(found)
    every = F.filter(F.sequence(F.lit(0), n - len(parts)), lambda i: _all(
        [F.get(found, i + k) == part for k, part in enumerate(parts)]))
    return F.when((n >= len(parts)) & F.array_contains(found, parts[-1]), every).otherwise(
        F.array().cast("array<int>"))


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def block_matches(docs: DataFrame, templates: dict, threshold: float) -> DataFrame:
    """(doc_id, text_md5, label, containment): templates contained in a block of a text."""
    spark = docs.sparkSession
    shapes = [(label, ws, needed(len(ws), threshold), run) for (label, ws), run in zip(
        template_words(templates), template_sentences(templates))]
    vocabulary = sorted({w for _, ws, _, _ in shapes for w in ws})
    least = min(need for _, _, need, _ in shapes)

    # the prefix filter holds for any order of words: with the longest first it
    # needs no frequencies, and drops most texts and blocks before words are cut
    def sure(least_run):
        return sorted({w for _, ws, need, run in shapes if run >= least_run
                       for w in sorted(ws, key=lambda w: (-len(w), w))[:len(ws) - need + 1]})

    def blocks_of(run, texts):
        return F.transform(texts, lambda x: F.struct(F.lit(run).alias("run"), x.alias("block")))

    def runs_of(run):
        return F.transform("sentences", lambda _, i: F.concat_ws(" ", F.slice("sentences", i + 1, run)))
    cut = (docs.where(has_any(F.col("text"), sure(1)))
           .select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "text",
                   F.filter(F.split("text", SENTENCE), lambda x: x.rlike(ANY_CASE_WORD)).alias("sentences")))
    # a sentence on one line is a block of the first kind already
    every = [blocks_of(1, F.split("text", BLOCK)),
             blocks_of(1, F.filter("sentences", lambda x: x.contains("\n")))]
    for run in sorted({run for _, _, _, run in shapes if run > 1}):
        every.append(F.when(has_any(F.col("text"), sure(run)), blocks_of(run, runs_of(run)))
                     .otherwise(F.array().cast("array<struct<run:int,block:string>>")))
    blocks = (cut.select("doc_id", "text_md5", F.explode_outer(F.concat(*every)).alias("cut"))
              .select("doc_id", "text_md5", "cut.run", "cut.block")
              .where(has_any(F.col("block"), sure(1))))
    # length filter: words outside all templates can't be shared
    held = saved(blocks.select("doc_id", "text_md5", "run", F.array_intersect(
        words(F.col("block")), F.array(*map(F.lit, vocabulary))).alias("shared"))
        .where(F.size("shared") >= least), "license-blocks")
    # global frequency of the templates' words: at most as many rows as they have words
    seen = {r["word"]: r["n"] for r in held.select(F.explode("shared").alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rare_first = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    order = {w: i for i, w in enumerate(rare_first)}
    prefix = []
    for label, ws, need, run in shapes:
        ranked = sorted(ws, key=order.get)
        prefix += [(ranked[i], i, label, need, len(ws), run, ranked) for i in range(len(ws) - need + 1)]
    prefixes = spark.createDataFrame(
        prefix, "word string, at int, label string, need int, size int, most int, ranked array<string>")
    ordered = held.select("doc_id", "text_md5", "run", F.array_intersect(
        F.array(*map(F.lit, rare_first)), F.col("shared")).alias("shared"))
    pairs = (ordered.select("doc_id", "text_md5", "run", "shared", F.posexplode_outer("shared").alias("pos", "word"))
             .join(F.broadcast(prefixes), "word")
             # no more sentences than the template has; length and positional filters
             .where((F.col("run") <= F.col("most")) & (F.size("shared") >= F.col("need"))
                    & (F.least(F.size("shared") - F.col("pos"), F.col("size") - F.col("at")) >= F.col("need"))))
    return (pairs.withColumn("both", F.size(F.array_intersect("shared", "ranked")))
            .where("both >= need")
            .groupBy("doc_id", "text_md5", "label").agg(F.max(F.col("both") / F.col("size")).alias("containment")))


def license_scan(docs: DataFrame, templates: dict | None = None, threshold: float = 0.9,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``score`` is the greatest containment of a template in a block (a line, a
    sentence, or as many neighbouring sentences as the template has); without
    one 1 if a phrase stands in the text, else 0.  A null or empty text has no
    words, null first_word and last_word, empty labels and score 0; null ids
    and repeated rows are kept (equal rows have equal results); other columns
    play no part; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    matches = block_matches(rows, templates or TEMPLATES, threshold)
    found = matches.groupBy("doc_id", "text_md5").agg(
        F.collect_set("label").alias("template_labels"), F.max("containment").alias("containment"))
    base = rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"),
                       F.regexp_count("text", F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"),
                       F.when(has_any(F.col("text"), sorted({p.split()[-1] for p in PHRASES})), words(F.col("text")))
                       .otherwise(F.array().cast("array<string>")).alias("words"))
    base = base.select("doc_id", "text_md5", "n_words", *(
        places(F.col("words"), phrase).alias(f"at_{i}") for i, phrase in enumerate(PHRASES)))
    each = [F.col(f"at_{i}") for i in range(len(PHRASES))]
    base = base.select(
        "doc_id", "text_md5", "n_words", F.concat(*each).alias("at"),
        F.filter(F.array(*(F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(each, PHRASES.values()))),
                 lambda x: x.isNotNull()).alias("base"))
    joined = base.alias("b").join(found.alias("f"), F.col("b.doc_id").eqNullSafe(F.col("f.doc_id"))
                                  & (F.col("b.text_md5") == F.col("f.text_md5")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("b.doc_id").alias(id_column), "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("template_labels", none))), ",").alias("labels"),
        F.coalesce("containment", F.when(F.size("at") > 0, F.lit(1.0)), F.lit(0.0)).alias("score"))


def oracle(threshold: float = 0.9) -> str:
    """DuckDB SQL for license_scan over ``documents``: every block against every template."""
    shapes = [(label, ws, needed(len(ws), threshold)) for label, ws in template_words(TEMPLATES)]
    values = ", ".join(f"('{label}', {ws!r}, {need})" for label, ws, need in shapes)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def at(phrase):
        parts = phrase.split()
        tests = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        return f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {tests})"
    lists = ", ".join(f"{at(p)} AS at_{i}" for i, p in enumerate(PHRASES))
    both = " || ".join(f"at_{i}" for i in range(len(PHRASES)))
    base = " || ".join(f"CASE WHEN len(at_{i}) > 0 THEN ['{label}'] ELSE []::VARCHAR[] END"
                       for i, label in enumerate(PHRASES.values()))
    return rf"""
        WITH t(label, words, need) AS (VALUES {values}),
        d AS (SELECT doc_id, {lower} AS low,
                     regexp_extract_all({lower}, '{WORD}') AS w FROM documents),
        b AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(
                     regexp_split_to_array(low, '{BLOCK}')), '{WORD}')) AS ws FROM d),
        m AS (SELECT doc_id, label, len(list_intersect(ws, words)) AS n, len(words) AS size
              FROM b JOIN t ON len(list_intersect(ws, words)) >= need),
        f AS (SELECT doc_id, list(DISTINCT label) AS more, max(n / size) AS containment FROM m GROUP BY doc_id),
        p AS (SELECT doc_id, len(w)::BIGINT AS n_words, {lists} FROM d),
        q AS (SELECT *, {both} AS places, {base} AS base FROM p)
        SELECT q.doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
               list_max(places)::BIGINT AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(base || coalesce(more, []::VARCHAR[]))), ',') AS labels,
               coalesce(containment, CASE WHEN len(places) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
        FROM q LEFT JOIN f ON f.doc_id = q.doc_id"""
