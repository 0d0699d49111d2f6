"""Runs of repeated words by online dyadic square catching.

Words are appended one by one.  Whenever a block [l, l + m) of a power of two
m, l a multiple of m, is complete, a catcher starts on it: it compares the
words that follow with the words from l on and keeps the longest prefix of
words[l:] that ends the text, at a distance q of m to 2m - 1 from l.  A word
that differs moves the comparison to the next shorter prefix (its borders), so
each catcher takes O(m) steps and a text of n words O(n log n), whatever it
repeats.  When the prefix reaches q words, words[l:l+2q] is a square; it is
merged into the run of period q that is open, or opens one, which is extended
to the left at once and by each further word to the right.

A run of period q and at least 3q - 1 words is never missed: the catcher of
the largest m <= q whose block starts in its first period sees its square
words[l:l+2q] end, and no smaller distance can still match there, for then q
would not be the smallest period.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import CHUNK_BYTES, prepare

RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


class RunDetector:
    """Online state of one text: ``extend`` appends words, ``runs`` gives the
    maximal runs of the words so far, as (start, length, period)."""

    def __init__(self, least: int = 6, exponent: int = 4):
        if exponent < 3:
            raise ValueError("runs of fewer than three periods can be missed")
        self.least, self.exponent = least, exponent
        self.words: list = []
        self._closed: list[tuple[int, int, int]] = []
        self._open: dict[int, int] = {}       # period -> start of its run
        self._first: list = [None]            # by level: first word of the block that waits
        self._moving: list[list] = []         # catchers with a prefix of one word or more

    def _keeps(self, length: int, period: int) -> bool:
        return length >= self.least and length >= self.exponent * period

    def extend(self, more) -> None:
        words, first, moving, running = self.words, self._first, self._moving, self._open
        before = words[-1] if words else None
        t = len(words) - 1
        for x in more:
            t += 1
            words.append(x)
            if running:
                for q in [q for q in running if words[t - q] != x]:
                    start = running.pop(q)
                    if self._keeps(t - start, q):
                        self._closed.append((start, t - start, q))
            if x == before and 1 not in running:
                running[1] = t - 1
            before = x
            if moving:
                moving = [c for c in moving if self._advance(c, x, t)]
            if x in first:
                for k, w in enumerate(first):
                    if w == x and w is not None:
                        m = 1 << k
                        first[k] = None
                        moving.append([t // m * m - m, m, 1, [0], k])
                        self._square(moving[-1], t)
            if t & 1:
                size, k = 2, 1
                while not (t + 1) & (size - 1):
                    if k == len(first):
                        first.append(None)
                    first[k] = words[t + 1 - size]
                    size, k = 2 * size, k + 1
        self._moving = moving

    def _advance(self, catcher: list, x, t: int) -> bool:
        """One more word for a catcher; whether it goes on."""
        words = self.words
        l, m, j, border, k = catcher
        if t - l >= 4 * m:
            return False
        while words[l + j] != x:
            if j == 0:
                # nothing matches: it waits again while its distances last
                if t + 1 - l < 2 * m:
                    self._first[k] = words[l]
                return False
            while len(border) < j:
                i, b = len(border), border[-1]
                while b and words[l + b] != words[l + i]:
                    b = border[b - 1]
                border.append(b + (words[l + b] == words[l + i]))
            j = border[j - 1]
            if t - j - l >= 2 * m:
                return False
        catcher[2] = j + 1
        if 2 * (j + 1) == t + 1 - l:
            self._square(catcher, t)
        return True

    def _square(self, catcher: list, t: int) -> None:
        """Merge the square that ends at t, if the catcher holds one."""
        l, q = catcher[0], catcher[2]
        if 2 * q != t + 1 - l:
            return
        for p, start in self._open.items():
            if start <= l and q % p == 0:
                return  # part of an open run, of this or of a smaller period
        words, start = self.words, l
        while start and words[start - 1] == words[start - 1 + q]:
            start -= 1
        self._open[q] = start

    def runs(self) -> list[tuple[int, int, int]]:
        n = len(self.words)
        return sorted(self._closed + [(s, n - s, q) for q, s in self._open.items() if self._keeps(n - s, q)],
                      key=lambda r: (r[0], r[2]))


def find_runs(words: list, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """Maximal runs (start, length, period) by start, then period."""
    state = RunDetector(least, exponent)
    state.extend(words)
    return state.runs()


def collapsed_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words left when each run keeps only its first period."""
    kept, at = [], 0
    for low, high in sorted((s + q, s + n) for s, n, q in runs):
        if high > at:
            kept += words[at:max(at, low)]
            at = high
    return kept + words[at:]


def word_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_column: str = "doc_id",
              text_column: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """Per row: the id, n_words, runs (array of start, length, period by start,
    then period) and the collapsed text, its kept words joined by one space.

    Words are the bytes between ASCII white space, numbered from 0.
    ``rewrite(id, words)`` may alter a row's words before.  A null or empty
    text has no words and an empty collapsed text; null ids are kept; repeated
    rows give a row each; other columns play no part; an empty table gives an
    empty result.  A text is one row of one task, whole however long (time
    O(n log n), memory O(n) of it); nothing is shuffled."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import periodic_runs as op
        from tickforge.llm.common import chunks
        to = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in chunks(batches, "text", CHUNK_BYTES):
            counts, found, kept = [], [], []
            ids = batch.column("id").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                words = text.as_py().split()
                if rewrite is not None:
                    words = rewrite(ids[i], words)
                runs = op.find_runs(words, least, exponent)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                kept.append(b" ".join(op.collapsed_words(words, runs) if runs else words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(found, to),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    out = rows.mapInArrow(run, f"id {kind}, n_words long, runs {RUNS_TYPE}, collapsed string")
    return out.withColumnRenamed("id", id_column)


def planted(doc_id, words: list) -> list:
    """The repetition that op11's contract plants in every tenth document (by
    the checksum of its id); a null id has none."""
    import zlib
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests(docs: DataFrame) -> DataFrame:
    """op11's columns from ``word_runs``: n_runs, the strongest run, digests."""
    found = word_runs(docs, rewrite=planted)
    # greatest length / period, compared without rounding
    best = F.expr("""array_sort(runs, (a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period
        THEN CASE WHEN a.length * b.period > b.length * a.period THEN -1 ELSE 1 END
        WHEN a.start <> b.start THEN CASE WHEN a.start < b.start THEN -1 ELSE 1 END
        WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)""")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", F.try_element_at(best, F.lit(1))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
