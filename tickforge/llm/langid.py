"""Language spans by Viterbi over word scores.

A word's letters give its script; only languages seen in that script compete
for it.  Each candidate scores a word by its character n-grams; Viterbi with a
fixed cost for changing the language between words labels the spans of a text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import prepare, sampled

#: Ranges of scripts; fixed values of Unicode blocks.  Letters elsewhere: 0.
SCRIPTS = [
    (1, "Latin", 0x0041, 0x024F), (2, "Greek", 0x0370, 0x03FF), (3, "Cyrillic", 0x0400, 0x052F),
    (4, "Armenian", 0x0530, 0x058F), (5, "Hebrew", 0x0590, 0x05FF), (6, "Arabic", 0x0600, 0x06FF),
    (7, "Devanagari", 0x0900, 0x097F), (8, "Bengali", 0x0980, 0x09FF), (9, "Tamil", 0x0B80, 0x0BFF),
    (10, "Thai", 0x0E00, 0x0E7F), (11, "Georgian", 0x10A0, 0x10FF), (12, "Hangul", 0xAC00, 0xD7AF),
    (13, "Kana", 0x3040, 0x30FF), (14, "Han", 0x4E00, 0x9FFF),
]
#: Hashed n-grams; with the languages this bounds the size of a model.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTH = 0.5
#: Language numbers are 16-bit in the Viterbi tables.
MAX_LANGS = 1 << 15
#: Words of a text that one Viterbi pass covers; passes are joined exactly.
PIECE_WORDS = 256
CHUNK_BYTES = 2 << 20
CACHE_WORDS = 300_000


def script_of(codes: np.ndarray) -> np.ndarray:
    """Script number of each code point."""
    out = np.zeros(len(codes), np.int8)
    for number, _, low, high in SCRIPTS:
        out[(codes >= low) & (codes <= high)] = number
    return out


def ngrams(words: list[str]):
    """Hashed n-gram buckets of ``^word$`` and the index of each one's word."""
    marked = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    buckets, owners = [], []
    value = np.zeros(len(codes), np.uint64)
    for k in range(1, max(ORDERS) + 1):
        value = value[:len(codes) - k + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[k - 1:]
        if k in ORDERS:
            whole = owner[:len(value)] == owner[k - 1:]
            mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
            buckets.append((mixed >> np.uint64(48)).astype(np.int64)[whole] % BUCKETS)
            owners.append(owner[:len(value)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def word_pattern():
    import regex
    return regex.compile(r"\p{L}[\p{L}\p{M}]*")


def training_counts(texts, langs, keep: dict):
    """Add n-gram and script counts of texts to ``keep[lang]``."""
    rx = word_pattern()
    for text, lang in zip(texts, langs):
        words = rx.findall(text.lower())
        if not words:
            continue
        if lang not in keep:
            keep[lang] = (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64))
        bucket, _ = ngrams(words)
        keep[lang][0][:] += np.bincount(bucket, minlength=BUCKETS)
        firsts = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
        keep[lang][1][:] += np.bincount(script_of(firsts), minlength=len(SCRIPTS) + 1)


class Model:
    """Log probabilities of hashed n-grams and the scripts of each language."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        if len(langs) > MAX_LANGS:
            raise ValueError(f"{len(langs)} languages; at most {MAX_LANGS}")
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True) + SMOOTH * BUCKETS
        self.logp = np.log((counts + SMOOTH) / total).astype(np.float32)  # bucket x language
        self.allowed = scripts > 0  # script x language
        self.allowed[~self.allowed.any(axis=1)] = True  # a script never seen: any language

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): mean log probability of a word's n-grams, times
        its root length; languages without its script are ruled out."""
        bucket, owner = ngrams(words)
        order = np.argsort(owner, kind="stable")
        bucket, owner = bucket[order], owner[order]
        starts = np.searchsorted(owner, np.arange(len(words)))
        sums = np.add.reduceat(self.logp[bucket], starts, axis=0)
        sizes = np.diff(np.append(starts, len(owner)))[:, None].astype(np.float32)
        firsts = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
        scores = sums / np.sqrt(sizes)
        return np.where(self.allowed[script_of(firsts)], scores, np.float32(-1e6))


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float, piece: int = PIECE_WORDS) -> np.ndarray:
    """Best language of every word of texts with ``sizes`` words each.

    A text is cut into pieces; each is solved for every language it may be
    entered in, the pieces are chained by these totals, and each piece is read
    back from the language it ends in.  The result is that of one pass."""
    langs = scores.shape[1]
    kind = np.int8 if langs <= 128 else np.int16  # holds every language number; Model bounds them
    counts = -(-sizes // piece)
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), counts)
    first_piece = np.cumsum(counts) - counts
    begin = starts[text] + (np.arange(len(text)) - first_piece[text]) * piece
    length = np.minimum(piece, (starts + sizes)[text] - begin)
    order = np.argsort(-length, kind="stable")  # pieces still running stay in front
    begin, length = begin[order], length[order]
    p = len(begin)
    steps = int(length[0]) if p else 0
    running = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
    grid = np.arange(langs)
    # value[piece, entered in, now in]; entering costs nothing here
    value = np.full((p, langs, langs), -np.inf, np.float64)
    value[:, grid, grid] = scores[begin]
    back = np.empty((steps, p, langs, langs), kind) if p else np.empty((0, 0, langs, langs), kind)
    for t in range(1, steps):
        n = running[t]
        v = value[:n]
        best = v.argmax(axis=2)
        top = np.take_along_axis(v, best[:, :, None], 2) - penalty
        stay = v >= top
        back[t, :n] = np.where(stay, grid, best[:, :, None])
        value[:n] = np.where(stay, v, top) + scores[begin[:n] + t][:, None, :]
    place = np.empty(p, np.int64)
    place[order] = np.arange(p)
    labels = np.empty(len(scores), kind)
    change = np.where(np.eye(langs, dtype=bool), 0.0, penalty)
    # chain the pieces of each text, all texts together
    entered = np.zeros(p, kind)
    left = np.zeros(p, kind)
    rounds = int(counts.max()) if len(counts) else 0
    # total[text, now in]; choice per round: language the piece was entered in and the one before
    total = np.zeros((len(sizes), langs))
    enter = np.zeros((rounds, len(sizes), langs), kind)
    before = np.zeros((rounds, len(sizes), langs), kind)
    for r in range(rounds):
        on = np.flatnonzero(counts > r)
        table = value[place[first_piece[on] + r]]  # text x entered x now
        if r:
            came = total[on][:, :, None] - change
            before[r, on] = came.argmax(axis=1)
            start = came.max(axis=1)
        else:
            start = np.zeros((len(on), langs))
        whole = start[:, :, None] + table
        enter[r, on] = whole.argmax(axis=1)
        total[on] = whole.max(axis=1)
    now = total.argmax(axis=1).astype(kind)
    for r in range(rounds - 1, -1, -1):
        on = np.flatnonzero(counts > r)
        at = place[first_piece[on] + r]
        left[at] = now[on]
        entered[at] = enter[r, on, now[on]]
        now[on] = before[r, on, entered[at]] if r else now[on]
    state = left.astype(np.int64)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        labels[begin[:n] + t] = state[:n]
        if t:
            state[:n] = back[t, np.arange(n), entered[:n], state[:n]]
    return labels


class Labeller:
    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self.rx = word_pattern()
        self.index: dict[str, int] = {}
        self.rows = np.empty((0, len(model.langs)), np.float32)

    def label(self, texts: list):
        """For each text its spans [(first word, words, letters, language)]."""
        found = [self.rx.findall((t or "").lower()) for t in texts]
        flat = [w for words in found for w in words]
        if not flat or not self.model.langs:
            return [[] for _ in texts]
        if len(self.index) > CACHE_WORDS:
            self.index, self.rows = {}, self.rows[:0]
        new = list(set(flat).difference(self.index))
        if new:
            self.index.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate([self.rows, self.model.word_scores(new)])
        scores = self.rows[np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))]
        letters = np.fromiter(map(len, flat), np.int64, len(flat))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        some = np.flatnonzero(sizes)
        labels = viterbi(scores, sizes[some], self.penalty)
        text = np.repeat(np.arange(len(found)), sizes)
        first = np.flatnonzero(np.append(True, (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])))
        ends = np.append(first[1:], len(flat))
        held = np.add.reduceat(letters, first)
        starts = np.cumsum(sizes) - sizes
        out = [[] for _ in texts]
        for a, b, n in zip(first.tolist(), ends.tolist(), held.tolist()):
            i = int(text[a])
            out[i].append((a - int(starts[i]), b - a, n, self.model.langs[labels[a]]))
        return out


def train(docs: DataFrame, labelled, max_texts: int = 20_000, id_column: str = "doc_id",
          text_column: str = "text", lang_column: str = "lang") -> Model:
    """Fit a model on a sample of about ``max_texts`` whole texts of the rows
    with a text and a language for which ``labelled`` holds.

    The sample is drawn by a hash of the id, over all of the table; only the
    counts of BUCKETS n-grams for each language come to the driver."""
    prepare(docs.sparkSession)
    rows = sampled(docs.where(labelled & F.col(text_column).isNotNull() & F.col(lang_column).isNotNull()).select(
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang"), F.col(id_column).alias("id")), "id", max_texts)

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import langid as op
        from tickforge.llm.common import chunks
        keep: dict = {}
        for batch in chunks(batches, "text", op.CHUNK_BYTES):
            op.training_counts(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), keep)
        for lang, (grams, scripts) in keep.items():
            for kind, counts in ((0, grams), (1, scripts)):
                at = counts.nonzero()[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.int32()),
                     pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
                    names=["lang", "kind", "slot", "n"])

    counts = rows.select("text", "lang").mapInArrow(run, "lang string, kind int, slot long, n long")
    table = counts.groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique())
    number = {lang: i for i, lang in enumerate(langs)}
    grams = np.zeros((BUCKETS, len(langs)), np.int64)
    scripts = np.zeros((len(SCRIPTS) + 1, len(langs)), np.int64)
    for lang, kind, slot, n in zip(table["lang"], table["kind"], table["slot"], table["n"]):
        (grams if kind == 0 else scripts)[slot, number[lang]] = n
    return Model(langs, grams, scripts)


def label_spans(docs: DataFrame, model: Model, penalty: float = 6.0, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans): ``spans`` are (first word, words,
    letters, lang) of the whole text in order; lang_pred is the language with
    most letters (ties: the first by name), score its share of the letters.

    A null text, one without a letter, and every text under a model without
    languages, is `und` with score 0 and no spans.  Null ids and repeated rows
    are kept; an empty table gives an empty result.  No shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.logp, model.allowed))
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import langid as op
        from tickforge.llm.common import chunks, trim
        known = op.Model.__new__(op.Model)
        known.langs, known.logp, known.allowed = shared.value
        labeller = op.Labeller(known, penalty)
        span = pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("letters", pa.int64()),
                          ("lang", pa.string())])
        for batch in chunks(batches, "text", op.CHUNK_BYTES):
            spans = labeller.label(batch.column("text").to_pylist())
            best, share = zip(*map(op.verdict, spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(best), pa.array(share, pa.float64()),
                 pa.array([[dict(zip(("first_word", "words", "letters", "lang"), s)) for s in x]
                           for x in spans], pa.list_(span))],
                names=["doc_id", "lang_pred", "score", "spans"])
        trim()

    out = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, "
                          "spans array<struct<first_word long, words long, letters long, lang string>>")
    return out.withColumnRenamed("doc_id", id_column)


def accepted(docs: DataFrame, model: Model, penalty: float = 6.0, min_score: float = 0.5,
             text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text has a letter and a
    language that holds at least ``min_score`` of its letters.  Null and empty
    texts are rejected; repeated rows are judged alike.  No shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.logp, model.allowed))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import langid as op
        from tickforge.llm.common import chunks, trim
        known = op.Model.__new__(op.Model)
        known.langs, known.logp, known.allowed = shared.value
        labeller = op.Labeller(known, penalty)
        for batch in chunks(batches, text_column, op.CHUNK_BYTES):
            found = [op.verdict(x) for x in labeller.label(batch.column(text_column).to_pylist())]
            yield batch.filter(pa.array([lang != "und" and score >= min_score for lang, score in found]))
        trim()

    return docs.mapInArrow(run, docs.schema)


def verdict(spans) -> tuple[str, float]:
    """The language of most letters and its share of them."""
    held: dict[str, int] = {}
    for _, _, letters, lang in spans:
        held[lang] = held.get(lang, 0) + letters
    if not held:
        return "und", 0.0
    best = min(held, key=lambda lang: (-held[lang], lang))
    return best, held[best] / sum(held.values())


def held_out(id_column: str = "doc_id"):
    """Rows whose crc32 of the id as text is divisible by 5; a null id: no."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predictions(docs: DataFrame, max_texts: int = 20_000, penalty: float = 6.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learnt from rows not held out."""
    model = train(docs, ~held_out() & F.col("doc_id").isNotNull(), max_texts)
    return label_spans(docs, model, penalty).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
