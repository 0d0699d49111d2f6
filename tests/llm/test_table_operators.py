"""Top-k, suffix dedup, decontamination, WARC, SimHash and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tickforge.llm import decontam, simhash, suffix_dedup, topk, warc
from tickforge.session import scratch_path


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(2)]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6),
             (None, [1.0] * 6), (400, [1.0, 2.0]), (310, [0.0] * 6), (320, [1e17] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    got = topk.exact_top_k(df, lambda i: i % 10 == 0, k=7, block_rows=32, query_rows=4).collect()
    ok = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q, v in ok.items():
        if q % 10 == 0:
            scored = sorted(((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -2**63), i) for i, w in ok.items() if i != q and len(w) == len(v)))
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:7])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.exact_top_k(df.where("false"), lambda i: i % 10 == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    rows = rng.integers(-50, 50, (4000, 2))
    rows[:20] += 500
    _, _, scored = topk.Block(np.arange(4000), rows).top(-1, np.array([3, 2]), 5)
    assert scored < 400


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    for r in raw:
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if count[r[p:p + length]] > 1:
                gone[p:p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield len(r), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()


def brute_kept(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    for r in raw:
        gone = set()
        for p in range(len(r) - length + 1):
            if count[r[p:p + length]] > 1:
                gone.update(range(p, p + length))
        yield bytes(b for i, b in enumerate(r) if i not in gone).decode("utf-8", "ignore")


def passages(seed=3, n=70):
    rnd = random.Random(seed)

    def para(k):
        return " ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(k))
    shared = [para(40) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(shared)
            parts.append(para(rnd.randint(1, 60)) if rnd.random() < .5 else p[rnd.randint(0, 60):rnd.randint(60, len(p))])
        texts.append(rnd.choice(["", " ", "x"]).join(parts))
    return texts + [texts[3], texts[5], texts[5], None, "", "a" * 300, "b" * 90 + "c" * 300, "ab" * 200, shared[0] * 2]


@pytest.mark.parametrize("length", [40, 100])
def test_repeated_bytes_equal_brute_force(spark, length):
    texts = passages()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'k' as key", "1 as low")
    rows = suffix_dedup.repeated_bytes(df, length).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == dict(enumerate(brute_repeats(texts, length)))
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(brute_kept(texts, length)))
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(df, length).collect()}
    assert cut[texts.index(None)] is None and cut[texts.index("a" * 300)] == ""


def test_repeated_bytes_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.repeated_bytes(df).count() == 0


def test_quicksort_orders_all_tokens():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 9, (9000, 2))
    assert (keys[suffix_dedup.multikey_quicksort(keys)] == keys[np.lexsort(keys.T[::-1])]).all()


def brute_leaks(docs, items, words):
    """Every document's best window for every item it holds."""
    def shingles(ws, k):
        return [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)]
    for d, text in docs:
        ws = words(text)
        for item, own in items:
            iw = words(own)
            k = min(5, len(iw))
            if not k:
                continue
            a, b = shingles(ws, k), shingles(iw, k)
            width = min(len(a), len(b))
            if not width or len(set(a) & set(b)) < 0.5 * len(set(b)):
                continue
            best = max(((lambda n: n / (width + len(b) - n))(sum((Counter(a[s:s + width]) & Counter(b)).values())), -s)
                       for s in range(len(a) - width + 1))
            if best[0] >= 0.8:
                yield d, item, -best[1], width + k - 1, best[0]


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(5)
    word = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choices(word, k=rnd.randint(12, 30)))) for i in range(8)] + [(8, "one two"), (9, None), (10, "")]
    docs = []
    for i in range(40):
        body = rnd.choices(word, k=rnd.randint(0, 40))
        if i % 2:
            leak = items[rnd.randrange(8)][1].split()
            for _ in range(rnd.randint(0, 3)):
                leak[rnd.randrange(len(leak))] = "zzz"
            at = rnd.randint(0, len(body))
            body[at:at] = leak + (leak if i % 6 == 1 else [])
        docs.append((i, ", ".join(body)))
    docs += [(40, "ONE, two"), (41, None), (42, ""), (43, items[0][1].upper()), (43, items[0][1].upper()), (None, items[1][1])]

    want = set(brute_leaks(docs, items, lambda t: (t or "").lower().replace(",", "").split()))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "2 as words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(df, bench).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) + 1
    assert decontam.clean(df, bench).count() == len(docs) - len(got)
    assert decontam.contaminated(df, bench.where("false")).count() == 0


def test_borderline_window_with_a_far_fingerprint_is_found(spark):
    rnd = random.Random(2721)  # fingerprints 21 bits apart, 40 of 45 shingles shared
    own = [f"w{rnd.randrange(10**6)}" for _ in range(49)]
    text = own[:24] + ["changed"] + own[25:]
    docs = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(own))], "item_id long, text string")
    assert [tuple(r) for r in decontam.contaminated(docs, bench).collect()] == [(1, 7, 0, 49, 0.8)]
    assert decontam.contaminated(docs, bench, radius=20).count() == 0


def test_warc_round_trip_over_small_ranges(spark):
    rnd = random.Random(1)
    noise = "".join(chr(rnd.randint(32, 0x2FF)) for _ in range(30_000))
    rows = [(i, f"http://x/{i}\n", f"<p>{i % 7}</p>" + noise[: 50 * (i % 7)]) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", noise), (None, "n", "only here"), (103, "u", "x" * (17 << 20))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'d' as digest", "1 as block")
    path = scratch_path(spark, f"test-warc-{random.random()}")
    warc.write_warc(df.repartition(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = {r.page_id: r for r in warc.read_warc(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(rows)
    first = {}
    for i, _, body in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (body or "").encode()
        r = got[i]
        assert r.payload_bytes == len(raw)
        home = first.setdefault(raw, i)
        assert (r.record_type, r.refers_to) == (("response", None) if home == i else ("revisit", home))
        assert r.payload is None if home != i else bytes(r.payload) == raw
    assert got[None].record_type == "response"


def test_warc_pieces_with_the_magic_inside():
    import zlib
    inner = b"<p>" + warc.MAGIC * 3 + b"</p>"

    class Stored:
        pass
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the magic stays visible
    head = (b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:x>\r\nWARC-Payload-Digest: sha1:A\r\n"
            b"X-Page-Id: 5\r\nContent-Length: %d\r\n\r\n")
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n" + inner
    raw = head % len(block) + block + b"\r\n\r\n"
    one = packer.compress(raw) + packer.flush()
    pieces = (one + one).split(warc.MAGIC)[1:]
    assert len(pieces) == 8
    assert [r["page_id"] for r in warc.scan([("f", 0, b"")] + [("f", 0, p) for p in pieces], True)] == [5, 5]
    edges = []
    for block_no, part in enumerate((pieces[:2], pieces[2:6], pieces[6:])):
        edges += list(warc.scan([("f", block_no, p) for p in part], True))
    whole = [e for e in edges if "page_id" in e]
    left = [e["fragment"] for e in edges if "fragment" in e]
    assert len(whole) + len(list(warc.stitch(left, True))) == 2


def brute_simhash(text):
    import xxhash
    ws = (text or "").encode().lower().split()
    sh = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_texts(seed=4, n=60):
    rnd = random.Random(seed)
    base = [" ".join(f"t{rnd.randint(0, 500)}" for _ in range(rnd.randint(0, 300))) for _ in range(n)]
    for i in range(25):
        ws = base[i % 6].split() or ["q"]
        ws[rnd.randrange(len(ws))] = "new"
        base.append(" ".join(ws))
    return base + [base[0], base[0].upper(), None, "", " \n", "one two", "One\ttwo"]


def test_simhash_components_equal_brute_force(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as fp", "2 as n")
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in simhash.near_duplicates(df, radius=8, tile_rows=16).collect()}
    prints = [brute_simhash(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 8:
                    label[i] = label[j] = min(label[i], label[j])
    assert got == {i: (f"{p:016x}", label[i]) for i, p in enumerate(prints)}
    assert simhash.near_duplicates(df.where("false")).count() == 0
    kept = simhash.one_per_group(df.union(df), radius=8)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    out = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in out} == {(i, 0) for i in range(1, 201)} | {(501, 500)}


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage's ids and texts against plain versions, on documents with
    languages, copies, passages and leaks of each kind."""
    import re

    import corpus_pipeline
    import tiktoken
    from tickforge.llm import langid
    rnd = random.Random(8)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(90)
    rows = [tuple(r) for r in docs.collect()]
    items = [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    prose = [r[1] for r in rows if r[1] and len(r[1].split()) > 80]
    passage = " ".join(prose[0].split()[:55])
    extra = [prose[1] + " " + passage, passage + " " + prose[2], prose[3], prose[3], prose[4].upper(),
             prose[5] + " " + items[0][1], None, "", "12 34 ... 56", prose[6] * 3]
    columns = docs.columns
    assert columns[:2] == ["doc_id", "text"]
    rows += [(10_000 + i, t, *rows[0][2:-1], 0) for i, t in enumerate(extra)] + [(None, prose[7], *rows[0][2:])] + [rows[5]]
    rnd.shuffle(rows)
    now = spark.createDataFrame(rows, docs.schema)

    def texts(df):
        return Counter((r["doc_id"], r["text"]) for r in df.collect())

    stages = dict(corpus_pipeline.STAGES)
    saved = corpus_pipeline.saved
    # one: the language of most letters, by a one-pass Viterbi, holds half of them
    model = langid.train(now, ~langid.held_out() & now.doc_id.isNotNull())
    rx = langid.word_pattern()

    def accepted(text):
        words = rx.findall((text or "").lower())
        if not words:
            return False
        scores = model.word_scores(words).astype(float)
        value, back = scores[0].copy(), []
        for s in scores[1:]:
            top = value.max() - 6.0
            back.append(np.where(value >= top, np.arange(len(value)), value.argmax()))
            value = np.maximum(value, top) + s
        at = int(value.argmax())
        held = Counter({model.langs[at]: len(words[-1])})
        for k in range(len(words) - 2, -1, -1):
            at = int(back[k][at])
            held[model.langs[at]] += len(words[k])
        return max(held.values()) >= 0.5 * sum(held.values())
    one = saved(stages["language_id"](spark, now, sf), "test")
    assert one.columns == columns
    assert texts(one) == Counter((r[0], r[1]) for r in rows if accepted(r[1]))
    # two: the smallest id of each group of fingerprints
    before = [tuple(r) for r in one.collect()]
    prints = [brute_simhash(r[1]) for r in before]
    label = list(range(len(before)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if label[i] > label[j] and (a ^ b).bit_count() <= 3:
                    label[i], changed = label[j], True
    groups = {}
    for r, k in zip(before, label):
        groups.setdefault(k, []).append(r)
    two = saved(stages["simhash_near_dedup"](spark, one, sf), "test")
    known = {(r[0], r[1]) for r in before}
    left = texts(two)
    assert two.columns == columns and sum(left.values()) == len(groups) and set(left) <= known
    for members in groups.values():
        ids = [r[0] for r in members if r[0] is not None]
        if ids:
            assert sum(left[r[0], r[1]] for r in set(members)) == 1 and (
                min(ids) in {d for d, _ in left if d in ids})
    # three: no repeated string of that length, all else as it was
    before = [tuple(r) for r in two.collect()]
    three = saved(stages["suffix_array_dedup"](spark, two, sf), "test")
    kept = list(brute_kept([r[1] for r in before], corpus_pipeline.PASSAGE_BYTES))
    assert three.columns == columns and texts(three) == Counter((r[0], t) for r, t in zip(before, kept))
    assert all(passage not in (t or "") for _, t in texts(three))
    # four: documents that hold an item go
    before = [tuple(r) for r in three.collect()]
    found = {d for d, *_ in brute_leaks(
        list(enumerate(r[1] for r in before)), items, lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))}
    four = saved(stages["benchmark_decontamination"](spark, three, sf), "test")
    assert four.columns == columns and texts(four) == Counter((r[0], r[1]) for i, r in enumerate(before) if i not in found)
    # five: tiktoken's ids, and the text again
    import base64

    import public_tokenizers as P
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in four.collect():
        ids = coder.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in stages["byte_bpe"](spark, four, sf).collect()) == want


def test_pipeline_runs_on_an_empty_and_a_whole_table(spark, tmp_path):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert 0 < corpus_pipeline.run(spark, sf).count() <= docs.count()
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
