"""Periodic runs, Merkle manifest and source mixing against plain versions."""

import hashlib
import math
import random
import zlib

import pytest

from tickforge.llm import merkle, mixing, periodic_runs


def brute_runs(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, exponent * q) and not any(
                    w[i:i + size - p] == w[i + p:i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rnd):
    k, w = rnd.choice([1, 2, 2, 3, 5]), []
    for _ in range(rnd.randint(1, 4)):
        base = [rnd.randrange(k) for _ in range(rnd.randint(1, 12))]
        if rnd.random() < .5:
            base = base * rnd.randint(1, 4) + [9]
        w += base * rnd.randint(1, 7)
        w = w[:len(w) - rnd.randrange(3)]
    return w


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    for _ in range(800):
        w, exponent = random_words(rnd), rnd.choice([3, 4, 4, 5])
        runs = periodic_runs.find_runs(w, 6, exponent)
        assert runs == brute_runs(w, 6, exponent), w
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert periodic_runs.collapsed_words(w, runs) == [x for i, x in enumerate(w) if i not in gone]


def test_runs_so_far_are_known_after_every_word():
    rnd = random.Random(3)
    for _ in range(20):
        w, state = random_words(rnd), periodic_runs.RunDetector()
        for i, x in enumerate(w):
            state.extend([x])
            assert state.runs() == brute_runs(w[:i + 1])


def test_long_repetitions_take_no_quadratic_time():
    n = 60_000
    assert periodic_runs.find_runs([1] * n) == [(0, n, 1)]
    assert periodic_runs.find_runs([1] * n + [2] + [1] * n) == [(0, n, 1), (n + 1, n, 1)]
    assert (0, 50 * 1001, 1001) in periodic_runs.find_runs(([1] * 1000 + [2]) * 50)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.RunDetector(exponent=2)


def run_row(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_digests_equal_brute_force(spark):
    rnd = random.Random(2)
    texts = [rnd.choice([" ", "\t", " \n"]).join(f"é{x}" for x in random_words(rnd)) for _ in range(120)]
    rows = list(enumerate(texts)) + [(200, None), (201, ""), (202, " \x0b\n"), (3, texts[3]), (None, "a " * 12),
                                     (203, "  x y " * 5), (204, "long " * 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "'x' as best", "2 as id")
    got = sorted((tuple(r) for r in periodic_runs.run_digests(df).collect()), key=repr)
    assert got == sorted((run_row(*r) for r in rows), key=repr)
    assert any(r[1] > 1 for r in got)
    assert periodic_runs.run_digests(df.where("false")).count() == 0
    spans = periodic_runs.word_runs(df.where("doc_id = 204")).first()
    assert spans.collapsed == "long" and [tuple(r) for r in spans.runs] == [(0, 2000, 1)]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_levels(bottom):
    out = [bottom]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def brute_manifest(rows):
    def low(t):
        return t and t.translate({c: c + 32 for c in range(65, 91)})

    groups = {}
    for r in rows:
        text = r[4]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            text = low(text)
        groups.setdefault(r[1], []).append((r[0], leaf_hash(r), leaf_hash((*r[:4], text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x))
        trees.append(tree_levels([x[1] for x in groups[s]]))
    top = tree_levels([t[-1][0] for t in trees])
    root = top[-1][0]
    for k, s in enumerate(order):
        for i, (doc_id, leaf, now) in enumerate(groups[s]):
            proof = ""
            for levels, at in ((trees[k], i), (top, k)):
                for nodes in levels[:-1]:
                    run = nodes[at // 16 * 16:at // 16 * 16 + 16]
                    proof += "".join(run[:at % 16] + run[at % 16 + 1:])
                    run[at % 16] = now
                    now, at = h("".join(run)), at // 16
            yield doc_id, leaf, trees[k][-1][0], root, h(proof), now, now == root


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n_sources, n_rows", [(1, 1), (1, 40), (3, 700), (20, 120)])
def test_manifest_equals_brute_force(spark, n_sources, n_rows):
    rnd = random.Random(n_rows)
    rows = [(i, f"s{rnd.randrange(n_sources)}é"[: rnd.choice([3, 9])], rnd.choice(["en", None]), i, f"Text {i} ÄB")
            for i in rnd.sample(range(5 * n_rows), n_rows)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' as key", "1 as tree", "2 as leaf", "3 as n")
    got = {tuple(r) for r in merkle.verified(df).collect()}
    assert got == set(brute_manifest(rows)) and len(got) == n_rows


def test_manifest_of_odd_rows(spark, monkeypatch):
    rows = [(i, "hot", "en", 1, "A" * i) for i in range(90)]
    rows += [(5, None, None, None, None), (6, None, "de", 2, ""), (None, "hot", "en", 3, "Null ID"), (7, "", "x", 0, "Empty source"),
             (40, "hot", "en", 1, "A" * 40), (41, "hot", "en", 9, "B"), (1000, "lone", None, None, "Ü" * 100_000)]
    monkeypatch.setattr(merkle, "LEAF_BLOCK", 16)  # many blocks below one node
    got = sorted((tuple(r) for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(brute_manifest(rows), key=repr)
    assert {r[6] for r in got} == {True, False}
    book = merkle.build(spark.createDataFrame([("k", i, bytes([i]) * 32, bytes([i]) * 32) for i in range(20)],
                                              "key string, id long, leaf binary, claimed binary"))
    proof = {r.id: r for r in merkle.proofs(book).collect()}
    assert all(bytes(r.folded) == book.root for r in proof.values())
    assert bytes(proof[0].siblings)[:15 * 32] == b"".join(bytes([i]) * 32 for i in range(1, 16))
    assert len(proof[0].siblings) == 16 * 32 and len(proof[19].siblings) == 4 * 32
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_mix(rows, block, weights=(5, 2, 1), seed=13):
    import re
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    words = [sum(n for _, s, n in sized if s == name) for name in names]
    heft = [weights[k % len(weights)] for k in range(len(names))]
    total, capped = sum(words), set()
    while True:
        rest = sum(w for k, w in enumerate(heft) if k not in capped)
        if not rest:
            break
        each = (3 * total - 2 * sum(2 * words[k] for k in capped)) / (2.0 * rest)
        new = {k for k in range(len(names)) if 2 * words[k] < heft[k] * each}
        if new == capped:
            break
        capped = new
    goal = [float(2 * words[k]) if k in capped else each * heft[k] for k in range(len(names))]
    blocks = [math.ceil(n / block) for n in words]
    left = 3 * total - 2 * sum(2 * words[k] for k in capped)

    def highest(parties, seats):
        won = dict.fromkeys((p for p, _, _ in parties), 0)
        for _, p, _ in sorted((-v / (2 * j + 1), p, j) for p, v, most in parties for j in range(most))[:seats]:
            won[p] += 1
        return won
    quota = highest([(k, goal[k], 2 * blocks[k]) for k in range(len(names)) if k not in capped],
                    (left + block) // (2 * block))
    for k, name in enumerate(names):
        seats = 2 * blocks[k] if k in capped else quota[k]
        wide = math.ceil(math.sqrt(blocks[k])) or 1
        shards = {a // wide: range(a, min(a + wide, blocks[k])) for a in range(0, blocks[k], wide)}
        own = highest([(a, len(b), 2 * len(b)) for a, b in shards.items()], seats)
        times = {}
        for a, b in shards.items():
            order = sorted(b, key=lambda x: (hashlib.md5(f"{seed}:{k}:{x}".encode()).hexdigest(), x))
            for r, x in enumerate(order):
                times[x] = own[a] // len(b) + (r < own[a] % len(b))
        at = 0
        for i, _, n in sorted((r for r in sized if r[1] == name), key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
            yield i, n, words[k], goal[k], sum(times[x // block] for x in range(at, at + n))
            at += n


@pytest.mark.parametrize("sizes, block", [([400, 30, 900, 5], 4), ([50] * 12, 8), ([1, 2, 3], 32), ([5000], 16)])
def test_mix_equals_brute_force(spark, sizes, block):
    rnd = random.Random(len(sizes))
    rows, i = [], 0
    for k, n in enumerate(sizes):
        while n > 0:
            own = min(n, rnd.randint(0, 60))
            rows.append((i, None if k == 3 else f"s{k}", rnd.choice([" ", "\n\t"]).join(["w "] * own)))
            n, i = n - own, i + 1
    rows += [(i, "s0", None), (i, "s0", None), (None, "s0", "a b"), (0, "s0", "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr(
        "*", "1 as place", "'k' as key", "2 as size", "3 as pos", "4 as block")
    got = sorted((tuple(r) for r in mixing.mixed(df, block_words=block).collect()), key=repr)
    want = sorted(brute_mix(rows, block), key=repr)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert all(math.isclose(a[3], b[3]) for a, b in zip(got, want))
    assert all(0 <= r[4] <= 2 * r[1] for r in got)


def test_mix_comes_near_its_targets_and_is_stable(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = (sorted(map(tuple, mixing.mixed(d).collect())) for d in (df, df.repartition(7)))
    assert one == two
    taken = {}
    for _, _, words, goal, t in one:
        taken[words, goal] = taken.get((words, goal), 0) + t
    assert all(abs(t - goal) <= max(0.02 * goal, 64) for (_, goal), t in taken.items())
    assert mixing.mixed(df.where("false")).count() == 0
    assert mixing.mixed(df.selectExpr("doc_id", "source", "CAST(NULL AS STRING) AS text")).agg({"taken": "sum"}).first()[0] == 0
