"""Token counts, byte-level BPE, language ID, license scan, main text."""

import base64
import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest

from tickforge.llm import bpe, html_text, langid, licenses, token_counts

TEXTS = ["", None, "aaaaaaaaaa bbb<|endoftext|>x <|endoftext|>", "Hello world's  end\n\n 123 ÄÖ",
         "日本語 ՘ ၀ 𝟘 　 x ́e", " " * 700 + "a" * 600, "tab\t\r\n\x85   x", "Hello world's  end\n\n 123 ÄÖ"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(None, "x y", "clash", 7), (3, TEXTS[3], "clash", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, key long")


def test_token_counts_match_the_library(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = token_counts.token_counts(texts, public_tokenizers.path("byte_bpe_50k.json"), limit=5).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids))
            for r in texts.collect()]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in out))) == sorted(map(str, want))
    assert all(r.over_limit == (r.n_tokens > 5) for r in out)


def encoding():
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library_and_round_trips(texts):
    enc = encoding()
    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode(texts, *args)
    rows = bpe.decode(encoded, *args).collect()
    by_id = {r.doc_id: r.text or "" for r in texts.collect()}
    for r in rows:
        ids = enc.encode_ordinary(by_id[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert bytes(r.decoded) == by_id[r.doc_id].encode()
    for r in bpe.digests(texts, *args).collect():
        assert r.decoded_sha256 == hashlib.sha256(by_id[r.doc_id].encode()).hexdigest()


def test_empty_tables(spark, texts):
    none = texts.where("false")
    assert token_counts.token_counts(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert bpe.digests(none, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert licenses.license_scan(none).count() == 0


def test_viterbi_equals_one_pass():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n_lang, sizes = int(rng.integers(1, 5)), rng.integers(1, 23, int(rng.integers(1, 6)))
        scores, cost = rng.normal(size=(sizes.sum(), n_lang)) * 2, float(rng.uniform(.1, 3))
        got = langid.viterbi(scores, sizes, cost, piece=int(rng.integers(1, 8)))
        at = 0
        for n in sizes:
            q, path = scores[at:at + n], got[at:at + n]
            best = q[0].copy()
            for w in range(1, n):
                best = (best[:, None] - cost * (1 - np.eye(n_lang))).max(0) + q[w]
            value = sum(q[i, path[i]] for i in range(n)) - cost * (path[1:] != path[:-1]).sum()
            assert abs(value - best.max()) < 1e-9
            at += n


@pytest.mark.parametrize("n_lang", [128, 129, 300])
def test_viterbi_of_many_languages(n_lang):
    path = np.repeat([n_lang - 1, 0, n_lang - 2, 126], 5)
    scores = np.where(np.arange(n_lang) == path[:, None], 0.0, -9.0)
    assert langid.viterbi(scores, np.array([12, 8]), 1.0, piece=3).tolist() == path.tolist()


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**9, None, "en"), (10**9 + 1, "", None), (10**9 + 2, "12 34 !", "fr"),
                                 (None, "the and of", None)], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in langid.predictions(docs.select("doc_id", "text", "lang").union(odd)).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if out[i].held_out]
    assert len(held) > 100 and np.mean([out[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(out[10**9 + k].lang_pred == "und" and out[10**9 + k].score == 0 for k in range(3))
    assert out[None].held_out is False


def test_samples_of_large_tables_are_not_empty(spark):
    from pyspark.sql import functions as F

    from tickforge.llm.common import sampled
    rows = spark.range(3_000_000).selectExpr("id as doc_id", "'the and of' as text", "'en' as lang", "id as page_id",
                                             "'<article><p class=\"zebra\">One two.</p></article>' as html")
    assert langid.train(rows, F.lit(True), max_texts=2).langs == ["en"]
    assert "class zebra" in html_text.train(rows, max_pages=2).emit
    assert abs(sampled(rows, "doc_id", 2_000).count() - 2_000) < 250
    assert sampled(rows, "lang", 5).count() == 3_000_000 and sampled(rows.limit(4), "doc_id", 5).count() == 4
    assert sampled(rows.where("false"), "doc_id", 5).count() == 0


def test_mixed_language_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    pick = {r.lang: r.text for r in docs.where("n_chars > 1500 and n_chars < 4000").select("lang", "text").collect()}
    words = {k: v.split()[:60] for k, v in pick.items()}
    mixed = " ".join(words["en"] + words["de"])
    labeller = langid.Labeller(model, 6.0)
    spans = labeller.label([mixed])[0]
    assert [s[3] for s in spans][0] == "en" and spans[-1][3] == "de"
    assert sum(s[1] for s in spans) == len(labeller.rx.findall(mixed.lower()))


def test_license_places_and_labels(spark):
    rows = [(1, "CC BY cc by-cc BY. All rights reserved"), (2, None), (3, "ccby license"), (None, "Released under the MIT License."),
            (4, "x. Licensed under the Apache License, Version 2.0!\nGeneral PUBLIC license"), (4, "x. Licensed under the Apache License, Version 2.0!\nGeneral PUBLIC license"),
            (5, "released under the BSD License")]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: tuple(r)[1:] for r in out}
    assert len(out) == len(rows)
    assert got[1] == (9, 4, 0, 6, "cc-by,reserved", "cc-by,reserved", 1.0)
    assert got[2] == (0, 0, None, None, "", "", 0.0)
    assert got[3][1:] == (0, None, None, "", "", 0.0)
    assert got[None][-2:] == ("mit", 1.0)
    assert got[4][4:] == ("gpl", "apache-2.0,gpl", 1.0)
    assert got[5][-2:] == ("", 0.0)


def test_license_templates_contain_their_own_text(spark):
    rows, want = [], {}
    for text, label in licenses.TEMPLATES.items():
        half = text.count(" ") // 2
        for form in (text, text.replace(" ", "\n"), " * " + text.replace(" ", "\n * "), text.replace(". ", ".\n\n"),
                     "\r\n".join([" ".join(text.split(" ")[:half]), " ".join(text.split(" ")[half:])])):
            for place in (form, f"Some words here. {form}.\nMore of them; and more.", f"A title\n\n{form}\n\nthe end"):
                want[len(rows)] = label
                rows.append((len(rows), place))
    rows += [(-1, "2. Licensed under the GNU General Public License,\nversion 3."), (-2, "Released under. The MIT.\nLicense"),
             (-3, "Released under the\n\nMIT License"), (-4, "Copyright 2024 by A. Smith, Inc. All rights\nreserved. No part of this "
              "book may be\nreproduced, in any form, without written\npermission."),
             (-5, "Copyright. All rights reserved. One. Two. No part may be. Reproduced without permission")]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, label in want.items():
        assert label in got[i].labels.split(",") and got[i].score == 1.0, rows[i]
    assert got[-1].labels == "gpl,gpl-3.0" and got[-2].labels == got[-3].labels == ""
    assert got[-4].labels == "no-reproduction,reserved" and got[-5].labels == "reserved"


def test_main_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    field = html_text.train(pages)
    extra = spark.createDataFrame([(-1, "u", None), (-2, "u", ""), (-3, "u", "no tags &amp; all")],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in html_text.main_texts(pages.union(extra), field).collect()}
    for r in pages.collect():
        want = "\n".join(b[0] for b in html_text.blocks_of(r.html) if any(t == "article" for t, _ in b[1]))
        assert out[r.page_id].text == want and out[r.page_id].n_chars == len(want)
    assert out[-1].text == out[-2].text == ""
    other = ('<body><header><h1>Site</h1></header><nav><a>x</a></nav><article><h1>A title</h1><p>One&nbsp;two\n three.</p>'
             '<div class="ad">Buy it now.</div><p>Five <b>six.<br></p><div class="comments"><p>Nice one, thanks.</p></div>'
             '</article><aside><p>Side text is here.</p></aside><div class="cookie notice">We use cookies.</div><footer>x</footer>')
    assert field.main_text(other) == "A title\nOne two three.\nFive six."


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><svg viewBox='0 0 1 1'/><p>b</p><svg><text>x</text></svg><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><svg /><p>b</p>", ["a", "b"]),
    *((f"<p>a</p><{tag}><p>b</p><{tag}>x</{tag}><p>c</p>", ["a", "b", "c"]) for tag in ("svg", "noscript", "template", "select")),
    *((f"<p>a</p><{tag}><p>b</p>", ["a", "b"]) for tag in ("svg", "noscript", "template", "select")),
    *((f"<p>a</p><{tag}>x<{tag}>y</{tag}>z</{tag.upper()} ><p>b</p>", ["a", "b"]) for tag in ("svg", "template")),
    ("<p>a</p><template><!-- <template> --><script>'<template>'</script>x</template><p>b</p>", ["a", "b"]),
    ("<p>" + "\u0130" * 12 + "</p><script>x</SCRIPT><p>Istanbul</p><style>y</style><p>c</p>", ["\u0130" * 12, "Istanbul", "c"]),
    ("<p>a</p><script>x</scripts>'<p>y</p>'</script><p>b</p><script>x", ["a", "b"]),
])
def test_no_text_after_raw_elements_is_lost(page, want):
    assert [b[0] for b in html_text.blocks_of(page)] == want


def test_decoding_is_the_best_labelling():
    import itertools
    field = html_text.Field({"any": 0.3, "words 1": -0.9, "ends stop": 0.5}, [[0.4, -0.7], [-0.2, 0.6]], [0.1, -0.3])
    blocks = [(t, (), 0.0, False) for t in ("One.", "two", "Three four five.", "x", "y z w q.", "end")]
    scores = field.scores(blocks)

    def value(path):
        return field.start[path[0]] + sum(s for s, y in zip(scores, path) if y) + sum(
            field.move[a][b] for a, b in zip(path, path[1:]))
    best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
    assert list(map(int, field.decode(blocks))) == list(best)


def test_long_words_are_contracted_as_the_library_does():
    import base64
    import random

    import numpy as np
    import public_tokenizers
    import tiktoken

    from tickforge.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.Codec(path, public_tokenizers.PATTERN)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("long", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(5)
    words = ["a" * 1001, "ab" * 700, "-" * 5000, "\u00e9" * 300 + "x" * 99,
             "".join(r.choice("etaoinshrdlu") for _ in range(2500)),
             "".join(r.choice(["ing", "the", "ab", "aba"]) for _ in range(500))]
    keep = bpe.STEP_ROWS
    try:
        for bpe.STEP_ROWS in (keep, 5000):  # one pass, several passes
            for w in words:
                text = f"so {w} on"
                assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)
    finally:
        bpe.STEP_ROWS = keep


def test_words_that_come_again_are_encoded_once_though_the_cache_is_full(monkeypatch):
    own = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library, asked, encode_words = encoding(), [], own.encode_words
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 40)
    monkeypatch.setattr(own, "encode_words", lambda words: asked.extend(words) or encode_words(words))
    for k in range(6):
        once = ["once" + chr(97 + k) + chr(97 + i % 26) * (i // 26 + 1) for i in range(10 if k == 1 else 35)]
        text = " ".join([f"often{chr(97 + i)}" for i in range(20 * (k > 0))] + once)
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)
        assert len(own.cache) <= 40
    often = [w for w in asked if "often" in w]
    assert len(asked) > 100 and len(often) == len(set(often))


def test_a_chunk_of_many_fairly_long_words_fits_the_memory_limit():
    import random
    r = random.Random(1)
    text = " ".join("".join(r.choice("etaoinshrdlu") for _ in range(250)) for _ in range(1100))
    own = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = np.frombuffer(own.encode([text])[0], "<u4")
    assert ids.tolist() == encoding().encode_ordinary(text)
    # slices that end within the text, ids of no text, an id outside the vocabulary
    assert own.decode([ids[:0], ids, ids[:3], np.array([1 << 31], "<u4")], at_once=1000) == [
        b"", text.encode(), encoding().decode_bytes(ids[:3].tolist()), b""]
