"""Main text of web pages: a linear-chain conditional random field over the
leaf blocks of the document tree.

A page is read into blocks of text with their ancestor tags, class words and
links.  Emission weights of ancestor-tag and text features and transition
weights are fitted to labelled pages by gradient ascent on the conditional
likelihood; Viterbi decodes which blocks are main text.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import CHUNK_BYTES, prepare, sampled

LEXER = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
#: Content that is never text.
RAW = {"script", "style", "template", "noscript", "textarea", "svg", "select"}
#: Of these, elements of their own; one that is never closed hides its tag only.
#: An unclosed script, style or textarea runs to the end of the page.
NESTED = {"template", "noscript", "svg", "select"}
CLOSING = {tag: re.compile(rf"</{tag}(?![a-z0-9:-])", re.I | re.A) for tag in RAW - NESTED}
NESTED_LEXER = re.compile(
    r"<!--|<(/?)(template|noscript|svg|select|script|style)(?![a-z0-9:-])((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.I | re.A)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Tags inside a block of text; all others begin and end blocks.
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "br", "img"}
#: Closed by the next tag of the same kind.
REPEATS = {"li", "p", "tr", "td", "th", "dt", "dd", "option"}

#: Labelled pages; blocks inside elements marked with an asterisk are main text.
LABELLED = [
    '<head><title>T of it</title></head><body><header><h2>Daily news</h2><p>All the news for you.</p></header>'
    '<nav><ul><li><a>Home</a></li><li><a>World</a></li></ul></nav><div class="cookie notice"><p>We use cookies here. '
    'Do you accept this?</p></div><main><article><h1 *>One day in May</h1><p *>It was a long day, and the sun was up.</p>'
    '<div class="ad"><p>Buy now, and save.</p></div><p *>Then all of them went home again, as before.</p><ul><li *>The '
    'first of them.</li><li *>The second one.</li></ul><section class="comments"><h3>Comments</h3><p>I like this text '
    'a lot, thank you.</p><p>So do I.</p></section></article></main><aside class="sidebar"><h3>More</h3><p>Read this '
    'as well, it is good.</p></aside><form><label>Your mail</label><p>Sign up for our letter.</p></form>'
    '<footer><p>&copy; 2024 Daily news. All rights reserved.</p></footer></body>',
    '<body><div id="menu"><a>Start</a> <a>Shop</a> <a>About us</a></div><div class="banner promo">Now at half the '
    'price for you.</div><div class="content"><h1 *>A short note</h1><div *>Some say that it never rains there.</div>'
    '<blockquote *>It does, said the other man.</blockquote><p *>Both were right, of course.</p></div>'
    '<div class="related"><h4>Related</h4><p><a>Another note</a></p></div><div id="comments"><div class="comment">'
    'Great, I want to read more of it.</div><div class="reply">Me too, said a reader.</div></div>'
    '<div class="footer">Contact and imprint</div></body>',
    '<body><div class="header"><h1>The site</h1></div><div class="nav menu"><ul><li><a>One</a></li><li><a>Two</a></li>'
    '</ul></div><div role="alert" class="notice">This page was moved last week.</div><article><h2 *>Of hills and sea'
    '</h2><p *>The hills are old.</p><p *>The sea is older, <a>they say</a>, and so it goes on and on.</p><aside>Sign up '
    'now for more of this.</aside><pre *>x = 1</pre><table><tr><td *>Height</td><td *>900</td></tr></table><form>'
    '<p>Your name and mail, please.</p></form><footer>Posted in May, share this.</footer></article><div class="widget '
    'subscribe newsletter"><p>Get it by mail every day.</p></div><div class="ads advert">A car for everyone.</div>'
    '<div class="social share">Share</div><div class="pagination"><a>Next</a></div><footer>Imprint</footer></body>',
]


def nested_ends(page: str) -> dict[int, int]:
    """Where the closing tag of each NESTED element begins, by the end of its
    opening tag; elements without one are missing.  Tags in comments and in
    scripts do not count."""
    ends, opened, at = {}, {tag: [] for tag in NESTED}, 0
    last = {"<!--": page.rfind("-->")}
    while m := NESTED_LEXER.search(page, at):
        at = m.end()
        tag = (m.group(2) or "<!--").lower()
        if tag == "<!--":
            if at <= last[tag]:
                at = page.find("-->", at)
        elif tag in NESTED:
            if m.group(1):
                if opened[tag]:
                    ends[opened[tag].pop()] = m.start()
            elif not (tag == "svg" and m.group(3).endswith("/")):
                opened[tag].append(at)
        elif not m.group(1):
            if tag not in last:
                last[tag] = max((c.start() for c in CLOSING[tag].finditer(page)), default=-1)
            if at <= last[tag]:
                at = CLOSING[tag].search(page, at).start()
    return ends


def blocks_of(page: str):
    """Leaf blocks in order: (text, ancestors, link share, marked).  Ancestors
    are (tag, class words) of the open elements that hold the block."""
    found, stack, parts = [], [], []
    at, linked, links, marked = 0, 0, 0, 0
    size = 0

    def flush():
        nonlocal parts, links, size, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((text, tuple(x[:2] for x in stack), links / max(1, size), any(x[2] for x in stack)))
        parts, links, size, linked = [], 0, 0, 0

    def say(text):
        nonlocal links, size
        if text:
            parts.append(text)
            size += len(text)
            if linked:
                links += len(text)

    ends = None
    while True:
        m = LEXER.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), m.group(1), m.group(3)
        if tag in RAW and not closing:
            if tag in NESTED:
                if ends is None:
                    ends = nested_ends(page)
                at = ends.get(at, at)
            else:
                end = CLOSING[tag].search(page, at)
                at = end.start() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                linked = 0 if closing else 1
            elif tag in ("br", "wbr", "img"):
                say(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            # a paragraph ends where any other block begins
            while stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in REPEATS):
                stack.pop()
            names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if attributes else ""
            stack.append((tag, tuple(WORDS.findall(names.lower())), " *" in attributes))
    flush()
    return found


def ancestor_features(ancestors) -> set[str]:
    names = {f"in {tag}" for tag, _ in ancestors}
    names |= {f"class {w}" for _, words in ancestors for w in words}
    names.add("parent " + (ancestors[-1][0] if ancestors else "none"))
    return names


def text_features(text: str, link_share: float) -> tuple[str, ...]:
    n = text.count(" ") + 1
    return (f"words {min(6, n.bit_length())}", f"links {int(link_share * 4)}",
            "ends " + ("stop" if text[-1] in ".!?" else "else"), "sign " + ("c" if "©" in text else "no"), "any")


class Field:
    """Weights: ``emit[feature]`` of main text against other text,
    ``move[previous, label]``, ``start[label]``."""

    def __init__(self, emit: dict, move, start):
        self.emit, self.move, self.start = emit, move, start
        self.paths: dict = {}

    def scores(self, blocks) -> list[float]:
        out = []
        for text, ancestors, share, _ in blocks:
            path = self.paths.get(ancestors)
            if path is None:
                if len(self.paths) > 50_000:
                    self.paths.clear()
                path = self.paths[ancestors] = sum(self.emit.get(f, 0.0) for f in ancestor_features(ancestors))
            out.append(path + sum(self.emit.get(f, 0.0) for f in text_features(text, share)))
        return out

    def decode(self, blocks) -> list[bool]:
        """Viterbi over two labels."""
        if not blocks:
            return []
        scores = self.scores(blocks)
        (m00, m01), (m10, m11) = self.move
        a, b = self.start[0], self.start[1] + scores[0]
        back = []
        for s in scores[1:]:
            back.append((m10 + b > m00 + a, m11 + b > m01 + a))
            a, b = max(m00 + a, m10 + b), max(m01 + a, m11 + b) + s
        label = b > a
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks_of(page or "")
        return "\n".join(b[0] for b, main in zip(found, self.decode(found)) if main)


def train_field(pages, labels, weights, rounds: int = 150, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Fit a field to pages (blocks) with labels, all pages at once.  Pages of
    equal feature rows are trained the same way whatever their order."""
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in sorted(ancestor_features(b[1])) + list(text_features(b[0], b[2]))]
             for b in page] for page in pages]
    lengths = np.array([len(p) for p in pages])
    steps = int(lengths.max())
    n = len(pages)
    page_of = np.repeat(np.arange(n), lengths)
    time_of = np.concatenate([np.arange(k) for k in lengths])
    sizes = np.array([len(f) for p in rows for f in p])
    block = np.repeat(np.arange(len(sizes)), sizes)
    feature = np.array([i for p in rows for f in p for i in f])
    gold = np.zeros((n, steps), np.int64)
    gold[page_of, time_of] = [int(x) for p in labels for x in p]
    on = np.arange(steps) < lengths[:, None]
    weight = np.asarray(weights, float)
    emit, move, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (gold[:, :-1][on[:, 1:]], gold[:, 1:][on[:, 1:]]),
              np.repeat(weight, np.maximum(0, lengths - 1)))
    squares = [np.full_like(x, 1e-8) for x in (emit, move, start)]
    scale = weight.sum()

    def logsum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(rounds):
        score = np.zeros((n, steps, 2))
        score[page_of, time_of, 1] = np.bincount(block, emit[feature], minlength=len(sizes))
        ahead = np.zeros((n, steps, 2))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, steps):
            new = logsum(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(on[:, t, None], new, ahead[:, t - 1])
        whole = logsum(ahead[:, -1], 1)
        after = np.zeros((n, steps, 2))
        moved = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            out = move + (score[:, t + 1] + after[:, t + 1])[:, None, :]
            after[:, t] = np.where(on[:, t + 1, None], logsum(out, 2), 0.0)
            pair = np.exp(ahead[:, t, :, None] + out - whole[:, None, None])
            moved += (pair * (on[:, t + 1] * weight)[:, None, None]).sum(axis=0)
        chance = np.exp(ahead + after - whole[:, None, None])[page_of, time_of]
        error = (gold[page_of, time_of] - chance[:, 1]) * weight[page_of]
        firsts = (np.eye(2)[gold[:, 0]] - np.exp(ahead[:, 0] + after[:, 0] - whole[:, None])) * weight[:, None]
        for x, g, sq in zip((emit, move, start), (np.bincount(feature, error[block], minlength=len(emit)) / scale - decay * emit,
                                                  (gold_move - moved) / scale - decay * move,
                                                  firsts.sum(axis=0) / scale - decay * start), squares):
            sq += g * g
            x += rate * g / np.sqrt(sq)
    return Field({f: float(emit[i]) for f, i in names.items()}, move.tolist(), start.tolist())


#: Inside an article these are no main text either; fixed values.
OUTSIDE = {"nav", "header", "footer", "aside", "form", "title", "head", "button", "dialog"}


def marked_labels(blocks):
    """Labels of a page that marks its article with the tag, else None."""
    inside = [any(tag == "article" for tag, _ in b[1]) and not any(
        tag in OUTSIDE or {"ad", "ads", "advert", "comments", "comment", "notice"} & set(words)
        for tag, words in b[1]) for b in blocks]
    return inside if any(inside) else None


def train(pages: DataFrame, max_pages: int = 150, id_column: str = "page_id", html_column: str = "html",
          max_chars: int = 200_000) -> Field:
    """Fit a field to the labelled pages of this module and a sample of about
    ``max_pages`` whole pages that mark their article (pages of more than
    ``max_chars`` characters are not used for training)."""
    texts = sampled(pages.where(F.col(html_column).contains("<article") & (F.length(html_column) <= max_chars)).select(
        F.col(html_column).alias("html"), F.col(id_column).alias("id")), "id", max_pages)
    known = [blocks_of(p) for p in LABELLED]
    labels = [[b[3] for b in page] for page in known]
    weights = [10.0] * len(known)
    for row in texts.limit(4 * max_pages).collect():
        page = blocks_of(row["html"])
        marks = marked_labels(page)
        if marks:
            known.append(page)
            labels.append(marks)
            weights.append(1.0)
    return train_field(known, labels, weights)


def main_texts(pages: DataFrame, field: Field | None = None, id_column: str = "page_id", url_column: str = "url",
               html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the main text of every whole page.

    A null or empty page has an empty text; null ids and repeated rows are
    kept; other columns play no part; an empty table gives an empty result.
    No shuffle."""
    prepare(pages.sparkSession)
    field = field or train(pages, id_column=id_column, html_column=html_column)
    weights = (field.emit, field.move, field.start)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_column, url_column)}
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"),
                        F.col(html_column).alias("html"))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import html_text as op
        from tickforge.llm.common import chunks
        own = op.Field(*weights)
        for batch in chunks(batches, "html", CHUNK_BYTES):
            texts = [own.main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    out = rows.mapInArrow(run, f"page_id {kinds[id_column]}, url {kinds[url_column]}, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_column, "url": url_column})
