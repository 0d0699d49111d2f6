"""Splitting texts into pre-tokens exactly as the tokenizer libraries do.

The pattern is the public one of the vocabulary files.  Unicode tables differ
between library versions, so characters from U+0500 on are classed by asking
the tokenizer library itself; the split then runs on a shadow text in which
each such character is replaced by a plain one of its class.
"""

from __future__ import annotations

import regex

#: Below this code point all libraries class letters, digits and spaces alike.
STABLE = 0x500
#: Stand-ins without a part in the pattern's contractions: letter, digit, rest.
STAND_IN = {"L": "á", "N": "1", "S": " ", "O": "!"}
PIECE = 100_000


class Splitter:
    """``split(text)`` yields lists of pre-tokens; ``classify(char)`` says L,
    N, S (white space) or O as the library sees it."""

    def __init__(self, pattern: str, classify):
        self.rx = regex.compile(pattern)
        self.high = regex.compile(f"[{chr(STABLE)}-\U0010ffff]")
        self.classify = classify
        self.shadow: dict[int, str] = {}

    def split(self, text: str):
        if len(text) <= 4 * PIECE and not self.high.search(text):
            yield self.rx.findall(text)
            return
        for ch in set(self.high.findall(text)):
            if ord(ch) not in self.shadow:
                self.shadow[ord(ch)] = STAND_IN[self.classify(ch)]
        seen = text.translate(self.shadow)
        piece = []
        for m in self.rx.finditer(seen):
            piece.append(text[m.start():m.end()])
            if len(piece) == PIECE:
                yield piece
                piece = []
        yield piece


def classify_by_tokenizer(tokenizer):
    """Classes as the pre-tokenizer of a ``tokenizers.Tokenizer`` has them."""
    pre = tokenizer.pre_tokenizer

    def classify(ch: str) -> str:
        for kind, probe in (("L", "á"), ("N", "1"), ("O", "!")):
            if len(pre.pre_tokenize_str(probe + ch)) == 1:
                return kind
        return "S"
    return classify


def classify_by_tiktoken(pattern: str):
    """Classes as ``tiktoken`` has them: a probe vocabulary merges a letter,
    digit or mark with a first byte only if both stand in one pre-token."""
    import tiktoken
    ranks = {bytes([i]): i for i in range(256)}
    for probe in b"a1!":
        for first in range(0xC2, 0xF5):
            ranks[bytes([probe, first])] = len(ranks)
    enc = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def classify(ch: str) -> str:
        for kind, probe in (("L", "a"), ("N", "1"), ("O", "!")):
            if enc.encode_ordinary(probe + ch)[0] >= 256:
                return kind
        return "S"
    return classify
