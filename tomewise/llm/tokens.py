"""Token ids of whole texts with the installed ``tokenizers`` library.

Natural text repeats its words, so each distinct piece is encoded once and remembered. A piece ends
where every match of the tokenizer's own pattern must end, so ids equal those of the whole text. A
text that may hold a special string goes through the library as a whole, which gives special ids.
What is remembered is bounded: when it is full, it becomes the old generation, from which
pieces are taken over when they are met again, and the generation before goes.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import regex

from .common import lower_words, worker_state

LIMIT = 600_000  # pieces remembered by a worker in each of two generations
LONGEST = 64  # code points of a piece that is worth remembering


class Remembered:
    """Bytes (ids, little-endian unsigned 32-bit) of pieces."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = LIMIT):
        self.encode, self.limit, self.known, self.old, self.passing = encode, limit, {}, {}, []

    def join(self, docs: list[list[str]]) -> list[bytes]:
        self._learn(docs)
        return [b"".join(map(self.known.__getitem__, d)) for d in docs]

    def lists(self, docs: list[list[str]]) -> list[list[bytes]]:
        self._learn(docs)
        return [[self.known[p] for p in d] for d in docs]

    def _learn(self, docs: list[list[str]]) -> None:
        for p in self.passing:
            self.known.pop(p, None)
        fresh = list(set().union(*docs).difference(self.known))
        if len(self.known) + len(fresh) > self.limit:
            self.old, self.known = self.known, {}
            fresh = list(set().union(*docs))
        if self.old:
            self.known.update((p, self.old[p]) for p in fresh if p in self.old)
            fresh = [p for p in fresh if p not in self.known]
        self.known.update(zip(fresh, self.encode(fresh), strict=True))
        self.passing = [p for p in fresh if len(p) > LONGEST]


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Code points below need no normalisation beyond lower-casing, and libraries agree on their classes.
PLAIN = "\u0250"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Pieces:
    """Ids of pieces: matches of the tokenizer's pattern go to its merge model one by one, once each.

    Pieces with characters from PLAIN on go through the whole tokenizer instead.
    """

    def __init__(self, tokenizer, pattern: str, lower: bool, limit: int = 300_000):
        self.tokenizer, self.model, self.lower = tokenizer, tokenizer.model, lower
        self.pattern, self.letters, self.limit = regex.compile(pattern), byte_letters(), limit
        self.known: dict[str, bytes] = {}
        self.id_bytes = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]

    def match(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            if text.isascii() and text.isprintable():
                shown = text.replace(" ", self.letters[32])  # other printable bytes stand for themselves
            else:
                shown = text.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([self.id_bytes[t.id] for t in self.model.tokenize(shown)])
            if len(self.known) >= self.limit:
                self.known = {}
            if len(text) <= LONGEST:
                self.known[text] = ids
        return ids

    def _words(self, words: list[str]) -> list[bytes]:
        """Lower-cased words: those of ASCII letters are one match and go to the model at once."""
        ids, tokenize = self.id_bytes, self.model.tokenize
        simple = [w.isascii() and w.isalpha() for w in words]
        rest = iter(self._any([w for w, ok in zip(words, simple, strict=True) if not ok]))
        return [
            b"".join([ids[t.id] for t in tokenize(w.lower())]) if ok else next(rest)
            for w, ok in zip(words, simple, strict=True)
        ]

    def __call__(self, pieces: list[str]) -> list[bytes]:
        return self._words(pieces) if self.lower else self._any(pieces)

    def _any(self, pieces: list[str]) -> list[bytes]:
        plain = [not p or max(p) < PLAIN for p in pieces]
        rest = [p for p, ok in zip(pieces, plain, strict=True) if not ok]
        whole = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        out = []
        for p, ok in zip(pieces, plain, strict=True):
            if ok:
                p = p.lower() if self.lower else p
                one = p[1:].isalpha() and (p[0] == " " or p[0].isalpha())
                out.append(self.match(p) if one else b"".join(map(self.match, self.pattern.findall(p))))
            else:
                out.append(np.array(next(whole).ids, "<u4").tobytes())
        return out


#: White space beside blank and newline, which has rules of its own in byte-level patterns.
OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def blank_pieces(text: str) -> list[str] | None:
    """Pieces of a text that begin with each blank, or None where blanks do not stand alone."""
    if "  " in text or " \n" in text or "\n " in text or any(c in text for c in OTHER_SPACE):
        return None
    return text.split(" ")


class ByteLevel:
    """Ids of a byte-level BPE whose pattern joins one blank to what follows it."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = LIMIT):
        self.first = Remembered(encode, limit // 4)
        self.later = Remembered(lambda ps: encode([" " + p for p in ps]), limit)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [blank_pieces(t) for t in texts]
        heads = self.first.join([[t] if s is None else s[:1] for t, s in zip(texts, split, strict=True)])
        tails = self.later.join([[] if s is None else s[1:] for s in split])
        return [h + t for h, t in zip(heads, tails, strict=True)]


class Words:
    """Ids of a lower-casing tokenizer that drops white space and never joins across it."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = LIMIT):
        self.words = Remembered(lambda ps: encode([p.decode() for p in ps]), limit)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.words.join([lower_words(t) for t in texts])


#: What the two files split texts by.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


class WithSpecials:
    """Another encoder, but for texts in which one of the tokenizer's special strings may be found."""

    def __init__(self, tokenizer, plain: Words | ByteLevel):
        self.tokenizer, self.plain = tokenizer, plain
        self.strings = [t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()]

    def special(self, text: str) -> bool:
        # some are looked for after lower-casing, and all begin alike: most texts are read once
        return any(s[:2] in text and s in text.lower() for s in self.strings)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = self.plain.encode(["" if self.special(t) else t for t in texts])
        for i, text in enumerate(texts):
            if self.special(text):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out[i] = np.array(ids, "<u4").tobytes()
        return out


def encoder(path: str, kind: str):
    """The worker's encoder of a file, loaded once: kind ``bytes`` or ``words``."""
    loaded = worker_state()
    if (kind, path) not in loaded:
        tokenizer, words = load(path), kind == "words"
        pieces = Pieces(tokenizer, WORD_PATTERN if words else BYTE_PATTERN, words)
        loaded[kind, path] = WithSpecials(tokenizer, Words(pieces) if words else ByteLevel(pieces))
    return loaded[kind, path]
