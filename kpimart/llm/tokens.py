"""Whole texts to token ids with a public tokenizer file, inside tasks.

The tokenizers' patterns never join characters over the start of a run of white
space, so a text's ids are the ids of its words one after the other. Words
repeat: each worker keeps the ids of the words it met last. That cache is
bounded and affects speed only.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What the tokenizers' patterns count as white space, and Latin
# letters that lower-casing and composition treat alike everywhere.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = ".,;:!?|"
RUNS = "!-&(-/:-@\\[-`{-~"  # ASCII marks but the apostrophe: a run of them after letters is one byte-level pre-token

PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
PLAIN = re.compile(f"([{LETTERS}]+)([{MARKS}]*)")
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to Python only
RARE = re.compile(f"[{WHITE[:1] + WHITE[2:5] + WHITE[6:]}]")  # all but blank and line end
CACHE_WORDS = 450_000  # in each of two generations
CACHE_CORES = 250_000  # likewise, of the words that Encoder.texts has looked up
CHARS_AT_ONCE = 1 << 23  # of the texts that Encoder.texts cuts into words at once


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level vocabularies use."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class Words(dict):
    """Word to ids, as bytes; forgets the words not met for a while."""

    def __init__(self, make, most: int = CACHE_WORDS):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, word):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        self[word] = got
        return got


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes.

    A null or empty text gives no ids. The strings of special tokens inside a
    text are those tokens, as the library takes them by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {str(t.content): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {s: np.asarray([i], "<u4").tobytes() for s, i in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self.cuts = re.compile(f"({'|'.join(longest_first)})") if added else None
        self.model, self.shown = self.tokenizer.model, _byte_letters()
        # Both kinds are told apart by what they do with white space.
        self.spaced = bool(self.whole(" "))
        self.pieces, self.cores = Words(self.piece), Words(self.core, CACHE_CORES)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def core(self, word: str) -> bytes:
        """Ids of one pre-token: Latin letters, maybe after a space."""
        if word.isascii():
            shown = self.shown[32] + word[1:] if word[0] == " " else word.replace("\n", self.shown[10])
        else:
            shown = word.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def piece(self, word: str) -> bytes:
        """Ids of a word with the white space before it."""
        at = 1 if self.spaced and word[:1] in (" ", "\n") else 0
        m = PLAIN.fullmatch(word, at)
        if not m:
            parts = PIECES.findall(word)
            return b"".join(map(self.pieces.__getitem__, parts)) if len(parts) > 1 else self.whole(word)
        core, marks = word[:m.end(1)] if self.spaced else m[1].lower(), m[2]
        if core[0] == "\n":
            ids = self.pieces["\n"] + self.pieces[m[1]]
        else:
            ids = self.core(core) if core == word else self.pieces[core]
        return ids + self.pieces[marks] if marks else ids

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cuts is None or not self.cuts.search(text):
            return self.plain(text)
        return b"".join(self.special[part] if i % 2 else self.plain(part) for i, part in enumerate(self.cuts.split(text)))

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.spaced:
            words = PIECES.findall(text) if SEPARATORS.search(text) else text.split()
        elif single_blanks(text):
            words = text.replace(" ", "\x1c ").split("\x1c")
        else:
            words = PIECES.findall(text)
        return b"".join(map(self.pieces.__getitem__, words))

    def texts(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Ids of each text, as :meth:`text` gives them; a word of several texts is looked up once for all of them."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= CHARS_AT_ONCE:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str | None]) -> Iterator[bytes]:
        alike = [self.spaced and bool(t) and single_blanks(t) and not any(map(t.__contains__, self.special)) for t in texts]
        cut = pc.split_pattern(pc.replace_substring(pa.array([t for t, a in zip(texts, alike, strict=True) if a],
                                                             pa.large_string()), " ", "\x1c "), "\x1c")
        words = cut.flatten().dictionary_encode()
        ids = self._distinct(words.dictionary).take(words.indices)
        # Where each text's ids begin and end, in bytes, in the words' ids laid end to end.
        ends = np.frombuffer(ids.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist() if len(cut) else [0]
        data, at = memoryview(ids.buffers()[2] or b""), 0
        for text, a in zip(texts, alike, strict=True):
            if a:
                yield bytes(data[ends[at]:ends[at + 1]])
                at += 1
            else:
                yield self.text(text)

    def _distinct(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words. Letters and the run of marks after them are looked up apart: few of either are new."""
        parts = pc.extract_regex(words, f"^(?P<letters> ?[{LETTERS}]+)(?P<marks>[{RUNS}]*)$")  # null: other words
        other = words.filter(pc.is_null(parts)).to_pylist()
        letters, marks = (pc.struct_field(parts, n).dictionary_encode() for n in ("letters", "marks"))
        sure, then = ([look[w] if w else b"" for w in x.dictionary.to_pylist()]
                      for x, look in ((letters, self.cores), (marks, self.pieces)))
        known = [pa.array(x, pa.large_binary()).take(y.indices) for x, y in ((sure, letters), (then, marks))]
        plain = pc.binary_join_element_wise(*known, pa.scalar(b"", pa.large_binary()))  # null: other words
        return pc.replace_with_mask(plain, pc.is_null(parts), pa.array([self.pieces[w] for w in other], pa.large_binary()))


def single_blanks(text: str) -> bool:
    """Whether blanks stand one by one between words, and no other white space but single line ends inside them."""
    return not (text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or "\x1c" in text
                or RARE.search(text))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    return Encoder(path)
