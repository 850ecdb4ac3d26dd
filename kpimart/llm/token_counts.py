"""Token counts of whole texts by the whole-token shortcut.

Most pre-tokens of a text are strings that a byte-level vocabulary holds
whole. Which of its strings the merges join to that one token, whatever stands
around them, is proved once per vocabulary on the driver
(:func:`whole_tokens`). Counting then is: cut the text into pre-tokens, count
the proved ones as one each, and run the merges for the rest only.

Edge cases: a null or empty text has 0 tokens and 0 bytes; a string of an added
token inside a text counts as the library counts it by default, as one token;
repeated rows and ids are counted row by row; there is no limit on a text's
length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import table

# White space as the tokenizers' patterns know it, the pattern
# of pre-tokens, and the end of the letters that need no newer Unicode tables.
WHITE = "\t-\r \x85\xa0  -     　"
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OLD_LETTERS = 0x250

# A run of white space goes with the word after it: no pre-token reaches over its start.
CHUNKS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
CACHE_CHUNKS = 400_000  # in each of two generations; affects speed only


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = sorted(set(range(256)) - set(kept))
    return [chr(b) if b not in other else chr(0x100 + other.index(b)) for b in range(256)]


def load(path: str):
    """The tokenizer of a file; one that is not plain byte-level BPE is refused."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
             and model["type"] == "BPE" and not model.get("ignore_merges") and not spec.get("normalizer"))
    added = spec.get("added_tokens", [])
    if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path}: only plain byte-level BPE files are counted")
    return Tokenizer.from_file(path), sorted((t["content"] for t in added), key=len, reverse=True)


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that alone are one token.

    A pre-token's tokens depend on the pre-token only, so a string that the
    merges join to one token is one wherever it is a pre-token. Strings that
    are no whole UTF-8 text cannot be pre-tokens.
    """
    tokenizer, added = load(path)
    merge, byte_of, out = tokenizer.model.tokenize, {c: b for b, c in enumerate(byte_letters())}, set()
    for shown in tokenizer.get_vocab(with_added_tokens=False):
        if any(c not in byte_of for c in shown) or len(merge(shown)) != 1:
            continue
        try:
            out.add(bytes(map(byte_of.__getitem__, shown)).decode())
        except UnicodeDecodeError:
            continue
    return frozenset(out.difference(added))


class Counts(dict):
    """Chunk to its number of tokens; forgets chunks not met for a while."""

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__()
        import regex

        self.whole, self.old = whole, {}
        self.tokenizer, added = load(path)
        self.merge, self.letters = self.tokenizer.model.tokenize, dict(enumerate(byte_letters()))
        self.find = regex.compile(PRE_TOKENS).findall
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def pre_tokens(self, chunk: str) -> list[str]:
        if chunk.isascii() or max(chunk) < chr(OLD_LETTERS):
            return self.find(chunk)
        # Letters newer than one library's tables: the tokenizer's own cut decides.
        return [chunk[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE_CHUNKS:
            self.old = dict(self)
            self.clear()
        n = self.old.get(chunk)
        if n is None:
            n = 0
            for p in self.pre_tokens(chunk):
                n += 1 if p in self.whole else len(self.merge(p.encode().decode("latin-1").translate(self.letters)))
        if len(chunk) <= 64:  # a long one hardly comes back
            self[chunk] = n
        return n

    def plain(self, text: str) -> int:
        return sum(map(self.__getitem__, CHUNKS.findall(text)))

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self.plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def _counter(path: str, key: int, whole) -> Counts:
    """One a worker process, file and broadcast."""
    return Counts(path, whole.value)


def token_counter(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens, as the library of ``path`` gives them.

    The file must be readable at ``path`` on the driver and the executors. The
    proved strings are broadcast; the vocabulary bounds them.
    """
    whole = spark.sparkContext.broadcast(whole_tokens(path))

    @F.pandas_udf("long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path, id(whole.value), whole)
        for texts in batches:
            yield pd.Series([counter.text(t) for t in texts], dtype="int64")

    return counts


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    count = token_counter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
