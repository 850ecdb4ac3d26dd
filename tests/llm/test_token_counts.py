import random

import public_tokenizers
import pytest
from kpimart.llm.token_counts import Counts, op11_token_counts, token_counter, whole_tokens
from tokenizers import Tokenizer

from conftest import DOCS, SF0001  # noqa: I001

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(spark, texts):
    got = {r.doc_id: r for r in op11_token_counts(spark, SF0001).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert (got[i].n_bytes, got[i].n_tokens) == (len(t.encode()), library(t)), i
        assert got[i].over_limit == (got[i].n_tokens > 1024)


def test_every_proved_string_is_one_token_and_most_words_are_proved(texts):
    whole = whole_tokens(PATH)
    assert len(whole) > 45_000
    assert all(library(w) == 1 for w in whole)
    assert "<|endoftext|>" not in whole


def test_any_characters():
    counter = Counts(PATH, whole_tokens(PATH))
    alphabet = ("abz AZ  09\t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　'’sdtrevml.,!|<>é́ßЖ中文՘\U0001f600\U00010940\x00½²٣​﻿"
                "<|endoftext|>")
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choices(alphabet, k=draw.randint(1, 14)))
        if draw.random() < 0.2:
            text = text.replace("a", "<|endoftext|>")
        assert counter.text(text) == library(text), repr(text)


def test_edges(spark, folder_of):
    long = "word and word, " * 60_000 + "x" * 20_000
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "one <|endoftext|> two<|endoftext|>", "en", "a", 3), (3, "again", None, None, None),
            (3, "again", None, None, None), (None, "no id", "en", "a", 5), (4, long, "en", "a", len(long)), (5, "  \n\n ", "en", "a", 5)]
    got = op11_token_counts(spark, folder_of("documents", rows, DOCS)).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), library(r[1]), library(r[1]) > 1024) for r in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert op11_token_counts(spark, folder_of("documents", [], DOCS)).count() == 0
    wide = [(7, "a b", 1, 2, True)]
    assert op11_token_counts(spark, folder_of("documents", wide, "doc_id long, text string, n_tokens int, n_bytes int, over_limit boolean")
                             ).collect()[0].n_tokens == library("a b")


def test_other_kinds_of_files_are_refused(spark):
    with pytest.raises(ValueError, match="byte-level"):
        token_counter(spark, public_tokenizers.path("word_bpe_49k.json"))
