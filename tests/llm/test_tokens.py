import zlib

import numpy as np
import public_tokenizers
import pytest
from kpimart.llm.packing import best_fit, crossover, evolve, mutate, op4_pack, pack
from kpimart.llm.token_files import op10_token_files, pack_block, read_token_files, unpack_block, write_token_files
from kpimart.llm.tokens import Encoder
from tokenizers import Tokenizer

from conftest import SF0001  # noqa: I001

ODD = ["a  b\t\tc \n\n d   ", " lead", "trail ", "x\x1cy !\x1c z\x85q　　r", "don't 's  're Don'T it's.",
       "<|endoftext|> a<|startoftext|>", "é ́a ́ é́.", "ΑΣ ΣΑ Σ", "​ a᠎b﻿ c",
       "İI ı ﬁ K", "日本語 テキスト\n　本", "", "   ", "\n", "\r\n\r\na", "12 345  6", "!!  ??", " !! x!!? .a. a.b|c",
       "\x00 \x00a", "ÀÖØß ÿŸ ×÷ a×b Straße, ǅ ŉ", "a\n b", "a \nb", " \n ", "x $$$ y%%% a***", "word " * 3000]


def whole(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))  # special strings are special tokens, its default
    return [np.asarray(e.ids, "<u4") for e in t.encode_batch(list(texts), add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_give_the_whole_text_s_ids(name, texts):
    some = [*texts.values(), *ODD]
    enc = Encoder(public_tokenizers.path(name))
    assert [enc.text(t) for t in some] == [i.tobytes() for i in whole(name, some)]
    assert enc.text(None) == b""


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_together_give_each_text_s_ids(name, monkeypatch):
    monkeypatch.setattr("kpimart.llm.tokens.CHARS_AT_ONCE", 40)
    some = [*ODD, "the cat's. sat_ on### Éa(b) a.b", "the sat<|endoftext|> on", "a b'''", "~a a~^`\\ a_b a2, _"] * 2
    enc = Encoder(public_tokenizers.path(name))
    assert list(enc.texts(some)) == [i.tobytes() for i in whole(name, some)]
    assert list(enc.texts([None, "a"])) == [b"", enc.text("a")] and list(enc.texts([])) == []


def test_a_word_of_several_texts_is_looked_up_once():
    enc, looked = Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    make = enc.cores.make
    enc.cores.make = lambda w: looked.append(w) or make(w)
    list(enc.texts(["zq qyx qyx. qyx!", "zq qyx$$$ qyx,"]))
    assert sorted(looked) == [" qyx", "zq"]


def test_special_strings_are_special_tokens():
    enc = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert np.frombuffer(enc.text("a<|endoftext|><|startoftext|> b"), "<u4").tolist()[1:3] == [49407, 49406]


def test_a_block_s_size_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="65535"):
        write_token_files(spark.createDataFrame([(1, "a")], "doc_id long, text string"), str(tmp_path / "t"),
                          public_tokenizers.path("byte_bpe_50k.json"), 2, block=65_536)


@pytest.mark.parametrize("ids", [[7], [0, 0, 0], [5, 4_000_000_000, 5, 6], list(range(3000)), [2**32 - 1, 0]])
def test_blocks_round_trip(ids):
    ids = np.asarray(ids, np.uint32)
    assert (unpack_block(b"xx" + pack_block(ids), 2) == ids).all()


def test_token_files_query(spark, texts):
    got = op10_token_files(spark, SF0001).orderBy("doc_id").collect()
    start, want = 0, []
    for doc, ids in zip(sorted(texts), whole("byte_bpe_50k.json", [texts[d] for d in sorted(texts)]), strict=True):
        data = np.append(ids, np.uint32(2)).astype("<u4").tobytes()
        want.append((doc, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    assert [tuple(r) for r in got] == want


def test_token_files_edges(spark, tmp_path):
    rows = [(3, "b", 1), (None, "n", 1), (1, None, 1), (1, "a", 1), (1, "a", 1), (2, "", 1), (4, "word " * 50_000, 1)]
    path = str(tmp_path / "t")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string, start long"), path,
                      public_tokenizers.path("byte_bpe_50k.json"), 2, page_ids=8)
    got = read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 2, 3, 4]
    n = [r.n_tokens for r in got]
    assert [n[0], *sorted(n[1:4]), *n[4:6]] == [2, 1, 2, 2, 1, 2] and n[6] > 50_000
    assert [r.start for r in got] == [sum(n[:k]) for k in range(7)]
    empty = str(tmp_path / "e")
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), empty, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert read_token_files(spark, empty).count() == 0


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark, texts):
    got = op4_pack(spark, SF0001).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    total = 0
    for doc, ids in zip(texts, whole("word_bpe_49k.json", texts.values()), strict=True):
        ids = np.append(ids, np.uint32(0)).astype("<u4")
        total += len(ids)
        pieces = sorted(by[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [
            (k, 2048 * k, min(2048, len(ids) - 2048 * k)) for k in range(-(-len(ids) // 2048))]
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in pieces)
    assert check_packing(got, 2048) <= -(-total // 2048) + 1


def test_packing_edges(spark, folder_of):
    rows = [(None, None), (1, "a"), (1, "a"), (2, ""), (3, "x " * 5000)]
    got = op4_pack(spark, folder_of("documents", rows, "doc_id long, text string")).collect()
    assert check_packing(got, 2048) == 3 and sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "3", "3", "None"]
    assert op4_pack(spark, folder_of("documents", [], "doc_id long, text string")).count() == 0


def test_islands_pack_groups(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1, 101, 3000))]
    table = spark.createDataFrame(rows, "item long, length long")
    got = pack(table, 100, group_items=500).join(table, "item").collect()
    assert len(got) == 3000
    assert check_packing(got, 100) <= 1.03 * sum(n for _, n in rows) / 100


def test_genetic_steps_keep_every_item():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 60, 200).tolist()
    one, other = [], []
    best_fit(one, [], range(200), size, 100)
    best_fit(other, [], rng.permutation(200).tolist(), size, 100)
    for bins in (one, crossover(one, other, size, 100, rng), mutate(one, size, 100, rng), evolve(size, [one], 100, 4, 5, rng)):
        assert sorted(i for b in bins for i in b) == list(range(200))
        assert all(sum(size[i] for i in b) <= 100 for b in bins)
    assert len(evolve(size, [one], 100, 4, 5, rng)) <= len(one)
