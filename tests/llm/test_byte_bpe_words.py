"""Stretches that byte-pair encoding looks up: words apart from what is behind them."""

import base64
from itertools import product

import pyarrow as pa
import pytest

from millrace.llm import byte_bpe

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_are_remembered_once_whatever_is_behind_them():
    codec = byte_bpe.RankCodec(PATH, P.PATTERN)
    words = [f"{a}{b}chheit" for a, b in product("abcdefghij", repeat=2)]
    marks = ["", ".", ",", "!", "?", ";", ":", ".)", "'s", "-"]
    codec.encode(" ".join(word + mark for word in ["x", *words] for mark in marks))
    assert len(codec.young) + len(codec.old) <= len(words) + 2 * len(marks) + 2


def test_ids_at_every_border_equal_the_library(library):
    signs = [*" \n\t\r\x0b\x1c\x85\xa0  ​ 　'.-{`@[7½²ªµ×÷ÿÀßǅʰж日́ͅ🙂\x00\x7f", "ll"]
    texts = [f"{a}Zé{b}{c}s{b}" for a, b, c in product(["", " ", "x", "x ", "  "], signs, signs)]
    for codec in (byte_bpe.RankCodec(PATH, P.PATTERN),
                  byte_bpe.RankCodec(PATH, P.PATTERN + "|\\Z(?!)", remembered=100)):
        ids, at = codec.code(pa.array([None, "", *texts, None]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
            library.encode_ordinary(t) for t in ["", "", *texts, ""]]


def test_each_column_of_a_text_longer_than_what_is_coded_together(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_TOGETHER", 20)
    texts = [None, "Ein  Wort\n\nund noch eins", "", "ab " * 50, None, "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rows = byte_bpe.encode_decode(docs, PATH, P.PATTERN).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids, bytes(r.decoded)) for r in rows] == [
        (len(ids), ids, (t or "").encode())
        for t in texts for ids in [library.encode_ordinary(t or "")]]
