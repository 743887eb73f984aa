"""Chunks of letters skip the tokenizer's preparation, with the same ids."""

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from millrace.llm.packing import WordIds, word_model

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_letters_have_the_tokenizers_ids():
    whole = Tokenizer.from_file(PATH)
    letters = [c for c in map(chr, range(0xC0, 0x100)) if c not in "×÷"]
    texts = [*letters, *(f"ab{c}cd" for c in letters), " ".join(letters), "", "a", "naïve Été, ÿ! don't",
             "x×y a÷b", "é Ωmega ß ẞ İ", "<|endoftext|>", "word1 2words it's O'RE", " a "]
    coder = WordIds(PATH, 1000)
    assert coder.words is not None
    got = [np.frombuffer(ids, "<u4").tolist() for ids in coder.ids(texts)]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_another_preparation_has_no_word_model():
    spec = json.loads(Tokenizer.from_file(PATH).to_str())
    assert word_model(json.dumps(spec)) is not None
    spec["normalizer"]["normalizers"][0]["type"] = "NFD"
    assert word_model(json.dumps(spec)) is None
    assert word_model(json.dumps({**spec, "normalizer": None})) is None


def test_marks_behind_letters_are_looked_up_apart():
    whole = Tokenizer.from_file(PATH)
    texts = ["thing$$$ other!! thing, Thing$$$ éa*** it's a'b, x.y end;", "", None, "no<|endoftext|>w$$$ W,", "a  !! \n,b\tc."]
    coder = WordIds(PATH, 1000)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in coder.ids(pa.array(["skipped", *texts]).slice(1))]
    assert got == [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert {"thing", "$$$", "it's"} <= coder.known.keys()
    assert not {"skipped", "thing$$$", "other!!", "éa***"} & coder.known.keys()
