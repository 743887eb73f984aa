"""Words and classes of the language model come from Arrow columns, as a plain split gives them."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import hmm

TEXTS = ["skipped", None, "", " \t a  B\x0b\x0c\r ", "É éa A a a x\x1cy  z\nÀ b", "zzz zzz Zzzz", "a"]


def plain(text):
    return (text or "").encode().lower().split()


def test_words_of_columns_are_those_of_a_plain_split():
    words, n_words = hmm.words_of(pa.array(TEXTS).slice(1))
    assert n_words.tolist() == [len(plain(t)) for t in TEXTS[1:]]
    assert words.to_pylist() == [w for t in TEXTS[1:] for w in plain(t)]
    words, n_words = hmm.words_of(pa.array([], pa.string()))
    assert len(words) == len(n_words) == 0


def test_encoded_texts_hold_classes_and_rare_words(spark):
    conf = hmm.HmmConf(shapes=16)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn(
        "held_out", F.lit(False))
    counted = {bytes(r.word): r.n for r in hmm.count_words(docs).collect()}
    assert counted == Counter(w for t in TEXTS for w in [*plain(t), hmm.END])
    for frequent in ({hmm.END: 0, b"a": 1, b"zzz": 2}, {}):
        corpus = hmm.Corpus(0, 0, frequent, np.zeros(len(frequent), np.int64), np.ones(16))
        got = {r.doc_id: r for r in hmm.encode(docs, corpus, conf).collect()}
        assert len({r.row for r in got.values()}) == len(TEXTS)
        for i, text in enumerate(TEXTS):
            words = [*plain(text), hmm.END]
            codes = [frequent.get(w, len(frequent) + hmm.shape(w, conf)) for w in words]
            assert np.frombuffer(got[i].codes, np.int32).tolist() == codes
            assert got[i].n_tokens == len(words)
            rare = Counter(w for w in words if w not in frequent and w != hmm.END)
            assert {bytes(r.word): r.times for r in got[i].rare} == rare
