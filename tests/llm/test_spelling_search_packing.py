"""Spelling variants, lexical search and packing, against brute force and the public library."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import lexical_search, packing, spelling

P = pytest.importorskip("public_tokenizers")
TOKENIZER = P.path("word_bpe_49k.json")


# --- spelling variants -----------------------------------------------------------------

def one_apart(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if u == v or len(v) - len(u) > 1:
        return False
    p = next((i for i in range(len(u)) if u[i] != v[i]), len(u))
    return u[p:] == v[p + 1:] if len(v) > len(u) else u[p + 1:] == v[p + 1:]


def brute_near(counts: dict[str, int]) -> dict:
    out = {}
    for w in counts:
        near = [v for v in counts if one_apart(w, v)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            out[w] = (len(near), counts[best], best)
    return out


def random_words(seed: int, size: int, letters: str, longest: int) -> dict[str, int]:
    rng = np.random.default_rng(seed)
    made = {"".join(rng.choice(list(letters), rng.integers(7, longest + 1))) for _ in range(size)}
    return {w: int(rng.integers(2, 60)) for w in sorted(made)}


@pytest.mark.parametrize("bucket", [4, 1024])
@pytest.mark.parametrize("letters, longest", [("ab", 10), ("abcdé", 8), ("aÿ", 13)])
def test_near_words_equal_brute_force(spark, bucket, letters, longest):
    counts = random_words(longest, 260, letters, longest)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.near_words(words, spelling.Spelling(bucket=bucket, cells=64 * bucket)).collect()
    assert {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in got} == brute_near(counts)
    assert len(got) == len({r["word"] for r in got})


def test_words_with_one_open_place_are_a_bucket_of_any_size(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    counts = {f"const{c}ant": 2 for c in letters} | {"constant": 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.near_words(words, spelling.Spelling(bucket=4)).collect()
    assert {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in got} == brute_near(counts)


def test_very_long_words(spark):
    long = "ab" * 20_000
    counts = {long: 3, long + "a": 40, "x" + long[1:]: 2, long[:9_999] + long[10_000:]: 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.near_words(words).collect()
    assert {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in got} == brute_near(counts)


def test_occurrences_lose_the_code_point_of_their_hash():
    text = "Colouré colouré COLOURÉ behaviour short neighbour"
    want = Counter()
    for run in ("colouré", "colouré", "colourÉ", "behaviour", "neighbour"):
        for doc in (5,):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] += 1
    assert spelling.occurrences(text, 5, spelling.Spelling(misspelt=3)) == want


def test_forms_and_roots(spark, rows):
    text = " ".join(["colourful"] * 300 + ["colorful"] * 25 + ["colorfull"] * 2 + ["unrelated"] * 2)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = rows(spelling.variants(docs, spelling.Spelling(misspelt=0)))
    assert got == [
        ("colorful", "colourful", "colourful", 25, 2, 300),
        ("colorfull", "colorful", "colourful", 2, 1, 25),
        ("colourful", None, "colourful", 300, 1, None),
        ("unrelated", None, "unrelated", 2, 0, None)]


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    assert spelling.variants(no_docs).count() == 0
    got = {r["word"]: r["n"] for r in spelling.variants(odd_docs).collect()}
    want = Counter()
    for r in odd_docs.collect():
        want.update(spelling.occurrences(r["text"] or "", r["doc_id"], spelling.Spelling()))
    assert got == {w: n for w, n in want.items() if n > 1}


# --- lexical search --------------------------------------------------------------------

def brute_search(docs, items, top=50):
    held = [(i, t) for i, t in ((d, lexical_search.terms_of(x)) for d, x in docs) if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = Counter(t for _, terms in held for t in set(terms))
    out = []
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(lexical_search.terms_of(text))
    for item, wanted in asked.items():
        scored = []
        for doc_id, terms in held:
            tf = Counter(terms)
            m = 50 + (50 * len(terms) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in wanted if t in tf)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, s[2], -s[0]) for k, s in enumerate(scored[:top])]
    return sorted(out, key=repr)


def texts_of_topics(seed: int, size: int) -> list[tuple[int, str]]:
    """Documents of few topics, with copies, so that blocks differ and scores tie."""
    rng = np.random.default_rng(seed)
    docs = []
    for i in range(size):
        topic = int(rng.integers(0, 6))
        words = [f"t{topic}w{int(rng.zipf(1.6)) % 40}" if rng.random() < 0.6
                 else f"c{int(rng.integers(0, 12))}" for _ in range(int(rng.integers(1, 40)))]
        docs.append((i, " ".join(words)))
        if i % 9 == 0:
            docs.append((i + size, " ".join(words)))
    return docs


ITEMS = [(1, "T0w1 t0w2, c1 c2 C3"), (2, "t3w1 t3w2 t3w3 t3w4 c5"), (3, "c0 c1 c2 c3 c4 c5 c6"),
         (4, "nowhere"), (5, None), (2, "t4w1"), (6, "t5w7 t5w7 t5w7"), (None, "t1w1 c7")]


@pytest.mark.parametrize("conf", [
    lexical_search.Search(top=5, shard=300, block=2), lexical_search.Search(top=50),
    lexical_search.Search(top=3, shard=4000, block=8, sketch=4, asked=40)])
def test_search_equals_brute_force(spark, rows, conf):
    docs = texts_of_topics(3, 400) + [(None, "t1w1 c7 c7"), (None, None), (7, ""), (8, " .,! ")]
    got = rows(lexical_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(ITEMS, "item_id long, text string"), conf))
    assert got == brute_search(docs, ITEMS, conf.top)


def test_blocks_are_skipped_and_none_that_ranks():
    rng = np.random.default_rng(5)
    terms, impacts = [], []
    for i in range(4_000):
        topic = i % 20
        own = np.unique(np.concatenate((rng.integers(0, 10, 4), topic * 10 + rng.integers(10, 20, 5))))
        terms.append(own)
        impacts.append(rng.integers(1, 1_000, len(own)))
    shard = lexical_search.Shard(terms, impacts, 220, lexical_search.Search(block=16))
    weights = np.full(220, 3, np.int64)
    asked = np.array([0, 1, 2, 53, 54, 57])
    best = lexical_search._Best(10)
    blocks, skipped = shard.search(
        asked, weights, best.floor, lambda docs, scores: best.add(scores, docs))
    assert skipped > blocks / 4
    dense = np.zeros(220, np.int64)
    dense[asked] = 3
    every = np.array([(dense[t] * v).sum() for t, v in zip(terms, impacts)])
    order = np.lexsort((np.arange(len(every)), -every))[:10]
    assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == every[order].tolist()


def test_summaries_are_maxima():
    terms = [np.array([0, 2]), np.array([0, 1]), np.array([0])]
    impacts = [np.array([5, 7]), np.array([9, 1]), np.array([2])]
    shard = lexical_search.Shard(terms, impacts, 3, lexical_search.Search(block=8))
    found = shard.list_of(0).summaries
    assert found.at.tolist() == [0, 3]
    assert dict(zip(found.numbers.tolist(), found.values.tolist())) == {0: 9, 1: 1, 2: 7}


def test_search_of_odd_rows(spark, rows, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the quick fox"), (2, "two")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows(lexical_search.search(odd_docs, items)) == brute_search(docs, items.collect())
    assert lexical_search.search(no_docs, items).count() == 0
    assert lexical_search.search(odd_docs, items.where("false")).count() == 0


# --- packing ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


def packs_whole(got, docs, tokenizer, capacity):
    """Every id lies in one piece, sequences have no gap and no padding."""
    want = Counter()
    for doc_id, text in docs:
        want[doc_id, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    by_id = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert len(r["ids"]) == r["length"] > 0
        by_id[r["doc_id"]].append(r)
    for (doc_id, ids), times in want.items():
        for at in range(len(ids)):
            covering = [r for r in by_id[doc_id] if r["doc_tokens"] == len(ids)
                        and r["start"] <= at < r["start"] + r["length"]
                        and r["ids"][at - r["start"]] == ids[at]]
            assert len(covering) >= times
    assert sum(r["length"] for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append(r)
    for pieces in sequences.values():
        filled = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == filled
            filled += r["length"]
            assert r["sequence_tokens"] == pieces[0]["sequence_tokens"]
        assert filled == pieces[0]["sequence_tokens"] <= capacity and filled & (filled - 1) == 0


def test_packing_holds_every_id_once(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(60)
    conf = packing.Packing(capacity=256, window=5_000)
    got = packing.pack(docs, TOKENIZER, conf, with_ids=True).collect()
    packs_whole(got, [tuple(r) for r in docs.collect()], tokenizer, 256)


def test_packing_of_odd_rows(spark, tokenizer, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if len(r["text"] or "") < 1_000]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = packing.pack(frame, TOKENIZER, with_ids=True).collect()
    packs_whole(got, docs, tokenizer, 2048)
    whole = packing.pack(odd_docs, TOKENIZER)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert packing.pack(no_docs, TOKENIZER).count() == 0


@pytest.mark.parametrize("text", [
    "Plain words, it's 12.5% done!\n\nNew line", "<|endoftext|> a<|startoftext|>b <| x", "é é ́x  y\x0bz",
    "  two  spaces \t tab\r\n", "ΟΔΟΣ ΣΑΣ İx ﬁ ½ Ⅷ 日本語 🙂🙂", "", " ", "a" * 3_000])
def test_ids_of_words_equal_the_library(tokenizer, text):
    coder = packing.WordIds(TOKENIZER, 1_000)
    for _ in range(2):
        got = np.frombuffer(coder.ids([text, "x"])[0], "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_least_cost_with_room_comes_first():
    conf = packing.Packing(capacity=16, linear=0, quadratic=1)
    # 10, 9, 6, 4, 3: two sequences of 16. Costs: 10 | 9, then 6 to the cheaper (81), 4 fits the other only.
    pieces = packing.assign([4, 10, 6, 9, 3], conf)
    assert [p[:4] for p in pieces[:4]] == [(1, 0, 10, 0), (3, 0, 9, 1), (2, 0, 6, 1), (0, 0, 4, 0)]
    # 3 finds room for two and for one: cut at the widest gap.
    assert [p[:4] for p in pieces[4:]] == [(4, 0, 2, 0), (4, 2, 1, 1)]


def test_assignment_equals_the_plain_rule():
    rng = np.random.default_rng(8)
    conf = packing.Packing(capacity=64)
    for _ in range(20):
        lengths = [int(n) for n in rng.integers(1, 150, int(rng.integers(1, 60)))]
        sizes = packing.room(sum(lengths), 64)
        used, cost = [0] * len(sizes), [0] * len(sizes)
        waiting, want = [(n, -i, 0) for i, n in enumerate(lengths)], []
        while waiting:
            n, i, start = max(waiting, key=lambda w: (w[0], w[1], -w[2]))
            waiting.remove((n, i, start))
            fits = [s for s in range(len(sizes)) if sizes[s] - used[s] >= n]
            s = min(fits, key=lambda s: (cost[s], s)) if fits else max(
                range(len(sizes)), key=lambda s: (sizes[s] - used[s], -s))
            take = min(n, sizes[s] - used[s])
            want.append((-i, start, take, s, used[s]))
            used[s] += take
            cost[s] += conf.linear * take + conf.quadratic * take * take
            if take < n:
                waiting.append((n - take, i, start + take))
        assert packing.assign(lengths, conf) == want
