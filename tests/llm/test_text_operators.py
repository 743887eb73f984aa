"""The operators over documents, against brute force and the public libraries."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import (
    byte_bpe, hmm, minhash, mixing, quality_classifier, quality_rules, secret_scan, token_count,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


# --- token counts and byte-level BPE ---------------------------------------------------

P = pytest.importorskip("public_tokenizers")
TRICKY = st.lists(st.sampled_from(
    list("abcdeABC123'.,!?- \t\n\r\x0b\x1c\x85\xa0\u3000éßñ日本🙂½Ⅷ") + ["<|endoftext|>", "'ll"]),
    max_size=60).map("".join)


@pytest.fixture(scope="module")
def public():
    import tiktoken
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return (Tokenizer.from_file(P.path("byte_bpe_50k.json")),
            tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))


@settings(max_examples=300, deadline=None)
@given(TRICKY)
def test_counts_and_ids_equal_the_libraries(public, text):
    counter = token_count.counter_for(P.path("byte_bpe_50k.json"))
    codec = byte_bpe.codec_for(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, byte_bpe.REMEMBERED)
    assert counter.count(text) == len(public[0].encode(text, add_special_tokens=False).ids)
    ids = codec.encode(text)
    assert ids == public[1].encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_very_long_pieces(public):
    counter = token_count.counter_for(P.path("byte_bpe_50k.json"))
    codec = byte_bpe.codec_for(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, byte_bpe.REMEMBERED)
    for text in ("a" * 20_000, "ab" * 10_000, " " * 5_000 + "x", "é" * 5_000, "abcdefg" * 3_000):
        assert counter.count(text) == len(public[0].encode(text, add_special_tokens=False).ids)
        assert codec.encode(text) == public[1].encode_ordinary(text)


def test_pieces_are_forgotten_in_bounds():
    codec = byte_bpe.RankCodec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, remembered=10)
    for i in range(100):
        codec.encode(f"w{i} w{i + 1}")
        assert len(codec.young) + len(codec.old) <= 12


def test_rank_queue_gives_lowest_rank_and_all_its_places():
    queue, rng = byte_bpe.RankQueue(50_256), np.random.default_rng(1)
    pushed = [(int(r), int(p)) for r, p in rng.integers(0, 50_256, (500, 2))]
    for rank, place in pushed:
        queue.push(rank, place)
    got = []
    while queue.top:
        rank, places = queue.pop()
        got += [(rank, p) for p in places]
    assert got == sorted(pushed)


def test_token_queries_on_odd_rows(public, odd_docs, no_docs):
    path, ranks = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
    want = Counter()
    for row in odd_docs.collect():
        text = row.text or ""
        n = len(public[0].encode(text, add_special_tokens=False).ids)
        want[row.doc_id, len(text.encode()), n, n > 512] += 1
    assert Counter(map(tuple, token_count.count_tokens(odd_docs, path).collect())) == want
    want = Counter()
    for row in odd_docs.collect():
        data, ids = (row.text or "").encode(), public[1].encode_ordinary(row.text or "")
        want[row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(data).hexdigest()] += 1
    assert Counter(map(tuple, byte_bpe.digests(odd_docs, ranks, P.PATTERN).collect())) == want
    whole = byte_bpe.encode_decode(odd_docs, ranks, P.PATTERN).collect()
    assert Counter(bytes(r.decoded) for r in whole) == Counter(
        (r.text or "").encode() for r in odd_docs.collect())
    assert token_count.count_tokens(no_docs, path).count() == 0
    assert byte_bpe.digests(no_docs, ranks, P.PATTERN).count() == 0


# --- quality rules ---------------------------------------------------------------------

def repeated_by_brute_force(words, size=8):
    spans = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    often = Counter(spans)
    covered = {i + j for i, s in enumerate(spans) if often[s] > 1 for j in range(size)}
    return len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    assert quality_rules.repeated_words(words) == repeated_by_brute_force(words)


def test_measures_of_a_text():
    text = "A b#\nA b#\n \nx\rÉ|y"
    assert dict(zip(quality_rules.COUNTS, quality_rules.measure_text(text))) == {
        "n_words": 6, "word_chars": 10, "n_symbols": 3, "n_dup_lines": 1,
        "n_repeat_words": 0, "n_lines": 3, "n_upper": 2}
    assert set(quality_rules.measure_text("")) == {0}


def test_quality_on_odd_rows(odd_docs, no_docs):
    got = quality_rules.adaptive_quality(odd_docs)
    assert got.count() == odd_docs.count()
    by = {r.doc_id: r for r in got.collect()}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0
    assert by[3].base_failed and not by[3].kept
    assert by[1].kept and not by[1].base_failed
    kept = quality_rules.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == got.where("kept").count()
    assert quality_rules.adaptive_quality(no_docs).count() == 0


def test_fences_follow_the_group(spark):
    """Symbols are common in one source and rare in the other."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i, base + (" " + "| " * (8 + i % 3) if i % 2 else ""), "en", "ab"[i % 2])
            for i in range(600)]
    rows += [(1000, base + " " + "| " * 9, "en", "a"), (1001, base + " " + "| " * 9, "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.adaptive_quality(docs, 100).collect()}
    assert not kept[1000] and kept[1001]
    assert sum(not k for k in kept.values()) == 1


def _plain(i):
    return " ".join(f"Word{i}x{j}" if j % 9 == 0 else f"w{(i * 7 + j) % 90}v{j}" for j in range(60))


JUNK = {
    "symbols": lambda i: _plain(i) + " " + "|#$ " * (60 + i % 7),
    "capitals": lambda i: _plain(i).upper(),
    "lines": lambda i: "\n".join([_plain(i)] + [f"same line here {i}"] * 9),
}


@pytest.mark.parametrize("kind", JUNK)
def test_junk_in_two_fifths_of_a_source_does_not_lift_the_fence(spark, kind):
    rows = [(i, JUNK[kind](i) if i % 5 < 2 else _plain(i), "en", "a") for i in range(600)]
    rows += [(i, _plain(i), "en", "bc"[i % 2]) for i in range(600, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.adaptive_quality(docs).collect()}
    assert kept == {i: i >= 600 or i % 5 >= 2 for i in range(1000)}


@pytest.mark.parametrize("size", [199, 200, 201])
def test_a_source_of_junk_has_the_same_verdict_at_any_size(spark, size):
    rows = [(i, JUNK["symbols"](i), "en", "a") for i in range(size)]
    rows += [(i, _plain(i), "en", "bcd"[i % 3]) for i in range(1000, 1700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.adaptive_quality(docs).collect()}
    assert kept == {i: i >= 1000 for i in kept}


# --- mixing ----------------------------------------------------------------------------

def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mixing.mix_sources(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (r.doc_id, len(WORD.findall(r.text or ""))) for r in odd_docs.collect())
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mix_sources(no_docs).count() == 0


def test_mix_hits_targets_and_repeats_itself(docs):
    first = mixing.mix_sources(docs)
    by = first.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"),
                                                    F.sum("size").alias("size")).collect()
    assert sum(r.taken for r in by) == pytest.approx(
        1.5 * docs.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0],
        rel=0.001)
    again = mixing.mix_sources(docs.repartition(7))
    assert sorted(first.collect()) == sorted(again.collect())


def test_spans_are_the_words_they_say(docs):
    few = docs.where("doc_id < 60")
    mix = mixing.Mix(block_words=64, shard_slots=16)
    sizes = mixing.sized(few, mix).cache()
    goals = mixing.targets(sizes, mix).cache()
    cut = mixing.spans(sizes, goals, mix).collect()
    slots = Counter()
    for r in cut:
        assert 0 <= r.word_from < r.word_to <= r.size
        slots[r.shard, r.draw] += r.word_to - r.word_from
    assert max(slots.values()) <= 64 and Counter(slots.values()).most_common(1)[0][0] == 64
    source = {r.doc_id: WORD.findall(r.text) for r in few.collect()}
    made = Counter(r.text and (r.doc_id, tuple(WORD.findall(r.text)))
                   for r in mixing.mixed_texts(few, mix).collect())
    assert made == Counter((r.doc_id, tuple(source[r.doc_id][r.word_from:r.word_to]))
                           for r in cut)


# --- language model --------------------------------------------------------------------

def test_forward_and_expectations_equal_brute_force():
    rng = np.random.default_rng(2)
    def rows(n, m):
        return (x := rng.random((n, m)) + 0.1) / x.sum(1, keepdims=True)
    model = hmm.Hmm(rows(1, 3)[0], rows(3, 3), rows(3, 5).T)
    docs = [rng.integers(0, 5, n).astype(np.int32) for n in (4, 1, 3, 4)]
    packed = hmm._TimeMajor(docs)
    *_, likelihood = hmm.forward(model, packed)
    found = hmm._nothing(hmm.HmmConf(states=3), 5)
    hmm.expect(model, packed, found)
    want, moves = {}, np.zeros((3, 3))
    from itertools import product
    for i, doc in enumerate(docs):
        paths = {}
        for path in product(range(3), repeat=len(doc)):
            p = model.start[path[0]] * model.emits[doc[0], path[0]]
            for a, b, o in zip(path, path[1:], doc[1:]):
                p *= model.moves[a, b] * model.emits[o, b]
            paths[path] = p
        want[i] = sum(paths.values())
        for path, p in paths.items():
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / want[i]
    for place, i in enumerate(packed.order):
        assert likelihood[place] == pytest.approx(math.log(want[i]))
    assert found.moves == pytest.approx(moves)
    assert found.emits.sum() == pytest.approx(sum(map(len, docs)))
    single = hmm._nothing(hmm.HmmConf(states=3), 5)
    hmm.expect(hmm.Hmm(*(p.astype(np.float32) for p in (model.start, model.moves, model.emits))),
               packed, single)
    assert single.emits == pytest.approx(found.emits, rel=1e-4)
    assert single.moves == pytest.approx(found.moves, rel=1e-4)


def test_frequent_words_are_whole_steps(spark):
    rows = [(b"", 5)] + [(f"w{i}".encode(), n) for i, n in enumerate([900, 40, 40, 7, 7, 7, 1])]
    counts = spark.createDataFrame(rows, "word binary, n long")
    assert [r.n for r in hmm.frequent_words(counts, 5)] == [5, 900, 40, 40]
    assert [r.n for r in hmm.frequent_words(counts, 7)] == [5, 900, 40, 40, 7, 7, 7]
    assert [r.n for r in hmm.frequent_words(counts, 1)] == [5]


def test_lm_scores(docs):
    conf = hmm.HmmConf(states=3, frequent=300, shapes=64, passes=5)
    got = {r.doc_id: r for r in hmm.score(docs, conf).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, ws in texts.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    total = Counter()
    for d, words in texts.items():
        row = got[d]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[d], len(words), n)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert row.base_score == pytest.approx(base)
        assert math.isfinite(row.score)
        total[held[d], "hmm"] += row.score
        total[held[d], "base"] += row.base_score
    assert all(total[h, "hmm"] > total[h, "base"] for h in (False, True))


def test_classes_are_a_distribution(docs):
    """Over all known words and one unknown word per shape, the shares add up to one."""
    conf = hmm.HmmConf(frequent=100, shapes=32)
    counts = hmm.count_words(docs.select("text", F.lit(False).alias("held_out"))).cache()
    corpus = hmm.corpus_of(counts, conf)
    mass = np.ones(conf.shapes)
    for row in counts.collect():
        if bytes(row.word) not in corpus.frequent:
            mass[hmm.shape(bytes(row.word), conf)] += row.n + 1
    assert corpus.shape_mass == pytest.approx(mass)


def test_a_rare_kind_of_text_gets_a_state(spark):
    """A language in 25 of 1,500 texts, none of them among the 512 with the least hash; no
    passes but those of the start."""
    rng = np.random.default_rng(4)
    ids = [r.id for r in spark.range(1500).orderBy(F.xxhash64("id")).collect()]
    rare = set(ids[-25:])
    rows = []
    for i in ids:
        letter = "r" if i in rare else "ab"[i % 2]
        rows.append((i, " ".join(f"{letter}{w}" for w in rng.integers(0, 60, 40)), False))
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    conf = hmm.HmmConf(states=3, frequent=300, shapes=16, passes=12)
    corpus = hmm.corpus_of(hmm.count_words(docs), conf)
    model = hmm.fit(hmm.encode(docs, corpus, conf).cache(), corpus, conf)
    own = [c for w, c in corpus.frequent.items() if w.startswith(b"r")]
    assert len(own) > 50
    assert model.emits[own].sum(0).max() > 0.5


def test_lm_on_odd_rows(odd_docs, no_docs):
    conf = hmm.HmmConf(states=2, frequent=50, shapes=16, passes=3)
    got = hmm.score(odd_docs, conf).collect()
    assert len(got) == odd_docs.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert hmm.score(no_docs, conf).count() == 0


# --- near duplicates -------------------------------------------------------------------

def shingle_sets(texts, size):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    return sets


def least_reachable(rows, size, percent):
    """Brute force: doc_id -> (n_shingles, component)."""
    sets, parent = shingle_sets([t for _, t in rows], size), {d: d for d, _ in rows}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((find(rows[i][0]), find(rows[j][0])))
            parent[b] = a
    return {d: (len(s), find(d)) for (d, _), s in zip(rows, sets)}


def family(seed, members, most_edits):
    rng = np.random.default_rng(seed)
    base = [f"t{seed}w{i}" for i in rng.integers(0, 4000, 160)]
    for _ in range(members):
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(0, most_edits)):
            words[at] = f"e{rng.integers(0, 10**9)}"
        yield " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    """Families in which most pairs are not linked, with shared passages beside them."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [t for seed in range(3) for t in family(seed, 60, 14)]
    texts += [passage + " " + " ".join(f"u{i}q{j}" for j in range(rng.integers(4, 40)))
              for i in range(60)]
    texts += [" ".join(f"p{i}" for i in range(n)) for n in range(30, 61)]
    rows = [(int(i), t) for i, t in enumerate(rng.permutation(np.array(texts, object)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = least_reachable(rows, 3, 85)
    for conf in (minhash.MinHash(), minhash.MinHash(frequent=4)):
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in minhash.near_duplicates(docs, conf).collect()}
        assert got == want


def test_near_duplicates_on_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    of = lambda d: {(r.component_id, r.kept) for r in got if r.doc_id == d}
    assert of(1) == {(1, True)} and of(2) == {(1, False)}
    assert of(3) == {(3, True)} and of(5) == {(5, True)}
    # One id with two texts ties "one two" to the fox.
    assert of(7) == {(1, False)} and of(8) == {(1, False)}
    assert of(None) == {(None, True)}
    assert minhash.near_duplicates(no_docs).count() == 0
    left = minhash.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 9]


def test_components(spark):
    rng = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(100, 140)]
    edges = chain + [tuple(map(int, p)) for p in rng.integers(200, 300, (70, 2))]
    want = {}
    for a, b in edges:
        group = want.get(a, {a}) | want.get(b, {b})
        for x in group:
            want[x] = group
    got = {r.node: r.component for r in minhash.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(g) for x, g in want.items() if x != min(g)}
    assert minhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- secrets ---------------------------------------------------------------------------

def secret_docs(spark, n=400):
    rng = np.random.default_rng(8)
    hexa = lambda k: "".join(rng.choice(list("0123456789abcdef"), k))
    key = lambda: "AKIA" + "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZ234567"), 16))
    rows, planted = [], {}
    for i in range(n):
        prose = " ".join("".join(rng.choice(["th", "er", "ing", "tion", "an", "on"], 3))
                         for _ in range(20))
        long_word = "".join(rng.choice(["th", "er", "ing", "tion"], 7))
        made = [hexa(18), key(), hexa(40), None, None][i % 5]
        secret = {0: f"password={made}", 1: f"x {made} y", 2: f'token = "{made}"',
                  3: str(rng.integers(10**15, 10**16)), 4: long_word}[i % 5]
        rows.append((i, f"{prose} {secret} {prose}"))
        if made:
            planted[i] = made
    return spark.createDataFrame(rows, "doc_id long, text string"), planted


def test_secrets_are_found_and_words_are_not(spark):
    docs, planted = secret_docs(spark)
    # Findings of other documents teach; the rest is judged.
    model = secret_scan.fit(docs.where("doc_id < 200"))
    judged = docs.where("doc_id >= 200")
    found = {(r.doc_id, r.token_sha256): r.is_secret for r in secret_scan.scan(judged, model).collect()}
    want = {(d, hashlib.sha256(s.encode()).hexdigest()) for d, s in planted.items() if d >= 200}
    caught = {k for k, secret in found.items() if secret}
    assert len(caught & want) >= 0.95 * len(want)
    assert len(caught - want) <= 0.05 * len(found)
    clean = {r.doc_id: r.text for r in secret_scan.redact(judged, model).collect()}
    before = {r.doc_id: r.text for r in judged.collect()}
    for d, secret in planted.items():
        if d >= 200 and found[d, hashlib.sha256(secret.encode()).hexdigest()]:
            assert clean[d] == before[d].replace(secret, secret_scan.REDACTED)


def announced_docs(spark, n=400):
    """Announced values that are short or broken by marks, and random looking strings that
    nothing announces."""
    rng = np.random.default_rng(9)
    draw = lambda letters, k: "".join(rng.choice(list(letters), k))
    hexa = lambda k: draw("0123456789abcdef", k)
    rows, planted, harmless = [], {}, {}
    for i in range(n):
        prose = " ".join(draw("abcdefghij", 5) for _ in range(20))
        low = draw("abcdefghijkmnpqrstuvw", 5)
        value = [f"{low}2x9", f"Tr0{low}&3!xy", low + draw("aeiou", 4), f"{low}.4@{low}$7"][i % 4]
        told = [f'password = "{value}"', f"pwd: {value}", f"db2_eu_west_1_passwd={value},",
                f"{{'api_key': '{value}'}}"][i // 4 % 4]
        plain = [hexa(40), f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}",
                 f"usr/lib{rng.integers(10)}/{draw('abcdefgh', 8)}/v{rng.integers(99)}.so",
                 hexa(64)][i % 4]
        rows.append((i, f"{prose} {told} {prose} {plain} {prose}"))
        planted[i], harmless[i] = value, plain
    return spark.createDataFrame(rows, "doc_id long, text string"), planted, harmless


def test_announced_values_of_any_form_are_found(spark):
    docs, planted, harmless = announced_docs(spark)
    model = secret_scan.fit(docs.where("doc_id < 200"))
    judged = docs.where("doc_id >= 200")
    found = {(r.doc_id, r.token_sha256): r.is_secret for r in secret_scan.scan(judged, model).collect()}
    for d in range(200, 400):
        assert found[d, hashlib.sha256(planted[d].encode()).hexdigest()], planted[d]
        assert not found.get((d, hashlib.sha256(harmless[d].encode()).hexdigest())), harmless[d]
    before = {r.doc_id: r.text for r in judged.collect()}
    for r in secret_scan.redact(judged, model).collect():
        assert r.text == before[r.doc_id].replace(planted[r.doc_id], secret_scan.REDACTED)


@pytest.mark.parametrize("text, want", [
    ('password = "hunter2x9"', [("hunter2x9", 1)]),
    ("pwd: Tr0ub4dor&3!xy.", [("Tr0ub4dor&3!xy", 1)]),
    ('{"token":"a b\\"c!d","n":1}', [('a b\\"c!d', 1)]),
    ("u?user=bob&password=hunter2x9 on", [("hunter2x9", 1)]),
    ("aws_secret_access_key=wJalrXUtnFEMI/K7MDENG/bPx", [("wJalrXUtnFEMI/K7MDENG/bPx", 1)]),
    ("passwd='open and left", [("open", 1)]),
    ("token: null password=${DB_PASS}", [("null", 0), ("${DB_PASS}", 0)]),
    ("conn = 'x9!y8' and DSN=q7.w8", [("x9!y8", None), ("q7.w8", None)]),
    ("the password, and nothing: else", []),
    ("abcdefghijklmnop0token==", [("abcdefghijklmnop0token==", None)]),
])
def test_candidates_and_their_labels(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = docs.select(F.explode(secret_scan.candidates(F.col("text"))).alias("c")).select(
        "c.token", secret_scan.weak_label(F.col("c.token"), F.col("c.before")))
    assert [tuple(r) for r in got.collect()] == want


def test_secret_scan_is_native(spark):
    docs, _ = secret_docs(spark, 60)
    model = secret_scan.fit(docs)
    for df in (secret_scan.scan(docs, model), secret_scan.redact(docs, model),
               mixing.mix_sources(docs.withColumn("source", F.lit("s")))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", text)


def test_secrets_on_odd_rows(odd_docs, no_docs):
    model = secret_scan.fit(odd_docs)
    assert secret_scan.scan(odd_docs, model).where("is_secret").count() == 0
    same = secret_scan.redact(odd_docs, model)
    assert same.columns == odd_docs.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))
    empty = secret_scan.fit(no_docs)
    assert not empty.forest and secret_scan.scan(no_docs, empty).count() == 0
    # Without a forest the label rules decide.
    keyed = odd_docs.limit(1).withColumn("text", F.lit("password=0123456789abcdef01 end"))
    assert [r.is_secret for r in secret_scan.scan(keyed, empty).collect()] == [True]


# --- quality classifier ----------------------------------------------------------------

def test_rules_tell_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_classifier.classify(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.95
    again = quality_classifier.classify(docs.repartition(5), labels.repartition(3))
    assert sorted(got.collect()) == sorted(again.collect())


def test_classifier_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (None, 1), (6, None), (7, 5)], "doc_id long, quality int")
    for given_labels in (labels, labels.where("false"), labels.where("quality = 1")):
        got = quality_classifier.classify(odd_docs, given_labels).collect()
        assert len(got) == odd_docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality_classifier.classify(no_docs, labels).count() == 0
