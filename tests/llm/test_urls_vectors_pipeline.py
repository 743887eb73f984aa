"""URL filters, nearest neighbours, the registered queries and the pipeline."""

import os
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import TABLES, compare
from millrace.llm import ann, url_filter
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


# --- urls ------------------------------------------------------------------------------

URLS = [None, "", "no mark", "http://", "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/",
        "x://y://net/fr/", "http://net/es/a", "http://sub.net/fr/?q", "http://net/es",
        "http://spam-farm.example.org/x", "http://a.b.casino-win.example.net?x",
        "http://notcasino-win.example.net/x", "http://example.com", "http://com/", "://com/x#/",
        "http://É.COM/", "http://h/p\nq", "http://" + "a." * 5000 + "com/" + "p" * 5000]


def judged_by_hand(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = m.groups() if m else ("", "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
    below = lambda d: host == d or host.endswith("." + d)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
            if below(h) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[1:])
    return host, path, None, "block" if any(map(below, url_filter.LISTED_HOSTS)) else "allow"


def test_urls(spark):
    pages = spark.createDataFrame(
        [(i, u, "x", 1) for i, u in enumerate([*URLS, *URLS[:3]])],
        "page_id long, url string, host string, verdict int")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 3
    for row in got:
        assert (row.host, row.path, row.rule, row.verdict) == judged_by_hand(row.url)
    assert url_filter.judge_urls(pages.where("false")).count() == 0


def test_digest_array_confirms_strings(spark, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda data: len(data))
    array = url_filter.DigestArray(url_filter.DigestArray.pack(["aa", "bb", "ccc", ""]))
    assert array.contains(["bb", "cc", "aa", "ccc", "", "dddd"]).tolist() == [
        True, False, True, True, True, False]
    assert not url_filter.DigestArray(url_filter.DigestArray.pack([])).contains(["x"]).any()
    with pytest.raises(ValueError):
        url_filter.DigestArray.pack(["long entry"], max_bytes=10)


def test_listed_hosts_from_a_table_whole_and_in_parts(spark):
    """A million entries: one array, and parts of it, against a join in SQL."""
    hosts = spark.range(1_000_000).select(
        F.concat(F.lit("Host"), F.col("id"), F.lit(".Listed."),
                 F.element_at(F.array(*map(F.lit, ("com", "net", "co.uk"))),
                              (F.col("id") % 3 + 1).cast("int"))).alias("host"))
    hosts = hosts.union(hosts.limit(5)).union(spark.createDataFrame(
        [(None,), ("",), ("deep.a.b.c.d.e.test",)], "host string"))
    urls = [f"http://{sub}host{i}.listed.{top}/p{i}"
            for i in (0, 1, 2, 5, 999_999, 1_000_000, -1) for top in ("com", "net", "co.uk")
            for sub in ("", "www.", "x")]
    urls += [*URLS, "http://q.deep.a.b.c.d.e.test", "http://a.b.c.d.e.test", "http://test"]
    # One host holds a third of the pages.
    urls += ["http://www.host3.listed.com/same"] * (len(urls) // 2)
    pages = spark.createDataFrame(
        [(None if i == 4 else i, u) for i, u in enumerate(urls)], "page_id long, url string")
    listed = {f"host{i}.listed.{('com', 'net', 'co.uk')[i % 3]}" for i in range(1_000_000)}
    listed.add("deep.a.b.c.d.e.test")

    def verdict(url):
        host, path, rule, found = judged_by_hand(url)
        if rule is None:
            labels = host.split(".")
            found = "block" if any(
                ".".join(labels[i:]) in listed for i in range(len(labels))) else "allow"
        return host, path, rule, found

    wanted = sorted(map(str, ((None if i == 4 else i, u, *verdict(u)) for i, u in enumerate(urls))))
    for array_bytes in (64 * 2**20, 3 * 2**20):
        got = url_filter.judge_urls(pages, hosts=hosts, array_bytes=array_bytes)
        assert sorted(str(tuple(r)) for r in got.collect()) == wanted
    none = url_filter.judge_urls(pages, hosts=hosts.where("false")).where("rule IS NULL")
    assert {r.verdict for r in none.collect()} == {"allow"}
    in_parts = url_filter.judge_urls(pages.where("false"), hosts=hosts, array_bytes=2**20)
    assert in_parts.count() == 0


# --- vectors ---------------------------------------------------------------------------

def brute_force(rows, every, k):
    usable = {i: v for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, vector in usable.items():
        if q % every == 0:
            scored = [(-float(np.dot(np.float64(np.float32(vector)), np.float64(np.float32(v)))), i)
                      for i, v in usable.items() if i != q and len(v) == len(vector)]
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_neighbours_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((8, 32))
    vectors = centres[rng.integers(0, 8, 1500)] + 0.7 * rng.standard_normal((1500, 32))
    vectors[300:340] = vectors[300]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute_force(rows, 20, 20)
    got = ann.nearest(df, conf=ann.CollisionIndex(least_blocks=3)).collect()
    found = Counter()
    for r in got:
        found[r.query_id] += r.vec_id in want[r.query_id]
    assert sum(found.values()) >= 0.95 * 20 * len(want)
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        for r in mine:
            assert r.score == pytest.approx(float(np.dot(
                np.float64(np.float32(vectors[q])), np.float64(np.float32(vectors[r.vec_id])))))
    # Copies tie: the smaller ids come first.
    copies = [r.vec_id for r in sorted((r for r in got if r.query_id == 320), key=lambda r: r.rank)
              if 300 <= r.vec_id < 340]
    assert len(copies) > 10 and copies == [i for i in range(300, 340) if i != 320][:len(copies)]


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [2.0, 1.0]), (7, []), (None, [1.0, 1.0]), (20, [1.0, 0.0]),
            (40, [0.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows],
                               "vec_id long, embedding array<float>, score double")
    got = {}
    for r in sorted(ann.nearest(df).collect(), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(6, 2.0), (20, 1.0)], 20: [(6, 2.0), (0, 1.0)]}
    assert ann.nearest(df.where("false")).count() == 0


# --- queries and pipeline --------------------------------------------------------------

@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, db, name):
    line = compare(spark, db, name, REGISTRY[name], ORACLE[name], SF)
    assert line.startswith("equal"), line


def test_contract_columns(spark):
    want = {
        "op1": "doc_id size source_size target taken", "op2": "page_id host path rule verdict",
        "op3": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op5": "query_id rank vec_id score", "op7": "doc_id n_bytes n_tokens over_limit",
        "op8": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9": "doc_id held_out score predicted", "op10": "doc_id n_shingles component_id kept",
        "op11": "word form root n n_near form_n", "op12": "item_id rank doc_id score",
        "op13": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    }
    assert sorted(n.split("_")[0] for n in REGISTRY) == sorted([*want, "op6"])
    for name in ("op2_url_filters", "op7_token_counts", "op8_byte_bpe", "op11_spelling_variants",
                 "op12_lexical_search", "op13_packing"):
        assert set(want[name.split("_")[0]].split()) <= set(REGISTRY[name](spark, SF).columns)


def test_stages_against_their_own_input(spark):
    """Each stage by itself: what it returns follows from what it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert corpus_pipeline.ORACLE_SQL is None and len(stages) == 5

    good = stages["quality rules"](spark, docs, SF).cache()
    assert good.columns == columns and good.exceptAll(docs).count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    long = clean.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= 20)
    assert long.join(good, "doc_id", "left_semi").count() >= 0.95 * long.count()
    assert good.join(labels.where("quality = 0"), "doc_id", "left_semi").count() <= 0.2 * labels.where(
        "quality = 0").count() + 1

    single = stages["near duplicates"](spark, good, SF).cache()
    assert single.columns == columns and single.exceptAll(good).count() == 0
    from test_text_operators import least_reachable
    rows = [(r.doc_id, r.text) for r in good.collect()]
    want = {d for d, (_, c) in least_reachable(rows, 5, 80).items() if d == c}
    assert {r.doc_id for r in single.collect()} == want

    safe = stages["secrets"](spark, single, SF).cache()
    assert safe.columns == columns and safe.count() == single.count()
    joined = single.alias("a").join(safe.alias("b"), "doc_id").select("a.text", F.col("b.text").alias("t"))
    for row in joined.collect():
        pieces = row.t.split("[SECRET]")
        assert re.fullmatch(".+".join(map(re.escape, pieces)), row.text, re.S)

    mixed = stages["mix"](spark, safe, SF).cache()
    assert mixed.columns == columns
    encoded = stages["encode"](spark, mixed, SF)
    assert encoded.count() == mixed.count()
    import hashlib
    assert Counter(r.decoded_sha256 for r in encoded.collect()) == Counter(
        hashlib.sha256(r.text.encode()).hexdigest() for r in mixed.collect())


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(
        str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert os.path.isdir(tmp_path)
