"""Filters, classifiers, fingerprints, token files and packing on small fixtures."""

from __future__ import annotations

import hashlib
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logsync.llm import fingerprints as fp
from logsync.llm import language_id as lid
from logsync.llm import license_scan as ls
from logsync.llm import packing as pk
from logsync.llm import text as text_tools
from logsync.llm import toxicity as tx
from logsync.llm.queries import QUERIES, URL_RULES, edited_fingerprints
from logsync.llm.token_files import read_index, read_token_files, write_token_files
from logsync.llm.tokens import Encoder, tokenizer_path
from logsync.llm import url_filter as uf
from logsync.session import run_folder

URLS = [
    "https://a.example.org/es/1?x",
    "https://A.EXAMPLE.org/es",
    "http://example.org/en/12",
    "http://notexample.org/es/1",
    "http://org/",
    "http://org",
    "http://x.com/fr/../de/",
    "ftp://x.com/de/#f",
    "http://com/de/",
    "http://x.com/DE/1",
    "x.com/de/1",
    "",
    None,
    "http://y.com\n/de/",
    "http://u@x.org:80/es/://z.com/de/1",
]


def best_rule(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(r.host + r.path), len(r.host), r.verdict, r.host + r.path)
        for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize("planned", [500, 0])
def test_url_rules(spark, monkeypatch, planned):
    monkeypatch.setattr(uf, "PLANNED_RULES", planned)
    rows = [(i, u, "mine") for i, u in enumerate(URLS)] + [(0, URLS[0], "mine")]
    urls = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = Counter(tuple(r) for r in uf.filter_urls(urls, URL_RULES).select("page_id", *uf.RESULT).collect())
    assert got == Counter((i, *best_rule(u)) for i, u, _ in rows)
    assert uf.filter_urls(urls.where("false"), URL_RULES).count() == 0
    assert uf.filter_urls(urls, ()).where("verdict = 'allow'").count() == len(rows)


def test_url_wildcards_and_rules_without_tokens(spark):
    rules = [uf.Rule("block", "net", "/*tracker"), uf.Rule("block", "", "/ad.(x)*/z"), uf.Rule("allow", "b.net", "/")]
    urls = ["http://a.net/x/mytracker2", "http://b.net/tracker", "http://c.de/ad.(x)y/z", "http://c.de/adx(x)y/z"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: r["verdict"] for r in uf.filter_urls(frame, rules).collect()}
    assert [got[u] for u in urls] == ["block", "block", "block", "allow"]


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("example.org", "/en/1")] * 3 + [("example.org", "/es/")], "host string, path string")
    index = uf.rule_index(urls, uf.compiled(spark, URL_RULES)).collect()
    filed = {r["rule"]: r["token"] for r in index}
    assert filed["example.org/es/"] == "es" and filed["org/"] == "org" and filed["com/de/"] == "com"


def test_licenses(spark, odd_docs):
    mit = dict(ls.KNOWN[::-1])["MIT"]
    texts = [
        "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " , "),
        "/* (C) 1999 X\n * All Rights Reserved. */\n" + mit.replace("copyright holders", "copyright owners"),
        "LICENCED under the Apache Licence, version 2.0",
        mit + " Really.",
        "Copyright me",
    ]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    )
    out = ls.scan_licenses(docs.withColumn("license_id", F.lit("old")), ls.known_licenses(spark))
    got = Counter((r["doc_id"], r["license_id"]) for r in out.collect())
    assert [got[(100 + i, x)] for i, x in enumerate(["MIT", "MIT", "Apache-2.0", None, None])] == [1] * 5
    assert sum(got.values()) == docs.count() and got[(5, None)] == 2
    assert ls.scan_licenses(docs.where("false"), ls.known_licenses(spark)).count() == 0


def test_wrapped_licenses(spark):
    rows = [
        (name, "Copyright (c) 2021 Some One\n\n" + "\n".join(textwrap.fill(t, width, break_long_words=False, break_on_hyphens=False) for t in text.split("\n")))
        for name, text in ls.KNOWN
        for width in range(30, 100, 2)
    ]
    assert any("\ncopyright notice" in t for n, t in rows if n == "ISC")
    out = ls.scan_licenses(spark.createDataFrame(rows, "name string, text string"), ls.known_licenses(spark))
    assert [r["text"] for r in out.where("NOT name <=> license_id").collect()] == []


def test_toxicity_learns_and_leaves_nothing_out(spark, make_docs, odd_docs):
    random.seed(3)
    rows, labels = [], []
    for i in range(600):
        words = random.choices([f"w{k}" for k in range(200)], k=40)
        if i % 4 == 0:
            words[random.randrange(40)] = random.choice(["awful", "nastyone", "nastytwo"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    truth = spark.createDataFrame(labels + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = tx.train_toxicity(make_docs(*rows), truth.where("doc_id < 450"))
    assert 0 < len(model.buckets) < 2_000
    got = {r["doc_id"]: r["predicted"] for r in tx.score_toxicity(make_docs(*rows), model).collect()}
    assert np.mean([got[i] == y for i, y in labels if i >= 450]) > 0.95
    odd = tx.score_toxicity(odd_docs.withColumn("score", F.lit("x")), model)
    assert odd.count() == 11 and odd.where("score NOT BETWEEN 0 AND 1 OR score IS NULL").count() == 0
    bias = [r["score"] for r in odd.where("doc_id IN (1, 2, 3)").collect()]
    assert len(set(bias)) == 1
    none = tx.train_toxicity(odd_docs, truth.where("false"))
    assert {r["score"] for r in tx.score_toxicity(odd_docs, none).collect()} == {0.0}


def test_language_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    net = lid.Network(*(w.astype(np.float64) for w in lid.fresh(3)))
    symbols, labels = draw.integers(97, 101, (4, 5)), draw.integers(0, 3, 5)

    def loss():
        odds = lid._positions(net, symbols)[1]
        return -np.mean(np.log(odds[:, np.arange(5), labels]))

    for w, g in zip(net, lid._gradients(net, symbols, labels)):
        at = tuple(draw.integers(0, s) for s in w.shape)
        if w is net.tables:
            at = (1, symbols[1, 1], 7)
        kept = w[at]
        w[at] = kept + 1e-4
        up = loss()
        w[at] = kept - 1e-4
        down = loss()
        w[at] = kept
        assert g[at] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=1e-5)


def test_languages(spark, odd_docs):
    random.seed(5)
    ways = {"xx": "bdgklm", "yy": "pqrstv", "zz": "äöüßñé"}
    rows = []
    for i in range(240):
        lang = random.choice(list(ways))
        text = " ".join("".join(random.choices(ways[lang] + "ae", k=random.randrange(2, 9))) for _ in range(30))
        rows.append((i, text.title() + ", 12.", lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.train_language_id(docs, F.col("doc_id") < 150)
    assert model.languages == ["xx", "yy", "zz"]
    out = lid.predict_language(docs, model).where("doc_id >= 150")
    assert out.where("lang_pred = lang").count() >= 88
    odd = lid.predict_language(odd_docs.withColumn("lang_pred", F.lit(0)), model)
    named = Counter((r["doc_id"], r["lang_pred"] == "und") for r in odd.collect())
    assert named[(1, True)] == named[(2, True)] == named[(3, True)] == named[(7, True)] == 1
    assert named[(5, False)] == 2 and named[(9, False)] == 1
    assert odd.where("score NOT BETWEEN 0 AND 1 OR score IS NULL").count() == 0
    nothing = lid.train_language_id(docs, F.lit(False))
    assert lid.predict_language(odd_docs, nothing).where("lang_pred = 'und' AND score = 0").count() == 11


def brute_sketch(text):
    words = [w for w in __import__("re").split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    runs = [hashes[i : i + 5] for i in range(len(hashes) - 4)] or ([hashes] if hashes else [])
    out = set()
    for run in runs:
        seed = 42
        for h in run:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        out.add(signed(seed))
    return sorted(out)[: fp.K]


def likeness(a, b):
    both = sorted({*a, *b})[: fp.K]
    return len({*both} & {*a} & {*b}) / len(both) if both else 1.0


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        a, e, b = map(brute_sketch, (text, edited, after))
        digits = ["".join(f"{h % (1 << 64):016x}" for h in s) for s in (a, e)]
        yield i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *digits, likeness(a, e), likeness(a, b)


@pytest.mark.parametrize("group", [8, 1024])
def test_fingerprints(spark, odd_docs, monkeypatch, group):
    monkeypatch.setattr(fp, "GROUP", group)
    odd = odd_docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    if group < 1024:
        odd = odd.withColumn("doc_id", F.col("doc_id") * 1_003 - 5_000)
    rows = [tuple(r) for r in odd.collect()]
    assert Counter(map(tuple, edited_fingerprints(odd).collect())) == Counter(brute_edits(rows))
    lone = edited_fingerprints(odd_docs.where("doc_id IS NULL").select("doc_id", "text")).collect()
    assert len(lone) == 2 and all(r["near_next"] == 0 for r in lone)
    assert edited_fingerprints(odd.where("false")).count() == 0


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(" ".join(words[:2000]), " ".join(words[1000:]), " ".join(words))]
    frame = spark.createDataFrame(rows, "x string, y string, z string")
    for c in "xyz":
        frame = fp.with_sketch(frame, c, f"s{c}")
    x, y, z = (F.col(f"s{c}") for c in "xyz")
    got = frame.select(
        fp.resemblance(x, y), fp.containment(x, z), fp.containment(z, x), fp.distinct_shingles(z), F.size(fp.merged(x, y))
    ).first()
    assert got[0] == pytest.approx(1 / 3, abs=0.13) and got[1] > 0.8 and got[2] == pytest.approx(2 / 3, abs=0.2)
    assert got[3] == pytest.approx(2996, rel=0.3) and got[4] == fp.K
    parts = frame.select(F.array_except(fp.merged(x, y), z)).first()[0]
    # Runs across the cut are in neither part; the rest of the whole's sketch is.
    assert len(parts) <= 5


def ids_of(texts):
    plain = Encoder(tokenizer_path())
    whole = plain._whole([t or "" for t in texts])
    return [np.frombuffer(x + bytes(4), "<u4") for x in whole]


def test_encoder_equals_the_library():
    random.seed(6)
    signs = ["a", "B", "'s", "1", ".", " ", "\n", "é", "_", "\x1d", "́", "　", "\r", "²", "<|endoftext|>", "\U0001f600", "—"]
    texts = ["".join(random.choices(signs, k=random.randrange(14))) for _ in range(4000)] + [None, "x" * 5000]
    got = [np.frombuffer(x, "<u4") for x in Encoder(tokenizer_path())(texts)]
    assert all(np.array_equal(a, b) for a, b in zip(got, ids_of(texts)))


def test_token_files(spark, odd_docs):
    path = run_folder(spark, "tokens-test")
    write_token_files(odd_docs.withColumn("payload", F.lit(1)), path, tokenizer_path(), 3)
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for (i, _), ids in zip(rows, ids_of([r[1] for r in rows])):
        want.append((i, start, len(ids), ids.tobytes()))
        start += len(ids)
    got = [(r[0], r[1], r[2], bytes(r[3])) for r in read_token_files(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert Counter(tuple(r) for r in read_index(spark, path).select("doc_id", "start", "n_tokens").collect()) == Counter(
        r[:3] for r in want
    )
    crcs = read_token_files(spark, path, crc=True).collect()
    assert Counter(map(tuple, crcs)) == Counter((*r[:3], zlib.crc32(r[3])) for r in want)
    some = read_token_files(spark, path, [5, 9, 1234]).collect()
    assert Counter(r["doc_id"] for r in some) == {5: 2, 9: 1}


def test_token_files_of_nothing_and_of_few(spark, make_docs):
    path = run_folder(spark, "tokens-test")
    write_token_files(make_docs((1, "x")).where("false"), path, tokenizer_path())
    assert read_token_files(spark, path).count() == 0 and read_index(spark, path).count() == 0


def test_short_documents_gain_by_the_dictionary(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = run_folder(spark, "tokens-test")
    write_token_files(docs, path, tokenizer_path())
    size, count = read_index(spark, path).where("n_tokens < 300").agg(F.sum("size"), F.sum("n_tokens")).first()
    assert size < 2 * count


def check_packing(rows, texts, capacity):
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    ids = ids_of([t for _, t in texts])
    for (i, _), own in zip(texts, ids):
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["piece"]):
            part = own[at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert r["piece"] == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(own)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(map(len, ids))


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    placed = pk.pack_documents(docs, tokenizer_path(), with_ids=True)
    n, tokens = check_packing(placed.collect(), texts, pk.CAPACITY)
    assert n <= -(-tokens // pk.CAPACITY) + 1
    whole = pk.sequences(placed).select(F.length("ids").alias("n")).collect()
    assert len(whole) == n and sum(r["n"] for r in whole) == 4 * tokens


def test_packing_of_odd_rows(spark, odd_docs, make_docs):
    assert pk.pack_documents(odd_docs.withColumn("part", F.lit(1)), tokenizer_path(), 64).count() > 11
    once = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = [tuple(r) for r in once.select("doc_id", "text").collect()]
    check_packing(pk.pack_documents(once, tokenizer_path(), 64).collect(), texts, 64)
    assert pk.pack_documents(make_docs((1, "x")).where("false"), tokenizer_path()).count() == 0


def fewest(items, capacity):
    """The optimum by trying everything."""
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - items[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


def test_bin_completion_finds_the_optimum():
    random.seed(8)
    for _ in range(25):
        items = sorted((random.randrange(1, 40) for _ in range(11)), reverse=True)
        plan = pk.pack(Counter(items), 50)
        held = Counter()
        for filling, times in plan:
            assert sum(filling) <= 50
            for x in filling:
                held[x] += times
        assert held == Counter(items)
        assert sum(times for _, times in plan) == fewest(items, 50)


def test_bin_completion_beats_best_fit():
    counts = Counter([7, 6, 5, 5, 4, 3, 3, 3, 2, 2])
    assert sum(t for _, t in pk.pack(counts, 10)) <= sum(t for _, t in pk.best_fit(counts, 10))


def test_every_query_gives_a_row_for_each_document(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op3_license_scan", "op4_toxicity", "op5_token_files", "op8_language_id"):
        assert QUERIES[name](spark, sf_dir).count() == n, name


def test_url_filter_keeps_columns_of_any_name(spark):
    urls = spark.createDataFrame([("http://x.org/es/1", "mine", "too")], "url string, _best string, _best_ string")
    for rules in (URL_RULES, (*URL_RULES, *(uf.Rule("block", f"h{i}.net", "/") for i in range(600)))):
        row = uf.filter_urls(urls, rules).first()
        assert (row["_best"], row["_best_"], row["verdict"]) == ("mine", "too", "allow")


def test_hash_bounds_leave_a_share_however_small():
    assert text_tools.hash_bound(1.0) == (1 << 63) - 1 and text_tools.hash_bound(0.0) == -(1 << 63)
    assert text_tools.hash_bound(0.5) == 0
    assert text_tools.hash_bound(1e-12) > text_tools.hash_bound(0.0)


def test_every_language_is_sampled_however_rare(spark):
    rows = [(i, "der die das und ist nicht", "de") for i in range(3000)] + [(9000 + i, "la le les et est pas", "fr") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lid.train_language_id(docs, F.lit(True), 40).languages == ["de", "fr"]


def test_word_tables_keep_rows_right_when_full():
    net = lid.fresh(3)
    chance = random.Random(2)
    words = ["".join(chance.choices("abc\u00e9", k=chance.randrange(1, 40))).encode() for _ in range(300)]
    whole, small = lid.WordTable(net, 1000), lid.WordTable(net, 17)
    for low in range(0, 300, 25):
        some = chance.choices(words[: low + 25], k=60)
        assert np.allclose(whole.of(some), small.of(some), atol=1e-5)
        for w, row in zip(some, whole.of(some)):
            parts = lid.pieces(w)
            assert row[-1] == len(w)
            assert np.allclose(row[:-1], sum(lid._positions(net, np.frombuffer(p, np.uint8)[:, None])[1].sum(0)[0] for p in parts), atol=1e-4)
