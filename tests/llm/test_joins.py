"""The Jaccard join, components, substring dedup and decontamination against brute force."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logsync.llm import decontamination as dec
from logsync.llm import jaccard_join as jj
from logsync.llm import substring_dedup as sd
from logsync.llm.components import components

SIX_BLANKS = " \t\n\x0b\f\r"


def shingles(text, width=4):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in re.split(f"[{SIX_BLANKS}]+", low) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    holders = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(k)
    pairs = {p for ks in holders.values() for p in itertools.combinations(sorted(ks), 2)}
    links = []
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= 85 * len(x | y):
            links.append((sets[a][0], sets[b][0]))
    return roots({i for i, _ in sets}, links)


def joined(docs):
    return {(r[0], r[1], r[2]) for r in jj.jaccard_components(docs).collect()}


def test_components(spark):
    random.seed(4)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 440)]
    table = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in components(table).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == roots(nodes, edges)
    assert components(table.where("a < 0")).count() == 0


def near_copies():
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = random.choices(vocabulary, k=random.choice([3, 4, 9, 40, 120]))
        for _ in range(random.choice([1, 3, 12])):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4])):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            if random.random() < 0.3:
                text += random.choices(vocabulary, k=3)
            rows.append((len(rows) * 3 + 1, " ".join(text).replace("w7", "W7")))
    shared = random.choices(vocabulary, k=30)
    for k in range(12):
        rows.append((1000 + k, " ".join(shared + random.choices(vocabulary, k=8 + k % 3))))
    random.shuffle(rows)
    return rows


def test_join_equals_brute_force(make_docs):
    rows = near_copies()
    want = brute_components(rows)
    assert joined(make_docs(*rows)) == {(i, len(shingles(t)), want[i]) for i, t in rows}


def test_join_on_the_test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute_components(rows)
    assert joined(docs) == {(i, len(shingles(t)), want[i]) for i, t in rows}


def test_join_of_odd_rows(odd_docs, make_docs):
    got = Counter((r[0], r[1], r[2]) for r in jj.jaccard_components(odd_docs.withColumn("n", F.lit(1))).collect())
    assert got[(1, 0, 1)] == got[(2, 0, 2)] == got[(3, 0, 3)] == 1
    assert got[(5, 1, 5)] == 2 and got[(6, 1, 5)] == 1
    assert {k for k in got if k[0] is None} == {(None, 7, None), (None, 0, None)}
    assert jj.jaccard_components(make_docs((1, "x")).where("false")).count() == 0


def test_rows_sharing_an_id_are_one_document(make_docs):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    rows = [(1, a), (4, a), (4, b), (6, b), (7, "other words")]
    assert {(r[0], r[2]) for r in jj.jaccard_components(make_docs(*rows)).collect()} == {(1, 1), (4, 1), (6, 1), (7, 7)}


def brute_dedup(rows):
    """Occurrences in order of id and place; a dictionary of what each run is."""
    occurrences = defaultdict(set)
    cut = []
    for i, text in rows:
        parts = [p.decode() for p in sd.sentences(text.encode())] if text else []
        words = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), p)) for p in parts]
        runs = {}
        for k in range(len(parts) - sd.SPAN + 1):
            own = tuple(w for p in words[k : k + sd.SPAN] for w in p)
            if len(own) >= sd.SPAN_WORDS:
                runs[k] = own
                occurrences[own].add((float("inf") if i is None else i, k))
        cut.append((i, text, parts, runs))
    out = []
    for i, text, parts, runs in cut:
        place = float("inf") if i is None else i
        gone = {k + d for k, own in runs.items() if (place, k) != min(occurrences[own]) for d in range(sd.SPAN)}
        out.append((i, "".join(p for k, p in enumerate(parts) if k not in gone) if gone else text, len(gone)))
    return Counter(out)


def deduped(docs):
    return Counter((r["doc_id"], r["kept_text"], r["removed_sentences"]) for r in sd.remove_repeated(docs).collect())


def test_dedup_on_the_test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = deduped(docs)
    assert got == brute_dedup(rows)
    assert sum(n > 0 for _, _, n in got) > 10


def test_dedup_finds_passages(make_docs):
    passage = "The first part of it stands here. Then comes a second one, of more words. And a third."
    docs = [
        (3, f"Something of its own begins here. {passage} It ends so."),
        (1, f"Another beginning it is, of some length. {passage.upper()} The end of it."),
        (2, "Nothing of the kind. Yes. No. Yes. No."),
    ]
    got = {i: t for i, t, _ in deduped(make_docs(*docs))}
    assert got[1] == docs[1][1] and got[2] == docs[2][1]
    assert got[3] == "Something of its own begins here. It ends so."


def test_dedup_cuts_long_sentences(make_docs):
    long = " ".join(f"w{i}" for i in range(60))
    got = {i: t for i, t, _ in deduped(make_docs((1, long), (2, long + ".")))}
    assert got[1] == long and got[2] == ""


def test_dedup_finds_passages_at_any_offset_of_a_long_sentence(make_docs):
    random.seed(6)
    passage = random.choices([f"p{i}" for i in range(500)], k=80)
    rows = [(k, " ".join([f"own{k}x{i}" for i in range(k)] + passage + [f"end{k}"] * 3)) for k in range(1, 30)]
    got = {i: t for i, t, _ in deduped(make_docs(*rows))}
    assert got[1] == rows[0][1]
    for k in range(2, 30):
        # What the passage shares a part with at its ends may stay.
        assert len(set(got[k].split()) & set(passage)) < 30, k
        assert got[k].split()[:1] == [f"own{k}x0"]


def test_dedup_finds_passages_of_short_sentences(make_docs):
    random.seed(8)
    for size in (1, 2, 3):
        listed = "".join(" ".join(f"q{random.randrange(900)}" for _ in range(size)) + random.choice(".!\n") + " " for _ in range(60))
        rows = [(k, "".join(f"own{k}x{i}. " for i in range(k)) + listed) for k in range(1, 8)]
        got = {i: t for i, t, _ in deduped(make_docs(*rows))}
        assert got[1] == rows[0][1]
        assert all(len(got[k].split()) < 15 * size + k for k in range(2, 8))


def test_dedup_of_scripts_without_blanks(make_docs):
    random.seed(7)
    signs = [chr(c) for c in range(0x4E00, 0x5E00)]
    passage = "".join(random.sample(signs, 90))
    ended = "".join("".join(random.sample(signs, 6)) + "\u3002" for _ in range(12))
    rows = [(k, "".join(random.sample(signs, 3 * k)) + passage) for k in range(1, 6)]
    rows += [(10 + k, "".join(random.sample(signs, k)) + "\u3002" + ended) for k in range(1, 4)]
    got = {i: t for i, t, _ in deduped(make_docs(*rows))}
    assert got[1] == rows[0][1] and got[11] == rows[5][1]
    assert all(len(set(got[k]) & set(passage)) < 40 for k in range(2, 6))
    assert all(len(got[10 + k]) == k + 1 for k in range(2, 4))


def test_sentences_lose_nothing():
    for text in ("", "a", "..", "a. b\nc", "\n\n x y! z", "é" * 200, " ".join(["w"] * 99) + "?!\n end", " \x0b ".join("ab") * 90):
        assert b"".join(sd.sentences(text.encode())) == text.encode()


def test_dedup_of_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    named = odd_docs.withColumns({"kept_text": F.lit(1), "marks": F.lit("m"), "place": F.lit(2)})
    out = sd.remove_repeated(named.drop("marks"))
    assert Counter((r["doc_id"], r["kept_text"], r["removed_sentences"]) for r in out.collect()) == brute_dedup(rows)
    assert "place" in out.columns
    assert sd.remove_repeated(odd_docs.where("false")).count() == 0


def plain(text):
    return [w for w in re.split(r"[\x00-/:-@\[-`{-\x7f]+", (text or "").lower()) if w]


def runs_of(words):
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def brute_contaminated(rows, items, similarity=0.8):
    out = {}
    firsts = {}
    for item, text in sorted(items):
        words = plain(text)
        if len(words) >= 5:
            firsts.setdefault(tuple(words), item)
    for i, text in rows:
        words = plain(text)
        for own, item in firsts.items():
            theirs = runs_of(list(own))
            if not set(theirs) & set(runs_of(words)):
                continue
            for at in range(max(1, len(words) - len(own) + 1)):
                window = runs_of(words[at : at + len(own)])
                shared = sum((window & theirs).values())
                near = shared / (sum(window.values()) + sum(theirs.values()) - shared)
                if near >= similarity and near > out.get((i, item), 0):
                    out[(i, item)] = near
    return out


def matched(docs, benchmark):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in dec.contaminated(docs, benchmark).collect()}


def test_decontamination_on_the_test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    assert matched(docs, benchmark) == pytest.approx(brute_contaminated(rows, items))


def test_decontamination_of_changed_copies(make_docs, spark):
    random.seed(2)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(k, " ".join(random.choices(vocabulary, k=random.randrange(25, 70)))) for k in range(25)]
    rows = []
    for k, (_, text) in enumerate(items * 4):
        words = text.split()
        if k % 4 == 1:
            words[random.choice([0, 1, -1, -2])] = "other"
        elif k % 4 == 2:
            words = words[random.choice([1, 2]) :]
        elif k % 4 == 3 and len(words) > 55:
            words[30] = "other"
        around = random.choices(vocabulary, k=random.choice([0, 3, 200]))
        rows.append((k, " ".join(around + [w.upper() + "," for w in words] + around[:2])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contaminated(rows, items)
    assert len(want) > 70
    assert matched(make_docs(*rows), benchmark) == pytest.approx(want)


def test_decontamination_of_odd_rows(odd_docs, spark):
    items = [
        (7, None),
        (8, ""),
        (9, "one sentence"),
        (None, "a text without an id which nobody can link to"),
        (11, "a text without an id which nobody can link to"),
        (10, "A text without an id, which nobody can link to!"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert matched(odd_docs.withColumn("item_id", F.lit(0)), benchmark) == {(None, 10): 1.0}
    assert dec.contaminated(odd_docs, benchmark.where("false")).count() == 0
    assert dec.contaminated(odd_docs.where("false"), benchmark).count() == 0


def test_dedup_takes_any_column_names(spark, make_docs):
    passage = "This passage stands in two documents word for word. It is long enough to be found as a run."
    docs = make_docs((1, passage), (2, passage)).withColumns(
        {c: F.lit(c) for c in ("marks", "_id", "id", "row", "span", "place", "a.b")}
    )
    found = sd.remove_repeated(docs).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["kept_text"]) for r in found] == [(1, passage), (2, "")]
    assert all(r[c] == c for r in found for c in ("marks", "_id", "id", "row", "span", "place", "a.b"))
