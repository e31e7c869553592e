"""Operators 11 to 13 against brute force, with nulls, empty, repeated and very long rows, empty tables and clashing columns."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import lexical, periodic_runs, queries, warc
from tidemill.llm.shared import LOWER, UPPER

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- operator 11

def brute_search(docs, items, k=10):
    def terms(t):
        return TERM.findall((t or "").translate(str.maketrans(UPPER, LOWER)))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    big_n, big_l = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    merged = {}
    for i, t in items:
        if i is not None:
            merged.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in merged.items():
        got = []
        for i, c, n in bags:
            m = 10 + (90 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in ts if t in c)
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, g[3], -g[0]) for r, g in enumerate(sorted(got)[:k])]
    return sorted(out)


def zipf_texts(rng, n, longest=60):
    words = [f"w{i}" for i in range(200)]
    return [" ".join(rng.choices(words, [1 / (i + 1) for i in range(200)], k=rng.randint(0, longest))) for _ in range(n)]


def searched(spark, docs, items, parts=3):
    d = spark.createDataFrame([(i, t, "x", 1, b"y") for i, t in docs], "doc_id long, text string, shard string, df long, packed binary")
    q = spark.createDataFrame([(i, t, 3, "z") for i, t in items], "item_id long, text string, block int, term string")
    out = lexical.search(lexical.build_index(d.repartition(parts)), q)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in out.collect())


def test_search_equals_brute_force(spark):
    rng = random.Random(4)
    texts = zipf_texts(rng, 300) + ["same words here"] * 15 + [None, "", " .,", "É é ÀB Ünï 東京 w1", "w1 " * 20_000]
    docs = list(enumerate(texts)) + [(5, "w1 w2 same"), (None, "same words w3")]
    items = [(i, " ".join(f"w{rng.randint(0, 220)}" for _ in range(rng.randint(1, 30)))) for i in range(20)]
    items += [(100, "same WORDS, here!"), (101, None), (102, ""), (103, "nowhere"), (104, "É 東京"), (104, "w7"), (None, "w1")]
    assert searched(spark, docs, items) == brute_search(docs, items)


def test_search_without_documents_or_queries(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def test_numbers_come_back_from_bytes():
    values = np.array([0, 1, 127, 128, 300, 16_383, 16_384, 2 ** 31, 2 ** 40])
    packed, size = lexical.pack_numbers(values)
    assert size.tolist() == [1, 1, 1, 2, 2, 2, 3, 5, 6] and lexical.unpack_numbers(packed).tolist() == values.tolist()


def test_blocks_are_rejected_before_they_are_decoded(monkeypatch):
    """One shard of many small blocks: the result is exact, and lists of frequent terms stay mostly packed."""
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "WINDOW", 64)
    rng = random.Random(2)
    texts = zipf_texts(rng, 2000, 40)
    for i in range(0, 2000, 100):
        texts[i] = "rare " + texts[i]
    held = lexical._Shard()
    for i, t in enumerate(texts):
        held.add(i, t.encode())
    head, rows = (b.to_pylist() for b in held.lists("0"))
    n, ids = np.array(head[0]["lengths"]), np.array(head[0]["doc_ids"])
    assert n.tolist() == sorted(n.tolist())
    big_n, big_l = len(n), int(n.sum())

    def docs_m(x):
        return 10 + (90 * x * big_n) // big_l
    windows = -(-len(n) // 64)
    for query, share in (("rare w0 w1 w2", 0.5), ("w0 w1 w150 w199", 1.0), ("w0", 1.0)):
        own = []
        for r in rows:
            if r["term"].decode() in query.split():
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * r["df"] + 1)))
                own.append(lexical._List(w, r, docs_m(n), docs_m, windows))
        docs, scores = lexical.top_of_shard(own, ids, 10)
        want = brute_search(list(enumerate(texts)), [(1, query)])
        assert [(1, i + 1, int(ids[d]), int(s)) for i, (d, s) in enumerate(zip(docs, scores))] == want
        decoded, there = sum(len(x.blocks) for x in own), sum(len(x.first) for x in own)
        assert decoded <= share * there and (share == 1.0 or decoded < there)


# ---- operator 12

PAGES = [(1, "http://www.Example.com/a?x=1#f", "same"), (2, "https://example.com:443/a?x=1", "same"), (3, None, "same"), (4, "http://example.com/b", None),
         (5, "", ""), (6, "not a url", "ünï\r\n\r\nWARC/1.1 trap"), (7, "http://a b.com/\n", "x"), (8, '"quoted"', "y"), (9, "http://[bad", "z"),
         (10, "http://example.com/long/" + "p" * 5000, "long " * 200_000), (11, "http://example.com/b", "other"), (12, "http://example.com/b!", "o2"),
         (13, "http://example.com:8080/b", "o3"), (14, "http://exämple.com/東", "o4"), (15, "http://example.com/b", "same")]


def page_table(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", 1) for r in rows], "page_id long, url string, html string, key string, payload string, offset long")


def expected(rows, least=0):
    top = {}
    for i, _, h in rows:
        h = (h or "").encode()
        top[h] = i if h not in top or (i is not None and (top[h] is None or i > top[h])) else top[h]
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        other = len(h) >= least and i != top[h]
        out.append((i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if other else "response", top[h] if other else None))
    return sorted(out, key=str)


def derived(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    rows = PAGES + [(16, "http://example.com/b", "same"), (16, "http://example.com/b", "same"), (None, "u", "same"), (None, "u", "alone")]
    assert derived(warc.round_trip(page_table(spark, rows).repartition(4), least)) == expected(rows, least)


def test_archives_of_nothing(spark):
    assert warc.round_trip(page_table(spark, [])).collect() == []


def test_hot_payload_and_hot_url(spark):
    rows = [(i, "http://h.org/same" if i % 3 else f"http://h.org/{i % 50}", "copy" if i % 2 else f"text {i}") for i in range(1500)]
    captures, _, folder = warc.archive(page_table(spark, rows).repartition(5))
    directory = warc.build_index(captures, folder, lines=16, per_file=200)  # the hot key spans blocks and files
    assert directory.select("file").distinct().count() > 3
    got = warc.read_records(warc.lookup(directory, folder, page_table(spark, rows)), folder, payloads=False)
    assert derived(got) == expected(rows)
    one = warc.lookup(directory, folder, spark.createDataFrame([("https://www.h.org/7",), ("http://h.org/none",)], "url string"))
    assert {r["page_id"] for r in one.collect()} == {i for i, u, _ in rows if u.endswith("/7")}


def test_archive_files_are_warc(spark):
    captures, _, folder = warc.archive(page_table(spark, PAGES))
    spots = captures.collect()
    base = warc.open_store(folder)[1]
    for f in {r["file"] for r in spots}:
        whole = gzip.open(os.path.join(base, f)).read()  # members in a row are one gzip file
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    out = {r["page_id"]: r for r in warc.read_records(captures, folder).collect()}
    for i, u, h in PAGES:
        assert out[i]["url"] == u
        assert out[i]["payload"] == (None if out[i]["record_type"] == "revisit" else (h or "").encode())


def test_damaged_record_is_refused():
    raw, _ = warc.record_bytes(1, "http://a.b/", b"payload")
    assert warc.read_record(warc.gzip_member(raw))[:3] == (1, "http://a.b/", 7)
    with pytest.raises(ValueError):
        warc.read_record(warc.gzip_member(raw.replace(b"payload\r", b"pAyload\r")))
    with pytest.raises(ValueError):
        warc.parse_record(raw[:-3])


def test_url_keys():
    assert warc.url_key("HTTPS://www.News.Example.org:443/a/B?q=1#top") == b"org,example,news)/a/B?q=1"
    assert warc.url_key("http://example.org:8080") == b"org,example:8080)/"
    assert warc.url_key(None) == b"" and warc.url_key("a b") == b"a%20b" and warc.url_key("http://[x") == b"http://[x"


# ---- operator 13

def brute_runs(w, least=6, times=4):
    out = []
    for p in range(1, len(w) // times + 1):
        s = 0
        while s < len(w) - p:
            if w[s] != w[s + p]:
                s += 1
                continue
            e = s
            while e < len(w) - p and w[e] == w[e + p]:
                e += 1
            if e + p - s >= max(least, times * p):
                smaller = any(all(w[x] == w[x + q] for x in range(s, e + p - q)) for q in range(1, p))
                if not smaller:
                    out.append((s, e + p - s, p))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(6)
    docs = []
    for _ in range(400):
        kind, n = rng.random(), rng.randint(0, 60)
        w = [rng.choice("ab" if kind < 0.5 else "abcde") for _ in range(n)]
        if kind > 0.3 and n:
            a, p = rng.randrange(n), rng.randint(1, 12)
            w += [w[a:][i % min(p, n - a)] for i in range(rng.randint(1, 90))] + [rng.choice("ab") for _ in range(rng.randint(0, 5))]
        docs.append(w)
    docs += [list("aaaaa"), list("aaaaaa"), list("abababab"), list("abcabcabcabc"), list("aabaabaabaab" * 3), []]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    runs = periodic_runs.find_runs(np.array([ord(c) for d in docs for c in d]), bounds)
    for i, d in enumerate(docs):
        assert sorted(((s, n, p) for j, s, p, n in runs if j == i), key=lambda r: (r[0], r[2])) == brute_runs(d), d


def contract(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(docs) > 150 and sum(1 for d in docs if got[d[0]][1]) > 10
    for d in docs:
        assert got[d[0]] == contract(*d)


def test_runs_of_odd_rows(spark):
    rows = [(None, "a b a b a b a b"), (1, None), (2, ""), (3, " \t\n"), (4, "É É É É É É"), (4, "É É É É É É"), (5, "x " * 100_000),
            (6, "one\x00two three"), (7, ("a b c " * 50_000))]
    df = spark.createDataFrame([(i, t, [1], "r") for i, t in rows], "doc_id long, text string, runs array<int>, collapsed string")
    got = sorted((tuple(r) for r in periodic_runs.digests(periodic_runs.periodic_runs(df.repartition(2))).collect()), key=str)
    plain = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    assert len(got) == len(rows) and plain[5]["runs"] == [(0, 100_000, 1)] and plain[5]["collapsed"] == "x"
    assert plain[7]["runs"] == [(0, 150_000, 3)] and plain[7]["collapsed"] == "a b c"
    assert plain[4]["runs"] == [(0, 6, 1)] and plain[1]["runs"] == [] and plain[1]["collapsed"] == ""
    assert plain[None]["runs"] == [(0, 8, 2)]
    none = hashlib.sha256(b"").hexdigest()
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, 0, None, None, None, None, none, none) for i in (1, 2, 3)]
    assert periodic_runs.periodic_runs(df.limit(0)).collect() == []
