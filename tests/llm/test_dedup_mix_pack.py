"""Operators 3, 4, 7 and 10 against brute force, with nulls, empty and repeated rows, empty tables and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tidemill.llm import exact_dedup, minhash, mixing, packing
from tidemill.llm.shared import LOWER, UPPER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, key string, node long, rep string, _u string"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"


def table(spark, rows):
    """(doc_id, text, source) rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, "k", 7, "r", "u") for i, t, s in rows], SCHEMA)


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


ROWS = [(1, "Same Text", "a"), (2, "same text", "a"), (3, "SAME TEXT", None), (4, None, "a"), (5, "", "b"), (6, " ", "b"),
        (7, "É", "b"), (8, "é", "c"), (9, BASE, "c"), (9, BASE, "c"), (None, "same text", "a"), (None, "alone", None),
        (10, "long " * 30_000, "c"), (11, "long " * 30_000, "d")]


def test_exact_duplicates(spark):
    out = [r.asDict() for r in exact_dedup.exact_duplicates(table(spark, ROWS).repartition(3), capacity=2).collect()]
    assert len(out) == len(ROWS)
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(lower(t), []).append(i)
    want = sorted((str(i), str(max((x for x in groups[lower(t)] if x is not None), default=None)), len(groups[lower(t)]),
                   hashlib.sha256(lower(t).encode()).hexdigest()) for i, t, _ in ROWS)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in out) == want
    kept = [r for r in out if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    left = exact_dedup.drop_exact_duplicates(table(spark, ROWS))
    assert left.columns == table(spark, ROWS).columns
    assert sorted(lower(r["text"]) for r in left.collect()) == sorted(groups)


def test_directory_doubles_only_overfull_buckets(spark):
    rng = np.random.default_rng(2)
    deep = [(1 << 62) + i for i in range(40)]  # these differ in their last bits alone
    places = [k << 58 for k in range(32)] + [5] * 9 + deep + rng.integers(0, 1 << 63, 300).tolist()
    df = spark.createDataFrame([(p, 1) for p in places], "place long, weight long")
    buckets = exact_dedup.build_directory(df, 3).collect()
    held = {(b["depth"], b["prefix"]): sorted(p for p in places if p >> (63 - b["depth"]) == b["prefix"]) for b in buckets}
    assert sorted(p for h in held.values() for p in h) == sorted(places)  # each place in one bucket
    for b in buckets:
        own = held[b["depth"], b["prefix"]]
        assert (b["n"], b["weight"], b["lo"], b["hi"]) == (len(own), len(own), own[0], own[-1])
        assert len(own) <= 3 or own[0] == own[-1] == 5  # nine equal keys can't split
        above = [p for p in places if p >> (64 - b["depth"]) == b["prefix"] >> 1] if b["depth"] else []
        assert not b["depth"] or len(above) > 3  # no bucket is deeper than it must be
    assert max(b["depth"] for b in buckets) > 60
    assert exact_dedup.build_directory(df.limit(0), 3).count() == 0


def test_owners_take_runs_of_buckets_of_like_weight(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "OWNED", 1000)
    rng = np.random.default_rng(4)
    places, weights = np.unique(rng.integers(0, 1 << 63, 2000)), rng.integers(1, 20, 2000)
    df = spark.createDataFrame(list(zip(places.tolist(), weights.tolist())), "place long, weight long")
    firsts = exact_dedup.owners(exact_dedup.build_directory(df, 8))
    load = np.bincount(np.maximum(np.searchsorted(firsts, places, "right") - 1, 0), weights[:len(places)])
    assert len(firsts) > 10 and load.max() < 1.3 * np.median(load)


def test_split_begins_new_chains_in_bounded_memory(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HELD", 2000)
    rows = [(i, f"text {i % 7} " + "x" * 300 * (i % 5), "a") for i in range(140)]
    out = exact_dedup.exact_duplicates(table(spark, rows).coalesce(1)).collect()
    assert len(out) == 140 and sum(r["kept"] for r in out) == 35
    assert all(r["keep_id"] == 105 + r["doc_id"] % 35 and r["group_size"] == 4 for r in out)


def test_owner_compares_bytes_along_a_chain():
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2]), pa.array([10, 11, 12, 13]), pa.array([1, 2, 1, 1]), pa.array([5, None, 9, 4]),
                                    pa.array(["x", "y", "x", "x"])], names=["key", "rep", "copies", "largest", "text"])
    got = [tuple(r.values()) for out in exact_dedup._owner_chains(iter([b])) for r in out.to_pylist()]
    assert sorted(got) == [(10, 9, 2), (11, None, 2), (12, 9, 2), (13, 4, 1)]


def test_mix(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3] if i % 10 else None) for i in range(400)] + [(400, None, "a"), (401, "", "z"), (None, "x y", "b"), (5, "w " * 6, "c")]
    out = [r.asDict() for r in mixing.mix_sources(table(spark, rows)).collect()]
    again = mixing.mix_sources(table(spark, rows).repartition(5))
    assert sorted(map(str, out)) == sorted(str(r.asDict()) for r in again.select(*out[0]).collect())
    assert len(out) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    # water filling, round by round
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, free, left = {}, set(size), 1.5 * sum(size.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= 2 * size[s]}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        free -= over
    taken = {}
    for r in out:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 4 for s in size)
    mixed = mixing.apply_mix(table(spark, rows))
    assert mixed.columns == table(spark, rows).columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == pytest.approx(sum(taken.values()), abs=12)


def shingles(text, n):
    w = lower(text).encode().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_near_duplicates(spark):
    rng = np.random.default_rng(0)
    rows, words = [], BASE.split()
    for g in range(12):  # chains of texts that drift word by word: ends of a chain are far apart
        text = [words[i] + str(g % 9) for i in rng.integers(0, len(words), 60)]
        for k in range(9):
            rows.append((len(rows), " ".join(text), "s"))
            text[int(rng.integers(0, 60))] = f"x{g}y{k}"
    rows += [(500, None, "s"), (501, "", "s"), (502, "One  two", "s"), (503, "one two", "s"), (504, "one", "s"), (None, rows[0][1], "s"), (0, rows[0][1], "s")]
    got = minhash.near_duplicates(table(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t, 3) for i, t, _ in rows if i is not None}
    reach = {i: i for i in sets}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                reach[y] = x
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root(r["doc_id"]), root(r["doc_id"]) == r["doc_id"])
    left = minhash.drop_near_duplicates(table(spark, rows))
    assert left.columns == table(spark, rows).columns and left.where("doc_id is null").count() == 1


def test_circulant_coordinates_estimate_similarity():
    a = minhash.shingle_set(" ".join(f"w{i}" for i in range(400)).encode(), 3)
    b = minhash.shingle_set(" ".join(f"w{i}" for i in range(40, 440)).encode(), 3)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (minhash.signature(a, 256) == minhash.signature(b, 256)).mean()
    assert abs(same - true) < 0.12


def test_pack(spark):
    rows = [(i, " ".join(f"Word{j % (i + 3)}" for j in range(37 * i % 900)), "s") for i in range(120)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "Σας <|endoftext|> <|ENDOFTEXT|> don't STOP...", "s"), (None, "null id", "s"), (3, rows[3][1], "s"),
             (203, "very long " * 6000, "s")]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    got = [r.asDict() for r in packing.pack(table(spark, rows).repartition(3), block=40).collect()]
    seen = {}
    for r in got:
        ids = want[r["doc_id"]][0]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for i, pieces in seen.items():
        n = len(want[i])
        line = sorted(pieces)[::n]
        assert [s for s, _ in line] == list(np.cumsum([0] + [x for _, x in line])[:-1]) and sum(x for _, x in line) == len(want[i][0])
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_seq.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [x for _, x in pieces])[:-1]) and sum(x for _, x in pieces) <= 2048
    total = sum(r["length"] for r in got)
    assert len(by_seq) <= total / 2048 * 1.05 + 1


def test_patterns_cover_demand_near_the_bound():
    rng = np.random.default_rng(1)
    sizes = np.arange(3, 60)
    demand = rng.integers(1, 400, len(sizes)).astype(float)
    patterns = packing.solve_patterns(demand, sizes, 128)
    assert (sum(p * n for p, n in patterns) >= demand).all() and all(p @ sizes <= 128 for p, _ in patterns)
    assert sum(n for _, n in patterns) <= (demand @ sizes) / 128 * 1.02 + 2
    value, pattern = packing.price_pattern(np.array([3.0, 5.1, 7.0]), np.array([2, 3, 5]), 10)
    assert pattern @ np.array([2, 3, 5]) <= 10 and value == pytest.approx(pattern @ np.array([3.0, 5.1, 7.0]))


def test_empty_tables(spark):
    empty = table(spark, [])
    for df in (exact_dedup.exact_duplicates(empty), exact_dedup.drop_exact_duplicates(empty), mixing.mix_sources(empty), mixing.apply_mix(empty),
               minhash.near_duplicates(empty), minhash.drop_near_duplicates(empty), packing.pack(empty)):
        assert df.count() == 0


def test_stages_keep_columns_named_like_helpers(spark):
    names = ["_key", "_nth", "__key", "_id", "_copies", "_src", "_u"]
    rows = [(i, f"{BASE} {'x' * (i % 3)} {i if i % 2 else ''}", "s", *[f"{n}{i}" for n in names]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for stage in (exact_dedup.drop_exact_duplicates, minhash.drop_near_duplicates, mixing.apply_mix):
        out = stage(df)
        assert out.columns == df.columns
        got = out.collect()
        assert got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)


def similar(text_a, text_b, words, percent):
    a, b = (set(minhash.shingle_set(t.encode(), words).tolist()) for t in (text_a, text_b))
    return 100 * len(a & b) >= percent * len(a | b)


def classes(texts, words, percent):
    """Least index reachable over all similar pairs."""
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if similar(texts[i], texts[j], words, percent):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return [root(i) for i in range(len(texts))]


def test_groups_around_the_similarity(spark):
    """Copies of one text with 0 to 9 % of the words replaced: some pairs link, many lie just below."""
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for i in range(60):
        w = list(base)
        for p in rng.choice(300, int(rng.integers(0, 28)), replace=False):
            w[p] = f"own{i}x{p}"
        texts.append(" ".join(w))
    texts += [" ".join(f"z{rng.integers(0, 10 ** 9)}" for _ in range(40)) for _ in range(20)]
    out = minhash.near_duplicates(table(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(3), 3, 85, bands=32, rows=4).collect()
    want = classes(texts, 3, 85)
    assert len(set(want[:60])) > 3 and len(set(want[:60])) < 50
    assert {r["doc_id"]: r["component_id"] for r in out} == dict(enumerate(want))


def test_open_pairs_are_whole_and_few(spark):
    """The set similarity join alone, every text a component: all similar pairs are among its pairs; of a large group just
    below the similarity no pair arises."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(200)]

    def variant(i, share):
        w = list(base)
        for p in rng.choice(200, int(200 * share), replace=False):
            w[p] = f"own{i}x{p}"
        return " ".join(w)
    near = [variant(i, 0.01) for i in range(12)] + [f"short {i % 3} text" for i in range(6)]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(near)], "id long, c long, text string").repartition(3)
    got = {(r["a"], r["b"]) for r in minhash._open_pairs(df, 3, 80).collect()}
    want = {(j, i) for i in range(len(near)) for j in range(i) if similar(near[i], near[j], 3, 80)}
    assert want and want <= got
    below = [variant(i, 0.08) for i in range(300)]  # a similarity of about 0.65
    assert not similar(below[0], below[1], 3, 80)
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(below)], "id long, c long, text string").repartition(3)
    assert minhash._open_pairs(df, 3, 80).count() < 300


def test_near_misses_make_no_pairs(spark):
    """Texts with 2 and with 3 words replaced: pairs of the first link at exactly 85 %, the others have 78 and 82 %."""
    rng = np.random.default_rng(3)
    texts = []
    for i in range(80):
        w = [f"b{k}" for k in range(150)]
        for k in range(2 + i % 2):
            w[int(rng.integers(4, 10)) + 40 * k + 10 * (i % 3)] = f"own{i}x{k}"
        texts.append(" ".join(w))
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, c long, text string").repartition(3)
    got = {(r["a"], r["b"]) for r in minhash._open_pairs(df, 3, 85).collect()}
    want = {(j, i) for i in range(80) for j in range(i) if similar(texts[i], texts[j], 3, 85)}
    assert len(want) >= 780 and want <= got and len(got) < 1.05 * len(want)


def test_joined_components_take_links_to_labels(spark):
    rng = np.random.default_rng(4)
    parts = [[(int(a), int(b)) for a, b in rng.integers(0, 90, (n, 2)) if a != b] for n in (20, 1, 25, 30)]
    labels, links = None, []
    for part in parts:
        links += part
        labels = minhash.joined_components(labels, spark.createDataFrame(part, "a long, b long"))
        whole = minhash.components(spark.createDataFrame(links, "a long, b long"))
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, whole.collect()))
    same = minhash.joined_components(labels, spark.createDataFrame(parts[0], "a long, b long"))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, labels.collect()))


def test_near_duplicates_keep_little_in_the_driver(spark):
    """The table of frequencies takes a byte a cell; the pairs' joins broadcast nothing, however small they are."""
    texts = spark.createDataFrame([(i, f"one two three four {i % 2}") for i in range(4)], "id long, text string")
    often = minhash._frequencies(texts, 3)
    assert often.nbytes == minhash.CELLS and sorted(often[often > 0].tolist()) == [9, 9, 17, 17]
    out = minhash._verified(spark.createDataFrame([(0, 2), (0, 1)], "a long, b long"), texts, 3, 85)
    assert [tuple(r) for r in out.collect()] == [(0, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_first_shingles_find_every_linked_pair():
    rng = np.random.default_rng(1)
    often = rng.integers(0, 50, minhash.CELLS).astype(np.uint32)
    for _ in range(300):
        percent = int(rng.choice([80, 85]))
        common = rng.integers(0, 2 ** 63, int(rng.integers(1, 60)), dtype=np.int64).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, int(rng.integers(0, 8)), dtype=np.int64).astype(np.uint64)])) for _ in "ab")
        a, b = sorted((a, b), key=len)
        inter = len(np.intersect1d(a, b))
        if 100 * inter >= percent * (len(a) + len(b) - inter):
            rare_a, small = minhash.first_shingles(a, often, percent)
            rare_b, _ = minhash.first_shingles(b, often, percent)
            assert len(np.intersect1d(rare_a[:small], rare_b))


def _id_of_a():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_vocabulary()).encode("a", add_special_tokens=False).ids[0]


IDS = {"a": _id_of_a()}


@pytest.mark.parametrize("lowest, highest", [(1, 1), (5, 40), (1, 700)])
def test_short_texts_leave_little_padding(spark, lowest, highest):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(["a"] * int(rng.integers(lowest, highest + 1))), "s") for i in range(4000)] + [(7, "a a", "s")] * 500
    out = packing.pack(table(spark, rows).repartition(4), block=300).collect()
    tokens = sum(len(t.split()) + 1 for _, t, _ in rows)
    assert sum(r["length"] for r in out) == tokens
    used = len({r["sequence_id"] for r in out})
    assert used * 2048 <= tokens * (1.02 if highest < 100 else 1.04) + 2 * 2048
    ends = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    of_doc = {}
    for r in out:
        if r["doc_id"] != 7:
            of_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]))
    for i, t, _ in rows[:4000]:
        if i != 7:
            parts, n = sorted(of_doc[i]), len(t.split()) + 1
            assert [p[0] for p in parts] == [sum(x[1] for x in parts[:j]) for j in range(len(parts))] and sum(p[1] for p in parts) == n == parts[0][2]
            ids = np.array([IDS["a"]] * (n - 1) + [1], "<u4")
            assert all(c == zlib.crc32(ids[s:s + k].tobytes()) for s, k, _, c in parts)


def test_plain_words_take_the_merges_alone():
    """Ids are those of the whole text; the tokenizer with its normalising is asked for other words only."""
    words = packing.WordIds(packing.default_vocabulary())
    whole, asked = words.tokenizer, []

    class Counted:
        def encode_batch_fast(self, new, **kw):
            asked.extend(new)
            return whole.encode_batch_fast(new, **kw)
    words.tokenizer = Counted()
    odd = ["it's", "Éa", "éx", "日本", "a​b", "<|endoftext|>", "x<|startoftext|>y", "1²"]
    plain = ["house", "and,", "élan.", "a1b22c", "%%%", "(x+y)=3;", "</w>", "a</w>", "ßü", "f_g-h", "|>", "é", "."]
    texts = [" ".join(plain + odd), "", " \t", " ".join(odd + plain[::-1]), "HOUSE And, New-Word!", "house"]
    ids, counts = words.of([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted(odd)


def spread(n, words, most, seed):
    """Copies of one text, each with up to ``most`` of its words replaced."""
    rng = np.random.default_rng(seed)
    texts = []
    for i in range(n):
        w = [f"b{k}" for k in range(words)]
        for k in rng.choice(words, int(rng.integers(0, most)), replace=False):
            w[k] = f"own{i}x{k}"
        texts.append(" ".join(w))
    return texts


def test_open_pairs_are_made_at_their_first_shared_shingle(spark):
    texts = spread(60, 200, 6, 11) + spread(20, 600, 9, 12)
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, c long, text string").repartition(3)
    got = [(r["a"], r["b"]) for r in minhash._rows_of_pairs(*minhash._open_rows(df, 3, 85), 85).collect()]
    want = {(j, i) for i in range(80) for j in range(i) if similar(texts[i], texts[j], 3, 85)}
    assert len(want) > 300 and want <= set(got)
    assert len(got) == len(set(got))  # one row, however many shingles they share


def test_large_components_take_others_in_by_a_few_nodes(spark, monkeypatch):
    """Drawn nodes make a share of the linked pairs; rounds of more and more of them give the same components."""
    near = [" ".join(f"own{i}" if k == i + 3 else f"b{k}" for k in range(200)) for i in range(130)]
    df = spark.createDataFrame([(i, min(i, 10), t) for i, t in enumerate(near)], "id long, c long, text string").repartition(3)
    rows = minhash._open_rows(df, 3, 85)
    whole = {tuple(r) for r in minhash._rows_of_pairs(*rows, 85).collect()}
    few = {tuple(r) for r in minhash._rows_of_pairs(*rows, 85, 12).collect()}
    assert len(whole) == 10 * 120 + 45 and few < whole and len(few) < 300
    assert {a for a, _ in few} == set(range(10)) and {b for _, b in few} <= set(range(10, 130))
    rounds, plain = [], minhash._rows_of_pairs
    monkeypatch.setattr(minhash, "_rows_of_pairs", lambda met, sketches, percent, drawn=None: rounds.append(drawn) or plain(met, sketches, percent, drawn))
    monkeypatch.setattr(minhash, "TURNS", 1)  # leaves much to the join
    monkeypatch.setattr(minhash, "DRAWN", 2)
    texts = spread(150, 300, 28, 13)
    out = minhash.near_duplicates(table(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(3), 3, 85, bands=32, rows=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == dict(enumerate(classes(texts, 3, 85)))
    assert rounds[0] == 2 and rounds[-1] is None and rounds.count(None) == 1
