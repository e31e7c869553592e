"""What tasks hold of their input and leave in a Python worker."""

import re

import pyarrow as pa

from tidemill.llm import exact_dedup, langid, shared


def resident_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


def test_large_batches_come_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(4_000)), pa.array(["x" * 10_000] * 4_000)], names=["id", "text"])
    read = []

    def run(batches):
        for b in batches:
            read.append((b.num_rows, b.nbytes))
            yield b
    out = list(shared.lean(run)(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert pa.Table.from_batches(out) == pa.Table.from_batches([batch, batch.slice(0, 1)])
    assert max(size for _, size in read) <= shared.PIECE and min(n for n, _ in read) == 1


def test_task_gives_back_what_it_freed():
    def run(batches):
        table = {}
        for b in batches:
            for t in shared.texts_of(b.column(0)):
                table.update((w, len(table)) for w in t.split())
        yield pa.RecordBatch.from_arrays([pa.array([len(table)])], names=["n"])

    def batches():
        for k in range(8):
            yield pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{k}x{i}y{j}" for j in range(100)) for i in range(1_000)] * 10)], names=["text"])
    before = resident_mb()
    assert [b.column(0).to_pylist() for b in shared.lean(run)(batches())] == [[800_000]]
    assert resident_mb() < before + 40


def test_large_batch_gives_back_between_its_pieces(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10_000] * 4_000)], names=["text"])
    said = []
    monkeypatch.setattr(shared, "give_back", lambda: said.append("given back"))
    list(shared.lean(lambda batches: (b for b in batches if not said.append(b.num_rows)))(iter([batch.slice(0, 5), batch])))
    assert said[0] == 5 and sum(x for x in said if x != "given back") == 4_005
    assert said.count("given back") == len(said) - said.count("given back") and said[-1] == "given back"


def test_exact_dedup_drops_what_another_operator_keeps():
    for chains, names, rows in ((exact_dedup._local_chains, ["uid", "doc_id", "key", "text_sha256", "text"], [[1], [7], [3], ["s"], ["a text"]]),
                                (exact_dedup._owner_chains, ["key", "rep", "copies", "largest", "text"], [[3], [1], [1], [7], ["a text"]])):
        assert shared.worker_cache("words of another operator", lambda: ["word"]) == ["word"]
        assert sum(b.num_rows for b in chains(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=names)])))
        assert shared._kept == [None, None]


def test_language_texts_go_to_tasks_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de"), (None, "en")])],
                                 "doc_id long, text string, lang string")
    read = []
    monkeypatch.setattr(langid, "map_batches", lambda df, *rest: (read.append(df), shared.map_batches(df, *rest))[1])
    model = langid.train(docs)
    whole, slim = langid.identify(docs, model), langid.identify(docs, model, ["doc_id"])
    assert [sum(t == "string" for _, t in df.dtypes) for df in read] == [2, 1]
    assert whole.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert sorted(whole.select("text").collect(), key=str) == sorted(docs.select("text").collect(), key=str)
    assert sorted(whole.select(*slim.columns).collect()) == sorted(slim.collect())
