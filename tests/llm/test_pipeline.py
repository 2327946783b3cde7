"""The pipeline against a version without Spark."""

from itertools import combinations

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from benchloom.llm import bin_packing, language_kernel, quality
from tests.llm.odd import table
from tests.llm.test_near_duplicates import Groups, brute_lines
from tests.llm.test_packing import check
from tests.llm.test_shingle_sets import brute_set, jaccard

FOLDER = "/root/testdata/sf0.01"


def wrapped(text, width):
    """The words of a text in other lines: no line is a near copy, but the document is."""
    words = text.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_pipeline(spark, tmp_path):
    given = pq.read_table(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in given.to_pylist()}
    long = [r for r in rows.values() if r["lang"] and len((r["text"] or "").split()) > 80][:25]
    planted = [{**r, "doc_id": 900_000 + i, "text": wrapped(r["text"], 4 + i % 4)} for i, r in enumerate(long)]
    rows |= {r["doc_id"]: r for r in planted}
    pq.write_table(pa.Table.from_pylist(list(rows.values()), given.schema), tmp_path / "documents.parquet")
    folder = str(tmp_path)
    # stage 1: the model is the operator's own, fitted on the same rows
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_kernel.train(documents.where(~language_kernel.held_out(documents["doc_id"], 4)))
    own = language_kernel.Presence()
    texts = {key: r["text"] for key, r in rows.items()}
    texts = {key: x for key, x in texts.items() if len(own.grams(x)) and model.scores([own.grams(x)]).max() >= 0.3}
    # stage 2: SQL
    import duckdb

    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(texts), "text": list(texts.values())}))
    good = {x for (x,) in con.execute(f"SELECT doc_id FROM ({quality.sql()}) WHERE kept").fetchall()}
    texts = {key: x for key, x in texts.items() if key in good}
    # stage 3
    cleaned = brute_lines(list(texts.items()))
    live = lambda x: any(any(c.isalnum() for c in y) for y in x.split("\n"))
    texts = {key: x for key, x in cleaned.items() if x == texts[key] or live(x)}
    # stage 4: all pairs that share a shingle
    names, sets = sorted(texts), {key: brute_set(x) for key, x in texts.items()}
    place, holders, groups = {key: i for i, key in enumerate(names)}, {}, Groups(len(names))
    for key in names:
        for shingle in sets[key]:
            holders.setdefault(shingle, []).append(key)
    for a, b in {pair for own in holders.values() for pair in combinations(own, 2)}:
        if jaccard(sets[a], sets[b]) >= 0.8:
            groups.join(place[a], place[b])
    first = {}
    for key in sorted(names, reverse=True):
        first[groups.root(place[key])] = key
    gone = set(names) - set(first.values())
    assert len(gone & {r["doc_id"] for r in planted}) >= 10
    texts = {key: texts[key] for key in first.values()}
    # stage 5: any placing is right that is whole and as cheap as the plan
    found = corpus_pipeline.run(spark, folder).collect()
    check(found, {key: len(x.encode().split()) + 1 for key, x in texts.items()}, 4096)
    histogram = {}
    for r in found:
        histogram[r["length"]] = histogram.get(r["length"], 0) + 1
    bins = {r["bin_id"]: r["capacity"] for r in found}
    assert abs(sum(map(bin_packing.sequence_cost, bins.values())) - bin_packing.plan(histogram)[0]) < 1e-6


def test_stages_on_odd_rows(spark):
    rows = table(spark).selectExpr("doc_id", "text", "lang", "'x' as source", "n_words as n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows.limit(0), FOLDER).count() == 0, name
        out = stage(spark, rows, FOLDER)
        assert out.count() > 0 and (out.columns == rows.columns or name == "best_fit_packing"), name
