"""Each stage of the pipeline on what its predecessor kept."""

import corpus_pipeline
from bizlens.llm.pii import KEY, find

from tests.llm.test_jaccard import plain


def test_stages(spark, small_dir, docs):
    (_, language), (_, near), (_, private), (_, packing) = corpus_pipeline.STAGES
    told = language(spark, docs, small_dir)
    rows = {r["doc_id"]: r for r in told.collect()}
    assert told.columns == docs.columns
    assert set(rows) == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    one = near(spark, told, small_dir)
    kept = {r["doc_id"]: r for r in one.collect()}
    assert one.columns == docs.columns
    assert set(kept) == {i for i, _, top in plain([(i, r["text"]) for i, r in rows.items()], 5, 80) if i == top}
    assert all(kept[i] == rows[i] for i in kept)
    masked = private(spark, one, small_dir)
    out = {r["doc_id"]: r for r in masked.collect()}
    assert masked.columns == docs.columns and set(out) == set(kept)
    for i, r in out.items():
        found = find(kept[i]["text"], KEY)
        assert (r["text"] != kept[i]["text"]) == bool(found) and r["n_chars"] == len(r["text"])
        assert not any(kept[i]["text"][a:b] in r["text"] for a, b, *_ in found)
    placed = packing(spark, masked, small_dir).collect()
    assert {r["doc_id"] for r in placed} == set(out)
    whole = corpus_pipeline.run(spark, small_dir).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in placed)


def test_one_document_of_each_group_where_ids_repeat(spark, small_dir):
    x, y = (" ".join(f"{w}{k}" for k in range(60)) for w in "xy")
    kept = lambda rows: sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), small_dir).collect())
    two = kept([(5, x), (5, x + " end")])
    assert len(two) == 1 and two[0] in [(5, x), (5, x + " end")]
    assert kept([(3, x), (5, x), (5, y), (5, y), (7, "")]) == [(3, x), (5, y), (7, "")]


def test_odd_and_empty(spark, small_dir, odd, none):
    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small_dir)
        got = sorted({r["doc_id"] for r in docs.collect()}, key=str)
        assert got == ([] if rows is none else [1, 4, 6])


def test_texts_that_stay_are_not_joined(spark, small_dir, monkeypatch):
    """Of 50 documents and a near copy of one, only the copy's text is looked up."""
    asked = []
    test = corpus_pipeline.perhaps_in
    monkeypatch.setattr(corpus_pipeline, "perhaps_in", lambda hashes: asked.append(hashes.count()) or test(hashes))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(50)]
    docs = spark.createDataFrame([*rows, (50, rows[7][1] + " end")], "doc_id int, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == rows
    assert kept.columns == docs.columns and asked == [1]
