import random

import corpus_pipeline as P


def prose(draw, n):
    return " ".join(f"w{draw.randint(0, 5000)}" for _ in range(n))


def test_stages_on_planted_cases(spark, tmp_path):
    draw = random.Random(8)
    item, shared, twin = prose(draw, 30), prose(draw, 60), prose(draw, 200)
    texts = {
        1: twin, 2: twin, 3: f"{prose(draw, 80)} {shared} {prose(draw, 80)}", 4: f"{prose(draw, 90)} {shared} {prose(draw, 70)}",
        5: f"{prose(draw, 50)} {item} {prose(draw, 50)}", 6: prose(draw, 150), 7: "too short", 8: "again and " * 60, 9: None, 10: "",
    }
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id: r for r in docs.collect()})
    assert [set(k) for k in kept] == [{1, 2, 3, 4, 5, 6}, {1, 3, 4, 5, 6}, {1, 3, 4, 5, 6}, {1, 3, 4, 6}]
    assert kept[3][3].text == texts[3] and shared not in kept[3][4].text and kept[3][4].n_chars == len(kept[3][4].text)
    packed = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {1, 3, 4, 6}
    assert all(r.text.split() == kept[3][r.doc_id].text.split() and r.n_tokens == len(r.text.split()) + 1 for r in packed)
