import corpus_pipeline


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > sizes[4] == sizes[5] > 0
    rows = sorted(docs.collect())
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))


def test_rows_of_one_id_or_none_are_decided_each_for_itself(spark, tmp_path):
    item = " ".join(f"term{k}" for k in range(14))
    base = [" ".join(f"{x}{k}" for k in range(60)) for x in "abcde"]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(5, base[0]), (5, base[0]), (5, base[1]), (9, base[1] + " tail"), (None, base[2]), (None, base[2]), (None, base[3]), (None, f"x {item} y"), (7, base[4]), (7, f"{item} {base[0][:90]}"), (8, None), (None, " ")]
    docs = spark.createDataFrame([(k, t, "en", "src1") for k, t in rows], "doc_id long, text string, lang string, source string")
    stages = dict(corpus_pipeline.STAGES)
    found = lambda name: sorted(((r.doc_id, r.text) for r in stages[name](spark, docs, str(tmp_path)).collect()), key=repr)
    assert found("decontamination") == sorted((r for r in rows if item not in (r[1] or "")), key=repr)
    assert found("near_dedup") == sorted({*rows} - {(9, base[1] + " tail")}, key=repr)


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    """Null and empty texts and ids, repeated rows and a column of an operator's name; a second run leaves the first one's result."""
    long = " ".join(f"w{k % 997}" for k in range(30_000))
    rows = [(1, None), (2, ""), (None, None), (None, "one"), (3, "alpha beta"), (3, "alpha beta"), (4, long), (5, " ")]
    docs = spark.createDataFrame([(k, t, None if k == 1 else "en", None if k == 2 else "src1", "b") for k, t in rows], "doc_id long, text string, lang string, source string, block string")
    for name, table in (("documents", docs), ("labels", spark.createDataFrame([(None, 1, 0), (3, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([(1, None), (None, "gamma")], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, kept, str(tmp_path)).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(rows[:4] + rows[5:], key=repr)
    first = corpus_pipeline.run(spark, str(tmp_path))
    count = first.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == first.count() == count
