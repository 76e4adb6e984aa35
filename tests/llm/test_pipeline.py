"""The corpus pipeline against brute force."""


def test_only_the_copied_text_of_an_id_goes(spark):
    from corpus_pipeline import ngram_jaccard_join
    text, other = (" ".join(f"{w}{i}" for i in range(30)) for w in "ab")
    df = spark.createDataFrame([(1, text, "x"), (2, text, "x"), (2, other, "x"), (2, other, "x"), (3, other, "x"), (4, None, "x")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.text) for r in ngram_jaccard_join(spark, df, "").where("text is not null").collect()) == [(1, text), (2, other)]


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as C
    import public_tokenizers

    from riskmart.llm.bpe import RANKS, load_encoding
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = C.quality_classifier(spark, docs, sf)
    assert good.columns == docs.columns
    kept = {r.doc_id: r for r in good.collect()}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)

    from test_joins import jaccard_brute
    rows = sorted(kept)
    _, root = jaccard_brute([kept[i].text for i in rows])
    single = {r.doc_id: r for r in C.ngram_jaccard_join(spark, good, sf).collect()}
    assert set(single) == {rows[i] for i in root if root[i] == i}

    extra = docs.limit(40).selectExpr("*", "'s' AS score", "1 AS size", "'sp' AS spans", "2 AS copies", "'h' AS held_out")
    odd = spark.createDataFrame([(None, None, None, None, None), (90001, "", "en", "src0", 0), (90002, "password=abcdef99", "en", "src0", 17), (90002, "password=abcdef99", "en", "src0", 17)], docs.schema)
    odd = odd.selectExpr("*", "'s' AS score", "1 AS size", "'sp' AS spans", "2 AS copies", "'h' AS held_out")
    at = extra.unionByName(odd)
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, at, sf).columns == at.columns
        assert stage(spark, at.limit(0), sf).count() == 0
    assert C.ngram_jaccard_join(spark, at, sf).where("doc_id = 90002").count() == 1
    clean = {r.doc_id: r for r in C.secret_scans(spark, at, sf).collect()}
    assert clean[90002].text == C.SECRET_MASK and clean[90002].n_chars == len(C.SECRET_MASK) and clean[None].text is None
    mixed = C.source_mixing(spark, docs, sf).groupBy("doc_id").count().collect()
    assert max(r["count"] for r in mixed) <= 2
    enc = load_encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    text = {r.doc_id: r.text for r in docs.limit(20).collect()}
    for r in C.bpe_encoding(spark, docs.limit(20), sf).collect():
        assert list(r.ids) == enc.encode_ordinary(text[r.doc_id])
    assert C.run(spark, sf).count() > 100
