"""The pipeline as a whole, and the registry."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark, edge_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup" and len(corpus_pipeline.STAGES) == 5
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "shard", "slot"]
    rows = out.collect()
    assert 0 < len(rows) < docs.count() and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    again = {(r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, SF).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_run_by_hand(spark):
    """Each stage by SQL or plain loops over the whole small table; the last by what shards and slots must be."""
    import re

    import duckdb
    import numpy as np

    from test_documents import brute_rake
    from tollway.llm import catalog, mixing, simhash

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    docs = con.sql("select doc_id, text, lang, source from documents order by doc_id").fetchall()
    good = {r[0] for r in con.sql(f"select doc_id from ({catalog.oracle_sql()['op7_quality_rules']}) where kept").fetchall()}
    bad = {r[0] for r in con.sql(f"select doc_id from ({catalog.oracle_sql()['op3_decontamination']}) where contaminated").fetchall()}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t, *_ in docs}
    ids = sorted(good)
    lower = {d: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words[d]] for d in ids}
    sets = [{tuple(lower[d][i : i + 5]) for i in range(max(len(lower[d]) - 4, 1))} for d in ids]
    near = [(i, j) for i in range(len(ids)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    top = simhash.roots(len(ids), np.array([i for i, _ in near], int), np.array([j for _, j in near], int))
    kept = {ids[i] for i in set(top.tolist())} - bad
    topic = {}
    for d in kept:
        votes = [len({w.lower() for w in words[d]} & set(own.split())) for own in mixing.TOPICS.values()]
        topic[d] = list(mixing.TOPICS)[int(np.argmax(votes))] if max(votes) else "general"
    cell = {d: (s or mixing.NONE, g or mixing.NONE, topic[d]) for d, _, g, s in docs if d in kept}
    cells = {}
    for d in kept:
        cells[cell[d]] = cells.get(cell[d], 0) + len(words[d])
    p = brute_rake(cells, {}, mixing.KEEP, mixing.SWEEPS)
    chance = {r.doc_id: r.c for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", mixing.chance().alias("c")).collect()}
    want = {d for d in kept if chance[d] < p[cell[d]]}
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(near) > 0 and len(bad & good) > 0 and len(want) < len(kept)
    assert sorted(r.doc_id for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in by.values())
