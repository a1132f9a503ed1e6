import zlib

import corpus_pipeline
from test_line_dedup import brute as brute_lines
from test_near_copies import alike, shingles
from test_packing import check_bins, ids, packed
from test_simhash import brute_components, brute_fingerprint

from countflow.llm import quality, toxicity
from countflow.llm.text import id_remainder


def test_pipeline_matches_brute_force(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = [r for r in quality.judge(docs, quality.train(docs, labels)).collect() if r["kept"]]
    left = docs.filter(docs["doc_id"].isin([r["doc_id"] for r in good]))
    model = toxicity.train(left, labels, where=id_remainder("doc_id", 4) != 2)
    scorer = toxicity.Scorer(model)
    rows = [r for r in left.collect() if scorer.score([r["text"]])[0] < 0.3]
    assert 0.4 * docs.count() < len(rows) < docs.count()
    texts = [(i, t) for i, t, _ in brute_lines(rows)]
    groups = brute_components([(i, brute_fingerprint(t)) for i, t in texts])
    texts = sorted((i, t) for i, t in texts if groups[(i, brute_fingerprint(t))] == i)
    sets, kept = [shingles(t) for _, t in texts], {}
    for k, (i, t) in enumerate(texts):
        if not any(alike(x, sets[k]) for x in sets[:k]):
            kept[i] = t
    want = {}
    for i, t in kept.items():
        tokens = [*ids(t), 0]
        for k in range(0, len(tokens), 2048):
            want[(i, k // 2048)] = (k, len(tokens[k : k + 2048]), zlib.crc32(packed(tokens[k : k + 2048])))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    check_bins(got, 2048)


def test_stages_take_odd_rows(spark, sf, clashing, none):
    for docs in (clashing, none):
        rows = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, sf)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, rows, sf).collect()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "line dedup", "simhash near-dedup", "best-fit packing"]
