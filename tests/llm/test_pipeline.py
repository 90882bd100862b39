import brute
import corpus_pipeline
from test_ngram_join import classes_of
from test_mixing import targets

from tidemark.llm.quality import quality_rules


def test_stages_and_columns():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_join", "decontamination", "mixing", "sharding"
    ]


def test_run_equals_brute_force(spark, small, documents):
    rows = {r.doc_id: r for r in documents.collect()}
    kept = [(r.doc_id, r.text) for r in quality_rules(documents).filter("kept").select("doc_id", "text").collect()]
    labels, _ = classes_of(kept)
    first = {}
    for (doc, text), label in zip(kept, labels, strict=True):
        first[label] = min(first.get(label, (doc, text)), (doc, text))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {d for d, v in brute.decontaminated(list(first.values()), items).items() if not v[4]}
    assert len(clean) < len(first) < len(kept) < len(rows)

    got = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in got} <= clean
    size = {d: len(brute.PLAIN.findall(rows[d].text or "")) for d in clean}
    sums = {}
    for d in clean:
        sums[rows[d].source] = sums.get(rows[d].source, 0) + size[d]
    taken = dict.fromkeys(sums, 0)
    for r in got:
        assert (r.text, r.lang, r.source, r.n_chars) == tuple(rows[r.doc_id])[1:]
        taken[r.source] += size[r.doc_id]
    for source, n in targets(sums).items():
        assert abs(taken[source] - n) <= 2 * max(size[d] for d in clean if rows[d].source == source)
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert corpus_pipeline.run(spark, small).count() == len(got)


def test_empty_documents(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0
