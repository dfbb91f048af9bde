"""The corpus pipeline and each of its stages against plain versions."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline
from tabflow.llm import mixing, toxicity
from test_table_ops import plain_groups


@pytest.fixture(scope="module")
def sf(spark, corpus, tmp_path_factory):
    """Documents without repeated ids (so every stage's plain version is by id), labels and a benchmark."""
    folder = str(tmp_path_factory.mktemp("sf"))
    seen = Counter(i for i, _, _ in corpus)
    rows = [(i, t, s, "en", 7) for i, t, s in corpus if i is not None and seen[i] == 1]
    rows += [(200 + i, f"vile words in clean text number {i}", "s1", "de", 7) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 200)) for i, *_ in rows], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    passage = " ".join(rows[3][1].split()[:14])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def whole(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_and_run(spark, sf, tmp_path):
    from test_text_ops import WORD, lower, plain_hits

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    items = [("1", WORD.findall(lower(item)))]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, sf)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{name}")
        after = docs.collect()
        if name == "toxicity":
            frame = spark.createDataFrame(before, docs.schema)
            w = toxicity.fit_on_labels(frame, spark.read.parquet(f"{sf}/labels.parquet"))
            score = lambda t: 1 / (1 + pow(2.718281828459045, -(float(w[-1]) + sum(float(w[k]) for k in set(toxicity.features(t.encode() if t else None))))))
            assert whole(after) == whole(r for r in before if score(r.text) < 0.7)
        elif name == "ngram_jaccard_join":
            named = {i for i, _, c in plain_groups([(r.doc_id, r.text, r.source) for r in before]) if i == c}
            assert whole(after) == whole(r for r in before if r.doc_id in named)
        elif name == "decontamination":
            hit = {r.doc_id: plain_hits(WORD.findall(lower(r.text)), items, 10)[0] for r in before}
            assert any(hit.values())
            words = {r.doc_id: len(WORD.findall(lower(r.text))) for r in before}
            assert {r.doc_id for r in after} == {i for i, n in hit.items() if 2 * n <= words[i]}
            assert all(len(WORD.findall(lower(r.text))) == words[r.doc_id] - hit[r.doc_id] for r in after)
        elif name == "mixing":
            times = Counter()
            for o in mixing.mix(spark.createDataFrame(before, docs.schema)).collect():
                times[o.doc_id] += o.taken // o["size"] if o["size"] else 0
            assert whole(after) == Counter({tuple(r): times[r.doc_id] for r in before if times[r.doc_id]})
        else:
            assert docs.columns == ["doc_id", "text", "source", "lang", "input_size", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
            assert whole(r[:5] for r in after) == whole(before)
            for r in after:
                data = (r.text or "").encode()
                assert (r["size"], r.text_crc32) == (len(data) + 1, None if r.text is None else zlib.crc32(data))
            for s in {r.shard for r in after}:
                own = sorted(r.slot for r in after if r.shard == s)
                assert own == list(range(len(own)))
            assert all(len({r.shard for r in after if r.doc_id == i}) == 1 for i in {r.doc_id for r in after})
    cols = [c for c in docs.columns if c != "slot"]  # a slot follows the order of files
    assert whole(corpus_pipeline.run(spark, sf).select(cols).collect()) == whole(docs.select(cols).collect())
