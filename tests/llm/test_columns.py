"""Callers' columns named like those that operators add or use inside keep their values."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabflow.llm import decontaminate, licenses, lines, tokens, toxicity

CLASH = ["hits", "h1", "h2", "s", "i", "t", "more", "spans", "ids", "_h1", "_h2", "n", "_n", "k", "c1", "c2", "part", "first", "last", "found",
         "score", "predicted", "n_lines", "n_dropped", "drops", "kept", "input_kept", "_d", "_h", "_drops", "_key", "word", "flag", "n_bytes_", "Hits_"]


@pytest.fixture(scope="module")
def docs(spark):
    line = "This very line is found in many of the documents here, always the same."
    rows = [(i, f"own words of {i}\n{line}\nReleased under the MIT License.\n" + " ".join(f"p{j}" for j in range(14))) for i in range(6)]
    rows += [(6, "long " * 20_000), (7, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASH])


def model():
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["hits", "hits in blocks", "decontaminate", "decontaminate in blocks", "tokens", "tokens in chunks", "lines", "licenses", "toxicity"])
def test_values_of_callers_columns_stay(spark, docs, name):
    items = spark.createDataFrame([(k, " ".join(f"p{j}" for j in range(k, 14))) for k in range(4)], "item_id long, text string")
    small = {"max_words": 5} if name.endswith("blocks") else {}
    bare = docs.select("doc_id", "text")
    run = {
        "hits": lambda d: decontaminate.find_hits(d, items, **small),
        "decontaminate": lambda d: decontaminate.decontaminate(d, items, **small),
        "tokens": lambda d: tokens.count_tokens(d, model(), chunk=1 << 10 if name.endswith("chunks") else tokens.CHUNK),
        "lines": lines.dedup_lines,
        "licenses": licenses.scan_licenses,
        "toxicity": lambda d: toxicity.classify(d, toxicity.weights_of(*([toxicity.np.ones((1 << toxicity.BITS) + 1)] * 2), toxicity.FtrlParams())),
    }[name.split()[0]]
    out, plain = run(docs), run(bare)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    added = [c for c in plain.columns if c != "doc_id"]
    assert sorted(map(str, out.select("doc_id", *added).collect())) == sorted(map(str, plain.collect()))
    names = {c: c if c not in added else f"input_{c}" if f"input_{c}" not in CLASH else f"input_input_{c}" for c in CLASH}
    for r in out.collect():
        assert all(r[new] == f"{c}:{r.doc_id}" for c, new in names.items())
