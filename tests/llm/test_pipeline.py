"""The pipeline against a plain version of each stage."""

import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tamiz.llm.catalogue import PII_KEY, SEQUENCE
from tamiz.llm.common import table
from tamiz.llm.pack import cut
from tamiz.llm.pii import replace_personal
from tamiz.llm.toxicity import fit_toxicity, read_tokens, survey
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import groups
from tests.llm.test_toxicity import plain_scores

FOLDER = os.environ.get("TAMIZ_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_stages_equal_a_plain_version(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    at = {c: i for i, c in enumerate(columns)}
    rows = sorted(map(tuple, docs.collect()))
    model = fit_toxicity(docs, table(spark, FOLDER, "labels"), read_tokens(survey(docs)))
    expected = [r for r, x in zip(rows, plain_scores([r[at["text"]] for r in rows], model), strict=True) if x < 0.5]
    results = []
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]

    def step(name, docs):
        path = str(tmp_path / name)
        stages[name](spark, docs, FOLDER).write.parquet(path)
        return spark.read.parquet(path)

    docs = step("toxicity", docs)
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == expected
    components = groups([(r[at["doc_id"]], r[at["text"]]) for r in expected])
    expected = [r for r, (doc, _, least) in zip(expected, components, strict=True) if doc == least]
    docs = step("near_duplicates", docs)
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == expected
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    hits = {d: n for d, _, n, *_ in contaminated([(r[at["doc_id"]], r[at["text"]]) for r in expected], items, 10)}
    expected = [r for r in expected if not hits[r[at["doc_id"]]]]
    docs = step("decontamination", docs)
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == expected
    expected = [tuple(replace_personal(v, PII_KEY)[0] if c == "text" else v for c, v in zip(columns, r, strict=True)) for r in expected]
    docs = step("pii", docs)
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == expected
    results = step("packing", docs).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in expected:
        n = len(tokens.encode(r[at["text"]], add_special_tokens=False).ids) + 1
        want += [(r[at["doc_id"]], i, start, size) for i, (start, size) in enumerate(cut(n, SEQUENCE))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in results) == sorted(want)
    fill = {}
    for r in results:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= SEQUENCE and len(fill) <= -(-sum(fill.values()) // SEQUENCE) * 1.02 + 1


def test_rows_that_repeat_lack_parts_or_have_other_columns(spark, tmp_path, monkeypatch):
    """Every stage takes nulls, empty texts, repeated rows and columns that clash with its own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, pii string, hits int, fp long, toxicity double"
    rows = [(1, "one two three four", "en", "s", 18, "p", 1, 2, 0.5), (None, None, None, None, None, None, None, None, None)]
    rows += [(2, "", "en", "s", 0, "p", 1, 2, 0.5), rows[0], (3, None, "en", "s", None, "p", 1, 2, 0.5)]
    for name, data in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for stage, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, FOLDER)
            out.write.parquet(str(tmp_path / name / stage))
            docs = spark.read.parquet(str(tmp_path / name / stage))
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        # Equal fingerprints are one document: the empty texts share one, and the repeated row is there once.
        assert sorted(r["doc_id"] for r in packed) == ([1, 2] if data else [])
