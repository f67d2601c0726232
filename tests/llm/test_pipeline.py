"""The pipeline's stages against plain Python, stage by stage, and on odd rows."""

import re
import zlib

import corpus_pipeline as pipeline
import numpy as np
import pytest
from edge_rows import docs, no_docs
from pyspark.sql import functions as F
from test_mixing import plain_odds
from test_simhash import fingerprint, groups
from tokenizers import Tokenizer

from touchline.llm import stages
from touchline.llm.mixing import OTHER_TOPIC, POWERS, SEED, TOPICS
from touchline.llm.toxicity import train_toxicity
from touchline.session import written

SF = "/root/testdata/sf0.001"


def topic(text):
    return next((t for t, markers in TOPICS if any(m in text for m in markers)), OTHER_TOPIC)


def mixed(rows):
    """Documents kept by raked odds and the hash of the id."""
    import hashlib

    cell = {r.doc_id: (r.source, r.lang, topic(r.text)) for r in rows}
    tokens = {r.doc_id: 1 + r.text.count(" ") + r.text.count("\n") for r in rows}
    cells = {}
    for i, c in cell.items():
        cells[c] = cells.get(c, 0) + tokens[i]
    targets = {}
    for k, (name, power) in enumerate(POWERS.items()):
        sums = {}
        for c, n in cells.items():
            sums[c[k]] = sums.get(c[k], 0) + n
        raised = {v: n**power for v, n in sums.items()}
        targets[name] = {v: x / sum(raised.values()) for v, x in raised.items()}
    odds = plain_odds(cells, targets)
    share = {i: int(hashlib.md5(f"{SEED}:{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in cell}
    return [r for r in rows if share[r.doc_id] < odds[cell[r.doc_id]]]


def test_run_agrees_with_plain_python(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_toxicity(source, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = sorted(source.collect(), key=lambda r: r.doc_id)
    score = model.score([r.text for r in rows])
    rows = [r for r, s in zip(rows, score) if s < stages.TOXIC_FROM]
    group = groups([fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    rows = [r for r, g in zip(rows, group) if r.doc_id == g]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(item in plain(r.text) for item in items)]
    rows = mixed(rows)
    library = Tokenizer.from_file(stages.default_tokenizer())
    found = sorted(pipeline.run(spark, SF).collect(), key=lambda r: r.doc_id)
    assert 20 < len(rows) < 200 and [r.doc_id for r in found] == [r.doc_id for r in rows]
    start = 0
    for row, doc in zip(found, rows):
        ids = [*library.encode(doc.text, add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# Names that the stages use themselves.
CLASHING = ["_row", "kept", "probability", "mix_source", "mix_tokens", "_toxicity", "component_id", "doc_4", "_ROW2"]


def with_clashes(rows):
    rows = rows.withColumns({c: F.lit(f"{c} of the user") for c in CLASHING})
    return rows.withColumn("_order", F.struct(F.lit(1).alias("row")))


@pytest.mark.parametrize("stage", range(len(pipeline.STAGES)))
def test_stages_stand_odd_rows_and_no_rows(spark, stage):
    name, function = pipeline.STAGES[stage]
    rows = with_clashes(docs(spark))
    odd = written(function(spark, rows, SF), "odd").collect()
    if stage < len(pipeline.STAGES) - 1:
        for r in odd:
            assert r.__fields__ == rows.columns
            assert all(r[c] == f"{c} of the user" for c in CLASHING) and r["_order"].row == 1
    assert function(spark, no_docs(spark), SF).count() == 0
    kept = [r.doc_id for r in odd]
    expected = {"simhash_near_dedup": [None, 1, 3, 6, 7, 8], "benchmark_decontamination": [None, 1, 2, 2, 3, 4, 5, 6, 7, 8]}
    if name in expected:
        assert sorted(kept, key=lambda i: (i is not None, i or 0)) == expected[name]
    if name == "token_output":
        assert len(kept) == 10


def test_one_of_several_rows_of_an_id_stays(spark):
    rows = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "x y z u v w")], "doc_id long, text string")
    assert sorted(r.doc_id for r in stages.simhash_near_dedup(spark, rows, SF).collect()) == [1, 2]


def test_rows_without_an_id_are_searched_and_deduplicated(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, item), (None, "one of two equal texts without an id"), (None, "one of two equal texts without an id"), (5, "p q r s t")]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.text for r in stages.benchmark_decontamination(spark, rows, SF).where("doc_id is null").collect()] == [rows.collect()[1].text] * 2
    assert stages.simhash_near_dedup(spark, rows, SF).count() == 3


def test_distinct_texts_of_one_id_are_distinct_rows(spark):
    a, b = "the first text that has one id with another", "quite another text under the very same number here"
    rows = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in stages.simhash_near_dedup(spark, rows, SF).collect()) == [(1, a), (2, b)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = spark.createDataFrame([(1, a), (1, item)], "doc_id long, text string")
    assert [r.text for r in stages.benchmark_decontamination(spark, rows, SF).collect()] == [a]

