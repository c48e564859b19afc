"""The stages on given rows, each against what its operator says of its own input."""

import re
from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_simhash import plain_components
from tidemark.llm import quality, secrets
from tidemark.llm.queries import held_out, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        assert docs.columns == columns or name == "bpe"
    raw = spark.read.parquet(f"{SF}/documents.parquet").collect()
    field = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"),
                        spark.read.parquet(f"{SF}/labels.parquet").filter(~held_out(1, 3)))
    good = [r for r, s in zip(raw, field.scores([r.text for r in raw])) if s >= 0.5]
    assert sorted(kept["quality"]) == sorted(good) and 0 < len(good) < len(raw)
    _, least = plain_components([(r.doc_id, r.text) for r in good])
    first = [r for r in good if least[r.doc_id] == r.doc_id]
    assert sorted(kept["near_duplicates"]) == sorted(first) and len(first) < len(good)
    scanner = secrets.Scanner()
    masked = {r.doc_id: r for r in kept["secrets"]}
    assert len(masked) == len(first)
    for r in first:
        spans = scanner.spans(r.text)
        got = masked[r.doc_id].text
        assert (got == r.text) == (not spans) and masked[r.doc_id].n_chars == (len(got) if spans else r.n_chars)
        assert all(r.text[s:e] not in got for _, s, e in spans)
    times = Counter(r.doc_id for r in kept["mixing"])
    assert set(times) <= set(masked) and max(times.values()) <= 2
    assert all(masked[r.doc_id] == r for r in kept["mixing"])
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in kept["mixing"]}
    assert Counter(r.doc_id for r in kept["bpe"]) == times
    for r in kept["bpe"]:
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_stages_take_odd_rows(spark):
    rows = [(1, "Some good words in a line.", "en", "s", 26), (1, "Some good words in a line.", "en", "s", 26),
            (2, None, None, None, None), (3, "", "en", "s", 0), (None, "No id but text.", "en", None, 15)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS fp")
    for frame in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.count() <= 2 * frame.count()
            assert name == "bpe" or out.columns == frame.columns


def test_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and "op8_maxscore_topk" in oracle_sql()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
