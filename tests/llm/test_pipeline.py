"""The pipeline against a plain version of its stages on the smallest tables."""

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from test_operators import SF001, plain_classes
from tidemark.llm import decontam, quality


def test_registered():
    assert "pipeline" in entry.queries()
    assert sorted(k.split("_")[0] for k in entry.queries() if k.startswith("op")) == sorted(f"op{n}" for n in range(1, 14))


def test_run_against_plain_stages(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    judged = quality._judge([d[1] for d in docs])
    docs = [(d[0], t) for d, k, t in zip(docs, judged["kept"], judged["clean_text"]) if k]
    keep = {c for _, c, _ in plain_classes(docs)}
    docs = [d for d in docs if d[0] in keep]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF001}/benchmark.parquet'")
    clean = {r[0] for r in con.execute(f"SELECT doc_id FROM ({decontam.SQL}) WHERE NOT contaminated").fetchall()}
    got = corpus_pipeline.run(spark, SF001).collect()
    texts = dict(docs)
    assert {r.doc_id for r in got} <= clean  # mixing may leave some out or repeat them
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in got)
    words = sum(len(texts[i].split()) for i in clean)
    taken = sum(len(r.text.split()) for r in got)
    assert abs(taken - words) < 0.25 * words
