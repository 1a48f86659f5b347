"""The registered queries on the smallest tables, and the pipeline against brute force."""

import hashlib
import re
import zlib

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerflow.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    order = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[k] for k in order) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("name,flag,column", [("op1_quality", "held_out", "quality"), ("op9_language_id", "held_out", "lang")])
def test_held_out_accuracy(spark, name, flag, column):
    got = {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}
    source = "labels" if column == "quality" else "documents"
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{SMALL}/{source}.parquet").collect()}
    modulus, rest = (3, 1) if column == "quality" else (4, 2)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) for i, r in got.items())
    held = [i for i in truth if got[i].held_out]
    right = sum((got[i].predicted if column == "quality" else got[i].lang_pred) == truth[i] for i in held)
    assert right >= 0.9 * len(held)


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination",
                     "SentencePiece encoding and decoding"]
    good = stages[0](spark, docs, SMALL).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    assert good.columns == docs.columns

    first = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):                 # exact copies
        first.setdefault(r.text.encode().lower(), r)
    rows = sorted(first.values(), key=lambda r: r.doc_id)
    sets = []
    for r in rows:
        w = r.text.encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset())
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[max(find(a), find(b))] = min(find(a), find(b))
    rows = [r for k, r in enumerate(rows) if find(k) == k]
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = WORD.findall(r.text.encode().lower().decode())
        windows |= {tuple(w[k:k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1) if w}
    sizes = {len(x) for x in windows}
    clean = [r for r in rows if not any(tuple(w[k:k + n]) in windows for w in [WORD.findall(r.text.encode().lower().decode())]
                                        for n in sizes for k in range(len(w) - n + 1))]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {r.doc_id: (r.lang, r.source, lib.encode(r.text)) for r in clean}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: (r.lang, r.source, r.ids) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(lib.decode(r.ids).encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_quality_stage_keeps_odd_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("*", "doc_id AS __quality", "lang AS `a.b`")
    got = corpus_pipeline.quality(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert all(r["__quality"] == r.doc_id and r["a.b"] == r.lang for r in got.collect())
