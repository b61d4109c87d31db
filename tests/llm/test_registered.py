"""The registered queries: DuckDB SQL where there is any, schemas and row counts for all."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["op1_secret_scan", "op8_mixing", "op10_sharding", "op11_hard_negatives", "op13_substring_dedup"])
def test_against_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    want = sorted(duck.execute(f"SELECT {', '.join(cols)} FROM ({E.oracle_sql()[name]})").fetchall(), key=str)
    assert got == want


@pytest.mark.parametrize("name,columns", [
    ("op5_token_output", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    ("op6_toxicity", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op3_simhash", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    ("op1_secret_scan", {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
    ("op8_mixing", {"size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    ("op13_substring_dedup", {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}),
    ("op12_whitening", {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
                        "identity_error": "double"}),
    ("op4_embedding_dedup", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    ("op2_ann", {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
])
def test_columns_and_rows(spark, duck, name, columns):
    df = E.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    table = "embeddings" if "vec_id" in columns else "documents"
    rows = duck.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    assert df.count() == {"op2_ann": 5 * -(-rows // 50), "op12_whitening": 8 * rows}.get(name, rows)
