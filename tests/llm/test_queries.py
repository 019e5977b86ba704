"""The registered queries: their columns, one row a document, and the SQL where there is one."""

import duckdb
import pytest

from corpusmill.llm import queries as Q
from corpusmill.llm.common import table

COLUMNS = {
    "op1_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op2_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op4_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_sentencepiece": {"doc_id": "bigint", "n_pieces": "bigint", "ids_crc32": "bigint", "round_trip": "boolean"},
    "op12_lines": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op10_media": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_a_document(spark, sf_dir, name):
    df = Q.queries()[name](spark, sf_dir)
    assert COLUMNS[name].items() <= dict(df.dtypes).items()
    ids = sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in table(spark, sf_dir, "documents").select("doc_id").collect())


def test_packing_columns(spark, sf_dir):
    df = Q.queries()["op9_packing"](spark, sf_dir)
    assert {c: t for c, t in df.dtypes} == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for name_of in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM read_parquet('{sf_dir}/{name_of}.parquet')")
    made = con.execute(Q.oracle_sql()[name])
    cols = [d[0] for d in made.description]
    df = Q.queries()[name](spark, sf_dir)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(made.fetchall())
