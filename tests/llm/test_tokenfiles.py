import glob

import pyarrow.parquet as pq

from rainledger.llm import tokenfiles
from rainledger.llm.queries import op2_token_files
from rainledger.llm.tokens import default_tokenizer
from tests.helpers import plan
from tests.llm import brute


def test_round_trip(spark, tables):
    folder, docs = tables
    got = {tuple(r) for r in op2_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
    want = brute.op2(docs)
    null = {r[2:] for r in want if r[0] is None}
    assert {r for r in got if r[0] is not None} == {r for r in want if r[0] is not None}
    assert {r[2:] for r in got if r[0] is None} == null


def test_empty(spark, empty_tables):
    assert op2_token_files(spark, empty_tables).collect() == []


def test_files_are_sorted_and_encoded_as_asked(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    tokenfiles.write_token_files(docs, str(tmp_path / "t"), default_tokenizer(), row_group_bytes=64 << 10)
    last = None
    groups = 0
    for path in sorted(glob.glob(f"{tmp_path}/t/*.parquet")):
        file = pq.ParquetFile(path)
        ids = [i for i in file.read(["doc_id"]).column(0).to_pylist() if i is not None]
        assert ids == sorted(ids) and (last is None or not ids or ids[0] >= last)
        last = ids[-1] if ids else last
        groups += file.num_row_groups
        for g in range(file.num_row_groups):
            columns = {c.path_in_schema: c for c in (file.metadata.row_group(g).column(i) for i in range(file.metadata.num_columns))}
            assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    assert groups > 1


def test_selective_reads(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    tokenfiles.write_token_files(docs, str(tmp_path / "t"), default_tokenizer())
    tokens = tokenfiles.read_token_files(spark, str(tmp_path / "t"))
    assert "ids" not in plan(tokens.select("doc_id", "n_tokens")).split("ReadSchema")[1].splitlines()[0]
    assert "GreaterThan(doc_id,1000)" in plan(tokens.where("doc_id > 1000"))
    one = tokens.where("doc_id = 3").collect()[0]
    assert one.ids == brute.ids_of("Two words", 0)


def test_added_tokens_are_found_as_the_library_does():
    import numpy as np

    from rainledger.llm.tokens import Encoder, default_tokenizer

    mark = "<|endoftext|>"
    texts = ["", mark, f"{mark}a b", f"a {mark} b", f"a b{mark}", f"a{mark}{mark}  b\n{mark} ", "<|endoftext|", "plain text <|end of text|>"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in Encoder(default_tokenizer()).encode(texts)]
    assert got == [brute.tokenizer().encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in got[3] and 50256 not in got[6]
