import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from citegrid.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_pieces_equal_the_library():
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    rng = random.Random(3)
    letters = "  \n\t'''strvelmd aé1² .!\"SÉ\u0085 \x1c日"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 50))) for _ in range(4000)]
    texts += ["", " ", "don't we'll they've I'm he'd you're it's", "<|endoftext|> x", "a\n\n  b"]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    encoder.known = token_files.Pieces(64)              # so full that it starts anew all the time
    assert [x.tolist() for i in range(0, 500, 50) for x in encoder.encode(texts[i:i + 50])] == want[:500]


def test_round_trip(spark, docs, rows, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write(docs, folder, PATH, partitions=4)
    got = token_files.digest(token_files.read(spark, folder)).collect()
    ids = [e.ids + [0] for e in library().encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    want = sorted(((-1 if r[0] is None else r[0]), len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())) for r, x in zip(rows, ids))
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at and r.n_read == r.n_tokens
        at += r.n_tokens
    named = [r.doc_id for r in ordered if r.doc_id is not None]
    assert named == sorted(named)


def test_added_tokens_as_in_the_plain_call(spark, tmp_path):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  don't<|endoftext|><|endoftext|>", "日 <|endoftext|>", "<|endoftext| >", "a b", ""]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    with open(PATH, encoding="utf-8") as f:
        assert [x.tolist() for x in token_files.Encoder(f.read(), added=True).encode(texts)] == want
    folder = str(tmp_path / "tokens")
    token_files.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folder, PATH, partitions=2)
    got = token_files.read(spark, folder).orderBy("doc_id").collect()
    assert [list(r.tokens) for r in got] == [x + [0] for x in want]
    assert [r.start for r in got] == [sum(len(x) + 1 for x in want[:i]) for i in range(len(want))]


def test_files(spark, docs, tmp_path):
    import glob

    import pyarrow.parquet as pq
    folder = str(tmp_path / "tokens")
    token_files.write(docs, folder, PATH, partitions=1)
    column = {c.path_in_schema: c for f in glob.glob(f"{folder}/*.parquet") for g in [pq.ParquetFile(f).metadata.row_group(0)]
              for c in (g.column(i) for i in range(g.num_columns))}
    assert "RLE_DICTIONARY" in column["tokens.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in column["n_tokens"].encodings
    assert column["doc_id"].has_offset_index and column["doc_id"].has_column_index
    plan = token_files.read(spark, folder).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan


def test_empty(spark, empty, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write(empty, folder, PATH, partitions=2)
    assert token_files.read(spark, folder).count() == 0
