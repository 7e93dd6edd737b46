"""Pieces and records against the libraries, on odd texts and on the small table."""

import hashlib
import zlib

import numpy as np
import pytest

from marketlens.llm import pieces, queries, token_output

ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\n  c", "▁x", "x▁▁y ▁z", "<s> </s> <unk> <0x41>",
    "\U0001f600 你好", "x" * 3000, "a b " * 2000, "\x00 \x1c a\x85b", "it's  <|endoftext|> 12　 \xa0x", "<|endoftext|>", "a\n \nb", "\t a",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "n_tokens") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (3, "again", "y"), (3, "again", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_pieces_equal_the_library(spark, odd):
    import sentencepiece

    path = queries.vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.ids, r.decoded) for r in pieces.encode_and_decode(odd, path, block_bytes=100).collect())
    wanted = []
    for row in odd.collect():
        ids = model.encode(row.text or "", add_eos=True)
        wanted.append((row.doc_id if row.doc_id is not None else -1, ids, model.decode(ids)))
    assert found == sorted(wanted)
    assert pieces.encode_and_decode(odd.limit(0), path).count() == 0


def test_piece_digests_on_the_table(spark):
    import sentencepiece

    folder = "/root/testdata/sf0.001"
    model = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_sentencepiece"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = model.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def byte_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_the_library():
    encode = token_output.Encoder(queries.vocabulary("byte_bpe_50k.json"))
    texts = [t or "" for t in ODD]
    for _ in range(2):
        assert [np.frombuffer(b, encode.type).tolist() for b in encode.encode(texts)] == byte_ids(texts)


def test_records_come_back(spark, odd, tmp_path):
    folder = f"file://{tmp_path}"
    files = token_output.write_records(odd, folder, queries.vocabulary("byte_bpe_50k.json"), file_bytes=500)
    rows = token_output.read_records(files, folder).orderBy("start").collect()
    source = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in rows] == [r.doc_id for r in source]
    by_start = 0
    wanted = {}
    for row, ids in zip(source, byte_ids([r.text for r in source])):
        wanted.setdefault(row.doc_id, set()).add((len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())))
    for r in rows:
        assert r.start == by_start and (r.n_tokens, r.ids_crc32) in wanted[r.doc_id]
        by_start += r.n_tokens
    name = files.first()["name"]
    forward = [ids.tolist() for _, ids in token_output.read_file(folder, name)]
    back = [ids.tolist() for _, ids in token_output.read_file(folder, name, np.arange(len(forward))[::-1])]
    assert back[::-1] == forward
    (tmp_path / f"{name}.rec").write_bytes((tmp_path / f"{name}.rec").read_bytes()[:-1] + b"?")
    with pytest.raises(ValueError, match="broken"):
        list(token_output.read_file(folder, name))
    none = tmp_path / "none"
    none.mkdir()
    files = token_output.write_records(odd.limit(0), f"file://{none}", queries.vocabulary("byte_bpe_50k.json"))
    assert token_output.read_records(files, f"file://{none}").count() == 0
