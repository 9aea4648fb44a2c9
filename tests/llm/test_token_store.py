"""Token files: exact round trip, pieces against whole texts."""
import random
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from llm.fixtures import awkward, clashing, docs_of, table
from tokenizers import Tokenizer

from riskwin.llm import token_store as K
from riskwin.session import scratch_path


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(K.default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_texts(whole, monkeypatch):
    rng = random.Random(5)
    odd = ["a", "the", " ", "\n", ".", ",", "1", "é", "ñ", "\t", "'s", " x", "  ", "!", "<|endoftext|>", "世", "\r", "😀", "don't", "\x1c", "²", "_"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(0, 40))) for _ in range(1500)] + [None, "", "a b", "\ud800 x"[1:]]
    words = ["word", "Tion", "é.", "x,", "it's", "9", "(", "ß!!", "a.b", "²"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "\n"]) for _ in range(20)).strip() for _ in range(1500)]
    for memory in (K.MEMORY, 5):
        monkeypatch.setattr(K, "MEMORY", memory)
        encoder = K.Encoder(K.default_tokenizer())
        assert encoder.by_piece
        for i in range(0, len(texts), 100):
            for text, ids in zip(texts[i:i + 100], encoder.encode(texts[i:i + 100])):
                assert np.frombuffer(ids, encoder.kind).tolist() == whole(text), text


def test_another_kind_of_tokenizer():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = K.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_piece
    texts = ["Hello World foo", "a  b\nc"]
    assert [np.frombuffer(b, encoder.kind).tolist() for b in encoder.encode(texts)] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def expected(rows, whole):
    out, start = [], 0
    for d, t in rows:
        ids = [*whole(t), K.END_ID]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents(spark, whole):
    rows = sorted(table(SF_SMALL, "documents", "doc_id, text"))
    got = sorted(tuple(r) for r in K.op9_token_store(spark, SF_SMALL).collect())
    assert got == expected(rows, whole)


def test_files_and_short_access(spark, whole):
    rows = sorted(table(SF_SMALL, "documents", "doc_id, text"))
    folder = scratch_path(spark, "tokens-test")
    files = K.write_token_files(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), folder).collect()
    assert len(files) > 1
    seen, packed = [], 0
    for f in sorted(files, key=lambda f: f["start"]):
        file = K.TokenFile(folder, f["file"])
        assert sum(file.index["n_ids"]) == f["ids"] and len(file.index) == f["docs"]
        assert sum(len(file.ids(i)) for i in range(len(file.index))) == f["ids"]
        packed += int(file.index["length"].sum())
        seen += file.index["doc_id"].tolist()
        d = int(file.index["doc_id"][-1])
        assert [x.tolist() for x in file.of_document(d)] == [[*whole(dict(rows)[d]), K.END_ID]]
        assert file.of_document(10 ** 9) == []
    assert seen == [d for d, _ in rows]
    assert packed < 0.7 * 2 * sum(f["ids"] for f in files)


def test_awkward_rows(spark, whole):
    docs = clashing(awkward(spark), ["id", "hash", "file"])
    folder = scratch_path(spark, "tokens-test")
    got = K.read_token_files(K.write_token_files(docs, folder), folder).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {(d, n, c) for d, _, n, c in expected(rows, whole)}
    assert len(got) == len(rows) and {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    got.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()


def test_empty_table(spark):
    folder = scratch_path(spark, "tokens-test")
    files = K.write_token_files(docs_of(spark, [(1, "x")]).limit(0), folder)
    assert files.count() == 0 and K.read_token_files(files, folder).count() == 0
