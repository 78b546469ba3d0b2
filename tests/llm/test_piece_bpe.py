"""Ids and texts against the sentencepiece library itself."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from wayfarer.llm import piece_bpe

from helpers import awkward, base_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.load(PATH)


def test_random_texts(library, model):
    encode, decode = piece_bpe.encoder(model), piece_bpe.decoder(model)
    rnd = random.Random(7)
    signs = list("abcdefghetnins   \n\t.,▁<>0x41s/éüß日本　𝕏\x00﷽ﬁ") + ["  ", "the", "ing", "▁▁", "</s>", "<unk>"]
    for _ in range(20_000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40)))
        assert encode(text) == library.encode(text), text
        assert decode(encode(text)) == library.decode(library.encode(text)), text


@pytest.mark.parametrize("text", ["x" * 30_000, " " * 3000, "ab" * 4000, "a" * 999 + " " * 77 + "zz", "=" * 1000, "-_" * 1000, "\n" * 500, "日" * 999])
def test_long_runs(library, model, text):
    assert piece_bpe.encoder(model)(text) == library.encode(text)


def test_arbitrary_ids_decode_alike(library, model):
    decode = piece_bpe.decoder(model)
    rnd = random.Random(8)
    for _ in range(20_000):
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(3, 259), rnd.randrange(3), 259]) for _ in range(rnd.randint(0, 9))]
        assert decode(ids) == library.decode(ids), ids


def test_lists_decode_at_once(library, model, monkeypatch):
    rnd = random.Random(9)
    texts = ["", " a", "a b  c", "naïve 日本 𝕏\x00 ﷽", "x" * 500, "\n\n", "▁"] + [t or "" for t in base_texts()]
    ids = [None, []] + [library.encode(t) for t in texts]
    odd = ids + [[1, 0, 2], [0], [2, 259 + 7], [3 + 0xE6], [3 + 0xE6, 300], [3 + 0x20, 5]] + [
        [rnd.choice([rnd.randrange(32_000), rnd.randrange(3, 259), rnd.randrange(3), 259]) for _ in range(rnd.randint(0, 9))] for _ in range(500)]
    kind = pa.list_(pa.int32())
    decode = piece_bpe.decoder(model)
    want = [decode(i or []) for i in odd]
    run = piece_bpe.decode_lists(model)
    assert run(pa.array(odd, kind)).to_pylist() == want == [library.decode(i or []) for i in odd]
    for i, w in zip(odd, want):
        assert run(pa.array([[5], i], kind)[1:]).to_pylist() == [w]
    assert run(pa.array([], kind)).to_pylist() == []

    def unused(model):
        def fail(ids):
            raise AssertionError("decoded text by text")
        return fail
    monkeypatch.setattr(piece_bpe, "decoder", unused)
    assert piece_bpe.decode_lists(model)(pa.array(ids, kind)).to_pylist() == want[:len(ids)]


def test_small_memory_changes_nothing(library, model, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MEMORY", 9)
    encode = piece_bpe.encoder(model)
    for text in filter(None, base_texts()):
        assert encode(text) == library.encode(text)


def test_documents(spark, library):
    docs = awkward(spark, base_texts())
    made = piece_bpe.encode_documents(docs, PATH)
    assert made.select("doc.*").columns == docs.columns
    for r in made.collect():
        ids = library.encode(r.doc.text or "")
        assert (r.ids, r.decoded) == (ids, library.decode(ids))
    assert piece_bpe.digests(docs.limit(0), PATH).count() == 0


def test_query_on_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    from wayfarer.llm.queries import QUERIES
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_piece_bpe"](spark, sf).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        ids = library.encode(text)
        assert got[k] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        piece_bpe.load(str(tmp_path / "m.model"))
