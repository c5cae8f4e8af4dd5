import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from helpers import ODD, SF, documents
from sentencepiece import sentencepiece_model_pb2 as proto

from histoframe.llm import pieces
from histoframe.llm.pieces import PieceBpe, piece_decode, piece_digests, piece_encode
from histoframe.llm.workloads import REGISTERED

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def own():
    return PieceBpe(MODEL)


def texts_of(seed, n):
    r = random.Random(seed)
    ranges = [(1, 127), (32, 700), (0x300, 0x3000), (0x4E00, 0x9000), (0x1F300, 0x1F700)]
    letters = [chr(r.randrange(*r.choice(ranges))) for _ in range(600)]
    letters += [" ", "  ", "▁", "\n", "\r\n", "<s>", "<0x41>", "<unk>", "the", "ing", " " * 7] * 15
    return ["".join(r.choices(letters, k=r.randrange(0, 40))) for _ in range(n)]


def test_ids_and_texts_as_the_library(own):
    texts = [*texts_of(11, 3000), "", " ", "▁", " " * 500, "a" * 3000 + "=" * 3000, "\x00 null \x85", "\n\n\n"]
    for text, ids in zip(texts, own.encode_batch(texts)):
        wanted = own.library.encode(text)
        assert ids.tolist() == wanted, text
        assert own.decode(ids) == own.library.decode(wanted)


def test_any_ids_are_decoded_as_the_library_does(own):
    r = random.Random(12)
    for _ in range(4000):
        ids = [r.choice([r.randrange(0, 3), r.randrange(3, 300), r.randrange(259, 32000), 259]) for _ in range(r.randrange(0, 8))]
        assert own.decode(np.array(ids, np.int32)) == own.library.decode(ids), ids


def test_other_models(tmp_path):
    """Without byte pieces, without the space in front, and with equal scores."""
    for prefix, fallback in ((True, False), (False, True), (False, False)):
        m = proto.ModelProto.FromString(MODEL)
        m.normalizer_spec.add_dummy_prefix = prefix
        m.trainer_spec.byte_fallback = fallback
        for p in m.pieces:
            p.score = -abs(round(p.score, -3))
        if not fallback:
            kept = [p for p in m.pieces if p.type != 6]
            del m.pieces[:]
            m.pieces.extend(kept)
        lib, bpe = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString()), PieceBpe(m.SerializeToString())
        for text in texts_of(13, 800):
            ids = bpe.encode(text)
            assert ids.tolist() == lib.encode(text), (prefix, fallback, text)
            assert bpe.decode(ids) == lib.decode(lib.encode(text))


def test_unsupported_models_are_refused():
    m = proto.ModelProto.FromString(MODEL)
    m.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        PieceBpe(m.SerializeToString())


def test_parts_are_forgotten_by_age(own, monkeypatch):
    monkeypatch.setattr(pieces, "_MEMO", 5)
    bpe = PieceBpe(MODEL)
    for text in texts_of(14, 60):
        assert bpe.encode_batch([text, "the same words again"])[0].tolist() == own.library.encode(text)
        assert len(bpe._known) <= 60 and len(bpe._known._older) <= 80


def test_a_wrong_part_is_noticed(own):
    bpe = PieceBpe(MODEL)
    bpe._known._make = lambda part: np.array([5], np.int32).tobytes()
    with pytest.raises(RuntimeError):
        bpe.encode_batch(["some words"])


def test_odd_rows(spark):
    encoded = piece_encode(documents(spark, ODD), PATH)
    out = {(r.doc_id, len(r.ids), r.decoded) for r in encoded.collect()}
    assert {(1, 0, ""), (2, 0, ""), (4, 3, "one two three")} <= out and encoded.count() == len(ODD)
    assert any(i == 6 and text == "word " * 60_000 for i, _, text in out)
    assert sorted((r.doc_id or 0, r.decoded) for r in piece_decode(encoded, PATH).collect()) == sorted((r.doc_id or 0, r.decoded) for r in encoded.collect())
    assert piece_encode(documents(spark, []), PATH).count() == 0
    assert piece_digests(encoded).filter("doc_id = 1").first().n_tokens == 0


def test_whole_table_as_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    wanted = {}
    for r in rows:
        ids = lib.encode(r["text"] or "")
        wanted[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
    found = REGISTERED["op11_sentencepiece_agenda"].build(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == wanted and len(found) == len(rows)
