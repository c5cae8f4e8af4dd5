import random

import public_tokenizers
from helpers import ODD, documents
from tokenizers import Tokenizer

from histoframe.llm.bpe import BoundaryBpe, bpe_decode, bpe_encode, digests

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_same_as_the_library():
    r = random.Random(8)
    letters = [chr(r.choice([r.randrange(32, 127), r.randrange(32, 700), r.randrange(0x300, 0x3000), r.randrange(0x1F300, 0x1F700), r.randrange(0, 33)])) for _ in range(900)]
    texts = ["".join(r.choices(letters, k=r.randrange(1, 60))) for _ in range(1500)]
    texts += ["<|endoftext|>Hello<|startoftext|> world's I'LL ΣΑΣ İI <|endoftext", "", "  ", "=" * 5000 + "aaaa" * 3000, "a\x1cb\x85c　d é É"]
    lib, own = Tokenizer.from_file(PATH), BoundaryBpe(open(PATH, encoding="utf-8").read())
    for text, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        ids = own.encode(text).tolist()
        assert ids == e.ids, text
        assert own.decode(ids) == lib.decode(e.ids, skip_special_tokens=False)


def test_a_cut_is_never_inside_a_token():
    own = BoundaryBpe(open(PATH, encoding="utf-8").read())
    for token in own.vocab:
        bare = token.removesuffix("</w>")
        assert all(bare[i - 1] + bare[i] in own._inside for i in range(1, len(bare)))


def test_odd_rows(spark):
    encoded = bpe_encode(documents(spark, ODD), PATH)
    out = {(r.doc_id, len(r.ids), r.decoded) for r in encoded.collect()}
    assert {(1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 3, "one</w> two</w> three</w>")} <= out and encoded.count() == len(ODD)
    assert sorted((r.doc_id or 0, r.decoded) for r in bpe_decode(encoded, PATH).collect()) == sorted((i or 0, d) for i, d in [(r.doc_id, r.decoded) for r in encoded.collect()])
    assert digests(encoded).filter("doc_id = 1").first().n_tokens == 0
    assert bpe_encode(documents(spark, []), PATH).count() == 0
