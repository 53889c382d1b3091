"""SentencePiece operators against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from tests.llm.support import awkward_texts, by_id, documents, empty
from tripstream.llm import sentence_pieces as sp

LETTERS = list("abcdeth  ▁▁\n\t\0.,-'<>/sx0é日本語テ 😀́  ing")
STRINGS = [*(" " * n for n in range(1, 40)), "the", "\n", "xxxxxxx", "x" * 70, "日", "<s>", "</s>", "<0x0A>", "<unk>", "Ａ", "▁▁▁"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)


def odd_texts():
    rng = random.Random(5)
    texts = [t or "" for t in awkward_texts()]
    texts += ["".join(rng.choices(LETTERS, k=rng.randrange(60))) for _ in range(2000)]
    texts += ["".join(rng.choices(STRINGS, k=20)) for _ in range(300)]
    texts += ["".join(chr(c) for c in rng.choices(range(1, 0xD800), k=20)) for _ in range(100)]
    return [*texts, " " * 5000, "ab" * 9999, "▁" * 100, "\n" * 300]


@pytest.mark.parametrize("part", [sp.PART, 300])
def test_ids_equal_the_library_s(library, monkeypatch, part):
    monkeypatch.setattr(sp, "PART", part)
    texts = odd_texts()
    table = sp.WordTable(sp.shared_model(sp.MODEL), limit=900, pool=5000)
    table.bits = 16
    table._begin()
    for _ in range(2):  # the second time from the table, or after it began afresh
        found = [[] for _ in texts]
        for at in range(0, len(texts), 50):
            for i, ids in sp.encoded_parts(table, texts[at : at + 50]):
                found[at + i] += ids.tolist()
        assert found == [library.encode(t) for t in texts]


def test_any_ids_are_decoded_as_the_library_does(library):
    rng, model = random.Random(3), sp.shared_model(sp.MODEL)
    some = [0, 1, 2, 32 + 3, 259, 260, 264, 28705, *range(3 + 0xC0, 3 + 0xF5), *range(3 + 0x80, 3 + 0xC0, 5)]
    for _ in range(3000):
        ids = [rng.choice([*some, rng.randrange(model.span)]) for _ in range(rng.randrange(9))]
        assert model.decoded(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_round_trip_digests(spark, library):
    texts = awkward_texts()
    found = sp.round_trip_digests(documents(spark, texts))
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "keep_id", "kept", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = by_id(found, "n_tokens", "ids_sha256", "decoded_sha256")
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes(), library.decode(ids).encode()
        assert got[i] == (len(ids), *(hashlib.sha256(r).hexdigest() for r in raw)), text
    assert sp.round_trip_digests(empty(spark)).count() == 0


def test_encode_then_decode(spark):
    texts = awkward_texts(2)
    docs = documents(spark, texts).withColumnsRenamed({"keep_id": "Ids", "source": "decoded"})
    back = sp.decode(sp.encode(docs))
    assert by_id(back, "decoded") == {i: t or "" for i, t in enumerate(texts)}
    assert sp.decode(sp.encode(empty(spark))).count() == 0


def test_a_model_of_another_kind_is_refused(tmp_path):
    with pytest.raises((ValueError, OSError, RuntimeError)):
        sp.PieceModel(str(tmp_path / "none.model"))
