import random

import numpy as np
import pytest
import sentencepiece

from fleetlake.llm import pieces

from .helpers import awkward_rows


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)


@pytest.fixture(scope="module")
def model():
    with open(pieces.DEFAULT_MODEL, "rb") as file:
        return pieces.compile_model(file.read())


def texts(model):
    rnd = random.Random(9)
    whole = [p[0].replace(pieces.SPACE, " ") for p in model.pieces if p[2] == pieces.NORMAL]
    out = ["  Hello  world\n\nfoo\tbar été 漢字 ▁x ", "", " ", "   ", "\0a", "<s>a<0x41>", "naïve—“quotes” … x=[1,2];\nfor(int i=0;i<n;++i){}", "a" * 500]
    out += ["".join(rnd.choice(whole) for _ in range(rnd.randint(1, 12))) for _ in range(600)]
    marks = [(32, 126), (0xA0, 0x2FFF), (0x4E00, 0x9FFF), (0x1F600, 0x1F64F)]
    return out + ["".join(chr(rnd.randint(*rnd.choice(marks))) for _ in range(rnd.randint(1, 30))) for _ in range(400)]


def test_same_ids_as_the_library(model, library):
    for text in texts(model):
        assert model.encode(text).tolist() == library.encode(text), text


def test_same_texts_as_the_library(model, library):
    for text in texts(model):
        ids = model.encode(text).tolist()
        assert model.decode(ids) == text.replace(pieces.SPACE, " ")
        if text.strip(" ") == text:  # the library drops the first of several spaces
            assert model.decode(ids) == library.decode(ids)


def test_memory_is_bounded(model, library, monkeypatch):
    model = pieces.Model(model.pieces, model.kind, model.byte_fallback, model.normaliser)
    monkeypatch.setattr(pieces, "REMEMBERED", 15_000)
    for text in texts(model)[:200]:
        assert model.encode(text).tolist() == library.encode(text)
    assert len(model.memory) <= 60


def test_normaliser_rules_are_those_of_the_library():
    for rule in ("nmt_nfkc", "nfkc_cf"):
        normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        spec = dict(pieces._fields(normaliser.serialized_normalizer_spec()))
        own = pieces.Normaliser(spec[2], True, True, True)
        for text in ["ＡＢＣ ﬁ① ½ ｶﾞ é ​\ttab\r\n x\0y", "　a  b ", "", "  ", "Straße İ", *(r[1] or "" for r in awkward_rows())]:
            assert own(text) == normaliser.normalize(text)


def unigram(scores, fallback=False):
    found = [("<unk>", 0.0, pieces.UNKNOWN), *((f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256 if fallback else 0))]
    found += [(t, s, pieces.NORMAL) for t, s in scores.items()]
    return pieces.Model(found, pieces.UNIGRAM, fallback, pieces.Normaliser(dummy_prefix=True, remove_extra=False))


def test_unigram_path_is_the_shortest():
    rnd = random.Random(2)
    scores = {c: -rnd.uniform(3, 6) for c in "abc▁"}
    for _ in range(25):
        scores["".join(rnd.choice("abc") for _ in range(rnd.randint(2, 4)))] = -rnd.uniform(2, 9)
    model = unigram(scores)

    def best(text):
        if not text:
            return 0.0
        return max(scores[text[:i]] + best(text[i:]) for i in range(1, 5) if text[:i] in scores and i <= len(text))

    for _ in range(100):
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 9)))
        ids = model.encode(text)
        assert sum(model.pieces[i][1] for i in ids) == pytest.approx(best("▁" + text.replace(" ", "▁")))
        assert model.decode(ids.tolist()) == text


def test_unknown_characters():
    model = unigram({"a": -1.0, "▁": -1.0})
    assert model.encode("axxa").tolist() == [2, 1, 0, 1]
    bytes_too = unigram({"a": -1.0, "▁": -1.0}, fallback=True)
    assert bytes_too.decode(bytes_too.encode("aé漢 a").tolist()) == "aé漢 a"


def test_documents(docs, rows, no_docs):
    got = pieces.encode_documents(docs)
    found = got.collect()
    assert len(found) == len(rows) and all(r.round_trip for r in found)
    assert sorted(r.n_chars for r in found) == sorted(len(r[1] or "") for r in rows)
    assert all(r.n_tokens == len(r.token_ids) for r in found)
    back = pieces.decode_documents(got).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in back) == sorted(repr((r[0], r[1] or "")) for r in rows)
    assert pieces.encode_documents(no_docs).collect() == []


def test_missing_tokens_are_empty_text(spark):
    got = pieces.decode_documents(spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")).collect()
    assert [(r.doc_id, r.text) for r in got] == [(1, ""), (2, "")]


def test_models_with_user_pieces_are_refused():
    with pytest.raises(ValueError):
        pieces.Model([("<unk>", 0.0, pieces.UNKNOWN), ("x", 0.0, pieces.USER)], pieces.BPE, False, pieces.Normaliser())
    assert np.array_equal(unigram({"a": -1.0}).encode(None), [])
