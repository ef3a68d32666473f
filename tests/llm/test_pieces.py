"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tillsight.llm import pieces
from tillsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def made():
    return pieces.Pieces(PATH)


def test_random_texts_equal_the_library(library, made):
    rnd = random.Random(5)
    names = [made.text_of[i].replace(pieces.SPACE, " ") for i in range(259, made.size)]
    odd = "\t\n\r\0▁\U0001f600�\U0010ffffé"

    def part():
        return rnd.choice([rnd.choice(names), " " * rnd.randint(1, 9), rnd.choice("abeinorst"), rnd.choice(odd), chr(rnd.randint(0x4E00, 0x9FFF))])

    for _ in range(3_000):
        text = "".join(part() for _ in range(rnd.randint(0, 14)))
        ids = made.encode(text).tolist()
        assert ids == library.encode(text, add_eos=True), text
        assert made.decode(ids) == library.decode(ids), text


@pytest.mark.parametrize("text", ["", None, " ", "a" * 5_000, " " * 3_000, "=" * 777, "ab" * 3_000, "\n" * 99, "0123456789" * 300])
def test_hard_texts(library, made, text):
    assert made.encode(text).tolist() == library.encode(text or "", add_eos=True)


def test_every_prefix_ends_in_its_own_last_token(library, made):
    text = "▁Théorie▁der▁Zahlen,▁一二三฿▁tokenization=====▁▁▁▁end"
    for k, token in enumerate(made.last_tokens(text), 1):
        ids = library.encode(text[1:k].replace("▁", " ")) if k > 1 else [made.id_of["▁"]]
        shown = [t for t in ids if t not in made.byte_of or t == token]
        assert token >= made.size or shown[-1] == token


def test_decode_any_ids(library, made):
    rnd = random.Random(6)
    for _ in range(2_000):
        ids = [rnd.choice([rnd.randint(0, 258), rnd.randint(259, made.size - 1)]) for _ in range(rnd.randint(0, 10))]
        assert made.decode(ids) == library.decode(ids), ids


def test_memory_is_bounded_and_changes_nothing(library):
    small = pieces.Pieces(PATH)
    small.words.most = small.pairs.most = 10
    texts = [f"word{k} und noch {k * 7} weitere Wörter" for k in range(200)] * 2
    assert [small.encode(t).tolist() for t in texts] == library.encode(texts, add_eos=True)
    assert len(small.words.young) + len(small.words.old) <= 21 and len(small.pairs.young) <= 11


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op11_sentencepiece"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode(docs[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_long_digest_is_that_of_all_ids():
    import numpy as np

    ids = np.arange(pieces._RUN * 2 + 5, dtype="<i4")
    assert pieces.decimal_digest(ids, list(map(str, range(len(ids))))) == hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest()


def test_odd_rows(spark, library):
    kinds = "doc_id bigint, text string, n_tokens string, ids array<string>"
    rows = [(1, None, "x", None), (1, "", None, []), (None, "a b", "y", None), (2, "long " * 50_000, None, None), (2, "a b", "y", None)]
    found = pieces.encode_pieces(spark.createDataFrame(rows, kinds)).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(library.encode(t or "", add_eos=True)) for _, t, *_ in rows)
    assert [list(r.ids) for r in found if r.doc_id is None] == [library.encode("a b", add_eos=True)]
    assert pieces.encode_pieces(spark.createDataFrame([], kinds)).count() == 0
