import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gaugeworks.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = bpe.codec(PATH).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text):
    return np.frombuffer(bpe.encoder(PATH, PATTERN)(text), dtype="<u4").tolist()


def test_agrees_with_the_library_on_random_text(library):
    rng = random.Random(5)
    parts = ["a", "aa", "b", " ", "  ", "e", "\n", "é", "日", "　", "!", "'s", "1", "\u0085", "\x1c", "the", "<|endoftext|>", "\0"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.choice((2, 9, 60))))
        assert ids(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 1500, "".join(random.Random(1).choices("etaoin", k=4000)), " " * 3000])
def test_agrees_on_long_pre_tokens(library, text):
    assert ids(text) == library.encode_ordinary(text)


def test_time_grows_with_the_length_of_a_pre_token():
    assert bpe.codec(PATH).decode(ids("q" + "ab" * 100_000)) == b"q" + b"ab" * 100_000


def test_query(documents, corpus, library):
    got = sorted(bpe.digests(documents, PATH, PATTERN).collect(), key=repr)
    want = []
    for key, text in corpus:
        code = library.encode_ordinary(text or "")
        raw = np.array(code, dtype="<u4").tobytes()
        want.append((key, len(code), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_columns_pass(documents, no_documents):
    coded = bpe.encode(documents, PATH, PATTERN)
    assert coded.columns == [*documents.columns, "token_ids", "decoded"]
    row = coded.where("doc_id = 204").first()
    assert bytes(row.decoded) == b"one" and row._given == "g"
    assert bpe.encode(no_documents, PATH, PATTERN).count() == 0 and documents.columns == no_documents.columns
