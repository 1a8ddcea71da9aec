import hashlib
import random

import numpy as np
import public_tokenizers as tok
import pytest
import tiktoken
from helpers import ODD_ROWS, SF, data, frame

from fleetspark.llm import byte_bpe as bb

PATH = tok.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bb.Codec(bb.read_ranks(PATH), tok.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=codec.vocabulary.ranks, special_tokens={})


def test_equals_the_library(codec, library):
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice("abeinrst aeiou  th\n1'2é漢aaaa😀#") for _ in range(rnd.randint(0, 60)))
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_appends_and_edits_are_exact(codec):
    v, rnd = codec.vocabulary, random.Random(2)
    for _ in range(400):
        data_ = bytes(rnd.choice(b"aabtheinr\xc3\xa9\xff 1") for _ in range(rnd.randint(1, 900)))
        whole = bb.PrefixState(v, data_)
        grown = bb.PrefixState(v)
        for k in range(0, len(data_), 7):
            grown.append(data_[k:k + 7])
        assert grown.last == whole.last
        a = rnd.randint(0, len(data_))
        b = rnd.randint(a, len(data_))
        new = bytes(rnd.choice(b"aabthe") for _ in range(rnd.randint(0, 9)))
        whole.replace(a, b, new)
        assert whole.data == data_[:a] + new + data_[b:] and whole.last == bb.PrefixState(v, whole.data).last


def test_every_token_encodes_to_itself(codec):
    v = codec.vocabulary
    assert all(len(t) == 1 or v.left[i] >= 0 for i, t in enumerate(v.tokens))


def test_operator(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = ODD_ROWS + [tuple(r) for r in docs.collect()]

    def want(text):
        ids = library.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = data(bb.encode_decode(frame(spark, rows), PATH, tok.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((i, *want(t)) for i, t, _ in rows), key=str)
    assert bb.encode_decode(frame(spark, []), PATH, tok.PATTERN, with_ids=True).count() == 0
