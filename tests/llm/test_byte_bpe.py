import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from countflow.llm.byte_bpe import ByteBpe, decode, encode, op9_byte_bpe, read_ranks
from countflow.llm.mph import MinimalPerfectHash

TOKENS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
CODER = ByteBpe(TOKENS, public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e\n\t    \x1c\x85é★🙂'lst19.,-漢"), max_size=60) | st.text(max_size=40))
def test_same_ids_as_tiktoken(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    packed = CODER.encode_batch([text])[0]
    assert np.frombuffer(packed, "<u4").tolist() == ENCODING.encode_ordinary(text)
    assert CODER.decode_batch([packed, b"", packed]) == [text.encode(), b"", text.encode()]


def test_memos_that_are_trimmed_give_the_same_ids(monkeypatch, docs):
    from countflow.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "MEMO", 50)
    monkeypatch.setattr(byte_bpe, "INNER", 5)
    coder = ByteBpe(TOKENS, public_tokenizers.PATTERN)
    texts = [r["text"] or "" for r in docs.limit(60).collect()] + ["word, Word,, ǆ, ɐɐ. it's it's, \u02b0a b\u0345 x1, ª.", ""]
    for k in range(0, len(texts), 7):
        for t, packed in zip(texts[k : k + 7], coder.encode_batch(texts[k : k + 7])):
            assert np.frombuffer(packed, "<u4").tolist() == ENCODING.encode_ordinary(t)
            assert coder.decode_batch([packed]) == [t.encode()]


@pytest.mark.parametrize("text", ["ab" * 3000, "x" * 5000, "zq" * 2000 + "the" * 900])
def test_long_pieces(text):
    assert CODER.merge(text.encode()) == ENCODING.encode_ordinary(text)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    mph = MinimalPerfectHash.build(keys)
    assert sorted(mph.lookup(keys).tolist()) == list(range(n))
    again = MinimalPerfectHash.from_bytes(mph.to_bytes())
    assert again.lookup(keys).tolist() == mph.lookup(keys).tolist()


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        MinimalPerfectHash.build(np.array([5, 5], dtype=np.uint64))


def test_query(spark, sf, docs):
    rows = {r["doc_id"]: r for r in op9_byte_bpe(spark, sf).collect()}
    for d in docs.collect():
        ids = ENCODING.encode_ordinary(d["text"] or "")
        r = rows.pop(d["doc_id"])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
    assert not rows


def test_odd_rows(clashing, none):
    out = decode(encode(clashing, "text", TOKENS, public_tokenizers.PATTERN), "ids", TOKENS).collect()
    assert len(out) == clashing.count()
    for r in out:
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["score"] == "clash"
    assert encode(none, "text", TOKENS, public_tokenizers.PATTERN).count() == 0
