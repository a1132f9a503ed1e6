import hashlib
import json
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from countflow.llm import merge_bpe
from countflow.llm.merge_bpe import MergeBpe, decode, encode, op13_bpe, read_spec

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODER = MergeBpe(**read_spec(PATH))


def ids_of(text, coder=CODER):
    return np.frombuffer(coder.encode(text), "<i4").tolist()


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e\n\t    \x1c\x85é★🙂'lst19.,-漢՘ "), max_size=60) | st.text(max_size=40) | st.lists(st.sampled_from(["<|endoftext|>", "<|endof", " a", "  ", "the", "|>"]), max_size=8).map("".join))
def test_same_ids_and_text_as_the_library(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = ids_of(text)
    assert ids == library(text)
    assert CODER.decode_batch([CODER.encode(text), b""]) == [LIBRARY.decode(ids, skip_special_tokens=False), ""]


def test_any_ids_decode_as_the_library_does():
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 50400, n).tolist() for n in (1, 5, 40, 300)]
    assert CODER.decode_batch([np.array(x, "<u4").tobytes() for x in lists]) == [LIBRARY.decode(x, skip_special_tokens=False) for x in lists]


def test_merges_go_by_the_list_and_not_by_the_vocabulary():
    letters = {c: i for i, c in enumerate(merge_bpe.byte_letters())}
    vocab = letters | {"ab": 256, "bc": 257, "abc": 258, "aab": 259}
    coder = MergeBpe(vocab, [("b", "c"), ("a", "b"), ("a", "ab")], {"<s>": 300})
    assert ids_of("abc", coder) == [letters["a"], 257]  # "abc" is in the vocabulary, but no merge makes it
    assert ids_of("aab<s>ab", coder) == [259, 300, 256]


@pytest.mark.parametrize("text", ["ab" * 3000, "x" * 5000, "zq" * 2000 + "the" * 900, " " * 4000, "漢字" * 1000])
def test_long_pieces(text):
    assert ids_of(text) == library(text)


def test_very_long_texts():
    begin = time.monotonic()
    text = ("lorem ipsum dolor sit amet, " * 9 + "\n") * 80_000  # 20 MB
    assert CODER.decode_batch([CODER.encode(text)]) == [text]
    piece = "ab" * 500_000  # a pre-token of 1 MB
    assert CODER.decode_batch([CODER.encode(piece)]) == [piece]
    assert time.monotonic() - begin < 120


def test_memos_that_are_trimmed_give_the_same_ids(monkeypatch, docs):
    monkeypatch.setattr(merge_bpe, "MEMO", 50)
    coder = MergeBpe(**read_spec(PATH))
    for r in docs.limit(40).collect():
        assert ids_of(r["text"] or "", coder) == library(r["text"] or "")


def test_other_kinds_of_files_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": spec["model"] | {"ignore_merges": True}}):
        at = tmp_path / "odd.json"
        at.write_text(json.dumps(spec | change), encoding="utf-8")
        with pytest.raises(ValueError):
            read_spec(str(at))


def test_odd_rows(clashing, none):
    rows = encode(clashing, "text", PATH, decoded="out").collect()
    assert len(rows) == clashing.count()
    for r in rows:
        assert r["ids"] == library(r["text"] or "") and r["out"] == LIBRARY.decode(r["ids"], skip_special_tokens=False)
        assert r["score"] == "clash"
    assert decode(encode(none, "text", PATH), "ids", PATH).count() == 0


def test_decode_of_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "k long, ids array<int>")
    assert [r["decoded"] for r in decode(df, "ids", PATH).orderBy("k").collect()] == [None, "", LIBRARY.decode([64, 65])]


def test_op13_against_the_library(spark, docs, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = op13_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library(texts[r["doc_id"]])
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
