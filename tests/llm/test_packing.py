import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fairtally.llm import packing
from frames import no_documents, odd_documents, words

HF = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
HF.encode_special_tokens = True
CODER = packing.encoding(packing.default_tokenizer())


def ids(text):
    return [*HF.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x1c\x85  abcABC'sdé漢😀1२.!|<>_-")), max_size=40))
def test_ids_equal_the_tokenizers_library(text):
    cache = packing.PieceIds(CODER)
    assert np.frombuffer(packing.text_ids(text, CODER, cache), "<u4").tolist() == ids(text)


def test_special_token_text_is_plain_text():
    cache = packing.PieceIds(CODER)
    text = "a <|endoftext|> b"
    assert np.frombuffer(packing.text_ids(text, CODER, cache), "<u4").tolist() == ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=1, max_size=60))
def test_bins_are_sound_and_not_below_the_bound(sizes):
    sizes = np.array(sorted(sizes, reverse=True))
    bins, offsets, fill = packing.best_fit_decreasing(sizes, 100)
    assert fill.max() <= 100 and fill.sum() == sizes.sum()
    for b in range(len(fill)):
        own = np.argsort(offsets[bins == b])
        assert (np.cumsum(sizes[bins == b][own]) - sizes[bins == b][own] == offsets[bins == b][own]).all()
    bound = packing.lower_bound(sizes, 100)
    assert -(-sizes.sum() // 100) <= bound <= len(fill)


def test_bound_sees_what_the_sum_does_not():
    assert packing.lower_bound(np.array([51] * 10), 100) == 10
    assert packing.lower_bound(np.array([34] * 9), 100) == 5


def sound(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_documents_come_back_whole(spark):
    docs = odd_documents(spark)
    rows = packing.pack_documents(docs, capacity=128, with_ids=True).collect()
    sound(rows, 128)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 3)}
    for i, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [x for r in own for x in r.ids] == ids(text)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert all(r.length == 128 for r in own[1:]) and [r.piece for r in own] == list(range(len(own)))
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in own)
    assert len([r for r in rows if r.doc_id == 3]) == 2 * len([r for r in rows if r.doc_id == 1])


@pytest.mark.parametrize("group", [40, 10_000])
def test_exchange_keeps_every_piece(spark, group):
    rng = random.Random(4)
    sizes = [rng.choice([520, 300, 1024, 7, 90, 700]) for _ in range(600)]
    pieces = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id bigint, length bigint")
    rows = packing.pack(pieces, 1024, group).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(sizes))
    assert sound(rows, 1024) <= packing.lower_bound(np.array(sizes), 1024) * (1.1 if group == 40 else 1.03)


def test_no_documents(spark):
    assert packing.pack_documents(no_documents(spark)).collect() == []
    one = spark.createDataFrame([(1, " ".join(words(random.Random(1), 5)))], "doc_id bigint, text string")
    assert packing.pack_documents(one).count() == 1
