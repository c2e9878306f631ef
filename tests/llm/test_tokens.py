"""Token counts and packing."""

import zlib

import numpy as np
import pytest
from helpers import PROSE, clashing, documents, fits, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import packing, token_counts
from tessella.llm.tables import public_tokenizer
from tessella.llm.tokenization import encoder
from tessella.session import scratch_path

PATH = public_tokenizer("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "x\n y", "\n\n", "it's <|endoftext|> 'll", "é ü ñ\x85 z", "a" * 3000, "1 22 333 . .. ...", " lead", "trail ", "\t\ttab  \n end"]


def ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z.,'!\n\t \x1c é中1_")), max_size=30))
def test_parts_make_the_librarys_ids(text):
    enc = encoder(PATH)
    assert enc.encode(text) == enc.whole(text)


def test_counts_and_cache(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(ODD)] + [(20, None), (21, PROSE), (21, PROSE), (None, PROSE)])
    cache = scratch_path(spark, "cache")
    for _ in range(2):  # the second run finds all it needs
        got = token_counts.count_tokens(clashing(docs), PATH, cache).collect()
        assert len(got) == docs.count()
        known = {r.doc_id: (r.n_tokens, r.n_bytes) for r in got}
        assert known[20] == (0, 0) and known[21] == known[None] == (len(ids(PROSE)), len(PROSE))
        assert all(known[i] == (len(ids(t)), len(t.encode())) for i, t in enumerate(ODD))
        stored = token_counts.read_cache(spark, cache)
        assert stored.count() == len({*ODD, "", PROSE}) == spark.read.parquet(cache).count()
    more = documents(spark, [(1, PROSE + " more"), (2, PROSE)])
    token_counts.count_tokens(more, PATH, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1  # only what is new


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(documents(spark, []), PATH, scratch_path(spark, "cache")).count() == 0


@pytest.mark.parametrize("share", [3, 1000])
def test_packing(spark, share):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, " ".join(prose(1, 3, 2000))), (52, PROSE), (52, PROSE), (None, PROSE)]
    texts += [(100 + i, t) for i, t in enumerate(prose(60, 1, 37))]
    got = packing.pack(clashing(documents(spark, texts)), PATH, length=128, share=share, open_bins=8).collect()
    assert fits([(r.sequence_id, r.offset, r.length) for r in got], 128)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in dict(texts).items():
        all_ids = np.array([*ids(text), 2], "<u4")
        pieces = sorted(by[i], key=lambda r: (r.piece, r.sequence_id, r.offset))
        if i == 52:
            pieces = pieces[:: len(pieces) // len({r.piece for r in pieces})]
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert all(r.length == 128 for r in pieces[1:])
        assert sum(r.length for r in pieces) == len(all_ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(all_ids[r.start : r.start + r.length].tobytes())
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_sequences_are_few(spark):
    texts = [t for k in range(60) for t in prose(50, k, 5 + 6 * k)]
    got = packing.pack(documents(spark, list(enumerate(texts))), PATH, length=1024)
    total, used = got.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert used <= 1.01 * -(-total // 1024)


def test_open_bins_take_the_best_fit_and_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 8, 7, 2, 4, 3)] == [(0, 0), (1, 0), (2, 0), (2, 7), (0, 6), (3, 0)]
