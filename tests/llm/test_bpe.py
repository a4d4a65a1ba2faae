"""Merge replay against the public library, on texts that are hard for an index shared by all pieces."""

import random

import public_tokenizers
import pytest
import regex
import tiktoken

from sheafline.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
SPLIT = regex.compile(public_tokenizers.PATTERN).findall


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def _odd_texts(number: int) -> list[str]:
    own = random.Random(number)
    alphabets = ("a", "ab", " \n\t", "aeiounst", "abcdefghijklmnopqrstuvwxyz", "éèü漢字a1 ", "=-_#")
    return ["".join(own.choices(alphabet, k=own.randint(0, 300))) for alphabet in alphabets for _ in range(40)]


@pytest.mark.parametrize("indexed", [64, bpe.INDEXED])
def test_ids_equal_the_library_whatever_the_size_of_an_index(library, monkeypatch, indexed):
    monkeypatch.setattr(bpe, "INDEXED", indexed)
    texts = _odd_texts(3)
    found = bpe.MergeReplay(RANKS).encode(texts, SPLIT).to_pylist()
    assert found == [library.encode_ordinary(text) for text in texts]


def test_pieces_share_one_index(library):
    pieces = [text.encode() for text in _odd_texts(5)] + [b"", "overlapping".encode(), b""]
    ids, begins = bpe.MergeReplay(RANKS).replay(pieces)
    assert len(begins) == len(pieces) + 1
    alone = bpe.MergeReplay(RANKS)
    for piece, begin, end in zip(pieces, begins, begins[1:], strict=False):
        assert ids[begin:end].tolist() == alone.replay([piece])[0].tolist()


@pytest.mark.parametrize("unit", ["a", " ", "ab", "the", "=-"])
def test_long_runs_are_merged_in_seconds(library, unit):
    text = unit * (40_000 // len(unit))
    assert bpe.MergeReplay(RANKS).encode([text], SPLIT).to_pylist() == [library.encode_ordinary(text)]


def test_a_late_pair_of_lower_rank_comes_first():
    """After ``bc`` (rank 258) ``a`` + ``bc`` may merge at 257, before the ``bc`` to its right."""
    ranks = {bytes([b]): b for b in range(256)} | {b"xy": 256, b"abc": 257, b"bc": 258, b"cbc": 259, b"abcbc": 260}
    plain = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcbc", "abcbcabc", "cbcbc", "abcabcabc", "abcbcbcbc", "xyabcxy"):
        found = bpe.MergeReplay(ranks).replay([text.encode()])[0].tolist()
        assert found == plain.encode_ordinary(text), text


def test_no_pieces():
    replay = bpe.MergeReplay(RANKS)
    assert replay.replay([])[0].tolist() == []
    assert replay.encode(["", None], SPLIT).to_pylist() == [[], []]
