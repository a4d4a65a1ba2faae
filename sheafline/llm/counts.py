"""Exact token counts at every prefix, by dynamic programming over byte-level BPE.

A BPE encoding without its last token is the encoding of the shorter text. So the best
known token count of a prefix follows from an earlier prefix and one last token: for each
end position exactly one token of the vocabulary can be last, the one that BPE keeps
beside the last token of the prefix before it. Two tokens are kept side by side if no
merge across their border comes before the merges that build them.

Pieces (what the pattern splits off) are encoded alone, so counts at every byte of each
distinct piece are stored once per task, and counts at the pieces' ends once per text.
Together they give the count of any prefix, and the longest prefix within a budget,
without encoding again. Nothing is shuffled.
"""

from __future__ import annotations

import json
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sheafline.llm.words import blocks

#: Distinct pieces (and pairs of tokens) whose counts a task keeps.
REMEMBERED = 500_000
NEVER = 1 << 62


def _byte_characters() -> dict[str, int]:
    """The bytes behind the printable characters that vocabulary files use."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Tokens, merges in order, and the strings that are tokens wherever they stand."""

    tokens: dict[bytes, int]
    merges: list[tuple[int, int, int]]
    special: tuple[str, ...]


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE tokenizer in JSON, without normaliser, prefix space or dropout."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, before = content["model"], content["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or not before["use_regex"]:
        raise ValueError("a byte-level BPE model is needed")
    if content["normalizer"] or before["add_prefix_space"] or model["dropout"] or model["ignore_merges"]:
        raise ValueError("normalisers, prefix spaces, dropout and ignored merges are not supported")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in content["added_tokens"]):
        raise ValueError("added tokens must stand for their exact text")
    byte = _byte_characters()
    ids = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Vocabulary(
        {bytes(byte[c] for c in token): number for token, number in ids.items()},
        [(ids[a], ids[b], ids[a + b]) for a, b in merges],
        tuple(t["content"] for t in content["added_tokens"]),
    )


class PrefixTable:
    """Token counts at every byte of each distinct piece."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.rank = {(a << 32) | b: n for n, (a, b, _) in enumerate(vocabulary.merges)}
        self.parts = {token: (a, b) for a, b, token in vocabulary.merges}
        self.built = {token: n for n, (_, _, token) in enumerate(vocabulary.merges)}
        # every ending of a token, with the token it is, if it is one
        self.endings: dict[bytes, int] = {}
        for token in vocabulary.tokens:
            for cut in range(len(token)):
                self.endings[token[cut:]] = -1
        self.endings |= vocabulary.tokens
        self.beside: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.right_spines: dict[int, list[tuple[int, int]]] = {}
        self.left_spines: dict[int, list[tuple[int, int]]] = {}
        self.special = vocabulary.special
        self.forget()

    def forget(self) -> None:
        # a piece not met before gets the next number; special strings, as bytes, come first
        self.number: defaultdict[str | bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.counts: list[bytes | array] = []
        self.totals = self.chars = np.zeros(0, np.int64)
        for string in self.special:
            self.number[string.encode("utf-8")]
        self.counts += [b""] * len(self.special)
        self.totals = np.ones(len(self.special), np.int64)
        self.chars = np.array([len(s) for s in self.special], dtype=np.int64)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one border of ``token`` while it is built, each with the rank that ends it."""
        spines = self.left_spines if side == 0 else self.right_spines
        if token not in spines:
            out, until = [], NEVER
            at = token
            while True:
                out.append((at, until))
                if at not in self.parts:
                    break
                until = self.built[at]
                at = self.parts[at][side]
            spines[token] = out[::-1]
        return spines[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether BPE keeps the two tokens side by side."""
        pair = (left << 32) | right
        known = self.beside.get(pair)
        if known is None:
            if len(self.beside) > self.remembered:
                self.beside.clear()
            known = self.beside[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        if not (self.is_whole(left) and self.is_whole(right)):
            return False
        ends, begins = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = ends[i], begins[j]
            merge = self.rank.get((a << 32) | b)
            # of equal merges the left one comes first
            if merge is not None and merge < a_until and merge <= b_until:
                return False
            if a_until == b_until == NEVER:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def is_whole(self, token: int) -> bool:
        """Whether BPE turns the token's own bytes into the token."""
        if token not in self.whole:
            parts = self.parts.get(token)
            self.whole[token] = parts is None or self._merge_of(*parts)
        return self.whole[token]

    def _merge_of(self, left: int, right: int) -> bool:
        # both sides must be complete before they merge, and merge with nothing else
        rank = self.rank[(left << 32) | right]
        if not (self.is_whole(left) and self.is_whole(right)):
            return False
        ends, begins = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while i < len(ends) - 1 or j < len(begins) - 1:
            (a, a_until), (b, b_until) = ends[i], begins[j]
            merge = self.rank.get((a << 32) | b)
            if merge is not None and merge < a_until and merge <= b_until:
                return False
            if min(a_until, b_until) > rank:
                return False
            if a_until <= b_until:
                i += 1
            else:
                j += 1
        return True

    def learn(self) -> None:
        """Counts the prefixes of the pieces numbered since the last call.

        In sorted order, so that pieces with a common beginning share its counts.
        """
        first = len(self.counts)
        if first == len(self.number):
            return
        new = list(islice(self.number, first, None))
        raw = [p.encode("utf-8") for p in new]
        self.counts += [b""] * len(new)
        before = b""
        counts, last = [0], [-1]
        for n in sorted(range(len(raw)), key=raw.__getitem__):
            same = len(commonprefix((before, raw[n])))
            del counts[same + 1 :], last[same + 1 :]
            self._extend(raw[n], counts, last)
            before = raw[n]
            self.counts[first + n] = bytes(counts) if counts[-1] < 256 and max(counts) < 256 else array("i", counts)
        self.totals = np.concatenate([self.totals, [c[-1] for c in self.counts[first:]]])
        self.chars = np.concatenate([self.chars, [len(p) for p in new]])

    def _extend(self, raw: bytes, counts: list[int], last: list[int]) -> None:
        """Adds the counts of the prefixes of ``raw`` that ``counts`` does not reach yet."""
        endings, beside = self.endings.get, self.beside.get
        for end in range(len(counts), len(raw) + 1):
            candidates = []
            for start in range(end - 1, -1, -1):
                token = endings(raw[start:end])
                if token is None:
                    break
                if token >= 0:
                    candidates.append((start, token))
            for start, token in reversed(candidates):
                before = last[start]
                if before < 0:
                    fits = self.is_whole(token)
                elif (fits := beside((before << 32) | token)) is None:
                    fits = self.stay_apart(before, token)
                if fits:
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError("a byte without a token")


@dataclass(frozen=True)
class Cut:
    """A piece of a text from ``begin`` to ``end``, ``before`` tokens after the text's beginning."""

    begin: int
    end: int
    before: int
    counts: bytes | array
    offsets: np.ndarray | None

    def at(self, end: int) -> int:
        chars = end - self.begin
        return self.before + self.counts[chars if self.offsets is None else self.offsets[chars]]


class PrefixCounts:
    """Token counts of the prefixes of one text, counted in characters."""

    def __init__(self, text: str, numbers: np.ndarray, counter: Counter):
        self.text, self.numbers, self.counter = text, numbers, counter
        table = counter.table
        self.ends = np.concatenate([[0], np.cumsum(table.chars[numbers])])
        self.totals = np.concatenate([[0], np.cumsum(table.totals[numbers])])
        self.fixed = numbers < len(table.special)
        # the white space and the piece asked for last
        self.run: Cut | None = None
        self.cut: Cut | None = None

    @property
    def total(self) -> int:
        return int(self.totals[-1])

    def at(self, end: int) -> int:
        """The token count of the first ``end`` characters, as if they stood alone."""
        if self.run and self.run.begin < end <= self.run.end:
            return self.run.at(end)
        space = self.counter.space
        white = end > 0 and space.match(self.text, end - 1, end) is not None
        n = int(np.searchsorted(self.ends, end))
        if self.ends[n] == end and not (n and white and not self.fixed[n - 1]):
            return int(self.totals[n])
        n -= 1  # the piece that the prefix cuts, or that ends in white space
        if self.fixed[n]:  # part of a special string is ordinary text, and may join what stands before it
            while n and not self.fixed[n - 1]:
                n -= 1
            return int(self.totals[n]) + self._alone(self.text[self.ends[n] : end])
        if white:  # white space is split by what follows it: at the end of a text it is one piece
            while n and not self.fixed[n - 1] and space.fullmatch(self.text, self.ends[n - 1], self.ends[n]):
                n -= 1
            self.run = self._counted(int(self.ends[n]), space.match(self.text, self.ends[n]).end(), int(self.totals[n]))
            return self.run.at(end)
        if self.text[self.ends[n]] == "'" and self.ends[n + 1] - self.ends[n] <= 3:  # a shorter contraction is none
            return int(self.totals[n]) + self._alone(self.text[self.ends[n] : end])
        if self.cut is None or self.cut.begin != self.ends[n]:
            self.cut = self._counted(int(self.ends[n]), int(self.ends[n + 1]), int(self.totals[n]))
        return self.cut.at(end)

    def _counted(self, begin: int, end: int, before: int) -> Cut:
        """The counts of all prefixes of one piece, learned once however many of them are asked for."""
        piece = self.text[begin:end]
        table = self.counter.table
        number = table.number[piece]
        table.learn()
        offsets = None if piece.isascii() else np.cumsum([0, *(len(c.encode("utf-8")) for c in piece)])
        return Cut(begin, end, before, table.counts[number], offsets)

    def _alone(self, text: str) -> int:
        numbers = self.counter.numbers(text, learn=True, special=False)
        return int(self.counter.table.totals[numbers].sum())

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        n = int(np.searchsorted(self.totals, budget, side="right")) - 1
        # white space may join over the border of two pieces, so look one piece further
        best, stop = int(self.ends[n]), int(self.ends[min(n + 2, len(self.ends) - 1)])
        for end in range(stop, best, -1):
            if self.at(end) <= budget:
                return end
        return best


class Counter:
    """Prefix counts of the texts of one task."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int):
        self.table = PrefixTable(vocabulary, remembered)
        self.split = regex.compile(pattern).findall
        # white space as the pattern sees it
        self.space = regex.compile(r"\s+")
        strings = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(map(regex.escape, strings))})").split if strings else None

    def numbers(self, text: str, *, learn: bool = False, special: bool = True) -> np.ndarray:
        """The numbers of a text's pieces."""
        number = self.table.number.__getitem__
        parts = self.special(text) if special and self.special else [text]
        found: list[int] = []
        for n, part in enumerate(parts):
            found.extend([number(part.encode("utf-8"))] if n % 2 else map(number, self.split(part)))
        if learn:
            self.table.learn()
        return np.array(found, dtype=np.int32)

    def __call__(self, texts: Iterable[str | None]) -> Iterator[PrefixCounts]:
        if len(self.table.number) > self.table.remembered:
            self.table.forget()
        whole = [t or "" for t in texts]
        numbers = [self.numbers(t) for t in whole]
        self.table.learn()
        for text, own in zip(whole, numbers, strict=True):
            yield PrefixCounts(text, own, self)


COUNTS = StructType([StructField("n_tokens", LongType()), StructField("prefix_chars", LongType())])


def token_counts(text: Column | str, *, vocabulary: str, pattern: str, budget: int, remembered: int = REMEMBERED) -> Column:
    """The token count of each whole text, and the longest prefix within ``budget`` tokens.

    A struct of ``n_tokens`` and ``prefix_chars``. A null text counts as the empty one:
    no tokens. A special string inside a text is one token.
    """
    content = read_vocabulary(vocabulary)

    @F.arrow_udf(COUNTS)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = Counter(content, pattern, remembered)
        for texts in batches:
            found = [
                (c.total, c.longest_within(budget)) for block in blocks(texts) for c in count(t.as_py() for t in block)
            ]
            columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(2)]
            yield pa.StructArray.from_arrays(columns, names=COUNTS.names)

    return counted(text)


def prefix_counts(text: Column | str, *, vocabulary: str, pattern: str, remembered: int = REMEMBERED) -> Column:
    """Token counts of the first 0, 1, ... characters of each whole text."""
    content = read_vocabulary(vocabulary)

    @F.arrow_udf(ArrayType(IntegerType()))
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = Counter(content, pattern, remembered)
        for texts in batches:
            rows = [
                [c.at(n) for n in range(len(c.text) + 1)]
                for block in blocks(texts)
                for c in count(t.as_py() for t in block)
            ]
            yield pa.array(rows, pa.list_(pa.int32()))

    return counted(text)
