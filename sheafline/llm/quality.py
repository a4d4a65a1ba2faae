"""Line-first cleaning: bad lines go first, then documents that lost too much text.

Each line is judged alone by punctuation, navigation and boilerplate rules. Lines that
fail are removed from the text, and a document is rejected if what it lost is more than
its share of characters allowed, or if its counts over the whole text (words, repeated
words) are beyond the limits. A block of documents is one flat array of lines and one of
words, so every rule is an array operation; no row depends on another document and
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from sheafline.llm.words import SPACE, Block, blocks, covered, per_text, whole_texts, word_block

# Characters counted as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
# Phrases of lines that belong to a site or a licence, not to a text (fixed values).
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "general public license",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "uses cookies",
    "enable javascript",
    "click here to",
    "sign up for our newsletter",
    "subscribe to our",
    "lorem ipsum",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document rules."""

    #: A line of fewer words must end in a mark of punctuation.
    heading_words: int = 20
    #: A line fails with as many separators, if they are more than one in ``separated_words`` words.
    separators: int = 2
    separated_words: int = 4
    #: A line fails with more than one run of symbols or double exclamation mark in so many words.
    shouted_words: int = 6
    #: A line of more words is text, even with a phrase of boilerplate in it.
    boilerplate_words: int = 30
    #: The share of a document's word characters that may go.
    lost: float = 0.5
    #: Fewest words of a document, and largest percentage of them in repeated windows.
    fewest_words: int = 20
    repeated_percent: int = 30
    window: int = 8


VERDICT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("word_chars", LongType()),
        StructField("n_symbols", LongType()),
        StructField("n_dup_lines", LongType()),
        StructField("n_repeat_words", LongType()),
        StructField("base_failed", BooleanType()),
        StructField("kept", BooleanType()),
        StructField("n_lines", LongType()),
        StructField("n_failed_punctuation", LongType()),
        StructField("n_failed_navigation", LongType()),
        StructField("n_failed_boilerplate", LongType()),
        StructField("lost_share", DoubleType()),
        StructField("clean_text", StringType()),
    ]
)


def line_first(text: Column | str, rules: LineRules = LineRules()) -> Column:
    """Counts, verdict and cleaned text of each whole text, as a struct.

    A null or empty text has no words, fails by its length and has an empty cleaned text.
    Lines without a word (blank lines) are kept and judged by no rule. Repeated documents
    have equal verdicts. A line fails under each rule that it breaks.
    """

    @F.arrow_udf(VERDICT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [judge(block, rules) for block in blocks(texts, 8_000_000)]
            yield pa.concat_arrays(parts) if parts else judge(texts, rules)

    return judged(text)


def judge(column: pa.Array, rules: LineRules) -> pa.StructArray:
    texts = whole_texts(column)
    block = word_block(texts)
    words = block.sizes
    repeated = repeated_words(block, rules.window)
    lists = pc.split_pattern(texts, pattern="\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.flatten()
    offsets = offsets - offsets[0]
    trimmed = pc.ascii_trim_whitespace(lines)
    filled = _flags(pc.greater(pc.binary_length(trimmed), 0))
    punctuation, navigation, boilerplate = (f & filled for f in _failed(trimmed, rules))
    bad = punctuation | navigation | boilerplate
    chars = word_characters(lines)
    word_chars = per_text(chars, offsets)
    lost = per_text(np.where(bad, chars, 0), offsets)
    share = lost / np.maximum(word_chars, 1)
    base_failed = (words < rules.fewest_words) | (100 * repeated > rules.repeated_percent * words)
    columns = {
        "n_words": words,
        "word_chars": word_chars,
        "n_symbols": pc.count_substring_regex(texts, pattern=f"[{SYMBOLS}]").to_numpy(zero_copy_only=False),
        "n_dup_lines": duplicate_lines(lines, filled, offsets),
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "kept": ~base_failed & (share <= rules.lost),
        "n_lines": per_text(filled, offsets),
        "n_failed_punctuation": per_text(punctuation, offsets),
        "n_failed_navigation": per_text(navigation, offsets),
        "n_failed_boilerplate": per_text(boilerplate, offsets),
        "lost_share": share,
        "clean_text": _joined(lines, ~bad, offsets),
    }
    arrays = [
        pa.array(columns[f.name], pa.bool_() if f.dataType == BooleanType() else None)
        if isinstance(columns[f.name], np.ndarray)
        else columns[f.name]
        for f in VERDICT
    ]
    return pa.StructArray.from_arrays(arrays, names=VERDICT.names)


def _flags(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def _failed(trimmed: pa.Array, rules: LineRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: whether it breaks the punctuation, navigation and boilerplate rules."""
    words = _flags(pc.count_substring_regex(trimmed, pattern="[\\x20\\x09-\\x0D]+")) + 1
    ended = _flags(pc.match_substring_regex(trimmed, pattern="[.!?…:;。！？]['\"”’»)\\]]*$"))
    shouted = _flags(pc.count_substring_regex(trimmed, pattern=f"!!+|[{SYMBOLS}][{SYMBOLS}][{SYMBOLS}]+"))
    punctuation = (~ended & (words < rules.heading_words)) | (shouted * rules.shouted_words > words)
    separators = _flags(pc.count_substring_regex(trimmed, pattern="[\\x20\\x09][|>»•·/][\\x20\\x09]"))
    navigation = (separators >= rules.separators) & (separators * rules.separated_words > words)
    phrase = _flags(pc.match_substring_regex(trimmed, pattern="|".join(BOILERPLATE), ignore_case=True))
    return punctuation, navigation, phrase & (words <= rules.boilerplate_words)


def word_characters(strings: pa.Array) -> np.ndarray:
    """Code points of each string that are not white space of ASCII."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    if not len(strings) or offsets[-1] == offsets[0]:
        return np.zeros(len(strings), dtype=np.int64)
    raw = np.frombuffer(strings.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    # bytes 10xxxxxx continue a character
    return per_text(~SPACE[raw] & ((raw & 0xC0) != 0x80), offsets - offsets[0])


def duplicate_lines(lines: pa.Array, filled: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    number = pc.dictionary_encode(lines).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[filled]
    width = int(number.max()) + 1 if len(number) else 1
    distinct = np.unique(owner * width + number[filled]) // width
    return per_text(filled, offsets) - np.bincount(distinct, minlength=len(offsets) - 1)


def repeated_words(block: Block, window: int) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in it.

    Windows are numbered exactly, without hashing: the numbers of two neighbouring
    shorter windows give the number of the window over both.
    """
    total = len(block.number)
    count = total - window + 1
    if count <= 0:
        return np.zeros(len(block.sizes), dtype=np.int64)
    number, length = block.number, 1
    while length < window:
        step = min(length, window - length)
        left = number[: len(number) - step]
        right = number[step:]
        number = np.unique(left * (int(number.max()) + 1) + right, return_inverse=True)[1]
        length += step
    owner = block.owner()
    starts = np.flatnonzero(owner[:count] == owner[window - 1 :])
    keys = owner[starts] * (int(number.max()) + 1) + number[starts]
    _, inverse, found = np.unique(keys, return_inverse=True, return_counts=True)
    return per_text(covered(starts[found[inverse] > 1], window, total), block.offsets)


def _joined(lines: pa.Array, kept: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The kept lines of each text, joined by line feeds."""
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    lists = pa.LargeListArray.from_arrays(pa.array(ends), lines.filter(pa.array(kept, pa.bool_())))
    return pc.binary_join(lists, pa.scalar("\n", lines.type)).cast(pa.string())
