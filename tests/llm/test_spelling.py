"""Spelling variants against a plain script over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sheafline.llm import spelling
from sheafline.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, noise=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def plain_groups(counts, ratio=10):
    # all pairs that agree but for one place, through words with one code point left out
    holes = {}
    for word in counts:
        for i in range(len(word)):
            holes.setdefault(word[:i] + word[i + 1 :], set()).add(word)
        holes.setdefault(word, set()).add(word)
    near = {word: set() for word in counts}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if b != a and b not in near[a] and one_edit(a, b)}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best and counts[best] >= ratio * n else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), counts[form[word]] if form[word] else None))
    return out


def rows_of(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in plain_counts(docs).items() if n >= 2}
    expected = plain_groups(counts)
    assert rows_of(QUERIES["op11_spelling_variants"](spark, sf_dir)) == expected
    assert sum(row[1] is not None for row in expected) > 10


WORDS = ["abcdefg", "abcdefgh", "abcdeg", "bbcdefg", "abcdefgg", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "éabcdefg", "zabcdefg", "", "a", "b"]


@pytest.mark.parametrize("block", [1, 2, 3, 512])
@pytest.mark.parametrize("regions", [1, 2, 4, 9])
def test_blocks_and_regions_do_not_matter(spark, block, regions):
    counts = {word: 10 ** (i % 4) for i, word in enumerate(WORDS)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variant_groups(words, regions=regions, block=block)) == plain_groups(counts)


def test_long_words_chains_and_ties(spark):
    long = "xy" * 40_000
    counts = {long: 5, long + "z": 500, "q" + long: 500, "rootword": 1000, "rotword": 100, "rotwrd": 10, "rtwrd": 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("best", F.lit("clash"))
    found = {r[0]: r for r in rows_of(spelling.variant_groups(words))}
    assert found[long][1] == "q" + long and found[long][4] == 2
    assert found["rtwrd"][2] == "rootword" and found["rotwrd"][1] == "rotword"


def test_counts_of_odd_texts(spark):
    schema = "doc_id long, text string, word string, n long"
    rows = [(1, None), (None, "Übermässig ÜBERMÄSSIG x×÷abcdef"), (2, ""), (2, "a1bcdefgh"), (3, "Hellothere " * 50_000), (3, "Hellothere")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], schema).repartition(3)
    found = {r["word"]: r["n"] for r in spelling.run_counts(docs, noise=31).collect()}
    assert found == dict(plain_counts(rows))
    assert spelling.run_counts(docs.limit(0)).collect() == []
    assert spelling.variant_groups(spelling.run_counts(docs.limit(0))).collect() == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=9), min_size=2, max_size=60, unique=True))
def test_any_words(spark, words):
    counts = {word: 1 + zlib.crc32(word.encode()) % 40 for word in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variant_groups(table, ratio=2, block=3)) == plain_groups(counts, ratio=2)


def test_ratio_must_lead_upwards(spark):
    with pytest.raises(ValueError, match="ratio"):
        spelling.variant_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
