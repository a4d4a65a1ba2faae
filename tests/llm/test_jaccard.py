"""The n-gram Jaccard join against its SQL, and against exact components whatever the order of n-grams."""

from pathlib import Path

import duckdb
import pytest

from sheafline.llm import jaccard
from sheafline.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark, sf_dir):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("documents.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    expected = sorted(duck.execute(ORACLES["op7_jaccard_join"]).fetchall())
    got = QUERIES["op7_jaccard_join"](spark, sf_dir).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == expected


def word_sets(text, n):
    words = text.split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("most_heavy", [0, 50, 4_000_000])
def test_order_of_grams_does_not_matter(spark, most_heavy):
    import random

    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(60)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    sets = [word_sets(t, 3) for t in texts]
    root = list(range(len(texts)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = jaccard.near_duplicates(docs, n=3, percent=80, most_heavy=most_heavy)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {k: top(k) for k in range(len(texts))}


def test_heavy_grams_are_the_most_frequent(spark):
    texts = ["a b"] * 40 + ["b c"] * 20 + ["c d"] * 9 + ["d e"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert sorted(jaccard.heavy_grams(docs, text="text", n=2).levels.tolist()) == [13, 17, 21]
    assert jaccard.heavy_grams(docs, text="text", n=2, most=2).levels.tolist() in ([17, 21], [21, 17])
    assert len(jaccard.heavy_grams(docs, text="text", n=2, most=0).grams) == 0
    assert len(jaccard.heavy_grams(docs.limit(0), text="text", n=2).grams) == 0
