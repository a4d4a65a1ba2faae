"""Fingerprints against a plain script, and classes of near copies against exact Jaccard of all pairs."""

import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheafline.llm import minhash
from sheafline.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_query_equals_a_plain_script(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in QUERIES["op13_fingerprints"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    texts = [r["text"] or "" for r in docs]
    errors, prints = [], {}
    for k, row in enumerate(docs):
        text, follower = texts[k], texts[(k + 1) % len(texts)]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + follower[:quarter]
        got = found[row["doc_id"]]
        assert got["n_chars"] == len(text)
        assert got["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, got["fingerprint"]) == got["fingerprint"]
        own = shingle_set(text)
        errors.append(got["near_edited"] - jaccard(own, shingle_set(edited)))
        errors.append(got["near_next"] - jaccard(own, shingle_set(follower)))
    assert len(prints) == len(set(texts)) or len(set(prints.values())) > 0.95 * len(set(texts))
    # 128 places: the standard error is 0.044 at most
    assert abs(np.mean(errors)) < 0.005 and np.max(np.abs(errors)) < 0.2


def test_minima_equal_a_loop():
    texts = pa.array(["a b c d e f g", "", "one two", "A b C d e F g", " \n"], pa.large_string())
    found, begins = minhash.shingles(texts, 5)
    signature = minhash.signatures(texts, permutations=8)
    mask = (1 << 64) - 1
    places = np.arange(1, 9, dtype=np.uint64)
    a = (minhash.mixed(places, places * minhash.MIX) | np.uint64(1)).tolist()
    b = minhash.mixed(places * minhash.MIX, places).tolist()
    for row in range(len(texts)):
        xs = [x >> 32 for x in found[begins[row] : begins[row + 1]].tolist()]
        expected = [min((((x * a[k] + b[k]) & mask) >> 32 for x in xs), default=0xFFFFFFFF) for k in range(8)]
        assert signature[row].tolist() == expected
    assert (signature[0] == signature[3]).all() and (signature[1] == signature[4]).all()


SCHEMA = "doc_id long, text string, key string, place string, part int, foreign string"


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_order_of_odd_rows(spark, parts):
    texts = {5: "zz" * 3, -7: "", 2: None, 9: "é" * 9, 3: "one two three four five six " * 9, 2**63 - 2: "last words"}
    rows = [(k, t, "clash", "clash", 1, "clash") for k, t in texts.items()] + [(None, "no id at all", "x", "x", 1, "x")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
        found = {r["doc_id"]: r for r in minhash.fingerprints(docs).collect()}
        ordered = sorted(texts) + [None]
        for k, key in enumerate(ordered):
            text = texts.get(key, "no id at all") or ""
            follower = texts.get(ordered[(k + 1) % len(ordered)], "no id at all") or ""
            quarter = len(text) // 4
            assert found[key]["edited_sha256"] == sha256((text[: len(text) - quarter] + follower[:quarter]).encode()).hexdigest()
        assert found[-7]["near_next"] == 1.0 and found[2]["near_next"] == 0.0  # without words; then with
        one = minhash.fingerprints(docs.filter("doc_id = 5")).collect()
        assert [(r["doc_id"], r["near_next"]) for r in one] == [(5, 1.0)]
        assert minhash.fingerprints(docs.limit(0)).collect() == []
        # a third of all rows and more under one id
        many = docs.filter("doc_id = 3").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50))))
        many = many.withColumn("text", F.concat("text", F.col("n").cast("string"))).drop("n").unionByName(docs)
        assert minhash.fingerprints(many).count() == 50 + len(rows)
        again = docs.filter("doc_id = 3").unionByName(docs).unionByName(docs.filter("doc_id = 3"))
        assert minhash.fingerprints(again).count() == 2 + len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def exact_classes(texts, percent=80):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    holders = {}
    for k, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(k)
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    pairs = {(a, b) for hs in holders.values() if len(hs) > 1 for a in hs for b in hs if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {k: top(k) for k in texts}


def test_near_copies_find_the_exact_classes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    expected = exact_classes(texts)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs).collect()}
    assert set(found) == set(texts)
    linked = {k for k, c in expected.items() if k != c}
    assert len(linked) > 50
    assert sum(found[k] == expected[k] for k in linked) >= 0.95 * len(linked)
    # no link that is not one
    assert all(expected[found[k]] == expected[k] for k in texts)


def test_near_copies_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(1, base), (2, base.upper()), (3, base + " more"), (4, None), (5, ""), (6, "a b"), (7, "a b"), (8, "b a"), (None, base)]
    docs = spark.createDataFrame([(k, t, "x", "x", 1, "x") for k, t in rows], SCHEMA).repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8}
    assert minhash.near_copies(docs.limit(0)).collect() == []
    twice = docs.unionByName(docs.filter("doc_id = 3").withColumn("text", F.lit("c d"))).unionByName(docs.filter("doc_id = 6"))
    again = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(twice).collect()}
    assert again == found
    rows = minhash.with_classes(docs.select("doc_id", "text"), minhash.near_copies(docs)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {**found, None: None}


def test_near_copies_lose_no_link_to_a_leader_that_is_not_similar(spark):
    # in each group 2 and 3 are similar, and 1, which shares most of their bands, is similar to neither
    rows = []
    for group in range(30):
        core = [f"g{group}w{i}" for i in range(100)]
        rows += [(3 * group + k, " ".join(core + [f"g{group}k{k}e{i}" for i in range(more)])) for k, more in ((1, 24), (2, 8), (3, 8))]
    texts = dict(rows)
    docs = spark.createDataFrame([(k, t, "x", "x", 1, "x") for k, t in rows], SCHEMA).repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs, permutations=6, band=1).collect()}
    expected = exact_classes(texts)
    assert all(expected[3 * g + 3] == 3 * g + 2 and expected[3 * g + 1] == 3 * g + 1 for g in range(30))
    assert found == expected


def test_near_copies_link_by_every_text_of_an_id(spark):
    one, two = (" ".join(f"{name}{i}" for i in range(100)) for name in "xy")
    rows = [(1, one), (2, two), (5, one + " more"), (5, two + " more"), (7, two + " more"), (8, None), (8, one + " end")]
    docs = spark.createDataFrame([(k, t, "x", "x", 1, "x") for k, t in rows], SCHEMA).repartition(3)
    assert {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs).collect()} == dict.fromkeys([1, 2, 5, 7, 8], 1)


def test_a_crowd_of_copies_is_compared_with_its_original_not_with_itself(spark, monkeypatch):
    # copies of one text with three other words each: like the text, but not like each other
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(words))]
    for k in range(1, 121):
        own = list(words)
        for place in rng.choice(150, 3, replace=False):
            own[place] = f"c{k}p{place}"
        rows.append((k, " ".join(own)))
    counted, compared = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda pairs, *rest: counted.append(pairs.count()) or compared(pairs, *rest))
    docs = spark.createDataFrame([(k, t, "x", "x", 1, "x") for k, t in rows], SCHEMA).repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs, permutations=24, band=3).collect()}
    assert found == exact_classes(dict(rows)) == dict.fromkeys(range(121), 0)
    assert sum(counted) < 6 * len(rows)
