"""Collocations against DuckDB and against a plain script."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from sheafline.llm import collocations
from sheafline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, prefix string, phrase string, n long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, *, longest=5, least=100, percent=100, top=2000):
    count = {}
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own = count.setdefault("und" if lang is None else lang, Counter())
            for size in range(1, longest + 1):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in count.items():
        n = sum(v for p, v in own.items() if len(p) == 1)
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(a, inside.get(p[i : i + size], 0))
        found = []
        for p, a in candidates.items():
            if 100 * inside.get(p, -1) >= percent * a and p in inside:
                continue
            score, _, l, r = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_equals_sql_and_script(spark, sf_dir):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("documents.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    got = rows_of(QUERIES["op12_collocations"](spark, sf_dir))
    assert got == sorted(duck.execute(ORACLES["op12_collocations"]).fetchall())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang").collect()
    assert got == plain(docs)
    assert len(got) > 50


@pytest.mark.parametrize(("least", "percent", "top", "longest"), [(3, 100, 2000, 5), (2, 60, 40, 4), (5, 100, 7, 2)])
def test_parameters(spark, sf_dir, monkeypatch, least, percent, top, longest):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    # small blocks and few bits: neither changes the result
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(collocations, "BITS_PER_PHRASE", 1)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = collocations.collocations(docs, longest=longest, least=least, percent=percent, top=top)
    assert rows_of(got) == plain(rows, longest=longest, least=least, percent=percent, top=top)


def test_odd_rows(spark):
    texts = ["a b c. a b c", "a b c", "A B c", None, "", " \t\n", "x\ty x y?x y!", "é ß é ß", "a" * 100_000 + " b", "w1 w2 " * 20_000]
    rows = [(i, t, None if i % 3 == 0 else "und" if i % 3 == 1 else "", "clash", "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(collocations.collocations(docs, least=2)) == plain([(r[1], r[2]) for r in rows], least=2)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs, least=10**6).collect() == []


def test_large_products_stay_exact(spark):
    a, n = 7_000_000_000_000_001, 9_000_000_000_000_003
    found = spark.sql(
        f"select cast({a} as decimal(19,0)) * cast({n} as decimal(19,0)) * 1000 div (cast(3 as decimal(19,0)) * cast(7 as decimal(19,0)) * 1000000000000000) q"
    ).first()["q"]
    assert found == 1000 * a * n // (21 * 10**15)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.text("aB .,\t\n", max_size=30), st.sampled_from([None, "x", "y"])), max_size=12))
def test_any_texts(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    assert rows_of(collocations.collocations(docs, least=2, longest=4)) == plain(rows, least=2, longest=4)
