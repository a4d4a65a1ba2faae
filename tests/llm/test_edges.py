"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheafline.llm import bpe, counts, jaccard, langid, lm, mixing, quality, substrings, topk, urls
from sheafline.llm.queries import QUERIES, RANKS, VOCABULARY
from sheafline.llm.staging import Tables

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk long, spans string, id string"
LONG = "lorem ipsum " * 30_000
RUN = "x1y2z3" * 3_000


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), 7, "extra", "clash")


ROWS = [
    _row(1, "The cat sat on the mat, and then it slept there for a long while in the sun."),
    _row(2, "The cat sat on the mat, and then it slept there for a long while in the sun."),
    _row(2, "The cat sat on the mat, and then it slept there for a long while in the sun."),
    _row(3, None),
    _row(4, ""),
    _row(5, " \n\t "),
    _row(None, "A text without an id, of some words."),
    _row(None, None, None, None),
    _row(6, LONG),
    _row(7, RUN, None, "s"),
    _row(8, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.", "de", None),
    _row(9, "12 34 !!", "de", "t"),
    _row(10, "a b", "de", "t"),
    _row(11, "<|endoftext|> 'tis​ it's 日本", "de", "t"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_round_trip(edges, nothing):
    def run(rows):
        ids = rows.select("text", bpe.encode("text", ranks=RANKS, pattern=public_tokenizers.PATTERN).alias("ids"))
        return ids.withColumn("raw", bpe.decode("ids", ranks=RANKS)).collect()

    assert run(nothing) == []
    found = run(edges)
    assert len(found) == len(ROWS)
    assert all(bytes(r["raw"]).decode() == (r["text"] or "") for r in found)
    assert all(r["ids"] == [] for r in found if not r["text"])


def test_token_counts(edges, nothing):
    def run(rows):
        found = counts.token_counts("text", vocabulary=VOCABULARY, pattern=public_tokenizers.PATTERN, budget=3)
        return rows.select("text", found.alias("c")).collect()

    assert run(nothing) == []
    for row in run(edges):
        assert (row["c"]["n_tokens"] == 0) == (not row["text"])
        assert 0 <= row["c"]["prefix_chars"] <= len(row["text"] or "")


def test_quality(edges, nothing):
    assert nothing.select(quality.line_first("text")).collect() == []
    found = {r["doc_id"]: r["v"] for r in edges.select("doc_id", quality.line_first("text").alias("v")).collect()}
    assert found[3]["n_words"] == found[4]["n_words"] == found[5]["n_words"] == 0
    assert found[3]["base_failed"] and not found[3]["kept"]
    assert found[6]["n_words"] == 60_000 and found[6]["n_repeat_words"] == 60_000
    assert found[5]["clean_text"] == " \n\t "


def test_mixture(edges, nothing):
    def run(rows, share=1.0, epochs=1):
        levels = {"lang": F.col("lang"), "source": F.col("source")}
        tokens = F.length("text")
        return mixing.mix(rows, levels=levels, tokens=tokens, share=share, epochs=epochs)

    assert run(nothing).collect() == []
    whole = run(edges)
    assert whole.columns == [*edges.columns, "mix_epoch"]
    assert whole.count() == len(ROWS)
    assert run(edges, share=0.0).agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0] == 0


def test_scores(edges, nothing):
    held = F.col("doc_id") == 1
    assert lm.score_documents(nothing, held_out=held).collect() == []
    found = lm.score_documents(edges, held_out=held).collect()
    assert len(found) == len(ROWS)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (3, 4, 5)} == {1}
    assert sum(r["held_out"] for r in found) == 1
    unlearned = lm.score_documents(edges, held_out=F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 for r in unlearned)


def test_top_k(spark):
    schema = "vec_id long, vector array<long>, label int, id int, pack int"
    rows = [(1, [1, 2], 0, 0, 0), (2, [1, 2], 0, 0, 0), (3, None, 0, 0, 0), (4, [None, 1], 0, 0, 0),
            (None, [1, 1], 0, 0, 0), (5, [3], 0, 0, 0), (6, [], 0, 0, 0), (7, [1, 2], 0, 0, 0)]
    vectors = spark.createDataFrame(rows, schema)
    found = sorted(map(tuple, topk.exact_top_k(vectors, vectors.filter("vec_id in (1, 3, 5, 6)"), k=2).collect()))
    assert found == [(1, 1, 2, 5), (1, 2, 7, 5)]
    empty = spark.createDataFrame([], schema)
    assert topk.exact_top_k(empty, empty, k=2).collect() == []
    assert topk.exact_top_k(vectors, empty, k=2).collect() == []


def test_urls(spark):
    schema = "page_id long, url string, host string, path int, key string"
    rows = [(1, None, "", 0, ""), (2, "no scheme", "", 0, ""), (3, "http://BAD.example.org/x?y", "", 0, ""),
            (3, "http://bad.example.org#z", "", 0, ""), (4, "http://a.net/fr", "", 0, ""), (5, "http://a.net", "", 0, "")]
    pages = spark.createDataFrame(rows, schema)
    hosts = pages.select(urls.host_and_path("url")[0].alias("key"))
    listed = spark.createDataFrame([("bad.example.org",), (None,), ("elsewhere",)], "key string")
    rules = [urls.Rule("allow", "net")]
    filters = urls.cascade(listed, hosts)
    found = {tuple(r) for r in urls.url_verdicts(pages, rules=rules, filters=filters).collect()}
    assert found == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "bad.example.org", "/x", None, "block"),
        (3, "bad.example.org", "", None, "block"), (4, "a.net", "/fr", "net/", "allow"), (5, "a.net", "", None, "allow"),
    }
    none = urls.cascade(listed.filter("false"), hosts.filter("false"))
    assert none.shares == [[]]
    assert {r["verdict"] for r in urls.url_verdicts(pages, rules=[], filters=none).collect()} == {"allow"}


@pytest.mark.parametrize("most", [10_000, 300])
def test_lists_and_universes_of_any_size_are_exact(spark, most):
    """A list beyond the bound of a row is dealt to several cascades."""
    universe = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 23 == 0).alias("listed"))
    filters = urls.cascade(universe.filter("listed"), universe, most_keys=most)
    assert (len(filters.shares) > 1) == (most == 300)
    assert universe.filter(filters.lists(F.col("key")) != F.col("listed")).count() == 0
    assert universe.filter(filters.lists(F.lit(None).cast("string"))).count() == 0
    small = urls.cascade(universe.filter("listed").limit(3), universe, most_keys=100)
    assert len(small.shares) > 1  # by the number of other keys


def test_rules_of_equal_length_go_by_name(spark):
    pages = spark.createDataFrame([(1, "http://x.b.c/d/")], "page_id long, url string")
    rules = [urls.Rule("allow", "c", "/d/"), urls.Rule("block", "b.c", "/"), urls.Rule("block", "c", "/d")]
    nothing = urls.cascade(spark.createDataFrame([], "key string"), spark.createDataFrame([], "key string"))
    found = urls.url_verdicts(pages, rules=rules, filters=nothing).first()
    assert (found["rule"], found["verdict"]) == ("b.c/", "block")


def test_near_duplicates(edges, nothing):
    assert jaccard.near_duplicates(nothing).collect() == []
    rows = jaccard.near_duplicates(edges).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == len(ROWS)
    assert found[1][1] == found[2][1] == 1
    assert found[3] == (0, 3) and found[4] == (0, 4) and found[10] == (1, 10)


def test_language(edges, nothing):
    untaught = langid.fit(nothing)
    assert {r[0]["lang_pred"] for r in edges.select(langid.predict("text", untaught)).collect()} == {"und"}
    model = langid.fit(edges)
    assert nothing.select(langid.predict("text", model)).collect() == []
    found = {r["doc_id"]: r["p"] for r in edges.select("doc_id", langid.predict("text", model).alias("p")).collect()}
    assert found[1]["lang_pred"] == "en" and found[8]["lang_pred"] == "de"
    assert found[3]["lang_pred"] == found[9]["lang_pred"] == "und" and found[9]["rejected"]
    assert all(0 <= p["score"] <= 1 for p in found.values())


def test_language_of_texts_longer_than_any_learned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 10000")
    model = langid.fit(docs)
    joined = docs.groupBy("lang").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("text"))
    cut = joined.select("lang", F.explode(F.array(*(F.substring("text", 1, n) for n in (50_000, 150_000, 300_000)))).alias("text"))
    found = cut.select("lang", langid.predict("text", model).alias("p")).collect()
    assert len(found) == 12
    assert [(r["lang"], r["p"]["score"]) for r in found if r["p"]["rejected"] or r["p"]["lang_pred"] != r["lang"]] == []
    # a long text in no language known is still far
    noise = spark.range(1).select(F.repeat(F.lit("qxz vvk 9 wqj zzx kkq jxw "), 10_000).alias("text"))
    assert noise.select(langid.predict("text", model).alias("p")).first()["p"]["rejected"]


def test_every_language_is_learned_whatever_their_number(spark):
    # 15 common languages would fill the sample of 2500 alone; the rare ones have 3 rows each
    text = F.concat(F.lit("word "), F.col("id").cast("string"))
    common = spark.range(15 * 400).select("id", F.concat(F.lit("c"), (F.col("id") % 15).cast("string")).alias("lang"), text.alias("text"))
    rare = spark.range(60).select("id", F.concat(F.lit("r"), (F.col("id") % 20).cast("string")).alias("lang"), text.alias("text"))
    copies = spark.range(900).select(F.lit(None).cast("long").alias("id"), F.lit("copied").alias("lang"), F.lit("one text").alias("text"))
    rows = common.unionByName(rare).unionByName(copies)
    chosen = langid.learning_sample(
        rows, text="text", lang="lang", key=F.col("id"), per_language=langid.PER_LANGUAGE, sample=langid.SAMPLE
    )
    found = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    assert len(found) == 36 and found["copied"] == 1
    assert all(n == 3 for lang, n in found.items() if lang.startswith("r"))
    assert all(20 <= n <= 140 for lang, n in found.items() if lang.startswith("c") and lang != "copied")


def test_substrings(edges, nothing):
    assert substrings.remove_repeated(nothing).collect() == []
    rows = substrings.remove_repeated(edges).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["n_removed"] == 0 and found[2]["n_removed"] == found[2]["n_words"] == 18
    assert [tuple(s) for s in found[2]["spans"]] == [(0, 18, 1)]
    assert found[3]["kept_text"] == "" and found[5]["kept_text"] == " \n\t " and found[6]["kept_text"] == LONG


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, edges, nothing, number):
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, nothing, "").collect() == []
    kept = stage(spark, edges, "")
    if number < 4:
        assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert set(ids) <= {r[0] for r in ROWS}
    if number != 3:  # the mixture may leave any document out
        assert 1 in ids and 8 in ids


def test_stages_are_registered_last():
    assert set(QUERIES) == {
        "op1_bpe", "op2_line_quality", "op3_mixture", "op4_lm_score", "op5_exact_top_k", "op6_url_filters",
        "op7_jaccard_join", "op8_language", "op9_token_counts", "op10_substring_dedup", "op11_spelling_variants", "op12_collocations",
        "op13_fingerprints",
    }


def test_near_duplicates_keep_different_texts_of_one_id(spark):
    text = "a b c d e f g"
    rows = [(1, text, "en"), (1, text, "en"), (1, "other text of one id", "en"), (2, text, "en"),
            (None, text, "en"), (None, None, None), (5, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, goes string").repartition(3)
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    expected = [rows[0], *rows[2:3], *rows[4:]]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_tables_go_when_their_block_ends(spark):
    with Tables(spark) as tables:
        assert tables.stored(spark.range(3)).count() == 3
        folder = spark._jvm.org.apache.hadoop.fs.Path(tables.folder)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        assert files.exists(folder)
    assert not files.exists(folder)
