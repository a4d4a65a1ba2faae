"""The queries of these operators: thin digests over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline.llm import bpe, collocations, counts, jaccard, langid, lm, minhash, mixing, quality, spelling, substrings, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Ranks of the merges, and the same vocabulary as a tokenizer.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 1024


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(remainder: int, modulus: int) -> Column:
    """By a checksum of the id; a row without an id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode("text", ranks=RANKS, pattern=public_tokenizers.PATTERN)
    encoded = documents.select("doc_id", ids.alias("ids"))
    decoded = encoded.select("doc_id", "ids", bpe.decode("ids", ranks=RANKS).alias("decoded"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    names = [name for name in quality.VERDICT.names if name != "clean_text"]
    return documents.select("doc_id", quality.line_first("text").alias("found")).select(
        "doc_id", *(F.col(f"found.{name}").alias(name) for name in names)
    )


#: Share of all tokens that the mixture takes, epochs of a source at most, and weights of nodes.
MIX_SHARE = 0.9
MIX_EPOCHS = 2
MIX_WEIGHTS = {("common",): 1.0, ("curated",): 2.0, ("curated", "en"): 2.0, ("curated", "de"): 3.0}


@_query
def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    domain = F.when(F.col("source") == "src0", "common").otherwise("curated")
    tokens = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    levels = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    mixed = mixing.mix(
        documents.withColumn("n_words", tokens.cast("long")).drop("text"),
        levels=levels, tokens=F.col("n_words"), share=MIX_SHARE, weights=MIX_WEIGHTS, epochs=MIX_EPOCHS, seed=7,
    )
    return mixed.select("doc_id", domain.alias("domain"), "lang", "source", F.col("mix_epoch").alias("epoch"), "n_words")


@_query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_documents(documents, held_out=_held_out(0, 10))


@_query
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    vectors = embeddings.filter(usable).select("vec_id", scaled.alias("vector"))
    queries = vectors.filter(F.col("vec_id") % 50 == 0)
    found = topk.exact_top_k(vectors, queries, k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: Rules on hosts and paths.
RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)
#: Names whose hosts, with all hosts below them, are listed.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


@_query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urls.host_and_path("url")[0].alias("key")).distinct()
    listed = hosts.filter(F.arrays_overlap(F.split("key", r"\."), F.array(*map(F.lit, LISTED_NAMES))))
    filters = urls.cascade(listed, hosts)
    return urls.url_verdicts(pages, rules=RULES, filters=filters)


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(documents, n=3, percent=90)


ORACLES["op7_jaccard_join"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
  ) w from documents
), shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(
      case when len(w) = 0 then [] when len(w) < 3 then [md5(array_to_string(w, ' '))]
      else list_transform(range(1, len(w) - 1), lambda p: md5(array_to_string(w[p : p + 2], ' '))) end
    ) s from words
  )
), sizes as (
  select doc_id, count(*) n from shingles group by doc_id
), shared as (
  select x.doc_id a, y.doc_id b, count(*) common from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id
  group by all
), links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * common >= 90 * (p.n + q.n - common)
), both_ways as (
  select a, b from links union all select b, a from links
), reached as (
  select doc_id, doc_id node from documents
  union
  select r.doc_id, e.b from reached r join both_ways e on r.node = e.a
)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, min(node) component_id
from documents d left join sizes using (doc_id) join reached r on r.doc_id = d.doc_id group by all
"""


@_query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(documents.filter(~_held_out(2, 4)))
    found = documents.select("doc_id", _held_out(2, 4).alias("held_out"), langid.predict("text", model).alias("found"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.lang_pred").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = counts.token_counts(
        "text", vocabulary=VOCABULARY, pattern=public_tokenizers.PATTERN, budget=TOKEN_LIMIT
    )
    found = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), counted.alias("found"))
    return found.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.col("found.n_tokens").alias("n_tokens"),
        (F.col("found.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("found.prefix_chars").alias("prefix_chars"),
    )


@_query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.remove_repeated(documents)
    words = F.trim(F.regexp_replace("kept_text", r"[\x20\x09-\x0D]+", " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


ORACLES["op10_substring_dedup"] = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 11)) p, w from words
), keyed as (
  select doc_id, p, md5(array_to_string(w[p : p + 12], ' ')) k from windows
), firsts as (
  select k, min(doc_id) first from keyed group by k
), removed as (
  select distinct doc_id, unnest(range(p, p + 13)) p from keyed join firsts using (k) where doc_id > first
), gone as (
  select doc_id, list(p) ps from removed group by doc_id
)
select doc_id, len(w)::bigint n_words, coalesce(len(ps), 0)::bigint n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: not list_contains(coalesce(ps, []), i)), ' ')) kept_sha256
from words left join gone using (doc_id)
"""


#: One of as many distinct runs of a document is misspelt, and words below the count are left out.
NOISE = 31
LEAST_COUNT = 2


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.run_counts(documents, least=7, noise=NOISE)
    return spelling.variant_groups(words.filter(F.col("n") >= LEAST_COUNT), ratio=10)


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(documents, longest=5, least=100, percent=100, top=2000)


ORACLES["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
  )) piece from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces
), grams as (
  select lang, size, array_to_string(w[p : p + size - 1], ' ') phrase
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) p from words, range(1, 6) sizes(size))
), f as (
  select lang, phrase, size, count(*) a from grams group by all
), totals as (
  select lang, sum(a)::bigint n from f where size = 1 group by lang
), candidates as (
  select lang, phrase, size, a, string_split(phrase, ' ') w from f where size > 1 and a >= 100
), kept as (
  select * from candidates c where not exists (
    select 1 from candidates o where o.lang = c.lang and o.size > c.size and 100 * o.a >= 100 * c.a
    and contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
  )
), cuts as (
  select lang, phrase, w, a, unnest(range(1, len(w))) k from kept
), scored as (
  select c.lang, c.phrase, c.a, k, x.a l, y.a r, n, ((1000::hugeint * c.a * n) // (x.a::hugeint * y.a))::bigint score
  from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1 :], ' ') join totals t on t.lang = c.lang
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
)
select lang, rank, phrase, a, l, r, n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from lowest
) where rank <= 2000
"""


@_query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.with_classes(minhash.fingerprints(documents), minhash.near_copies(documents))
