"""Registered queries of the operators, and their DuckDB SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefacts.llm import (
    bit_sliced, exact_dedup, huffman_tokens, language_mixture, line_dedup, mixing, packing, pseudonyms, ranked_search, secrets, signature_tree,
    spelling_variants, toxicity,
)
from sitefacts.plans.scratch import scratch_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of every document as a sequence, with a digest of its ids."""
    pieces = packing.decompose(documents(spark, d), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def kind_counts(spans: str, kinds: Iterable[str]) -> list[Column]:
    """How many spans there are of each kind, as columns ``n_<kind>``."""

    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [of(kind) for kind in kinds]


def op2_secrets(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.scan(documents(spark, d))
    strong = F.filter("spans", lambda s: s["strong"])
    return found.select(
        "doc_id", *kind_counts("spans", secrets.KINDS), F.sha2(secrets.span_list(strong), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans")
    )


def remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op3_language(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = language_mixture.fit(docs.where(remainder(4) != 2))
    found = language_mixture.identify(docs, model)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "languages", "shares")


def op4_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return bit_sliced.top_k(vectors, F.col("vec_id") % 50 == 0)


# Registered queries need a key that gives the same result in each run; a user passes a secret one.
DEMONSTRATION_KEY = "demonstration key"


def op5_pseudonyms(spark: SparkSession, d: str) -> DataFrame:
    found = pseudonyms.pseudonymise(documents(spark, d), DEMONSTRATION_KEY)
    return found.select("doc_id", "text", *kind_counts("found", [kind for kind, _, _ in pseudonyms.KINDS]), "found")


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    labels = spark.read.parquet(f"{d}/labels.parquet").where(remainder(3) != 1)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted", "worst_word", "windows")


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, d))


def domain_labels(labels: DataFrame) -> DataFrame:
    """The domains of the labelled documents: toxic ones, and the others by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


MIXTURE = {"good": 0.80, "poor": 0.15, "toxic": 0.05}


def op8_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = mixing.fit_classifier(docs, domain_labels(spark.read.parquet(f"{d}/labels.parquet")), list(MIXTURE))
    found = mixing.mix(docs.select("doc_id", "text"), model, MIXTURE)
    p = [F.get("posteriors", F.lit(i)).alias(f"p_{domain}") for i, domain in enumerate(model.domains)]
    return found.select("doc_id", "tokens", *p, "rate", "copies")


def op9_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return signature_tree.near_groups(documents(spark, d), words=4, percent=85)


def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = line_dedup.deduplicate(documents(spark, d).select("doc_id", "text"))
    n_dropped = F.size("dropped").cast("bigint").alias("n_dropped")
    return found.select("doc_id", "text", n_dropped, "dropped")


def op11_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search.top_documents(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


def op12_huffman_tokens(spark: SparkSession, d: str) -> DataFrame:
    """The token files written, read again, and a digest of the ids of each document."""
    folder = scratch_folder(spark, "huffman-tokens")
    huffman_tokens.write_tokens(documents(spark, d), folder, BYTE_TOKENIZER)
    found = huffman_tokens.read_tokens(spark, folder)
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling_variants.variant_groups(documents(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_secrets, op3_language, op4_topk, op5_pseudonyms, op6_toxicity, op7_exact_dedup, op8_mixing, op9_ngram_join, op10_line_dedup,
        op11_ranked_search, op12_huffman_tokens, op13_spelling_variants,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op11_ranked_search": r"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as l from documents
), q as (
    select item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) as term from benchmark
), totals as (select count(*) as docs, cast(sum(len(l)) as bigint) as terms from d where len(l) > 0),
t as (select doc_id, len(l) as n, unnest(l) as term from d),
tf as (select doc_id, n, term, count(*) as tf from t where term in (select term from q) group by all),
df as (select term, count(*) as df from tf group by term),
w as (select term, cast(floor(1000 * ln((2 * docs + 2) / cast(2 * df + 1 as double))) as bigint) as w from df, totals),
s as (
    select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) as bigint) as score
    from q join tf using (term) join w using (term), totals group by item_id, doc_id
), r as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10
""",
    "op9_ngram_join": r"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') as l from documents
), g as (
    select doc_id, list_distinct(case when len(l) = 0 then [] when len(l) < 4 then [array_to_string(l, ' ')]
           else list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], ' ')) end) as s from w
), t as (select doc_id, len(s) as n, unnest(s) as s from g),
p as (
    select a.doc_id as a, b.doc_id as b from t a join t b on a.s = b.s and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), e as (select a, b from p union all select b, a from p),
r(doc_id, seen) as (select doc_id, doc_id from documents union select e.b, r.seen from r join e on r.doc_id = e.a)
select g.doc_id, len(g.s) as n_shingles, min(r.seen) as component_id from g join r on g.doc_id = r.doc_id group by g.doc_id, len(g.s)
""",
    "op13_spelling_variants": r"""
with recursive crc as (
    select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end, i) order by i) as t from range(256) x(i)
), runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents) group by all
), hashed as (
    select run, n, xor(4294967295, list_reduce(flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, ''),
           lambda x: case when unicode(x) < 128 then [unicode(x)] else [195, unicode(x) - 64] end)),
           lambda c, b: xor(crc.t[1 + (xor(c, b) & 255)], c >> 8), 4294967295)) as h from runs, crc
), words as (
    select word, cast(sum(n) as bigint) as n from (
        select n, case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
    where length(word) >= 7 group by word having sum(n) >= 2
), places as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
gaps as (select word, n, left(word, i - 1) || '*' || substr(word, i + 1) as gap from places),
shorter as (select distinct word, n, left(word, i - 1) || substr(word, i + 1) as less from places),
near as (
    select a.word, b.word as other, b.n from gaps a join gaps b on a.gap = b.gap and a.word <> b.word
    union all select s.word, w.word, w.n from shorter s join words w on w.word = s.less
    union all select w.word, s.word, s.n from shorter s join words w on w.word = s.less
), best as (
    select word, other, n, count(*) over (partition by word) as n_near from near
    qualify row_number() over (partition by word order by n desc, other) = 1
), found as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.n >= 10 * w.n then b.other end as form, case when b.n >= 10 * w.n then b.n end as form_n
    from words w left join best b on b.word = w.word
), ways(word, root) as (
    select word, word from found union all select ways.word, f.form from ways join found f on f.word = ways.root where f.form is not null
)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n from found f
join (select ways.word, ways.root from ways join found g on g.word = ways.root where g.form is null) r on r.word = f.word
""",
    "op4_topk": """
with v as (
    select vec_id, cast(embedding as double[]) as e from embeddings
    where embedding is not null and len(list_filter(cast(embedding as double[]), lambda x: x is null or not isfinite(x))) = 0
), i as (select vec_id, list_transform(e, lambda x: cast(floor(256 * x) as bigint)) as e from v),
s as (
    select q.vec_id as query_id, c.vec_id,
           cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
    from i q join i c on q.vec_id != c.vec_id where q.vec_id % 50 = 0
), r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""",
    "op7_exact_dedup": r"""
with t as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       row_number() over (partition by norm order by doc_id) = 1 as kept, sha256(norm) as text_sha256
from t window g as (partition by norm)
""",
}
