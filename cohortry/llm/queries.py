"""One registered query for each operator: production parameters, the whole table, the full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import collocations, decontamination, html_text, jaccard_join, langid, nearest, packing, periodic_runs, pseudo_likelihood, quality, token_counts, token_records, toxicity
from cohortry.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), limit=1024)


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), window=2048, end_id=1)


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return decontamination.digest(found)


ORACLE["op10_decontamination"] = r"""
with words as (
  select kind, id, n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select 'd' as kind, doc_id as id, row_number() over () as n, text from documents
        union all select 'i', item_id, 0, text from benchmark where item_id is not null)),
items as (
  select distinct id as item_id, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as phrase, least(len(w), 10) as size
  from (select id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from words where kind = 'i' and len(w) > 0)),
places as (
  select n, i, size, array_to_string(w[i:i + size - 1], ' ') as phrase
  from (select n, w, size, unnest(range(1, len(w) - size + 2)) as i from words, (select distinct size from items) where kind = 'd' and len(w) >= size)),
found as (select distinct n, i, p.size, item_id from places p join items using (phrase, size)),
hit as (select n, count(distinct k) as n_hit from (select n, unnest(range(i, i + size)) as k from found) group by n),
listed as (select n, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
           from (select distinct n, item_id from found) group by n)
select id as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (n) left join listed using (n) where kind = 'd'
"""


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"), threshold=0.8, size=5, tolerance=1e-6)


ORACLE["op3_jaccard_join"] = r"""
with recursive words as (
  select doc_id, row_number() over () as n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
nodes as (select md5(array_to_string(w, ' ')) as node, any_value(w) as w, min(doc_id) as id, count(*) as copies from words where len(w) > 0 group by 1),
grams as (select distinct node, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as gram
          from (select node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from nodes)),
sizes as (select node, count(*) as size from grams group by node),
links as (select a, b from (select x.node as a, y.node as b, count(*) as shared from grams x join grams y using (gram) where x.node <> y.node group by 1, 2)
          join sizes s on s.node = a join sizes t on t.node = b where shared * 5 >= (s.size + t.size - shared) * 4),
reach as (select id as label, node from nodes union select label, b from reach join links on a = node),
classes as (select node, min(label) as class_id from reach group by node),
counts as (select a as node, sum(copies) as links from links join nodes on nodes.node = b group by a)
select doc_id, coalesce(class_id, doc_id) as class_id, cast(coalesce(links, 0) + coalesce(copies, 1) - 1 as bigint) as n_links, coalesce(copies, 1) as n_copies
from words left join nodes on nodes.node = md5(array_to_string(words.w, ' ')) and len(words.w) > 0
left join classes using (node) left join counts using (node)
"""


def remainder(divisor: int) -> Column:
    """crc32 of the document's id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def held_out(divisor: int, value: int) -> Column:
    return F.coalesce(remainder(divisor) == value, F.lit(False)).alias("held_out")


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.where(remainder(4) != 2))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score", "languages", "proportions")


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs.where(remainder(5) != 0), table(spark, folder, "labels"), "quality")
    return quality.score(docs, model, threshold=0.3).select("doc_id", held_out(5, 0), "score", "predicted")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs.where(remainder(4) != 2), table(spark, folder, "labels"), "toxic")
    return toxicity.score(docs, model, threshold=0.3).select("doc_id", held_out(4, 2), "score", "predicted", "votes")


@query
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query
def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op6_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


@query
def op13_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    token_records.write(table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER), path, end_id=1)
    return token_records.digest(token_records.read(spark, path))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = periodic_runs.with_planted_tail(docs["doc_id"], docs["text"])
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, least_periods=4, least_words=6, text=changed))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    phrases = collocations.frequent_phrases(table(spark, folder, "documents"), least=30, longest=4)
    return collocations.collocations(phrases, top=2000, cover=80)


ORACLE["op11_collocations"] = r"""
with pieces as (
  select lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w
  from (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents)),
grams as (select lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as phrase
          from pieces, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k),
counts as (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 30),
totals as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k > 1),
cuts as (select c.lang, c.phrase, c.a, c.j, x.f as l, y.f as r, cast(c.a as hugeint) * 2000000 // (x.f + y.f) as score
         from (select *, unnest(range(1, k)) as j from candidates) c
         join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.j], ' ')
         join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.j + 1:c.k], ' ')),
scored as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inner_ as (select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(a) as longer
           from (select *, unnest(range(1, k - s + 2)) as i from candidates, (select unnest([2, 3]) as s) where s < k) group by all),
kept as (select s.* from scored s left join inner_ i using (lang, phrase) where i.longer is null or 100 * i.longer < 80 * s.a)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join totals using (lang) where rank <= 2000
"""
