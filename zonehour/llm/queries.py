"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table and derives the contract's columns from what the operator returns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.llm.best_fit_packing import best_fit_packing
from zonehour.llm.chat_format import END, TURN, format_conversations, load_tokenizer, read_back
from zonehour.llm.common import id_remainder, joined_small, read_table, stored
from zonehour.llm.decontaminate import MatchSpec, match_benchmark
from zonehour.llm.exact_shuffle import exact_shuffle
from zonehour.llm.language_id import fit_language_model, predict_languages
from zonehour.llm.near_clusters import near_clusters
from zonehour.llm.ngram_quality import MEASURES, judge_quality
from zonehour.llm.ppm_scoring import score_documents
from zonehour.llm.simhash_dedup import simhash_components
from zonehour.llm.source_divergence import DivergenceSpec, audit_sources
from zonehour.llm.source_mixing import MixSpec, measured, mix_sources
from zonehour.llm.token_codes import encode_documents
from zonehour.llm.url_reputation import ReputationSpec, Rule, filter_urls
from zonehour.llm.vector_codes import MOST, CodeSpec, compress_vectors

# path of the tokenizer file (a parameter; the file is not part of this repository)
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ESCAPE_CASE = "\\### Assistant: </turn> ok"
SHARDS = 24
URL_RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", ESCAPE_CASE), (-7, 1, "assistant", ESCAPE_CASE)], "conv_id bigint, turn bigint, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_conversations(turns, load_tokenizer(TOKENIZER)))


def op2_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", *MEASURES, "base_failed", "kept", "log_ppl", "word_log_ppl")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return best_fit_packing(docs, clusters=near_clusters(docs.select("text")))


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by page: a label's id is read as a page's; toxic or of low
    quality is bad."""
    return read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(read_table(spark, sf_dir, "pages"), page_labels(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", (F.round(F.col("bound") * 1e6) / 1e6).alias("bound"))


def op5_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", (id_remainder(F.col("doc_id"), 5) != 1).alias("train"))
    return score_documents(docs).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = match_benchmark(docs, read_table(spark, sf_dir, "benchmark"))
    return matched.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near"),
        F.sha2(F.concat_ws(",", "near_ids").cast("binary"), 256).alias("near_sha256"),
    )


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op8_exact_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return exact_shuffle(docs, SHARDS).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", id_remainder(F.col("doc_id"), 3) == 1)
    model = fit_language_model(docs.where(~F.col("held_out")).select("text", "lang"))
    return predict_languages(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op10_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), load_tokenizer(TOKENIZER))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = measured(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = compress_vectors(read_table(spark, sf_dir, "embeddings"), "embedding", "vec_id")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    by_label = stored(coded.groupBy("label").agg(total.alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(str(c) for part in codebooks for c in part.ravel()).encode()).hexdigest()
    return joined_small(coded, by_label, "label", "vec_id").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


OP1_SQL = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, t, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)
), parts as (
  select *, replace(replace(text, '\', '\\'), '<|', '<\|') as body,
    replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') as head from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(head) + length(body) + {len(TURN) + len(END) + 2}) as bigint) as formatted_chars
from parts group by conv_id
"""


def level_sql(name: str, groups: str, spec: ReputationSpec) -> str:
    """CTEs of one level: ``name``_s has its strength, ``name`` its means."""
    lo, hi = spec.rho_range
    return f"""
{name}_s as (
  select case when sum(n * prior * (1 - prior) * (n - 1)) > 0
    then greatest({lo}, least({hi}, sum(power(bad - n * prior, 2) - n * prior * (1 - prior)) / sum(n * prior * (1 - prior) * (n - 1))))
    else {hi} end as rho from {groups} where n > 0
), {name} as (
  select g.*, (1 - rho) / rho as s, (bad + (1 - rho) / rho * prior) / (n + (1 - rho) / rho) as mean from {groups} g, {name}_s
)"""


def rules_sql(pick: str) -> str:
    rules = sorted(URL_RULES, key=lambda r: -len(r.name))
    return "case " + " ".join(f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{getattr(r, pick)}'" for r in rules) + " end"


def op4_sql(spec: ReputationSpec = ReputationSpec()) -> str:
    suffixes = ", ".join(f"'{s}'" for s in spec.suffixes)
    return rf"""
with tails as (
  select page_id, coalesce(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end, '') as tail from pages
), parts as (
  select page_id, translate(regexp_extract(tail, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path from tails
), outcomes as (
  select doc_id as page_id, count(*) as n, sum(cast(toxic = 1 or quality = 0 as bigint)) as bad from labels
  where doc_id is not null and (toxic = 1 or quality = 0) is not null group by doc_id
), counted as (
  select host, coalesce(sum(n), 0) as n, coalesce(sum(bad), 0) as bad,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as name
  from parts left join outcomes using (page_id) group by host
), hosts as (
  select host, n, bad, string_split(name, '.') as l,
    case when array_to_string(l[-2:], '.') in ({suffixes}) then 2 else 1 end as k,
    array_to_string(l[-k:], '.') as suffix, array_to_string(l[-k - 1:], '.') as domain from counted
), suffix_groups as (
  select suffix, sum(n) as n, sum(bad) as bad, (select (sum(bad) + 1.0) / (sum(n) + 2.0) from hosts) as prior from hosts group by suffix
), {level_sql("suffixes", "suffix_groups", spec)}, domain_groups as (
  select suffix, domain, sum(h.n) as n, sum(h.bad) as bad, any_value(x.mean) as prior from hosts h join suffixes x using (suffix) group by suffix, domain
), {level_sql("domains", "domain_groups", spec)}, host_groups as (
  select host, h.n, h.bad, d.mean as prior from hosts h join domains d using (suffix, domain)
), {level_sql("judged", "host_groups", spec)}, bounds as (
  select host, mean - {spec.z} * sqrt(mean * (1 - mean) / (n + s + 1)) as bound from judged
)
select page_id, host, path, {rules_sql("name")} as rule,
  coalesce({rules_sql("verdict")}, case when bound > {spec.max_bad} then 'block' else 'allow' end) as verdict, round(bound * 1e6) / 1e6 as bound
from parts left join bounds using (host)
"""


def op6_sql(spec: MatchSpec = MatchSpec()) -> str:
    return rf"""
with doc_words as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from benchmark
), item_windows as (
  select distinct item_id, least(len(w), {spec.window}) as n, array_to_string(w[s:s + least(len(w), {spec.window}) - 1], ' ') as phrase
  from (select *, unnest(range(1, greatest(len(w) - {spec.window}, 0) + 2)) as s from item_words where len(w) > 0)
), doc_windows as (
  select r, n, s, array_to_string(w[s:s + n - 1], ' ') as phrase
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s from doc_words, (select distinct n from item_windows))
), found as (
  select r, item_id, s, n from doc_windows join item_windows using (n, phrase)
), hits as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from found) group by r
), items as (
  select r, count(*) as n_items, string_agg(i, ',' order by i) as ids from (select distinct r, cast(item_id as varchar) as i from found where item_id is not null) group by r
), item_terms as (
  select i, item_id, len(w) + 2 * {spec.slop} as stretch, greatest(1, ceil({spec.near_share}::double * len(list_distinct(w)))) as need, unnest(list_distinct(w)) as word
  from (select row_number() over () as i, * from item_words where len(w) > 0)
), postings as (
  select r, p, word from (select r, unnest(w) as word, generate_subscripts(w, 1) as p from doc_words) semi join item_terms using (word)
), shared as (
  select r, i from (select distinct r, word from postings) join item_terms using (word) group by r, i, need having count(*) >= need
), met as (
  select r, i, p, word, item_id, stretch, need from postings join item_terms using (word) join shared using (r, i)
), near as (
  -- a stretch with enough words can begin at one of them
  select distinct a.r, cast(a.item_id as varchar) as id from met a join met b on a.r = b.r and a.i = b.i and b.p between a.p and a.p + a.stretch - 1
  where a.item_id is not null group by a.r, a.i, a.p, a.item_id, a.need having count(distinct b.word) >= a.need
), near_items as (
  select r, count(*) as n_near, string_agg(id, ',' order by id) as near_ids from near group by r
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated,
  coalesce(n_near, 0) as n_near, sha256(coalesce(near_ids, '')) as near_sha256
from doc_words left join hits using (r) left join items using (r) left join near_items using (r)
"""


def op11_sql(spec: MixSpec = MixSpec()) -> str:
    weight = " ".join(f"when {k} then {float(w)}::double" for k, w in enumerate(spec.weights))
    return rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as hash
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size, {spec.most}::double * cast(sum(size) as double) as most,
    case (row_number() over (order by source nulls last) - 1) % {len(spec.weights)} {weight} end as weight
  from sized group by source
), stops as (
  -- sources stop in the order of most / weight; level after the first k of them have
  select *, {spec.share} * cast(sum(source_size) over () as double) as total, row_number() over by_stop as k,
    coalesce(sum(most) over (by_stop rows between unbounded preceding and 1 preceding), 0) as held,
    sum(weight) over (by_stop rows between current row and unbounded following) as open
  from sources window by_stop as (order by most / weight, source nulls last)
), level as (
  select coalesce((select arg_min((total - held) / open, k) from stops where most >= weight * ((total - held) / open)), 'infinity'::double) as level
), targets as (
  select source, source_size, least(most, weight * level) as target from sources, level
), budgets as (
  select *, case when source_size > 0 then least({spec.most}, floor(target / source_size)) else 0 end as whole from targets
), placed as (
  select doc_id, size, source_size, target, whole, target - whole * source_size as rest,
    coalesce(sum(size) over (partition by s.source order by hash rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join budgets b on s.source is not distinct from b.source
)
select doc_id, size, source_size, target,
  cast(size * (whole + case when size > 0 and before + size / 2.0 <= rest then 1 else 0 end) as bigint) as taken
from placed
"""


def op12_sql(spec: DivergenceSpec = DivergenceSpec()) -> str:
    def share(count: str, total: str) -> str:
        return f"(1 + (1000000000 * ({count} + {spec.smooth})::hugeint) // ({total} + {spec.smooth} * terms))"

    return rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents
), found as (
  select lang, source, term, count(*) as n, count(distinct r) as docs from (select r, lang, source, unnest(words) as term from docs) group by all
), kept as (
  select lang, term, sum(n)::bigint as in_lang from found group by lang, term having sum(docs) >= {spec.min_docs}
), langs as (
  select lang, count(term) as terms, coalesce(sum(in_lang), 0)::bigint as lang_total from (select distinct lang from docs) left join kept using (lang) group by lang
), totals as (
  select g.lang, g.source, terms, lang_total, coalesce((select sum(n) from found f join kept k using (lang, term) where f.lang = g.lang and f.source = g.source), 0)::bigint as total
  from (select distinct lang, source from docs) g join langs using (lang)
), grid as (
  select t.lang, t.source, k.term, coalesce(f.n, 0) as n, {share('coalesce(f.n, 0)', 'total')} as p, {share('in_lang', 'lang_total')} as q
  from totals t join kept k using (lang) left join found f on f.lang = t.lang and f.source = t.source and f.term = k.term
), apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
  from totals a join totals b on a.lang = b.lang and a.source <> b.source left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source
), ranked as (
  select lang, source, 'pair' as part, item, value from pairs
  union all select lang, source, 'term', term, (p - q)::bigint from grid where n > 0 and p > q
)
select * from (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from ranked
) where part = 'pair' or rank <= {spec.top}
"""


def op13_sql(spec: CodeSpec = CodeSpec()) -> str:
    def assign(k: int) -> str:
        return f"""apart{k} as (
  select r, v.part, entry, cast(sum((x - c) * (x - c)) as bigint) as d from cells v join entries{k} e on v.part = e.part and v.place = e.place group by all
), codes{k} as (
  select r, part, arg_min(entry, (d, entry)) as entry, min(d) as d from apart{k} group by r, part
)"""

    def move(k: int) -> str:
        return f"""entries{k + 1} as (
  select part, entry, place, coalesce(cast(floor(total / n) as bigint), c) as c from entries{k}
  left join (select part, entry, place, sum(x) as total, count(*) as n from codes{k} join cells using (r, part) group by all) using (part, entry, place)
)"""

    steps = ",\n".join(f"{assign(k)}, {move(k)}" for k in range(spec.rounds))
    last = spec.rounds
    return f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), cells as materialized (
  select r, (k - 1) // (n // {spec.parts}) as part, (k - 1) % (n // {spec.parts}) as place, cast(floor({spec.scale}::double * embedding[k]) as bigint) as x
  from (select r, embedding, len(embedding) as n, unnest(range(1, len(embedding) + 1)) as k from kept)
), entries0 as (
  select part, r - 1 as entry, place, x as c from cells where r <= {spec.entries}
), {steps}, {assign(last)}, rows as (
  select r, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from codes{last} group by r
), labels as (
  select label, cast(sum(error) as bigint) as label_error from rows join kept using (r) group by label
)
select vec_id, code, error, label_error, (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, place)) from entries{last}) as codebooks_sha256
from rows join kept using (r) join labels on labels.label is not distinct from kept.label
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_ngram_quality": op2_ngram_quality,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_url_reputation": op4_url_reputation,
    "op5_ppm_scoring": op5_ppm_scoring,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_exact_shuffle": op8_exact_shuffle,
    "op9_language_id": op9_language_id,
    "op10_token_codes": op10_token_codes,
    "op11_source_mixing": op11_source_mixing,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op4_url_reputation": op4_sql(),
    "op6_decontaminate": op6_sql(),
    "op11_source_mixing": op11_sql(),
    "op12_source_divergence": op12_sql(),
    "op13_vector_codes": op13_sql(),
}
