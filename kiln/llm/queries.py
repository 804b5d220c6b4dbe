"""The registered queries ``opN_<name>``: each applies its operator with
production parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (chat, decontam, fingerprints, gru_lm, jaccard_join, langid, mixing, phrases, secrets, spelling, token_store, toxicity,
                      url_rules)
from kiln.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = phrases.count_phrases(table(spark, sf_dir, "documents"), max_words=3, least=10)
    return phrases.collocations(counts, max_words=3, least=10, cover_percent=50, top=2000)


ORACLE_SQL["op11_phrase_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
rows as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from rows),
found as (
  select lang, size, array_to_string(ws[i:i + size - 1], ' ') as phrase
  from places, (values (1), (2), (3)) s(size) where i + size - 1 <= len(ws)),
f as (select lang, size, phrase, count(*) as n from found group by all),
totals as (select lang, sum(n)::bigint as n from f where size = 1 group by lang),
cand as (select lang, size, phrase, n as a, string_split(phrase, ' ') as ws from f where size > 1 and n >= 10),
cuts as (select *, unnest(range(1, size)) as k from cand),
scored as (
  select c.lang, c.phrase, c.size, c.a, c.k, x.n as l, y.n as r,
         (1000000::hugeint * c.a * c.a) // (x.n::hugeint * y.n) as score
  from cuts c
  join f x on x.lang = c.lang and x.size = c.k and x.phrase = array_to_string(c.ws[1:c.k], ' ')
  join f y on y.lang = c.lang and y.size = c.size - c.k and y.phrase = array_to_string(c.ws[c.k + 1:c.size], ' ')),
lowest as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, k) as place from scored) where place = 1),
covers as (
  select lang, phrase, max(n) as n from (
    select lang, array_to_string(ws[1:2], ' ') as phrase, a as n from cand where size = 3
    union all select lang, array_to_string(ws[2:3], ' '), a from cand where size = 3) group by lang, phrase),
kept as (
  select s.* from lowest s left join covers c on c.lang = s.lang and c.phrase = s.phrase and s.size = 2
  where c.n is null or 100 * c.n < 50 * s.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::bigint as score
from ranked r join totals t on t.lang = r.lang where r.rank <= 2000
"""


@query
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = gru_lm.fit(docs.where(~held_out(F.col("doc_id"), 10, 0)))
    return gru_lm.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), typo_every=199, least_length=6, least_count=5)
    return spelling.group_spellings(words, least_ratio=5)


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return langid.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5, 0))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("restored").alias("n_restored"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select(
        "doc_id", "class", F.col("group_id").alias("class_id"), "n_links")


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_join(table(spark, sf_dir, "documents"))


@query
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(*mixing.mix(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


#: Fixed by the contract.
HOST_RULES = [url_rules.HostRule("allow", "org", "/"), url_rules.HostRule("block", "example.org", "/es/"),
              url_rules.HostRule("block", "example.org", "/en/1"), url_rules.HostRule("allow", "com", "/fr/"),
              url_rules.HostRule("block", "com", "/de/")]
#: For pages that no host rule fits: links of tracked campaigns.
PATTERN_RULES = [url_rules.PatternRule("block", "*?*utm_source=*")]


@query
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), [*HOST_RULES, *PATTERN_RULES])


ORACLE_SQL["op6_url_rules"] = r"""
with parts as (
  select page_id, coalesce(lower(url), '') as low,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
rules(name, host, path, action) as (values
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
fits as (
  select p.*, r.name, r.action,
         row_number() over (partition by p.page_id order by length(r.name) desc nulls last) as place
  from parts p left join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, name as rule,
       coalesce(action, case when (host <> '' or path <> '') and regexp_matches(low, '(?s)^.*\?.*utm_source=')
                             then 'block' else 'allow' end) as verdict
from fits where place = 1
"""


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_preferences(chat.preference_turns(table(spark, sf_dir, "conversations"))).withColumnRenamed("pair_id", "conv_id")


ORACLE_SQL["op2_preference_format"] = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i,
         count(*) over (partition by conv_id) as n
  from conversations where conv_id is not null),
last as (select conv_id, role, text from c where i = n),
rejected as (
  select conv_id, i, role, text from c where i < n
  union all
  select c.conv_id, c.i, o.role, o.text from c join last o on o.conv_id = xor(c.conv_id, 1) where c.i = c.n),
common as (
  select c.conv_id, coalesce(min(case when r.i is null or c.role <> r.role or c.text <> r.text then c.i end) - 1, max(c.n)) as k
  from c left join rejected r on r.conv_id = c.conv_id and r.i = c.i group by c.conv_id),
turns as (
  select 'chosen' as side, conv_id, i, role, text from c
  union all select 'rejected', conv_id, i, role, text from rejected),
shown as (
  select t.*, m.k, '<|im_start|>' || role || chr(10) as head, text || '<|im_end|>' || chr(10) as body
  from turns t join common m using (conv_id)),
placed as (
  select *, coalesce(sum(case when i > k then length(head) + length(body) end)
              over (partition by side, conv_id order by i rows between unbounded preceding and 1 preceding), 0) as pos
  from shown)
select conv_id, max(k)::bigint as n_prompt_turns,
       coalesce(string_agg(head || body, '' order by i) filter (where side = 'chosen' and i <= k), '') as prompt,
       coalesce(string_agg(head || body, '' order by i) filter (where side = 'chosen' and i > k), '') as chosen,
       coalesce(string_agg(head || body, '' order by i) filter (where side = 'rejected' and i > k), '') as rejected,
       coalesce(string_agg((pos + length(head))::bigint || ':' || (pos + length(head) + length(body))::bigint, ',' order by i)
                filter (where side = 'chosen' and i > k and role = 'assistant'), '') as chosen_mask,
       coalesce(string_agg((pos + length(head))::bigint || ':' || (pos + length(head) + length(body))::bigint, ',' order by i)
                filter (where side = 'rejected' and i > k and role = 'assistant'), '') as rejected_mask
from placed group by conv_id
"""
