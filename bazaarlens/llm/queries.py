"""The queries of this package over the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, html_template, line_windows, lm_scoring, merkle, personal, quality, simhash, suffix_dedup, wavelet, whitening
from .common import table


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_file_report(table(spark, sf_dir, "documents"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), outputs=False)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    own = spark.sql(f"select -7L as conv_id, t.* from values (0L, 'user', '{control}'), (1L, 'assistant', '{control}') t(turn, role, text)")
    return chat.conversation_report(turns.unionByName(own))


# The template's own marks have no part in the digests but for the count of formatted characters: each turn
# adds its role, 12 + 1 + 10 + 1 characters of marks, and one for each backslash and control string in its text.
CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(role) + 24 + length(text) + len(regexp_extract_all(text, '\\'))
                + len(regexp_extract_all(text, '<\|')) + len(regexp_extract_all(text, '\|>'))
                + len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?SYS>>'))) as bigint) as formatted_chars
from turns group by conv_id
"""


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal_data(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.line_report(table(spark, sf_dir, "documents"))


LINE_DEDUP_SQL = r"""
with lines as (
  select doc_id, coalesce(text, '') as text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
full_lines as (
  select doc_id, text, line, i, row_number() over (partition by doc_id, text order by i) as nth
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
windows as (
  select doc_id, text, nth, concat_ws(chr(10), line, line2, line3) as w from (
    select doc_id, text, nth, line, lead(line, 1) over d as line2, lead(line, 2) over d as line3
    from full_lines window d as (partition by doc_id, text order by nth))
  where line3 is not null),
later as (
  select doc_id, text, nth from (
    select *, row_number() over (partition by w order by doc_id nulls last, nth) as n from windows) where n > 1),
gone as (
  select distinct f.doc_id, f.text, f.i from full_lines f
  join later l on l.doc_id = f.doc_id and l.text = f.text and f.nth between l.nth and l.nth + 2),
kept as (
  select l.doc_id, l.text, string_agg(l.line, chr(10) order by l.i) as rest from lines l
  left join gone g on g.doc_id = l.doc_id and g.text = l.text and g.i = l.i
  where g.i is null group by all),
counts as (
  select doc_id, text, count(*) as n_lines from full_lines group by all),
removed as (select doc_id, text, count(*) as n_removed from gone group by all)
select d.doc_id, case when d.text is null then null else coalesce(k.rest, '') end as text,
       cast(coalesce(c.n_lines, 0) as bigint) as n_lines, cast(coalesce(r.n_removed, 0) as bigint) as n_removed
from documents d
left join kept k on k.doc_id = d.doc_id and k.text = d.text
left join counts c on c.doc_id = d.doc_id and c.text = d.text
left join removed r on r.doc_id = d.doc_id and r.text = d.text
"""


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex(simhash.FINGERPRINT)), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark")).drop("text")
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return decontaminate.measures(found).select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


DECONTAMINATION_SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az
    from documents)),
item_words as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from (
    select item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az
    from benchmark)),
patterns as (
  select distinct item_id, least(len(w), 13) as size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as p
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as i from item_words where len(w) > 0)),
sizes as (select distinct size from patterns),
doc_windows as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as p
  from (select doc_id, size, w, unnest(generate_series(1, len(w) - size + 1)) as i
        from doc_words, sizes where len(w) >= size)),
found as (select d.doc_id, d.i, d.size, p.item_id from doc_windows d join patterns p using (size, p)),
hit as (
  select doc_id, count(distinct nth) as n_hit from (
    select doc_id, unnest(generate_series(i, i + size - 1)) as nth from (select distinct doc_id, i, size from found))
  group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct doc_id, item_id from found) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(i.n_items, 0) as bigint) as n_items, sha256(coalesce(i.names, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from doc_words d left join hit h using (doc_id) left join items i using (doc_id)
"""


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


# CRC-32 bit by bit; each tree grows one level a step, and each leaf folds one level a step.
MERKLE_SQL = r"""
with recursive
crcs as (
  select doc_id, xor(list_reduce(list_concat([4294967295::bigint],
           list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
         lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda t, z: case when t % 2 = 1 then xor(t // 2, 3988292384::bigint) else t // 2 end)), 4294967295::bigint) as crc
  from (select distinct doc_id from documents where doc_id is not null)),
fields as (
  select d.doc_id, lang, coalesce(crc % 7 = 0, false) as tampered, n_chars,
         coalesce(strlen(cast(d.doc_id as varchar)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen("text") || ':' || "text", '-') as tail
  from documents d left join crcs c on c.doc_id = d.doc_id),
hashed as (
  select doc_id, lang, sha256(head || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || tail) as leaf,
         sha256(head || coalesce(strlen(cast(n_chars + tampered::int as varchar)) || ':' || (n_chars + tampered::int), '-') || tail) as shown
  from fields),
leaves as (
  select *, row_number() over () as rid, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by lang) as n from hashed),
up as (
  select lang, 0 as level, idx, n, leaf as h from leaves
  union all
  select lang, level + 1, idx // 2, (n + 1) // 2, sha256(h || coalesce(nxt, '')) from (
    select *, lead(h) over (partition by lang, level order by idx) as nxt from up where n > 1) where idx % 2 = 0),
roots as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as idx, count(*) over () as n from up where n = 1),
top as (
  select 0 as level, idx, n, subroot as h from roots
  union all
  select level + 1, idx // 2, (n + 1) // 2, sha256(h || coalesce(nxt, '')) from (
    select *, lead(h) over (partition by level order by idx) as nxt from top where n > 1) where idx % 2 = 0),
low as (
  select rid, lang, 0 as level, idx, n, shown as acc, '' as proof from leaves
  union all
  select l.rid, l.lang, l.level + 1, l.idx // 2, (l.n + 1) // 2,
         sha256(case when l.idx % 2 = 1 then s.h || l.acc else l.acc || coalesce(s.h, '') end), l.proof || coalesce(s.h, '')
  from low l left join up s on s.lang is not distinct from l.lang and s.level = l.level and s.idx = xor(l.idx, 1::bigint)
  where l.n > 1),
high as (
  select l.rid, 0 as level, r.idx, r.n, l.acc, l.proof from low l join roots r on r.lang is not distinct from l.lang where l.n = 1
  union all
  select l.rid, l.level + 1, l.idx // 2, (l.n + 1) // 2,
         sha256(case when l.idx % 2 = 1 then s.h || l.acc else l.acc || coalesce(s.h, '') end), l.proof || coalesce(s.h, '')
  from high l left join top s on s.level = l.level and s.idx = xor(l.idx, 1::bigint) where l.n > 1)
select l.doc_id, l.leaf, r.subroot, t.h as root, sha256(f.proof) as proof_sha256, f.acc as folded_root, f.acc = t.h as verified
from leaves l join roots r on r.lang is not distinct from l.lang join high f on f.rid = l.rid and f.n = 1
join top t on t.n = 1
"""


QUERIES = {
    "op1_token_files": (token_files, None),
    "op2_bpe_round_trip": (bpe_round_trip, None),
    "op3_html_extraction": (html_extraction, None),
    "op4_chat_formatting": (chat_formatting, CHAT_SQL),
    "op5_personal_data": (personal_data, None),
    "op6_line_dedup": (line_dedup, LINE_DEDUP_SQL),
    "op7_simhash_near_dedup": (simhash_near_dedup, None),
    "op8_benchmark_decontamination": (benchmark_decontamination, DECONTAMINATION_SQL),
    "op9_lm_scoring": (lm_scores, None),
    "op10_quality_rules": (quality_rules, None),
    "op11_suffix_array_dedup": (suffix_array_dedup, None),
    "op12_embedding_whitening": (embedding_whitening, None),
    "op13_merkle_manifest": (merkle_manifest, MERKLE_SQL),
}
