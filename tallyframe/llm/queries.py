"""The queries of the training-data operators, with SQL statements where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyframe.llm import (
    bpe, chat, cuckoo, fingerprints, html, langid, lines, minhash, mixing, periodic, prefix_trie, suffixes, vptree)

VOCABULARY = "word_bpe_49k.json"
ESCAPE_PROBE = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark, sf_dir):
    rows = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.in_training_order(rows).select("doc_id", "size", "source_size", "target", "taken")


def op2_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=2)


def op4_language(spark, sf_dir):
    return langid.predict_languages(_table(spark, sf_dir, "documents"))


def op5_neighbours(spark, sf_dir):
    return vptree.nearest(_table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark, sf_dir):
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op7_main_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return html.extracted(pages, html.fit(html.sample_texts(pages)))


def op8_chat(spark, sf_dir):
    own = spark.createDataFrame([(-7, 0, "user", ESCAPE_PROBE), (-7, 1, "assistant", ESCAPE_PROBE)],
                                "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.formatted_conversations(turns))


def op9_repeats(spark, sf_dir):
    return suffixes.without_repeats(_table(spark, sf_dir, "documents"), digest=True)


def op10_bpe(spark, sf_dir):
    return bpe.encoded_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_runs(spark, sf_dir):
    return periodic.digests(periodic.periodic_runs(_table(spark, sf_dir, "documents"), periodic.repeated_tail))


def op12_exact(spark, sf_dir):
    return cuckoo.exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations"))


# The resharing is written as its fixed point: sources sorted by the level at which they are full.
OP1_SQL = r"""
with sized as (
  select doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         md5('mix' || coalesce(doc_id::varchar, '')) as order_key
  from documents),
blocked as (
  select *, ('0x' || order_key[1:8])::ubigint % 4096 as block from sized),
per_source as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) - 1 as rank
  from blocked group by source),
weighed as (
  select *, 2.0::double * source_size as cap, case rank % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as weight
  from per_source),
levels as (
  select *, cap / weight as fills_at,
         (1.5::double * sum(source_size) over ()
          - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
         / (sum(weight) over ()
            - coalesce(sum(weight) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0)
           ) as level_here
  from weighed),
level as (select arg_min(level_here, (fills_at, rank)) as level from levels where level_here <= fills_at),
targets as (
  select source, source_size, case when level is null or level >= fills_at then cap else level * weight end as target
  from levels, level),
placed as (
  select b.doc_id, b.size, t.source_size, t.target, round(t.target)::bigint as whole,
         coalesce(sum(b.size) over (partition by b.source order by b.block, b.order_key, b.doc_id, b.size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from blocked b join targets t on b.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target,
       (greatest(0, least(size, whole - start)) + greatest(0, least(size, whole - start - source_size)))::bigint as taken
from placed
"""

OP12_SQL = r"""
with texts as (
  select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as plain
  from documents),
ranked as (
  select *, row_number() over w as place, first_value(doc_id) over w as keep_id, count(*) over (partition by plain) as group_size
  from texts
  window w as (partition by plain order by chars desc, doc_id nulls last
               rows between unbounded preceding and unbounded following))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(plain) as text_sha256 from ranked
"""

# A node is the list of its turns; CRC-32 is written as its bitwise definition over the digits.
OP13_SQL = r"""
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null),
own as (
  select conv_id, list(struct_pack(role := role, text := text) order by place) as told from turns group by conv_id),
crc as (
  select conv_id, 4294967295::bigint as crc, 0 as digit, 0 as bit from own
  union all
  select conv_id,
         case when bit = 0 then xor(crc, ascii(substr(conv_id::varchar, digit + 1, 1))::bigint)
              when crc % 2 = 1 then xor(crc >> 1, 3988292384::bigint) else crc >> 1 end,
         case when bit = 8 then digit + 1 else digit end, (bit + 1) % 9
  from crc where digit < length(conv_id::varchar)),
hashed as (
  select conv_id, xor(crc, 4294967295::bigint) % 6 as h from crc where digit = length(conv_id::varchar)),
rebuilt as (
  select o.conv_id, list_concat(coalesce(f.told[1:h], []), o.told[h + 1:]) as told
  from own o join hashed using (conv_id) left join own f on f.conv_id = o.conv_id - o.conv_id % 100),
steps as (
  select conv_id, told[1:d] as node, d, d = len(told) as ends
  from (select conv_id, told, unnest(range(0, len(told) + 1)) as d from rebuilt)),
nodes as (
  select node, d, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256,
         case when d = 0 then 0 else (count(*) - 1) * length(node[d].text) end as saved
  from steps group by node, d),
children as (select node[1:d - 1] as node, count(*) as n_children from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (node)),
sums as (
  select node[1:a] as node, count(*) filter (where n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from full_nodes) group by 1)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children::bigint as n_children,
       n_leaves, saved_tokens, n.ends_sha256
from full_nodes n join sums using (node) left join nodes p on n.d > 0 and p.node = n.node[1:n.d - 1]
"""

QUERIES = {
    "op1_mix": (op1_mix, OP1_SQL),
    "op2_fingerprints": (op2_fingerprints, None),
    "op3_near_duplicates": (op3_near_duplicates, None),
    "op4_language": (op4_language, None),
    "op5_neighbours": (op5_neighbours, None),
    "op6_line_dedup": (op6_line_dedup, None),
    "op7_main_text": (op7_main_text, None),
    "op8_chat": (op8_chat, None),
    "op9_repeats": (op9_repeats, None),
    "op10_bpe": (op10_bpe, None),
    "op11_runs": (op11_runs, None),
    "op12_exact": (op12_exact, OP12_SQL),
    "op13_trie": (op13_trie, OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
