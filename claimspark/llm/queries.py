"""The registered queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimspark.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    fingerprint,
    language_id,
    lexical_search,
    line_dedup,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filter,
)
from claimspark.llm.common import read_table
from claimspark.llm.registry import query


#: Every window of a text by its digest, and which windows occur at more than one place. {read} gives (doc_id, size), {window}
#: the window of ``wide`` symbols from place i, from 0, on.
_REPEATS = """
  windows as (select doc_id, i, md5({window}) as k from texts, unnest(range(0, greatest(size - {wide} + 1, 0))) as t(i)),
  gone as (select distinct doc_id, unnest(range(i, i + {wide})) as p from windows where k in (select k from windows group by k having count(*) > 1)),
  places as (select doc_id, p, g.p is not null as removed from (select doc_id, unnest(range(0, size)) as p from texts) left join gone g using (doc_id, p))"""

#: The letters beyond ASCII in the test texts, and as many control characters. Edit distance counts bytes in SQL; with one byte
#: for each letter it counts characters.
_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßáâäçèéêíîñóöúüàôùû"
_BYTES = "||".join(f"chr({c})" for c in (*range(1, 9), 11, 12, *range(14, 32), 127))

OP1_SQL = f"""
  with lines as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
  firsts as (select line, length(line) as n, min((doc_id, pos)) as place, translate(line, '{_LETTERS}', {_BYTES}) as flat
    from lines where not regexp_full_match(line, '[ \\x09-\\x0D]*') group by line),
  near as (select distinct b.line from (select *, unnest(range(n - 2, n + 3)) as m from firsts) a join firsts b on a.m = b.n and a.place < b.place
    and levenshtein(a.flat, b.flat) <= least(2, greatest(a.n, b.n) // 5)),
  kept as (select doc_id, pos, line from lines l where regexp_full_match(line, '[ \\x09-\\x0D]*')
    or ((doc_id, pos) = (select place from firsts f where f.line = l.line) and line not in (select line from near))),
  sums as (select doc_id, count(*) as n, string_agg(line, chr(10) order by pos) as body from kept group by doc_id)
  select d.doc_id, coalesce(len(string_split(text, chr(10))), 0) as n_lines, coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) as n_removed,
    sha256(coalesce(body, '')) as kept_sha256
  from documents d left join sums using (doc_id)"""

OP3_SQL = f"""
  with texts as (select doc_id, hex(encode(coalesce(text, ''))) as body, octet_length(encode(coalesce(text, ''))) as size from documents),
  {_REPEATS.format(window="substr(body, 2 * i + 1, 400)", wide=200)},
  sums as (select doc_id, count(*) filter (where removed) as n_removed, count(*) filter (where removed and not before) as n_spans,
      string_agg(substr(body, 2 * p + 1, 2), '' order by p) filter (where not removed) as kept
    from (select *, coalesce(lag(removed) over (partition by doc_id order by p), false) as before from places) join texts using (doc_id) group by doc_id)
  select doc_id, size as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
  from texts left join sums using (doc_id)"""

OP10_SQL = f"""
  with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as body from documents),
  texts as (select doc_id, body, len(body) as size from words),
  {_REPEATS.format(window="array_to_string(body[i + 1:i + 35], ' ')", wide=35)},
  sums as (select doc_id, count(*) filter (where removed) as n_removed, string_agg(body[p + 1], ' ' order by p) filter (where not removed) as kept
    from places join texts using (doc_id) group by doc_id)
  select doc_id, size as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from texts left join sums using (doc_id)"""


OP11_SQL = """
  with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as body from documents),
  lengths as (select doc_id, len(body)::bigint as n from words where len(body) > 0),
  sums as (select count(*)::bigint as docs, sum(n)::bigint as total from lengths),
  found as (select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(body) as term from words) group by doc_id, term),
  weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from found, sums group by term, docs),
  items as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
  scored as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
    from items join found using (term) join weights using (term) join lengths using (doc_id), sums group by item_id, doc_id),
  ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0)
  select item_id, rank, doc_id, score from ranked where rank <= 10"""

#: crc32 of a number's digits, bit by bit: a byte is taken in, then eight times a bit goes out.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch)::bigint] || repeat([-1::bigint], 8)))),
  lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295)"""

OP13_SQL = f"""
  with own as (select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) as turns from conversations
      where conv_id is not null group by conv_id),
  heads as (select o.*, b.turns as first, ({_CRC32.format(text="o.conv_id::varchar")} % 9)::bigint as h from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 5),
  built as (select conv_id, coalesce(first, [])[1:h] || turns[h + 1:] as turns from heads),
  grown as (select conv_id, d, turns[1:d] as node, len(turns) = d as ends from built, unnest(range(0, len(turns) + 1)) as x(d)),
  nodes as (select node, d, min(conv_id) as conv_id, count(*) as n, coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '') as ids
    from grown group by node, d),
  kids as (select node[1:d - 1] as node, count(*) as n_children from nodes where d > 0 group by 1),
  full_nodes as (select n.*, coalesce(n_children, 0) as n_children, case when d = 0 then 0 else (n - 1) * octet_length(encode(node[d].t)) end as saved
    from nodes n left join kids using (node)),
  sums as (select up, sum(saved) as saved, count(*) filter (where n_children = 0) as leaves
    from (select node[1:a] as up, saved, n_children from full_nodes, unnest(range(0, d + 1)) as x(a)) group by up)
  select f.conv_id, f.d as depth, p.conv_id as parent_conv_id, f.n as n_convs, f.n_children, s.leaves as n_leaves, s.saved::bigint as saved_tokens, sha256(f.ids) as ends_sha256
  from full_nodes f join sums s on s.up = f.node left join nodes p on f.d > 0 and p.node = f.node[1:f.d - 1] and p.d = f.d - 1"""


def word_vocabulary() -> bytes:
    return bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.kept_lines_digest(read_table(spark, folder, "documents"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op3_suffix_array_dedup", OP3_SQL)
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_bytes_digest(read_table(spark, folder, "documents"))


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read_table(spark, folder, "pages"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read_table(spark, folder, "documents"))


@query("op6_bpe_encoding")
def op6_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, folder, "documents"), word_vocabulary())


@query("op7_document_fingerprints")
def op7_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_pairs(read_table(spark, folder, "documents"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, folder, "documents"), word_vocabulary())


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_words_digest(read_table(spark, folder, "documents"))


@query("op11_ranked_search", OP11_SQL)
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op12_sharding")
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digest(read_table(spark, folder, "documents"))


@query("op13_conversation_trie", OP13_SQL)
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(read_table(spark, folder, "conversations"))
