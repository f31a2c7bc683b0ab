"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from credere.llm.bpe import bpe_report
from credere.llm.chat import rotate
from credere.llm.common import documents
from credere.llm.decontam import leak_report
from credere.llm.divergence import audit
from credere.llm.exact_dedup import exact_report
from credere.llm.jaccard_join import jaccard_report
from credere.llm.language_id import identify_pages
from credere.llm.line_dedup import line_report
from credere.llm.lm_score import score_documents
from credere.llm.prefix_trie import trie
from credere.llm.quality import quality_report
from credere.llm.secrets import secret_report
from credere.llm.substring_dedup import substring_report


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more hold: (doc_id, n_lines, n_dropped, kept_sha256).

    A null or empty text is one empty line; repeated and null ids are documents of their own; a very
    long text is cut like any other; an empty table gives an empty result; further columns are ignored.
    """
    return line_report(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and what they decode to: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    A null text is empty and has no tokens; repeated rows are each encoded; a very long text is
    encoded whole; an empty table gives an empty result; further columns are ignored.
    """
    return bpe_report(documents(spark, sf_dir), tokenizer_path())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word passages that a smaller id holds: (doc_id, n_words, n_removed, kept_sha256).

    A null, empty or short text keeps all its words; rows of equal ids remove nothing from each other, and a null
    id counts as larger than all others; a very long text is read whole; an empty table gives an empty result;
    further columns are ignored.
    """
    return substring_report(documents(spark, sf_dir))


def op4_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue as each of its speakers sees it, in parts: (conv_id, speaker, part, n_turns, start, text, mask).

    Nulls count as empty texts, unknown roles and last turns; a row without a conv_id is a dialogue of its own; equal
    turn numbers go by role and text; rows repeated with their turn number are one turn; dialogues of any length come
    in parts; an empty table gives an empty result; further columns are ignored.
    """
    return rotate(documents(spark, sf_dir, "conversations"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language from text, markup, address and host: (page_id, host, declared, path, lang, posterior, text_lang, rejected).

    Null pages or addresses are no evidence and a page without letters is rejected; repeated rows are judged alike;
    ties go to the first language by name; very long pages are read whole; without labelled documents all pages are
    rejected; an empty table gives an empty result; further columns are ignored.
    """
    return identify_pages(documents(spark, sf_dir, "pages"), documents(spark, sf_dir))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the smallest id it reaches by links of 0.85: (doc_id, n_shingles, component_id).

    A null or empty text has an empty set and links with nothing; copies share a component; a null id counts as
    larger than all others; very long texts are read whole; an empty table gives an empty result; further columns are ignored.
    """
    return jaccard_report(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text by pattern and by entropy: (doc_id, n_assign, n_access, n_hex, base_sha256, spans).

    A null or empty text has none; rows are scanned one by one, repeated ones alike; very long texts are read whole;
    an empty table gives an empty result; further columns are ignored.
    """
    return secret_report(documents(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's probability under whole words and under the piece lattice: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    A null or empty text is its end token alone; a null id hashes as the empty text; repeated rows each count and score
    alike; very long texts are read whole; an empty table gives an empty result; further columns are ignored.
    """
    return score_documents(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays: (doc_id, keep_id, group_size, kept, text_sha256), a row a document.

    A null text is empty, and empty texts are equal; of repeated rows one stays; a null id counts as larger than all
    others; very long texts are compared whole; an empty table gives an empty result; further columns are ignored.
    """
    return exact_report(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside passages of test items: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    A null text or item has no words and meets nothing; repeated items and documents each count; an item shorter than a
    window is one window; very long texts are read whole; empty tables give no hits or no rows; further columns are ignored.
    """
    return leak_report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source's terms differ from the other sources and from its language: (lang, source, part, item, value, rank).

    Nulls count as empty texts and labels; an empty text has no terms, but its source occurs; ties go to the
    smaller item by UTF-8 bytes; repeated rows each count; very long texts are read whole; an empty table gives an
    empty result; further columns are ignored.
    """
    return audit(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared opening of the rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Null roles and texts are empty, null turns come first, ties go by role and text, repeated rows are turns; rows without a
    conversation id are left out; conversations of any length are read whole; an empty table gives an empty result;
    further columns are ignored.
    """
    return trie(documents(spark, sf_dir, "conversations")).drop("enter", "exit")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting rules and the perplexity band of every document: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lang, perplexity, low, high).

    A null or empty text has no words and fails; a null language is the empty label; repeated rows are judged alike
    and each train; the bounds of a band pass; very long texts are read whole; an empty table gives an empty result;
    further columns are ignored.
    """
    return quality_report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bpe": op2_bpe,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_chat_perspectives": op4_chat_perspectives,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secret_scan": op7_secret_scan,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}

WHITE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": f"""
with line as (
  select doc_id, generate_subscripts(parts, 1) as i, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
keyed as (select doc_id, i, line, translate(trim(line, {WHITE}), {UPPER}, {LOWER}) as key from line),
common as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10),
marked as (select k.doc_id, k.i, k.line, c.key is not null as gone from keyed k left join common c on k.key = c.key)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op3_substring_dedup": r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as s from (select *, unnest(generate_series(1, len(w) - 12)) as i from doc where len(w) >= 13)),
least as (select s, min(doc_id) as first_id from win group by s),
gone as (select distinct doc_id, p from (select win.doc_id, unnest(generate_series(i, i + 12)) as p from win join least using (s) where first_id < win.doc_id)),
word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from doc),
kept as (select word.doc_id, count(gone.p) as n_removed, string_agg(x, ' ' order by word.p) filter (where gone.p is null) as t
         from word left join gone on word.doc_id = gone.doc_id and word.p = gone.p group by word.doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc left join kept on doc.doc_id = kept.doc_id""",
    "op4_chat_perspectives": """
with every as (select conv_id, turn, case when coalesce(role, '') = '' then 'unknown' else role end as role, coalesce(text, '') as text from conversations),
said as (select distinct * from every where conv_id is not null and turn is not null union all select * from every where conv_id is not null and turn is null),
speaker as (select distinct conv_id, role as speaker from said where role <> 'system'),
seg as (select s.conv_id, p.speaker, s.turn // 64 as block, s.turn, s.role, s.text, s.role = p.speaker as own,
               '<|im_start|>' || case when s.role = 'system' then 'system' when s.role = p.speaker then 'assistant' else 'user name=' || s.role end || chr(10) as head,
               s.text || '<|im_end|>' || chr(10) as body
        from said s join speaker p using (conv_id)),
placed as (select *, coalesce(sum(length(head) + length(body)) over (partition by conv_id, speaker order by turn, role, text rows between unbounded preceding and 1 preceding), 0) as a from seg),
part as (select conv_id, speaker, block, count(*) as n_turns, cast(min(a) as bigint) as start, string_agg(head || body, '' order by turn, role, text) as text,
                coalesce(string_agg((a + length(head)) || ':' || (a + length(head) + length(body) - 1), ',' order by a) filter (where own), '') as mask
         from placed group by all)
select conv_id, speaker, row_number() over (partition by conv_id, speaker order by block) - 1 as part, n_turns, start, text, mask from part
union all
select conv_id, role, 0, 1, 0, '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10), '22:' || (32 + length(text))
from every where conv_id is null and role <> 'system'""",
    "op9_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, sha256(n.t) as text_sha256 from n join g on n.t = g.t""",
    "op10_decontamination": rf"""
with doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (select item_id, regexp_extract_all(translate(text, {UPPER}, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
sized as (select item_id, w, least(10, len(w)) as n from item where len(w) > 0),
win as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s from (select *, unnest(generate_series(1, len(w) - n + 1)) as i from sized)),
lens as (select distinct n from win),
cand as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as s
         from (select d.doc_id, d.w, l.n, unnest(generate_series(1, len(d.w) - l.n + 1)) as i from doc d, lens l where len(d.w) >= l.n)),
hit as (select c.doc_id, c.i, c.n, w.item_id from cand c join win w on c.n = w.n and c.s = w.s),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from (select distinct doc_id, i, n from hit)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as list from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(words.n_hit, 0) as n_hit, coalesce(items.n_items, 0) as n_items,
       sha256(coalesce(items.list, '')) as items_sha256, coalesce(words.n_hit, 0) > 0 as contaminated
from doc d left join words on d.doc_id = words.doc_id left join items on d.doc_id = items.doc_id""",
    "op11_source_divergence": rf"""
with doc as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                    regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
tok as (select r, lang, source, unnest(w) as t from doc),
kept as (select lang, t from tok group by lang, t having count(distinct r) >= 30),
v as (select lang, count(*) as v from kept group by lang),
grp as (select distinct lang, source from doc),
cnt as (select lang, source, t, count(*) as n from tok join kept using (lang, t) group by all),
tot as (select lang, source, sum(n) as total from cnt group by all),
p as (select g.lang, g.source, k.t, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (coalesce(tot.total, 0) + 5 * v.v) as p
      from grp g join kept k on k.lang = g.lang join v on v.lang = g.lang left join tot on tot.lang = g.lang and tot.source = g.source
      left join cnt c on c.lang = g.lang and c.source = g.source and c.t = k.t),
q as (select c.lang, c.t, 1 + (1000000000::hugeint * (c.n + 5)) // (s.total + 5 * v.v) as q
      from (select lang, t, sum(n) as n from cnt group by all) c join (select lang, sum(n) as total from cnt group by lang) s using (lang) join v using (lang)),
sums as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by all),
pair as (select a.lang, a.source, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
         from grp a join grp b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (select p.lang, p.source, p.t as item, cast(p.p - q.q as bigint) as value from p join q on p.lang = q.lang and p.t = q.t where p.n > 0 and p.p > q.q)
select lang, source, 'pair' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from pair
union all
select * from (select lang, source, 'term' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from term) where rank <= 50""",
    "op12_prefix_trie": r"""
with tab as (select list(v order by i) as t from (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
             from (select cast(range as bigint) as i from range(256)))),
own as (select conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as s
        from conversations where conv_id is not null group by conv_id),
cut as (select conv_id, s, cast(xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 as integer) as h from own, tab),
conv as (select o.conv_id, list_concat(coalesce(b.s, [])[1:h], o.s[h + 1:]) as s from cut o left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
pre as (select conv_id, d, s[1:d] as k, d = len(s) as ends from (select conv_id, s, unnest(generate_series(0, len(s))) as d from conv)),
node as (select d as depth, k, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '')) as ends_sha256,
                case when d = 0 then 0 else (count(*) - 1) * len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) end as saved
         from pre group by d, k),
kids as (select depth - 1 as depth, k[1:depth - 1] as k, count(*) as n_children from node where depth > 0 group by all),
up as (select a as depth, k[1:a] as k, sum(saved) as saved_tokens, sum(leaf) as n_leaves
       from (select n.depth, n.k, n.saved, case when c.n_children is null then 1 else 0 end as leaf, unnest(generate_series(0, n.depth)) as a
             from node n left join kids c on n.depth = c.depth and n.k = c.k) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, cast(u.n_leaves as bigint) as n_leaves,
       cast(u.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from node n join up u on n.depth = u.depth and n.k = u.k left join kids c on n.depth = c.depth and n.k = c.k
left join node p on p.depth = n.depth - 1 and p.k = n.k[1:n.depth - 1]""",
}
