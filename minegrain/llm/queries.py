"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minegrain.llm.collocations import collocations
from minegrain.llm.common import table
from minegrain.llm.decontaminate import contamination
from minegrain.llm.exact_dedup import exact_duplicates
from minegrain.llm.html_text import main_text
from minegrain.llm.language import identify_languages
from minegrain.llm.line_dedup import judge_lines
from minegrain.llm.mixing import mix_sources
from minegrain.llm.packing import pack_documents
from minegrain.llm.ranked_search import ranked_search
from minegrain.llm.simhash import simhash_components
from minegrain.llm.token_counts import count_tokens
from minegrain.llm.url_rules import judge_urls
from minegrain.llm.warc import page_records, read_warc, write_warc
from minegrain.plans.inputs import uniform_sql
from minegrain.runtime import scratch_path

QUERIES = {}
SQL = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def bpe_encoder() -> tuple[str, str | None, str]:
    import public_tokenizers as files

    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), bpe_encoder())


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op7_exact_dedup"] = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, g.group_size, n.doc_id is not distinct from g.keep_id as kept, sha256(n.t) as text_sha256
from n join g on n.t = g.t
"""


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path))


SQL["op1_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as payload_bytes, sha256(payload) as payload_digest from p),
g as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as keep from d)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when keep is null or page_id is not distinct from keep then 'response' else 'revisit' end as record_type,
  case when keep is not null and page_id is distinct from keep then keep end as refers_to
from g
"""


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    return count_tokens(table(spark, sf_dir, "documents"), files.path("piece_bpe_32k.model"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(table(spark, sf_dir, "documents"))


_WORDS = r"""regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SQL["op9_decontamination"] = f"""
with d as materialized (select doc_id, {_WORDS} as ws from documents),
i as (select item_id, {_WORDS} as ws from benchmark),
starts as (select item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) as p from i where len(ws) > 0),
windows as materialized (
  select distinct item_id, least(len(ws), 13) as n, array_to_string(ws[p : p + 12], ' ') as k from starts),
sizes as (select distinct n from windows),
places as (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as p from d, sizes where len(ws) >= n),
found as materialized (
  select doc_id, p, w.n, item_id from (select doc_id, p, n, array_to_string(ws[p : p + n - 1], ' ') as k from places) x
  join windows w on x.n = w.n and x.k = w.k),
hits as (
  select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from found) group by 1),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by 1)
select d.doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(ws), false) as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL["op11_collocations"] = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_FOLDED}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
totals as (select lang, sum(len(ws))::hugeint as n from w group by 1),
lengths as (select unnest(range(1, 6)) as k),
places as (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, lengths where len(ws) >= k),
f as materialized (
  select lang, k, ws[i : i + k - 1] as words, array_to_string(ws[i : i + k - 1], ' ') as phrase, count(*)::hugeint as f
  from places group by 1, 2, 3, 4 having count(*) >= 100),
cuts as (
  select lang, k, phrase, f as a, c, array_to_string(words[1 : c], ' ') as head, array_to_string(words[c + 1 :], ' ') as tail
  from (select *, unnest(range(1, k)) as c from f where k > 1)),
scored as (
  select x.lang, x.k, x.phrase, x.a, h.f as l, t.f as r, n, c, (1000 * x.a * n) // (h.f * t.f) as score
  from cuts x join f h on h.lang = x.lang and h.phrase = head join f t on t.lang = x.lang and t.phrase = tail
  join totals on totals.lang = x.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
kept as (
  select * from lowest s where not exists (
    select 1 from f o where o.lang = s.lang and o.k > s.k and 100 * o.f >= 100 * s.a
    and contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op12_ranked_search"] = f"""
with d as (select doc_id, {_TERMS} as ts from documents),
s as (select count(*) as n_docs, sum(len(ts)) as n_terms from d where len(ts) > 0),
q as materialized (select distinct item_id, unnest({_TERMS}) as term from benchmark),
tf as materialized (
  select doc_id, any_value(n) as n, term, count(*) as tf from (select doc_id, len(ts) as n, unnest(ts) as term from d)
  where term in (select term from q) group by doc_id, term),
df as (select term, count(*) as df from tf group by 1),
w as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as w from df, s),
scored as (
  select item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms::bigint)))))::bigint as score
  from q join tf using (term) join w using (term), s group by 1, 2)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
from scored where score > 0 qualify rank <= 50
"""


@query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


SQL["op13_source_mix"] = rf"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place from d group by source),
weighted as (select *, 1 + (place - 1) % 3 as w, 3 * source_size as most, sum(source_size) over () as total from s),
filled as (
  select *, coalesce(sum(most) over (order by most / w, place rows between unbounded preceding and 1 preceding), 0) as below,
    sum(w) over (order by most / w, place rows between current row and unbounded following) as above from weighted),
marked as (select *, w * (total - below) >= most * above as is_full from filled),
level as (
  select cast(coalesce(sum(most) filter (is_full), 0) as double) as capped,
    cast(coalesce(sum(w) filter (not is_full), 0) as double) as open_share from marked),
targets as (
  select place, source, source_size,
    case when is_full then cast(most as double) else w * (cast(total as double) - capped) / open_share end as target
  from marked, level),
copies as (
  select doc_id, d.source, place, size, source_size, target,
    least(case when source_size > 0 then target / source_size else 0 end, 3.0) as expected,
    {uniform_sql(13, 'doc_id')} as u
  from d join targets t on t.source is not distinct from d.source),
parts as (select *, floor(expected) as whole, expected - floor(expected) as p from copies),
odds as (select *, (u / (1.0 - u)) * ((1.0 - p) / p) as o from parts where p > 0 and size > 0),
ordered as (
  select *, row_number() over (partition by place order by o / (1.0 + o), cast(doc_id as varchar)) as n from odds),
rooms as (select place, max(target) - sum(whole * size) as room from parts group by place),
walk as (
  select place, cast(0 as bigint) as n, room as rest, false as drawn, null::bigint as doc_id, 0::bigint as size from rooms
  union all
  select w.place, o.n, case when o.size <= w.rest then w.rest - o.size else w.rest end, o.size <= w.rest, o.doc_id, o.size
  from walk w join ordered o on o.place = w.place and o.n = w.n + 1),
left_over as (select place, arg_max(rest, n) as rest from walk group by place),
nearest as (
  select w.place, w.doc_id from walk w join left_over using (place) where w.n > 0 and not drawn and w.size < 2 * left_over.rest
  qualify row_number() over (partition by w.place order by w.size, w.n) = 1),
drawn as (select doc_id from walk where drawn union select doc_id from nearest)
select p.doc_id, lang, p.source, n_chars, size::bigint as size, source_size, target,
  cast((whole + case when p.doc_id in (select doc_id from drawn) then 1 else 0 end) * size as bigint) as taken
from parts p join documents using (doc_id)
"""
