"""DuckDB SQL for the rows of those queries that SQL can express on whole tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

ORACLE = {
    "op1_ngram_join": f"""
with recursive words as (
  select doc_id, [x for x in string_split_regex({FOLDED}, '[\\x20\\x09-\\x0D]+') if x <> ''] as w
  from documents where doc_id is not null
),
grams as (
  select distinct doc_id, unnest(
    case when len(w) = 0 then []
         when len(w) < 5 then [array_to_string(w, ' ')]
         else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as gram
  from words
),
sizes as (select w.doc_id, count(g.gram) as n from words w left join grams g using (doc_id) group by 1),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2
),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 80 * (x.n + y.n - common)
),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from reach r join edges e on r.b = e.a)
select doc_id, n as n_shingles, component_id
from sizes join (select a, min(b) as component_id from reach group by 1) on a = doc_id
""",
    "op8_exact_dedup": f"""
with folded as (select doc_id, {FOLDED} as norm from documents where doc_id is not null)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from folded window same as (partition by norm)
""",
    "op9_perspectives": """
with turns as (
  select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as said,
         case when turn is null then -1 when turn < 0 then cast(floor(turn / 256.0) as bigint) - 1 else turn // 256 end as part
  from conversations
),
rotated as (
  select t.*, w.perspective, t.speaker = w.perspective as own,
         '<|im_start|>' || case when t.speaker = w.perspective then 'assistant' else 'user name=' || t.speaker end || chr(10) as head,
         t.said || '<|im_end|>' || chr(10) as learnt
  from turns t join (select distinct conv_id, speaker as perspective from turns) w on t.conv_id is not distinct from w.conv_id
),
placed as (
  select *, sum(length(head) + length(learnt)) over (
    partition by conv_id, perspective, part order by turn nulls first, speaker, said rows unbounded preceding) - length(learnt) as start
  from rotated
)
select conv_id, perspective, part, count(*) as n_turns, count(*) filter (own) as n_masked,
       string_agg(head || learnt, '' order by turn nulls first, speaker, said) as text,
       coalesce(string_agg(start || ':' || length(learnt), ',' order by turn nulls first, speaker, said) filter (own), '') as mask
from placed group by conv_id, perspective, part
""",
    "op10_decontamination": f"""
with item_words as (
  select item_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark where item_id is not null
),
windows as (
  select distinct item_id, least(len(w), 10) as n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) as gram
  from item_words where len(w) > 0
),
doc_words as (
  select doc_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents where doc_id is not null
),
lengths as (select distinct n from windows),
places as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from doc_words, lengths where len(w) >= n
),
hits as (
  select doc_id, item_id, i, windows.n from places join windows on windows.n = places.n and windows.gram = array_to_string(w[i:i + places.n - 1], ' ')
),
hit_words as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from hits) group by 1),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
""",
}


def clustering(clusters: int, rounds: int) -> str:
    """k-means in SQL, a few steps a round: assign, then the floor of the mean where a centroid has vectors."""
    steps = [
        """v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings where vec_id is not null and len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""",
        f"""c0 as (select row_number() over (order by h) - 1 as k, e
  from (select sha256('1:' || vec_id) as h, e from v order by h limit {clusters}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} as (select vec_id, e, min(k) as k, min(d) as d from (
  select *, min(d) over (partition by vec_id) as least from (
    select vec_id, v.e, k, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from v, c{i} c))
  where d = least group by vec_id, e)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} as (select k, i, sum(x) as s, count(*) as n from (
  select k, unnest(e) as x, unnest(range(1, 65)) as i from a{i}) group by k, i)"""
            )
            steps.append(
                f"""c{i + 1} as (select c.k, coalesce(m.e, c.e) as e from c{i} c left join (
  select k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as e from s{i} group by k) m on m.k = c.k)"""
            )
    last = rounds
    return f"""with {", ".join(steps)}
select vec_id, cast(a.k as int) as cluster, cast(d as bigint) as distance,
       cast(sum(d) over (partition by a.k) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(c.e, ',')) as centroid_sha256
from a{last} a join c{last} c on c.k = a.k"""


ORACLE["op11_centroid_clustering"] = clustering(16, 3)
