"""DuckDB SQL for the operators whose results SQL can express on whole tables. Independent of the
operators: plain strings and sets, no hashing scheme, anchors or sketches."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_SPLIT = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Pairs with equal shingles are counted per pair, so every link is found; components follow by
#: recursion over links.
NEAR_DUPLICATES = f"""with recursive d as materialized (select doc_id, {_SPLIT.format(
    text=f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')")} as w from documents),
 s as materialized (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g from
  (select doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) as i from d where len(w) > 0) x),
 n as materialized (select d.doc_id, count(s.g) as n from d left join s on s.doc_id = d.doc_id group by 1),
 p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 l as materialized (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)),
 e as materialized (select a, b from l union all select b, a from l),
 r as (select doc_id as v, doc_id as c from d union select e.b, r.c from r join e on e.a = r.v),
 m as (select v, min(c) as c from r group by v)
 select n.doc_id, n.n as n_shingles, m.c as component_id, m.c = n.doc_id as kept from n join m on m.v = n.doc_id"""

REPEATED_WORDS = f"""with d as materialized (select doc_id, {_SPLIT.format(text="coalesce(text, '')")} as w from documents),
 win as materialized (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from
  (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50) x),
 first as (select h, min(doc_id) as m from win group by h),
 gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from (select win.doc_id, i from win join first using (h) where m < win.doc_id) y),
 word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d),
 kept as (select word.doc_id, string_agg(x, ' ' order by word.p) as t, count(*) as n from word
  anti join gone on gone.doc_id = word.doc_id and gone.p = word.p group by 1)
 select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
 from d left join kept on kept.doc_id = d.doc_id"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '{up}', '{low}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(
    up=ascii_uppercase, low=ascii_lowercase)

#: Every document scored for every item term by term.
RANKED_SEARCH = f"""with d as materialized (select doc_id, row_number() over () as r, {_TERMS} as w from documents),
 c as materialized (select r, doc_id, len(w) as n from d where len(w) > 0),
 g as materialized (select count(*) as nn, cast(sum(n) as bigint) as ll from c),
 tf as materialized (select r, t, count(*) as tf from (select r, unnest(w) as t from d) x group by 1, 2),
 wt as (select t, cast(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) as bigint) as w from (select t, count(*) as df from tf group by 1) x, g),
 q as (select item_id, t, count(*) as k from (select item_id, unnest({_TERMS}) as t from benchmark) x group by 1, 2),
 s as (select item_id, doc_id, r, cast(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll)))) as bigint) as score
  from q join wt using (t) join tf using (t) join c using (r), g group by 1, 2, 3)
 select item_id, cast(rank as integer) as rank, doc_id, score from
  (select *, row_number() over (partition by item_id order by score desc, doc_id, r) as rank from s where score > 0) x where rank <= 10"""

ORACLE = {"op2_near_dedup": NEAR_DUPLICATES, "op3_substring_dedup": REPEATED_WORDS, "op11_lexical": RANKED_SEARCH}
