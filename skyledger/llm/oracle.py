"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in ``tests/llm``.

Tokenizers, learned scores, eigenvectors, packing and approximate search are beyond SQL. What SQL says here it says plainly:
every window, every pair, every part against every entry.
"""

from __future__ import annotations

#: Every window of 13 words against the least document it starts in.
SUPERKMERS = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
wins as (select doc_id, i, array_to_string(ws[i:i+12], ' ') as words from (select doc_id, ws, unnest(range(1, len(ws)-11)) as i from docs) z),
least as (select words, min(doc_id) as first_doc from wins group by words),
gone as (select distinct doc_id, unnest(range(i, i+13)) as i from wins join least using (words) where first_doc < doc_id),
words as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from docs),
kept as (select w.doc_id, string_agg(w.word, ' ' order by w.i) filter (where g.i is null) as text, count(g.i) as n_removed
 from words w left join gone g on w.doc_id=g.doc_id and w.i=g.i group by w.doc_id)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join kept k using (doc_id)"""

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x)))=0"

#: Every pair of vectors, and components by reachability.
NEAR_VECTORS = f"""
with recursive vecs as (select vec_id, embedding::double[] as v from embeddings where {_FINITE} and len(list_filter(embedding, lambda x: x<>0))>0),
links as (select a.vec_id as a, b.vec_id as b from vecs a, vecs b where a.vec_id<>b.vec_id and list_cosine_similarity(a.v, b.v)>=0.95),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b=l.a)
select e.vec_id, (select count(*) from links where a=e.vec_id)::bigint as n_links,
 least(e.vec_id, (select min(b) from reach where a=e.vec_id))::bigint as component_id,
 (e.vec_id=least(e.vec_id, (select min(b) from reach where a=e.vec_id))) as kept from embeddings e"""


def _lloyd(rounds: int = 4, entries: int = 256) -> str:
    """Every part against every entry, as many rounds as the contract has."""
    far = "list_sum(list_transform(list_zip(m.v, b.v), lambda z: (z[1]-z[2])*(z[1]-z[2])))"

    def assigned(book: str) -> str:
        return f"""select vec_id, p, any_value(v) as v, arg_min(e, far*{entries}+e) as e, min(far) as far
 from (select m.vec_id, m.p, m.v, b.e, {far}::hugeint as far from parts m join {book} b using (p)) z group by vec_id, p"""

    steps = [
        f"kept as (select vec_id, label, list_transform(embedding, lambda x: floor(1024*x::double)::bigint) as x, row_number() over (order by vec_id) as r from embeddings where {_FINITE})",
        "parts as (select vec_id, r, p, x[p*len(x)//4+1:(p+1)*len(x)//4] as v from kept, range(4) t(p))",
        f"book0 as (select p, r-1 as e, v from parts where r<={entries})",
    ]
    for n in range(rounds):
        steps += [
            f"near{n} as ({assigned(f'book{n}')})",
            f"sums{n} as (select p, e, i, sum(c)::hugeint as s, count(*) as n from (select p, e, unnest(v) as c, generate_subscripts(v, 1) as i from near{n}) z group by p, e, i)",
            f"mean{n} as (select p, e, list(((s-((s%n)+n)%n)//n)::bigint order by i) as v from sums{n} group by p, e)",
            f"book{n + 1} as (select b.p, b.e, coalesce(m.v, b.v) as v from book{n} b left join mean{n} m on b.p=m.p and b.e=m.e)",
        ]
    last = f"book{rounds}"
    return f"""with {', '.join(steps)}, final as ({assigned(last)}),
codes as (select vec_id, string_agg(printf('%02x', e), '' order by p) as code, sum(far)::bigint as error from final group by vec_id)
select k.vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
 (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from {last}) as codebooks_sha256
from kept k join codes using (vec_id)"""


ORACLES: dict[str, str] = {
    "op3_superkmer_dedup": SUPERKMERS,
    "op6_hnsw_near_dups": NEAR_VECTORS,
    "op11_vector_codes": _lloyd(),
}
