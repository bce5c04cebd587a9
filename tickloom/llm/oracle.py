"""DuckDB SQL for those queries whose result SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op8_exact_dedup": """
        with t as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as norm from documents
        ), g as (
            select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from t join g using (norm)
    """,
    "op5_embedding_dedup": """
        with recursive v as (
            select vec_id, label, embedding::double[] as e from embeddings
            where vec_id is not null and label is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from v a join v b
            on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
            where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93
        ), reach(vec_id, other) as (
            select vec_id, vec_id from embeddings union select r.vec_id, l.b from reach r join links l on r.other = l.a
        ), c as (
            select vec_id, min(other) as component_id from reach group by vec_id
        ), n as (
            select a as vec_id, count(*) as n_links from links group by a
        )
        select e.vec_id, coalesce(n_links, 0) as n_links, component_id, e.vec_id = component_id as kept
        from embeddings e left join c using (vec_id) left join n using (vec_id)
    """,
    "op10_substring_dedup": """
        with d as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
        ), s as (
            select doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) as i from d
        ), windows as (
            select doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') as words from s
        ), later as (
            select doc_id, i from windows qualify row_number() over (partition by words order by doc_id, i) > 1
        ), gone as (
            select distinct doc_id, i + k as i from later, range(20) t(k)
        ), places as (
            select doc_id, w, unnest(range(1, len(w) + 1)) as i from d
        ), kept as (
            select doc_id, count(*) as n_kept, string_agg(w[i], ' ' order by i) as words
            from places p anti join gone g using (doc_id, i) group by doc_id
        )
        select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n_kept, 0))::bigint as n_removed,
               sha256(coalesce(words, '')) as kept_sha256
        from d left join kept using (doc_id)
    """,
}
