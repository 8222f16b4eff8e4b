"""The queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, quality
from .common import table
from .divergence import source_divergence
from .jaccard_join import jaccard_join
from .mixing import mix_sources
from .mtree import exact_top_k
from .near_dedup import near_duplicates
from .packing import pack
from .prefix_forest import approximate_top_k
from .spelling import spelling_variants
from .substring_dedup import remove_repeats
from .token_counts import token_counts
from .warc import round_trip


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, words and greedy word-piece tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_words", "n_tokens")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, and its source's size and target."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by models of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs), ["doc_id"]).withColumn("held_out", language_id.held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector with all others."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 512 to 4,096 words."""
    return pack(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document by a model of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.ratings(table(spark, sf_dir, "labels")))
    return quality.grade_documents(docs, model, ["doc_id"])


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each document whose five-word shingles agree by 85 % or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_approximate_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every 20th vector."""
    return approximate_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    return round_trip(table(spark, sf_dir, "pages"))


def op10_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in windows of 35 that stand elsewhere, too, and the digest of the rest."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each two sources of a language, and the ten terms that set each source apart most."""
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document, by links of five-word shingles that agree by 80 % or more."""
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, and the more frequent spelling that each stands for."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_counts, op2_mix_sources, op3_language_id, op4_exact_top_k, op5_pack, op6_quality, op7_near_duplicates, op8_approximate_top_k, op9_warc, op10_remove_repeats, op11_source_divergence, op12_jaccard_join, op13_spelling_variants)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those that SQL can express; the others are tested against brute force in tests/llm."""
    return {
        "op12_jaccard_join": r"""
            with recursive w as (select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
            s as (select distinct r, h from (select r, md5_number(array_to_string(w[i + 1:i + 5], ' ')) as h from w, range(greatest(len(w) - 4, least(len(w), 1))) t(i))),
            z as (select r, count(*) as n, md5(string_agg(h::varchar, ' ' order by h)) as k from s group by r),
            c as (select k, min(r) as r, any_value(n) as n, min(doc_id) as doc_id from z join w using (r) group by k),
            q as (select r, h from s semi join c using (r)),
            i as (select a.r as a, b.r as b, count(*) as m from q a join q b on a.h = b.h and a.r < b.r group by all),
            l as (select a, b from i join c x on x.r = a join c y on y.r = b where 100 * m >= 80 * (x.n + y.n - m)),
            e as (select a, b from l union all select b, a from l),
            reach as (select r as a, r as b from c union select reach.a, e.b from reach join e on reach.b = e.a),
            f as (select x.k, min(y.doc_id) as component_id from reach join c x on x.r = a join c y on y.r = b group by x.k)
            select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id from w left join z using (r) left join f using (k)""",
        # a crc32 is a fold over bytes with a table of 256; words of one code point less meet in what remains of them, others in what a skipped one leaves
        "op13_spelling_variants": r"""
            with recursive x as (select list(case when crc is null then 0 else crc end order by b) as crcs from (
                select b, list_reduce(list_prepend(b::bigint, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as crc from range(256) t(b))),
            d as (select row_number() over () as r, coalesce(doc_id::text, '') as id, coalesce(text, '') as text from documents),
            u as (select r, id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w from d),
            c as (select id, w, count(*) as n, hex(encode(id || ':' || w)) as bytes from u group by all),
            h as (select w, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(bytes) // 2), lambda i: ('0x' || substr(bytes, (2 * i + 1)::int, 2))::bigint)),
                    lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1]))) as h from c, x),
            v as (select case when h % 97 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h),
            words as (select word, sum(n)::bigint as n from v where length(word) >= 5 group by word having sum(n) >= 3),
            s as (select word, n, i, substr(word, 1, i) || chr(1) || substr(word, i + 2) as gap, substr(word, 1, i) || substr(word, i + 2) as rest from words, range(length(word)) t(i)),
            near as (select a.word, b.word as other, b.n as m from s a join s b on a.gap = b.gap and a.word <> b.word
                     union select a.word, b.word, b.n from s a join words b on a.rest = b.word
                     union select b.word, a.word, a.n from s a join words b on a.rest = b.word),
            top as (select word, count(*) as n_near, max(m) as m, min(struct_pack(less := -m, other := other)).other as other from near group by word),
            f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 2 * n then other end as form, case when m >= 2 * n then m end as form_n from words w left join top using (word)),
            g as (select word, word as root, form as next from f union all select g.word, f.word, f.form from g join f on g.next = f.word)
            select f.word, f.form, g.root, f.n, f.n_near::bigint as n_near, f.form_n::bigint as form_n from f join g on f.word = g.word and g.next is null""",
        "op4_exact_top_k": """
            with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
                       where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
            s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
                  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
            r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
            select query_id, rank::int as rank, vec_id, score from r where rank <= 5""",
        "op9_warc": """
            with p as (select page_id, coalesce(html, '') as html from pages),
            d as (select *, max(page_id) over (partition by html) as top, sha1(html) as hex,
                         from_hex(sha1(html)) as raw from p),
            b as (select *, list_aggregate(list_transform(range(40), lambda i: ('0x' || hex[i + 1])::int), 'list') as n from d)
            select page_id, strlen(html)::bigint as payload_bytes,
                   list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                     (((n[(k * 5) // 4 + 1] << 4) + coalesce(n[(k * 5) // 4 + 2], 0)) >> (3 - (k * 5) % 4) & 31) + 1, 1)), 'string_agg', '') as payload_digest,
                   case when page_id = top then 'response' else 'revisit' end as record_type,
                   case when page_id <> top then top end as refers_to
            from b""",
        "op10_remove_repeats": r"""
            with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
            p as (select doc_id, i, sha256(array_to_string(w[i + 1:i + 35], ' ')) as h from w, range(greatest(len(w) - 34, 0)) t(i)),
            r as (select h from p group by h having count(*) > 1),
            m as (select distinct doc_id, i + j as k from p join r using (h), range(1, 36) u(j)),
            g as (select doc_id, list(k) as gone from m group by doc_id),
            k as (select w.doc_id, len(w) as n, coalesce(gone, []) as gone, w from w left join g using (doc_id))
            select doc_id, n::bigint as n_words, len(gone)::bigint as n_removed,
                   sha256(array_to_string(list_filter(w, lambda x, i: not list_contains(gone, i)), ' ')) as kept_sha256 from k""",
        "op11_source_divergence": r"""
            with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
            w as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as w from d),
            t as (select r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from w),
            c as (select lang, source, term, count(*) as n from t group by all),
            k as (select lang, term, count(*) as n from t group by all having count(distinct r) >= 10),
            l as (select lang, count(*) as v, sum(n) as n from k group by lang),
            s as (select distinct lang, source from d),
            o as (select lang, source, sum(c.n) as n from c join k using (lang, term) group by all),
            g as (select lang, source, coalesce(o.n, 0) + 2 * coalesce(v, 0) as total, l.n + 2 * v as lang_total from s left join o using (lang, source) left join l using (lang)),
            p as (select lang, source, term, coalesce(c.n, 0) as n, 1 + 1000000000 * (coalesce(c.n, 0) + 2)::hugeint // total as p, 1 + 1000000000 * (k.n + 2)::hugeint // lang_total as q
                  from g join k using (lang) left join c using (lang, source, term)),
            b as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
                  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
            u as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
                  from s a join s b on a.lang = b.lang and a.source <> b.source left join b as m on m.lang = a.lang and m.source = a.source and m.item = b.source
                  union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q),
            r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from u)
            select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 10""",
    }
