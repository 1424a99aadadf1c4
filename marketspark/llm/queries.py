"""The queries of this subpackage, one an operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from marketspark.llm import codes, fingerprints, language, minhash, mixing, packing, phrases, quality, scoring, sharding, suffixes, urls, vectors
from marketspark.llm.common import table, tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


#: Words, letters and a draw in (0, 1) from the MD5, as the operators take them.
DRAW = "(('0x' || substr(md5('{seed}:' || doc_id), 1, 13))::bigint + 0.5) / 4503599627370496.0"
SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint"

MIX_SQL = f"""
with d as (
    select doc_id, source, {SIZE} as size,
           -ln({DRAW.format(seed=17)}) / (0.5 + coalesce(length(regexp_replace(text, '[^A-Za-z]+', '', 'g')) / nullif(length(text), 0), 0.0)) as sort_key
    from documents),
s as (select source, sum(size)::bigint as source_size from d group by 1),
w as (select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight, 2 * source_size as cap from s),
l as (select *, (sum(source_size) over () * 3 / 2.0
                 - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
              / (sum(weight) over ()
                 - coalesce(sum(weight) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)) as level
      from w),
f as (select *, level * weight >= cap as filled from l),
t as (select source, source_size,
             case when filled then cap::double else (select arg_min(level, cap / weight) from f where not filled) * weight end as target
      from f),
e as (select *, coalesce(floor(target / nullif(source_size, 0)), 0) as epochs from t),
p as (select d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size as rest,
             2 * sum(d.size) over (partition by d.source order by d.sort_key, d.doc_id rows unbounded preceding) - d.size as middle
      from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target, ((epochs + case when middle <= 2 * rest then 1 else 0 end) * size)::bigint as taken from p
"""


@query("op4_mixing", MIX_SQL)
def op4_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_sharding")
def op7_sharding(spark, folder):
    """The row law: every shard within one row of the others."""
    rows = sharding.interleave(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source",
    )


#: Links of a table l (x, y) followed from every x: the least id reached.
REACH = """
r as (select x, y from l union select r.x, l.y from r join l on r.y = l.x),
c as (select x, least(x, min(y)) as component from r group by x)
"""

VECTOR_SQL = f"""
with recursive v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.98),
{REACH}, n as (select x, count(*) as links from l group by x)
select vec_id, coalesce(links, 0)::bigint as n_links, coalesce(component, vec_id) as component_id, coalesce(component, vec_id) = vec_id as kept
from embeddings left join c on vec_id = c.x left join n on vec_id = n.x
"""


@query("op1_vectors", VECTOR_SQL)
def op1_vectors(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"))


NEAR_SQL = f"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') as words from documents),
s as materialized (
    select doc_id, unnest(list_distinct(case when len(words) = 0 then [] when len(words) < 4 then [words]
        else list_transform(range(1, len(words) - 2), lambda i: words[i:i + 3]) end)) as shingle from w),
n as materialized (select doc_id, count(*) as size from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as both_have from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
l as materialized (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * both_have >= 80 * (a.size + b.size - both_have)),
{REACH}
select d.doc_id, coalesce(size, 0)::bigint as n_shingles, coalesce(component, d.doc_id) as component_id, coalesce(component, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join c on c.x = d.doc_id
"""


@query("op2_minhash", NEAR_SQL)
def op2_minhash(spark, folder):
    return minhash.near_documents(table(spark, folder, "documents"), words=4, percent=80)


@query("op3_scoring")
def op3_scoring(spark, folder):
    return scoring.score_documents(table(spark, folder, "documents"))


@query("op5_urls")
def op5_urls(spark, folder):
    return urls.filter_urls(table(spark, folder, "pages"))


@query("op6_language")
def op6_language(spark, folder):
    return language.predict_languages(table(spark, folder, "documents"))


@query("op8_packing")
def op8_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer=tokenizer())


@query("op9_quality")
def op9_quality(spark, folder):
    judged = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_suffixes")
def op10_suffixes(spark, folder):
    return suffixes.removed_passages(table(spark, folder, "documents"))


PHRASE_SQL = r"""
with p as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                    '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
n as (select lang, sum(len(ws))::bigint as n from w group by 1),
g as (select lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as phrase
      from (select *, unnest(range(1, 6)) as size from w) where len(ws) >= size),
f as materialized (select lang, phrase, size, count(*) as f from g group by all having count(*) >= 100),
c as (select lang, phrase, f as a, string_split(phrase, ' ') as ws from f where size >= 2
      and not exists (select 1 from f o where o.lang = f.lang and o.size > f.size and 100 * o.f >= 100 * f.f and contains(' ' || o.phrase || ' ', ' ' || f.phrase || ' '))),
k as (select *, unnest(range(1, len(ws))) as k from c),
s as (select k.lang, k.phrase, a, k, x.f as l, y.f as r, n, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
      from k join n on n.lang = k.lang join f x on x.lang = k.lang and x.phrase = array_to_string(ws[1:k], ' ')
      join f y on y.lang = k.lang and y.phrase = array_to_string(ws[k + 1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from b qualify rank <= 2000
"""


@query("op11_phrases", PHRASE_SQL)
def op11_phrases(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


#: One assignment of parts p to the entries of a codebook: the nearest, the lower index of equals.
ASSIGN = """
a{t} as materialized (
    select vec_id, part, x, best // 64 as error, best % 64 as entry from (
        select p.vec_id, p.part, p.x, min(list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + c.entry)::bigint as best
        from p join c{t} c on c.part = p.part group by all))"""
#: The floor of the mean of an entry's parts; an unused entry stays.
MOVE = """
s{t} as (select part, entry, pos, sum(y)::bigint as total, count(*) as n
         from (select part, entry, unnest(range(1, len(x) + 1)) as pos, unnest(x) as y from a{t}) group by all),
m{t} as (select part, entry, list((total - ((total % n) + n) % n) // n order by pos) as c from s{t} group by all),
c{n} as materialized (select o.part, o.entry, coalesce(m.c, o.c) as c from c{t} o left join m{t} m on m.part = o.part and m.entry = o.entry)"""

CODE_SQL = f"""
with v as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as q from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (
    select vec_id, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] as x from (select *, unnest(range(16)) as part from v)),
c0 as materialized (
    select part, entry, x as c from (select part, x, row_number() over (partition by part order by vec_id) - 1 as entry from p) where entry < 64),
{ASSIGN.format(t=0)},{MOVE.format(t=0, n=1)},
{ASSIGN.format(t=1)},{MOVE.format(t=1, n=2)},
{ASSIGN.format(t=2)},
k as (select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(error)::bigint as error from a2 group by 1),
b as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from c2)
select k.vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from k join v on v.vec_id = k.vec_id, b
"""


@query("op12_codes", CODE_SQL)
def op12_codes(spark, folder):
    return codes.code_vectors(table(spark, folder, "embeddings"))


@query("op13_fingerprints")
def op13_fingerprints(spark, folder):
    """All anchors of every text, so that likeness is no estimate."""
    return fingerprints.compare_edited(table(spark, folder, "documents"), kept=None)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)
