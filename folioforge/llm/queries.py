"""The queries of this subpackage over the driver's tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import embed_dedup, importance, jpeg_media, langid, lm_score, minhash, mixing, piece_codec, quality_crf, sharding, token_counts, toxicity, vector_codes
from folioforge.llm.common import delete_at_exit, fold, shared_folder, table
from folioforge.operators.relational import spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, over all cores even if it is one small file."""
    return spread(table(spark, sf_dir, "documents"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row as it is read back from the shards of the store's last version."""
    root = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    rows = sharding.shard_table(documents(spark, sf_dir), root)
    delete_at_exit(spark, root)
    return rows.select("doc_id", "n_chars", "text_md5", (F.col("shard_bytes") > 0).alias("stored"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_digests(documents(spark, sf_dir))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link_documents(documents(spark, sf_dir), words=3, num=85, den=100)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), quality_crf.training_rows())
    scored = quality_crf.score_documents(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict_languages(docs, langid.fit(docs, langid.training_rows()))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.training_rows()))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), block=mixing.BLOCK)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lm_score.score_documents(docs, lm_score.fit(docs))


def op9_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg_media.media_features(jpeg_media.to_media(documents(spark, sf_dir)))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(spread(table(spark, sf_dir, "embeddings")))


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2 can be held against in SQL: decoding gives the text back, with spaces for the pieces' space sign."""
    return op2_sentencepiece(spark, sf_dir).select("doc_id", "decoded_sha256")


def media_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op10 can be held against in SQL: the payload that is read back from the media."""
    return op10_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def queries() -> dict:
    return {f.__name__: f for f in (piece_round_trip, media_payload, op1_sharding, op2_sentencepiece, op3_minhash, op4_quality, op5_language, op6_toxicity, op7_mixing, op8_lm_score, op9_embedding, op10_media, op11_token_counts, op12_importance, op13_vector_codes)}


SHARDING_SQL = "select doc_id, length(text) as n_chars, md5(text) as text_md5, true as stored from documents"

ROUND_TRIP_SQL = "select doc_id, sha256(replace(coalesce(text, ''), chr(9601), ' ')) as decoded_sha256 from documents"
PAYLOAD_SQL = """
with b as (select doc_id, coalesce(text, '') as t, strlen(coalesce(text, ''))::bigint as n from documents)
select doc_id, n as n_bytes, greatest(64, (n + 63) // 64 * 64) as payload_bytes, sha256(t || repeat(chr(0), (greatest(64, (n + 63) // 64 * 64) - n)::bigint)) as payload_sha256 from b
"""

REACH = """
reach as (
    select id, id as other from nodes
    union
    select r.id, l.b as other from reach r join links l on r.other = l.a
)"""

MINHASH_SQL = f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
    from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all),
near as (
    select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 85 * (p.n + q.n - c)
),
links as (select a, b from near union all select b, a from near),
nodes as (select distinct a as id from links),{REACH}
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(m.low, d.doc_id) as component_id, coalesce(m.low, d.doc_id) = d.doc_id as kept
from documents d left join sizes s using (doc_id) left join (select id as doc_id, min(other) as low from reach group by id) m using (doc_id)
"""

EMBEDDING_SQL = f"""
with recursive ok as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and list_max(list_transform(embedding, lambda x: abs(x))) > 0
),
links as (select x.vec_id as a, y.vec_id as b from ok x join ok y on x.vec_id <> y.vec_id and len(x.v) = len(y.v) and list_cosine_similarity(x.v, y.v) >= 0.95),
nodes as (select distinct a as id from links),{REACH}
select e.vec_id, coalesce(n.n, 0) as n_links, coalesce(m.low, e.vec_id) as component_id, coalesce(m.low, e.vec_id) = e.vec_id as kept
from embeddings e left join (select a as vec_id, count(*) as n from links group by a) n using (vec_id)
left join (select id as vec_id, min(other) as low from reach group by id) m using (vec_id)
"""

MIXING_SQL = """
with recursive counted as (select coalesce(source, chr(0)) as source, count(*) as n_docs from documents group by 1),
plan as (
    select source, n_docs, n_docs // 16 as blocks, greatest(1, round(pow(n_docs, 0.5) / sum(pow(n_docs, 0.5)) over () * 4294967296))::bigint as w from counted
),
s as (select list(source order by source) as names, list(w order by source) as w, list(blocks order by source) as blocks, sum(w)::bigint as total from plan),
run as (
    select 0::bigint as t, list_transform(w, lambda x: 0::bigint) as done, null::bigint as pick, null::bigint as j, true as real from s
    union all
    select t + 1, list_transform(done, lambda d, i: case when i = p.i then d + 1 else d end), p.i, p.j, p.j < blocks[p.i]
    from (
        select t, done, blocks, list_min(list_filter(
            list_transform(range(1, len(w) + 1), lambda i: case when (done[i] * total) // w[i] <= t
                then {'deadline': ((done[i] + 1) * total + w[i] - 1) // w[i], 'i': i, 'j': done[i]} end),
            lambda y: y is not null)) as p
        from run, s where real
    )
),
slots as (select names[pick] as source, t - 1 as slot, j from run, s where pick is not null and real),
horizon as (select coalesce(max(t - 1), 0) as h from run where not real),
placed as (
    select doc_id, coalesce(source, chr(0)) as source,
        row_number() over (partition by coalesce(source, chr(0)) order by doc_id is null, md5(doc_id::varchar), doc_id) - 1 as k
    from documents
)
select doc_id, nullif(d.source, chr(0)) as source, k // 16 as block, coalesce(slot, h + ((k // 16 + 1) * total + plan.w - 1) // plan.w) as slot, k % 16 as place,
    slot is not null as in_mix, plan.w / total::double as weight
from placed d join plan on plan.source = d.source left join slots on slots.source = d.source and slots.j = k // 16, horizon, s
"""


#: CRC-32 of distinct words and pairs by the table of its 256 steps, whose entries the first fold makes.
IMPORTANCE_SQL = """
with steps as (
    select list(list_reduce(range(0, 9), lambda c, k: case when k = 0 then c when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i) order by i) as t from range(0, 256) r(i)
),
spoken as (
    select 'd' as side, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
    union all
    select 't', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') from benchmark
),
runs as (select side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from spoken),
held as (select side, id, f, count(*) as n from runs group by all),
names as (select distinct f, hex(encode(f)) as h from held),
hashed as (
    select f, xor(list_reduce(list_transform(range(1, strlen(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint), lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]), 4294967295::bigint), 4294967295) % 10000 as bucket
    from names, steps
),
sums as (select bucket, coalesce(sum(n) filter (side = 'd'), 0)::bigint as s, coalesce(sum(n) filter (side = 't'), 0)::bigint as t from held join hashed using (f) group by bucket),
whole as (select sum(s)::bigint as s, sum(t)::bigint as t from sums),
gain as (select bucket, floor(1000 * ln(((sums.t + 1) * (whole.s + 10000)::double) / ((sums.s + 1) * (whole.t + 10000)::double)))::bigint as g from sums, whole),
mean as (select id as doc_id, sum(n)::bigint as n_features, floor(sum(n * g) / sum(n)::double)::bigint as weight from held join hashed using (f) join gain using (bucket) where side = 'd' group by id),
scored as (
    select id as doc_id, len(w) as words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
    from spoken left join mean on doc_id = id where side = 'd'
),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as k, count(*) over () as n from scored where words >= 20)
select s.doc_id, n_features, weight, score, case when k <= 25 * n // 100 then k end as rank from scored s left join placed using (doc_id)
"""

_PARTS = "list_transform(range(0, 8), lambda p: list_slice(v, p * 8 + 1, p * 8 + 8))"
_NEAREST = """a{k} as materialized (
    select vec_id, p, arg_min(e, d * 16 + e) as e, min(d) as d
    from (select parts.vec_id, parts.p, b.e, list_sum(list_transform(list_zip(x, z), lambda y: (y[1] - y[2]) * (y[1] - y[2])))::bigint as d from parts join b{k} b using (p))
    group by all
)"""
_MEANS = """m{k} as (
    select p, e, i, sum(x[i])::bigint as s, count(*) as n from a{j} join parts using (vec_id, p), range(1, 9) r(i) group by all
),
b{k} as materialized (
    select p, e, coalesce(l, z) as z from b{j} left join (select p, e, list((s - ((s % n) + n) % n) // n order by i) as l from m{k} group by all) using (p, e)
)"""

#: For vectors of 64 components, as the table has them.
VECTOR_SQL = (
    f"""
with ok as (
    select vec_id, label, list_transform(embedding, lambda c: floor(c::double * 4096)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
),
parts as materialized (select vec_id, unnest(range(0, 8)) as p, unnest({_PARTS}) as x from ok),
b0 as materialized (select p, r - 1 as e, x as z from parts join (select vec_id, row_number() over (order by vec_id) as r from ok) using (vec_id) where r <= 16),
"""
    + ",\n".join(x for k in range(1, 7) for x in (_NEAREST.format(k=k - 1), _MEANS.format(k=k, j=k - 1)))
    + f""",
{_NEAREST.format(k=6)},
coded as (select vec_id, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from a6 group by vec_id),
digest as (select sha256(string_agg(array_to_string(z, ','), ',' order by p, e)) as codebooks_sha256 from b6)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from coded join ok using (vec_id), digest
"""
)


def oracle_sql() -> dict[str, str]:
    return {"op12_importance": IMPORTANCE_SQL, "op13_vector_codes": VECTOR_SQL, "piece_round_trip": ROUND_TRIP_SQL, "media_payload": PAYLOAD_SQL, "op1_sharding": SHARDING_SQL, "op3_minhash": MINHASH_SQL, "op7_mixing": MIXING_SQL, "op9_embedding": EMBEDDING_SQL}
