"""Queries of the operators over whole tables, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmill.llm import (
    bpe,
    centroids,
    fingerprints,
    languages,
    mixing,
    negatives,
    ngram_join,
    pseudonyms,
    quality,
    repeats,
    token_counts,
    topk,
    warc,
)
from trailmill.llm.storage import shared_path
from trailmill.llm.tables import read

#: A key for tests; production passes a secret.
TEST_KEY = "not-a-secret"
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    target = F.regexp_extract(warc.header_field(F.col("header"), "WARC-Refers-To"), "<urn:page:(.*)>", 1)
    return warc.read_archive(spark, path).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        warc.header_field(F.col("header"), "WARC-Type").alias("record_type"),
        target.cast("long").alias("refers_to"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, plan = mixing.mix_plan(read(spark, sf_dir, "documents"))
    rows = mixing.with_copies(sized, plan)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = languages.fit(docs.where(~languages.held_out()))
    return languages.predicted(docs, model).withColumn("held_out", languages.held_out())


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.reported(read(spark, sf_dir, "documents"), TEST_KEY)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", noisy)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, 5, 5, (80, 100))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, scale=1024.0, seed=3)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_token_counts, op3_quality, op4_topk, op5_mixing,
        op6_languages, op7_ngram_join, op8_pseudonyms, op9_byte_bpe, op10_repeats,
        op11_negatives, op12_centroids, op13_fingerprints,
    )
}

WORD = r"[^\x20\x09-\x0D]+"

SQL = {
    "op1_warc": """
with p as (select page_id, strlen(coalesce(html, '')) n, sha256(coalesce(html, '')) d from pages),
f as (select d, min(page_id) m from p group by d)
select page_id, n::bigint payload_bytes, d payload_digest,
  case when n >= 100 and page_id <> m then 'revisit' else 'response' end record_type,
  case when n >= 100 and page_id <> m then m end refers_to
from p join f using (d)
""",
    "op3_quality": f"""
with d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{WORD}') w from documents),
l as (select doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) ls from d),
win as (select doc_id, i, list_slice(w, i, i + 7) k from (select doc_id, w, unnest(range(1, len(w) - 6)) i from d where len(w) >= 8)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) c from win) where c > 1),
cov as (select doc_id, sum(least(8, coalesce(after - i, 8))) n from
  (select doc_id, i, lead(i) over (partition by doc_id order by i) after from rep) group by doc_id),
m as (select doc_id, len(w) n_words, length(array_to_string(w, '')) word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols, len(ls) - len(list_distinct(ls)) n_dup_lines,
  coalesce(cov.n, 0)::bigint n_repeat_words, len(ls) n_lines, length(regexp_replace(t, '[^!?]', '', 'g')) n_marks,
  len(list_filter(w, lambda x: x in ({", ".join(f"'{w}'" for w in quality.STOP_WORDS)}))) n_stop_words
  from l left join cov using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from m)
select *, not base_failed and word_chars >= 2.5::double * n_words and word_chars <= 12.0::double * n_words
  and n_symbols <= 0.1::double * n_words and n_marks <= 0.3::double * n_words
  and n_stop_words >= 0.02::double * n_words and n_dup_lines <= 0.45::double * n_lines kept
from b
""",
    "op4_topk": """
with v as (select vec_id, row_number() over () rn, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint score
  , q.rn from v q join v c on q.vec_id % 50 = 0 and q.rn <> c.rn),
r as (select *, row_number() over (partition by rn order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 5
""",
    "op5_mixing": f"""
with f as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint size,
  md5('0:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) draw from documents),
n as (select *, row_number() over (partition by source, draw) nth from f),
d as (select doc_id, source, size, case when nth = 1 then draw else md5(draw || ':' || (nth - 1)) end draw from n),
s as (select source, sum(size)::bigint source_size, count(*) filter (size > 0) filled from d group by source),
w as (select *, 3 * source_size lim,
  list_extract([5, 2, 1], ((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::bigint) weight from s),
p as (select *, row_number() over o place, coalesce(sum(lim) over b, 0) capped, coalesce(sum(weight) over b, 0) used
  from w window o as (order by lim / weight, encode(source) nulls last),
  b as (order by lim / weight, encode(source) nulls last rows between unbounded preceding and 1 preceding)),
t as (select sum(source_size) total, sum(weight) weights from w),
v as (select p.*, (total - capped)::double / (weights - used)::double level from p, t),
c as (select arg_min(level, place) level from v where lim / weight >= level),
a as (select v.source, v.source_size, v.filled, least(v.lim::double, coalesce(c.level * v.weight, v.lim::double)) target from v, c),
g as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end whole from a),
h as (select *, target - whole * source_size rest from g),
k as (select *, case when source_size > 0 then rest / source_size else 0 end share,
  case when filled > 0 then source_size::double / filled else 0 end mean_size from h),
u as (select d.doc_id, d.size, d.draw, k.*, (('0x' || substr(draw, 1, 13))::bigint::double + 0.5) / 4503599627370496 u
  from d join k on d.source is not distinct from k.source),
x as (select *, case when share > 0 and size > 0 then u / (1 - u) / (share / (1 - share) * sqrt(size / mean_size)) end rnk from u),
y as (select *, sum(size) over (partition by source order by rnk, draw rows unbounded preceding) run from x where rnk is not null),
z as (select *, coalesce(max(run) filter (run <= rest) over (partition by source), 0) sampled from y),
e as (select *, row_number() over (partition by source, run <= rest order by abs(size - (rest - sampled)), size, rnk, draw) nth from z)
select x.doc_id, x.size, x.source_size, x.target, (x.size * (x.whole
  + case when e.run <= e.rest or (e.nth = 1 and abs(e.size - (e.rest - e.sampled)) < e.rest - e.sampled) then 1 else 0 end))::bigint taken
from x left join e on x.draw = e.draw and x.source is not distinct from e.source
""",
    "op7_ngram_join": f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ngram_join.UPPER}', '{ngram_join.LOWER}'), '{WORD}') w
  from documents),
t as (select distinct doc_id, array_to_string(list_slice(w, i, i + 2), ' ') k
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from t group by doc_id),
o as (select a.doc_id a, b.doc_id b, count(*) c from t a join t b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
l as (select o.a, o.b from o join n x on x.doc_id = o.a join n y on y.doc_id = o.b where 100 * c >= 90 * (x.n + y.n - c)),
r as (select doc_id a, doc_id b from d union select r.a, l.b from r join l on r.b = l.a)
select r.a doc_id, coalesce(any_value(n.n), 0)::bigint n_shingles, min(r.b) component_id
from r left join n on n.doc_id = r.a group by r.a
""",
    "op11_negatives": """
with v as (select vec_id, row_number() over () rn, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
  list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id anchor_id, q.rn an, q.l al, c.vec_id, c.l, list_inner_product(q.e, c.e)::bigint score
  from v q join v c on q.vec_id % 100 = 0 and q.rn <> c.rn),
p as (select *, row_number() over (partition by an order by score desc, vec_id) n from s where l = al),
t as (select p.an, p.n, p.anchor_id, p.vec_id positive_id, p.score positive_score, s.vec_id negative_id, s.score negative_score,
  row_number() over (partition by p.an, p.n order by s.score desc, s.vec_id) rank
  from p join s on p.an = s.an and p.n <= 5 and s.l <> s.al and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, rank::int rank, negative_id, positive_score, negative_score from t where rank <= 5
""",
}


def cluster_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds written out one after another, as a recursive query cannot aggregate."""
    parts = [
        """v as materialized (select row_number() over () rn, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) e
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""c0 as materialized (select row_number() over (order by h, e) - 1 c, e from
  (select e, sha256('3:' || vec_id) h from v where vec_id is not null) order by h, e limit {k})""",
    ]
    nearest = """select rn, c, d from (select v.rn, c.c, list_inner_product(x, x) d, row_number() over (partition by v.rn order by list_inner_product(x, x), c.c) n
  from v, {centroids} c, lateral (select list_transform(list_zip(v.e, c.e), lambda p: p[1] - p[2]) x)) where n = 1"""
    for i in range(rounds):
        parts += [
            f"a{i} as materialized ({nearest.format(centroids=f'c{i}')})",
            f"""m{i} as materialized (select c, list(m order by j) e from (select c, j, floor(sum(x::hugeint) / count(*)) m
  from (select a.c, unnest(range(64)) j, unnest(v.e) x from a{i} a join v using (rn)) group by c, j) group by c)""",
            f"c{i + 1} as materialized (select c, coalesce(m.e, o.e) e from c{i} o left join m{i} m using (c))",
        ]
    return f"""with {", ".join(parts)},
f as ({nearest.format(centroids=f"c{rounds}")}),
s as (select c, sum(d)::bigint own from f group by c)
select vec_id, c::int "cluster", d::bigint distance, own cluster_inertia, (select sum(d)::bigint from f) inertia,
  sha256(array_to_string(list_transform(z.e, lambda x: x::bigint::varchar), ',')) centroid_sha256
from f join v using (rn) join s using (c) join c{rounds} z using (c)
"""


SQL["op12_centroids"] = cluster_sql()
