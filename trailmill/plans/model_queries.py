"""Queries on vectors, features, clusters, topics, learnt recommenders, and files."""

from __future__ import annotations

import uuid

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmill import schema as S
from trailmill.functions import arrays
from trailmill.operators import (
    clusters,
    embeddings,
    evaluate,
    factors,
    features,
    pooling,
    profile,
    recommend,
    retrieval,
    sequences,
    sessions,
    splits,
    topics,
)
from trailmill.plans.explore_queries import located
from trailmill.plans.recommend_queries import ALL_CTE, INDEX_CTE, SQL_NAMES, TRACK_CTE, _long_sql, metric_rows, model_recs, track
from trailmill.plans.registry import mean_sql, on_clicks, query
from trailmill.scale import beside, checkpoint_dir, materialise
from trailmill.sources import io
from trailmill.sources.tables import click_facts, clicks, vectors

VECS_CTE = """
vecs as (select cast(vec_id as int) as item_no, cast(embedding as double[]) as v, label as cluster from embeddings),
dims as (select item_no, cluster, unnest(v) as x, generate_subscripts(v, 1) as dim from vecs)"""


def item_vectors(spark, sf_dir):
    """Vector n stands in as the embedding of item number n."""
    return vectors(spark, sf_dir).select(F.col("vec_id").cast("int").alias("item_no"), "vector")


def numbered(df):
    return df.withColumnRenamed("item_no", "item_idx")


def by_dimension(df, keys, column="vector"):
    long = df.select(*keys, F.posexplode(column).alias("dim", "x"))
    return long.select(*keys, (F.col("dim") + 1).cast("long").alias("dim"), F.round("x", 6).alias("x"))


@query(
    "mean_pool",
    on_clicks(
        """select session_id, dim, round(x, 6) as x, round(x / sqrt(sum(x * x) over (partition by session_id)), 6) as unit_x
        from (select session_id, dim, avg(x) as x from clicks join dims using (item_no) group by session_id, dim)""",
        VECS_CTE,
    ),
)
def _(spark, sf_dir):
    pooled = pooling.mean_pool(clicks(spark, sf_dir), item_vectors(spark, sf_dir), "item_no")
    both = pooled.select("session_id", F.posexplode(F.arrays_zip("pooled", "unit")).alias("dim", "p"))
    return both.select(
        "session_id", (F.col("dim") + 1).cast("long").alias("dim"), F.round("p.pooled", 6).alias("x"),
        F.round("p.unit", 6).alias("unit_x"),
    )


POOL_CTE = (
    TRACK_CTE
    + ","
    + VECS_CTE
    + """,
pooled as (select session_id, dim, sum(pow(0.8, last_order - 1 - click_order) * x) as x
  from held join dims using (item_no) where click_order < last_order group by session_id, dim)"""
)


@query("decayed_pool", on_clicks("select session_id, dim, round(x, 6) as x from pooled", POOL_CTE))
def _(spark, sf_dir):
    pooled = pooling.decayed_pool(track(spark, sf_dir).context, item_vectors(spark, sf_dir), 0.8, "item_no")
    return by_dimension(pooled, ["session_id"])


@query(
    "cosine_retrieval",
    on_clicks(
        """select session_id, item_no as item_idx, score, rank from (select *, cast(row_number() over
        (partition by session_id order by score desc, item_no) as int) as rank from (
          select session_id, item_no, round(list_dot_product(q, v)
            / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))), 9) as score
          from (select session_id, list(x order by dim) as q from pooled group by session_id), vecs
          where (session_id, item_no) not in
            (select session_id, item_no from held where click_order < last_order))) where rank <= 10""",
        POOL_CTE,
    ),
)
def _(spark, sf_dir):
    context = track(spark, sf_dir).context
    items = item_vectors(spark, sf_dir)
    pooled = pooling.decayed_pool(context, items, 0.8, "item_no")
    return retrieval.cosine_recs(pooled, numbered(items), numbered(context.drop("item_idx")))


PREFIX_CTE = (
    VECS_CTE
    + """,
ahead as (select session_id, click_order, item_no, lead(item_no) over (partition by session_id order by click_order) as next,
  min(click_order) over (partition by session_id, item_no) as first_order from clicks),
parts as (select p.session_id, p.click_order, p.next, c.item_no, sum(pow(0.01, p.click_order - c.first_order)) as w
  from ahead p join ahead c on c.session_id = p.session_id and c.click_order <= p.click_order
  where p.next is not null group by all),
pooled as (select session_id, click_order, any_value(next) as next, dim, sum(w * x) / sum(w) as x
  from parts join dims using (item_no) group by session_id, click_order, dim)"""
)


@query(
    "prefix_pool",
    on_clicks(
        """select session_id, click_order, any_value(next) as next, round(sqrt(sum(x * x)), 6) as length,
        round(sum(x * dim), 6) as weighted from pooled group by session_id, click_order""",
        PREFIX_CTE,
    ),
)
def _(spark, sf_dir):
    pooled = pooling.prefix_pool(clicks(spark, sf_dir), item_vectors(spark, sf_dir), 0.01, "item_no")
    v = F.col("vector")
    positions = F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: i.cast("double"))
    return pooled.select(
        "session_id", "click_order", "next", F.round(arrays.norm(v), 6).alias("length"),
        F.round(arrays.dot(v, positions), 6).alias("weighted"),
    )


@query(
    "prefix_retrieval",
    on_clicks(
        """select session_id, item_no as item_idx, score, rank from (select *, cast(row_number() over
        (partition by session_id order by score desc, item_no) as int) as rank from (
          select session_id, vecs.item_no, round(list_dot_product(q, v)
            / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))), 9) as score
          from (select session_id, click_order, list(x order by dim) as q from pooled
            where (session_id, click_order) in (select session_id, max(click_order) from pooled group by session_id)
            group by session_id, click_order) join ahead using (session_id, click_order)
          join vecs on vecs.item_no <> ahead.item_no)) where rank <= 10""",
        PREFIX_CTE,
    ),
)
def _(spark, sf_dir):
    c, items = materialise(clicks(spark, sf_dir).select("session_id", "click_order", "item_no")), item_vectors(spark, sf_dir)
    pooled = pooling.last_prefix_pool(c, items, 0.01, "item_no")
    return retrieval.last_prefix_recs(pooled, numbered(items), numbered(c))


NEXT_RANKS_CTE = (
    PREFIX_CTE
    + """,
queries as (select session_id, click_order, any_value(next) as next, list(x order by dim) as q from pooled group by all),
scored as (select session_id, click_order, next, item_no, round(list_dot_product(q, v)
    / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))), 9) as score from queries, vecs),
own as (select session_id, click_order, score from scored where item_no = next),
ranks as (select s.session_id, s.click_order, any_value(s.next) as next,
  case when any_value(o.score) is not null then count_if(s.score > o.score or (s.score = o.score and item_no < s.next)) + 1 end as rank
  from scored s left join own o using (session_id, click_order) group by s.session_id, s.click_order)"""
)


def prefix_ranks(spark, sf_dir):
    items = item_vectors(spark, sf_dir)
    prefixes = pooling.prefix_pool(clicks(spark, sf_dir), items, 0.01, "item_no")
    return retrieval.next_ranks(prefixes, numbered(items))


@query("next_item_ranks", on_clicks("select * from ranks", NEXT_RANKS_CTE))
def _(spark, sf_dir):
    return prefix_ranks(spark, sf_dir)


@query(
    "all_prefix_metrics",
    on_clicks(
        """select round(avg(case when rank <= 10 then 1.0 else 0.0 end), 9) as recall,
        round(avg(case when rank <= 10 then 1.0 / log2(rank + 1.0) else 0.0 end), 9) as ndcg, count(*) as prefixes from ranks""",
        NEXT_RANKS_CTE,
    ),
)
def _(spark, sf_dir):
    row = evaluate.next_rank_metrics(prefix_ranks(spark, sf_dir))
    return row.withColumns({c: F.round(c, 9) for c in ("recall", "ndcg")})


@query(
    "davies_bouldin",
    """with c as (select label, count(*) as n, dim, avg(x) as m from (select label, vec_id,
      unnest(cast(embedding as double[])) as x, generate_subscripts(embedding, 1) as dim from embeddings) group by label, dim),
    p as (select vec_id, label, unnest(cast(embedding as double[])) as x, generate_subscripts(embedding, 1) as dim from embeddings),
    s as (select label, avg(d) as s from (select vec_id, label, sqrt(sum((x - m) ** 2)) as d from p join c using (label, dim)
      group by vec_id, label) group by label),
    m as (select a.label as i, b.label as j, sqrt(sum((a.m - b.m) ** 2)) as d from c a join c b using (dim)
      where a.label <> b.label group by a.label, b.label)
    select round(avg(worst), 8) as davies_bouldin from (select i, max((x.s + y.s) / d) as worst
      from m join s x on x.label = i join s y on y.label = j group by i)""",
)
def _(spark, sf_dir):
    score = clusters.davies_bouldin(clusters.cluster_stats(vectors(spark, sf_dir)))
    return score.select(F.round("davies_bouldin", 8).alias("davies_bouldin"))


@query(
    "calinski_harabasz",
    """with p as (select vec_id, label, unnest(cast(embedding as double[])) as x,
      generate_subscripts(embedding, 1) as dim from embeddings),
    c as (select label, dim, avg(x) as m, count(*) as n from p group by label, dim),
    g as (select dim, avg(x) as m from p group by dim),
    b as (select sum(n * (c.m - g.m) ** 2) as b from c join g using (dim)),
    w as (select sum((x - m) ** 2) as w from p join c using (label, dim)),
    k as (select count(distinct label) as k, count(*) as n from embeddings)
    select round((b / (k - 1)) / (w / (n - k)), 8) as calinski_harabasz from b, w, k""",
)
def _(spark, sf_dir):
    score = clusters.calinski_harabasz(clusters.cluster_stats(vectors(spark, sf_dir)))
    return score.select(F.round("calinski_harabasz", 8).alias("calinski_harabasz"))


@query(
    "silhouette",
    """with p as (select vec_id, label, unnest(cast(embedding as double[])) as x,
      generate_subscripts(embedding, 1) as dim from embeddings),
    q as (select vec_id, label, sum(x * x) as xx from p group by vec_id, label),
    c as (select label as k, dim, avg(x) as m from p group by label, dim),
    t as (select label as k, count(*) as n, avg(xx) as psi from q group by label),
    d as (select q.vec_id, q.label, t.k, t.n, xx + psi - 2 * dp as dist from q, t,
      lateral (select sum(p.x * c.m) as dp from p join c using (dim) where p.vec_id = q.vec_id and c.k = t.k)),
    s as (select vec_id, max(case when k = label then dist * n / (n - 1) end) as a,
      min(case when k <> label then dist end) as b from d group by vec_id)
    select round(avg((b - a) / greatest(a, b)), 8) as silhouette from s""",
)
def _(spark, sf_dir):
    value = clusters.silhouette(materialise(vectors(spark, sf_dir)))
    return io.rows_frame(spark, [(value,)], "silhouette double").select(F.round("silhouette", 8).alias("silhouette"))


SCALED = ["n_clicks", "avg_price", "n_categories", "n_colours", "country", "month", "day_of_week"]


@query(
    "scaled_features",
    on_clicks(
        "select session_id, label, "
        + ", ".join(f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 0), 6) as {c}" for c in SCALED)
        + " from sums",
        f"""sums as (select session_id, count(*) as n_clicks, {mean_sql('price')} as avg_price,
        count(distinct category) as n_categories, count(distinct colour) as n_colours,
        min_by(country, click_order) as country, month(min_by(click_date, click_order)) as month,
        dayofweek(min_by(click_date, click_order)) + 1 as day_of_week, cast(bool_or(price_above_avg) as int) as label
        from clicks group by session_id)""",
    ),
)
def _(spark, sf_dir):
    summary = sessions.session_summary(clicks(spark, sf_dir, premium=True))
    rows = materialise(sessions.session_label(summary))
    scaled = features.session_feature_pipeline().fit(rows).transform(rows)
    values = F.col("values")
    return scaled.select("session_id", "label", vector_values("features").alias("values")).select(
        "session_id", "label", *[F.round(values[i], 6).alias(c) for i, c in enumerate(SCALED)]
    )


def vector_values(column):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)


@query(
    "tfidf_long",
    on_clicks(
        """select session_id, item_id, tf, df, round(weight, 8) as weight,
        round(coalesce(weight / nullif(sqrt(sum(weight * weight) over (partition by session_id)), 0), 0), 8) as unit_weight
        from (select *, tf * ln((n + 1.0) / (df + 1.0)) as weight from (
          select session_id, item_id, count(*) as tf, count(*) over (partition by item_id) as df from clicks
          group by session_id, item_id), (select count(distinct session_id) as n from clicks))"""
    ),
)
def _(spark, sf_dir):
    rows = features.tfidf_rows(clicks(spark, sf_dir))
    return rows.withColumns({"weight": F.round("weight", 8), "unit_weight": F.round("unit_weight", 8)})


@query(
    "vector_arithmetic",
    """with p as (select vec_id, unnest(cast(embedding as double[])) as x from embeddings)
    select vec_id, round(sqrt(sum(x * x)), 8) as length, round(sum((x * 2 + x) * x), 8) as triple,
    cast(1 as double) as self_cosine from p group by vec_id""",
)
def _(spark, sf_dir):
    v = F.col("vector")
    return vectors(spark, sf_dir).select(
        "vec_id",
        F.round(arrays.norm(v), 8).alias("length"),
        F.round(arrays.dot(arrays.add(arrays.scale(v, F.lit(2.0)), v), v), 8).alias("triple"),
        F.round(arrays.cosine(v, v), 6).alias("self_cosine"),
    )


@query(
    "vector_means",
    """with p as (select label as cluster, unnest(cast(embedding as double[])) as x,
      generate_subscripts(embedding, 1) as dim from embeddings)
    select cluster, dim, round(avg(x), 6) as x from p group by cluster, dim""",
)
def _(spark, sf_dir):
    stats = clusters.cluster_stats(vectors(spark, sf_dir))
    return by_dimension(stats, ["cluster"], "centre")


def event_features(spark, sf_dir):
    rows = materialise(located(spark, sf_dir).withColumn("location_code", F.col("location")))
    return rows


def event_pipeline(components):
    return features.event_feature_pipeline(
        text=["category", "item_id", "region"],
        codes=["colour", "location", "page"],
        binary=["photo_type"],
        numeric=["price"],
        components=components,
    )


@query("pca_variance")
def _(spark, sf_dir):
    rows = event_features(spark, sf_dir)
    found = [(k, features.explained_variance(event_pipeline(k).fit(rows))) for k in (15, 20, 30)]
    return io.rows_frame(spark, found, "k int, explained_variance double")


@query("event_clusters")
def _(spark, sf_dir):
    rows = event_features(spark, sf_dir)
    reduced = materialise(event_pipeline(15).fit(rows).transform(rows).drop("vector"))
    model = KMeans(k=8, seed=55, maxIter=30, featuresCol="reduced", predictionCol="cluster").fit(reduced)
    kept = ["session_id", "price", "page", "photo_type", "item_id", "category", "colour", "country"]
    return profile.group_profile(materialise(clusters.assign(model, reduced, kept)), "cluster")


def sweep_points(spark, sf_dir):
    rows = event_features(spark, sf_dir)
    return materialise(event_pipeline(15).fit(rows).transform(rows).select("reduced"))


@query("kmeans_sweep")
def kmeans_sweep(spark, sf_dir):
    models = {
        "kmeans": KMeans(maxIter=30),
        "bisecting": BisectingKMeans(maxIter=50),
        "gmm": GaussianMixture(maxIter=20),
    }
    return clusters.k_sweep(models, sweep_points(spark, sf_dir), range(2, 5), features="reduced")


@query("best_k")
def _(spark, sf_dir):
    sweep = clusters.k_sweep({"kmeans": KMeans(maxIter=30)}, sweep_points(spark, sf_dir), (2, 4, 8), "reduced")
    return clusters.best_k(sweep)


@query("tfidf_clusters")
def _(spark, sf_dir):
    bags, _ = features.session_bags(clicks(spark, sf_dir))
    points = features.tfidf_pipeline().fit(bags := materialise(bags)).transform(bags)
    return clusters.k_sweep({"kmeans": KMeans(maxIter=30)}, materialise(points.select("unit_norm")), (3, 6), "unit_norm", "cosine")


@query(
    "session_bags",
    on_clicks(
        """select session_id, item_idx, cast(count(*) as double) as n, (select count(*) from idx) as size
        from clicks join idx using (item_id) group by session_id, item_idx""",
        INDEX_CTE,
    ),
)
def _(spark, sf_dir):
    bags, _ = features.session_bags(clicks(spark, sf_dir))
    dense = vector_to_array("bow")
    listed = bags.select("session_id", F.size(dense).cast("long").alias("size"), F.posexplode(dense).alias("item_idx", "n"))
    return listed.filter("n > 0").select("session_id", "item_idx", "n", "size")


def trained_vectors(found, rounds=1):
    docs = materialise(sequences.session_sequences(found))
    return embeddings.item_vectors(embeddings.fit_sequences(docs, rounds=rounds))


@query("word2vec_vectors")
def _(spark, sf_dir):
    found = trained_vectors(clicks(spark, sf_dir))
    return found.select("item_id", F.size("vector").alias("size"), arrays.norm(F.col("vector")).alias("length"))


@query("session_clusters")
def _(spark, sf_dir):
    c = materialise(clicks(spark, sf_dir))
    pooled = pooling.mean_pool(c, trained_vectors(c))
    from pyspark.ml.functions import array_to_vector

    points = materialise(pooled.select("session_id", array_to_vector("unit").alias("features")))
    model = KMeans(k=6, seed=52, maxIter=30, distanceMeasure="cosine", predictionCol="cluster").fit(points)
    members = materialise(clusters.assign(model, points, ["session_id"]))
    return profile.group_profile(materialise(c.join(members, "session_id")), "cluster")


@query("lda_sweep")
def lda_sweep(spark, sf_dir):
    bags, _ = features.session_bags(clicks(spark, sf_dir))
    return topics.lda_sweep(materialise(bags), range(2, 15), rounds=30)


@query("best_topics")
def _(spark, sf_dir):
    bags, _ = features.session_bags(clicks(spark, sf_dir))
    return topics.best_topics(topics.lda_sweep(materialise(bags), (2, 4, 6), rounds=30))


def topic_items(spark, sf_dir):
    bags, index = features.session_bags(clicks(spark, sf_dir))
    return materialise(topics.topic_terms(topics.fit_topics(materialise(bags), k=4, rounds=30), index))


@query("lda_topics")
def _(spark, sf_dir):
    attributes = click_facts(spark, sf_dir).select("item_id", "colour", "location", "photo_type").distinct()
    return topic_items(spark, sf_dir).join(attributes, "item_id", "left")


@query("topic_profile")
def _(spark, sf_dir):
    """Prices, pages, photos and modes of the clicks on the strongest items of each topic."""
    members = topic_items(spark, sf_dir).select("topic", "item_id")
    return profile.group_profile(clicks(spark, sf_dir).join(F.broadcast(members), "item_id"), "topic")  # 15 a topic


@query("als_recs")
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    numbers = materialise(factors.session_numbers(t.train))
    return factors.als_recs(factors.fit_als(t.train, numbers), numbers, t.train)


@query("als_foldin")
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    model = factors.fit_als(t.train, factors.session_numbers(t.train))
    items = factors.factor_frame(model.itemFactors, "item_idx")
    return factors.fold_in_recs(t.history, items, t.history)


@query(
    "given_foldin",
    on_clicks(
        """select session_id, round((b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12), 9) as x1,
        round((b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12), 9) as x2 from (
        select session_id, any_value(g11) + 0.1 + sum(w * x * x) as a11, any_value(g12) + sum(w * x * y) as a12,
          any_value(g22) + 0.1 + sum(w * y * y) as a22, sum((1 + w) * x) as b1, sum((1 + w) * y) as b2 from (
          select session_id, 80.0 * count(*) as w, any_value(v[1]) as x, any_value(v[2]) as y
          from clicks join vecs using (item_no) group by session_id, item_no),
          (select sum(v[1] * v[1]) as g11, sum(v[1] * v[2]) as g12, sum(v[2] * v[2]) as g22 from vecs)
        group by session_id)""",
        VECS_CTE,
    ),
)
def _(spark, sf_dir):
    """Fold-in with given item factors: two components of the vectors, where the normal equations have a closed form."""
    items = numbered(item_vectors(spark, sf_dir)).withColumn("vector", F.slice("vector", 1, 2))
    history = clicks(spark, sf_dir).groupBy("session_id", F.col("item_no").alias("item_idx")).agg(F.count(F.lit(1)).alias("click_count"))
    found = factors.fold_in(history, items, reg=0.1, alpha=80.0)
    return found.select("session_id", F.round(F.col("vector")[0], 9).alias("x1"), F.round(F.col("vector")[1], 9).alias("x2"))


@query("item2vec_recs")
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    docs = sequences.session_sequences(t.train_clicks)
    model = embeddings.fit_sequences(docs, rounds=20, seed=42)
    learnt = materialise(embeddings.item_vectors(model).join(t.index, "item_id").select("item_id", "item_idx", "vector"))
    pooled = pooling.decayed_pool(t.context, learnt, 0.8)
    return retrieval.cosine_recs(pooled, learnt, t.history)


#: Hash directions of the checked retrieval, the same on every machine.
DIRECTIONS = retrieval.random_directions(5, 64, 42)
LSH_CTE = (
    PREFIX_CTE
    + f""",
dirs as (select [{", ".join("[" + ", ".join(map(repr, row)) + "]" for row in DIRECTIONS.tolist())}]::double[][] as ds),
queries as (select session_id, click_order, any_value(next) as next, list(x order by dim) as q from pooled group by all),
asked as (select session_id, click_order, next, list_transform(q, lambda x: x / sqrt(list_dot_product(q, q))) as u from queries),
known as (select item_no, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as u from vecs),
qh as (select a.*, list_transform(ds, lambda d: floor(list_dot_product(u, d))) as h from asked a, dirs),
ih as (select k.*, list_transform(ds, lambda d: floor(list_dot_product(u, d))) as h from known k, dirs),
near as (select session_id, click_order, next, item_no as item_idx,
  round(sqrt(greatest(2 - 2 * round(list_dot_product(q.u, i.u), 9), 0)), 9) as distance
  from qh q, ih i where q.h[1] = i.h[1] or q.h[2] = i.h[2] or q.h[3] = i.h[3] or q.h[4] = i.h[4] or q.h[5] = i.h[5]),
recs as (select * from (select *, cast(row_number() over (partition by session_id, click_order, next
  order by distance, item_idx) as int) as rank from near where distance <= 1.3) where rank <= 10)"""
)


def lsh_recs(spark, sf_dir):
    c, items = clicks(spark, sf_dir), item_vectors(spark, sf_dir)
    prefixes = pooling.prefix_pool(c, items, 0.01, "item_no")
    # clicks are numbered within their session, so a prefix has its own (session, click)
    return retrieval.lsh_recs(prefixes, numbered(items), ["session_id", "click_order", "next"], directions=DIRECTIONS, unique_ids=True)


@query("lsh_retrieval", on_clicks("select * from recs", LSH_CTE))
def _(spark, sf_dir):
    return lsh_recs(spark, sf_dir)


@query(
    "lsh_metrics",
    on_clicks(
        """select round(avg(hit), 9) as recall, round(avg(gain), 9) as ndcg, count(*) as prefixes from (
        select max(cast(item_idx = next as int)) as hit, max(case when item_idx = next then 1.0 / log2(rank + 1.0) else 0.0 end) as gain
        from recs group by session_id, click_order)""",
        LSH_CTE,
    ),
)
def _(spark, sf_dir):
    row = evaluate.prefix_metrics(lsh_recs(spark, sf_dir))
    return row.withColumns({c: F.round(c, 9) for c in ("recall", "ndcg")})


@query(
    "sample_by_cluster",
    on_clicks(
        """select location, count(distinct session_id) as sessions from clicks
        where substring(md5(concat('42:', location, '/', session_id)), 1, 8) < '1999999a' group by location"""
    ),
)
def _(spark, sf_dir):
    drawn = splits.sample_by_group(clicks(spark, sf_dir), "location", 0.1)
    return drawn.groupBy("location").agg(F.count_distinct("session_id").alias("sessions"))


def fresh_folder(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


@query("roundtrip_parquet", on_clicks("select session_id, click_order, item_id, price, click_date from clicks"))
def _(spark, sf_dir):
    path = fresh_folder(spark)
    rows = clicks(spark, sf_dir).select("session_id", "click_order", "item_id", "price", "click_date")
    io.write_parquet(rows, path, ["click_date"])
    return io.read_parquet(spark, path).select(rows.columns)


RAW_SQL = """select session_id, click_order, country, item_id, cast(colour as varchar) as colour,
        cast(location as varchar) as location, cast(photo_type as varchar) as photo_type,
        cast(category as varchar) as category, cast(round(price * 100) as int) as price, page, click_date,
        price_above_avg from (select * replace (case category when 'click' then 1 when 'error' then 2
          when 'purchase' then 3 when 'signup' then 4 else 5 end as category) from clicks)"""


def raw_clicks(spark, sf_dir):
    """Clicks in the raw layout: whole-number codes and split dates."""
    kinds = F.array(*[F.lit(c) for c in ("click", "error", "purchase", "signup", "view")])
    rows = clicks(spark, sf_dir, premium=True).withColumns(
        {
            "year": F.year("click_date"),
            "month": F.month("click_date"),
            "day": F.day("click_date"),
            "category": F.array_position(kinds, F.col("category")).cast("int"),
            "price": F.round(F.col("price") * 100).cast("int"),
            "price_2": F.when(F.col("price_above_avg"), 1).otherwise(2),
        }
    )
    return rows.select([f.name for f in S.RAW_CLICKS])


@query("roundtrip_csv", on_clicks(RAW_SQL))
def _(spark, sf_dir):
    path = fresh_folder(spark)
    raw_clicks(spark, sf_dir).write.options(sep=";", header=True).csv(path)
    return io.clean_clicks(io.read_clicks_csv(spark, path))


@query("csv_inferred", on_clicks("select count(*) as clicks, count(distinct item_id) as items, cast(sum(page) as bigint) as pages from clicks"))
def _(spark, sf_dir):
    path = fresh_folder(spark)
    headed = raw_clicks(spark, sf_dir).withColumnsRenamed(
        {"session_id": "session ID", "category": "page 1 (main category)", "item_id": "page 2 (clothing model)"}
    )
    headed.write.options(sep=";", header=True).csv(path)
    read = io.read_clicks_csv_inferred(spark, path)
    return read.agg(
        F.count("session_id").alias("clicks"),
        F.count_distinct("page_2_clothing_model").alias("items"),
        F.sum("page").alias("pages"),
    )


@query("roundtrip_json")
def _(spark, sf_dir):
    path, t = fresh_folder(spark), track(spark, sf_dir)
    models = {name: recs for name, recs in model_recs(t).items() if name != "markov"}
    io.write_metrics(metric_rows(t, models, ["warm"]), path)
    return io.nested_metrics(io.read_metrics(spark, path))


#: Parameters of the learnt models, as the document reports them.
PARAMS = {
    "als": {"rank": factors.RANK, "alpha": factors.ALPHA, "regParam": factors.REG},
    "item2vec": {"vectorSize": 32, "windowSize": 5, "maxIter": 20, "minCount": 5},
}


@query(
    "metrics_document",
    on_clicks(
        f"""select 'metrics' as section, track || '/' || model as owner, metric as name, value from ({_long_sql(SQL_NAMES, ["warm", "cold"])})
        where value is not null
        union all select 'top_items', cast(row_number() over (order by views desc, item_id) as varchar), item_id, cast(views as double) from (
          select item_id, cast(sum(click_count) as bigint) as views from train join idx using (item_idx)
          group by item_id order by views desc, min(item_idx) limit 10)
        union all select 'params', o, n, cast(v as double) from (values {", ".join(f"('{o}', '{n}', {v})" for o, x in PARAMS.items() for n, v in x.items())}) p(o, n, v)""",
        ALL_CTE,
    ),
)
def _(spark, sf_dir):
    path, t = fresh_folder(spark), track(spark, sf_dir)
    top = evaluate.most_viewed(t.train, t.index).select("item_id", F.col("clicks").alias("views"))
    io.write_document(metric_rows(t, model_recs(t)), top, PARAMS, path)
    return io.read_document(spark, path).filter("value is not null")


@query("model_comparison_all")
def _(spark, sf_dir):
    """All five models on both tracks; the learnt ones have no SQL."""
    t = track(spark, sf_dir)
    words = sequences.session_sequences(t.train_clicks)
    # the rounds over item sequences keep no more cores busy than their partitions; the other models take the rest
    with beside(spark, lambda: embeddings.fit_sequences(words, rounds=20, seed=42)) as trained:
        models = model_recs(t)
        fitted = factors.fit_als(t.train, factors.session_numbers(t.train))
        models["als"] = materialise(factors.fold_in_recs(t.history, factors.factor_frame(fitted.itemFactors, "item_idx"), t.history))
        model = trained.result()
    learnt = materialise(embeddings.item_vectors(model).join(t.index, "item_id").select("item_id", "item_idx", "vector"))
    models["item2vec"] = materialise(retrieval.cosine_recs(pooling.decayed_pool(t.context, learnt, 0.8), learnt, t.history))
    return evaluate.compare_models(metric_rows(t, models))


@query(
    "profile_csv",
    on_clicks(
        """select cast(location as int) as location, cast(to_json(list_sort(list(distinct cast(colour as varchar)))) as varchar) as colour_set
        from clicks group by location"""
    ),
)
def _(spark, sf_dir):
    path = fresh_folder(spark)
    io.write_csv(profile.code_sets(click_facts(spark, sf_dir), "location", ["colour"]), path)
    layout = T.StructType([T.StructField("location", T.IntegerType()), T.StructField("colour_set", T.StringType())])
    return spark.read.schema(layout).options(header=True, escape='"').csv(path)


@query("model_roundtrip", on_clicks("select distinct session_id, true as same from clicks"))
def _(spark, sf_dir):
    rows = materialise(sessions.session_label(sessions.session_summary(clicks(spark, sf_dir, premium=True))))
    path = fresh_folder(spark)

    def fit():
        return features.session_feature_pipeline().fit(rows)

    first = io.load_or_fit(PipelineModel, path, fit)
    again = io.load_or_fit(PipelineModel, path, fit)
    left = first.transform(rows).select("session_id", vector_values("features").alias("fitted"))
    right = again.transform(rows).select("session_id", vector_values("features").alias("loaded"))
    return left.join(right, "session_id").select("session_id", (F.col("fitted") == F.col("loaded")).alias("same"))
