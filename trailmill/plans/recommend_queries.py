"""Queries on the click graph, recommenders and their evaluation."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from trailmill.operators import evaluate, graph, profile, recommend, splits
from trailmill.plans.explore_queries import GROUP_PROFILE
from trailmill.plans.registry import on_clicks, query
from trailmill.plans.sequence_queries import CUTOFF, MOVES_CTE, SPLIT_CTE
from trailmill.scale import bounded_side, materialise
from trailmill.sources.tables import click_facts, clicks

EDGES_CTE = """
moves as (
  select src, dst, count(*) as moves from (
    select item_no as src, lead(item_no) over (partition by session_id order by click_order) as dst from clicks)
  where dst is not null group by src, dst),
edges as (
  select src, dst, ln(moves) as weight from moves
  where moves >= (select quantile_cont(moves, 0.95) from moves) and src <> dst),
verts as (select src as id from edges union select dst from edges)"""


def pruned(spark, sf_dir):
    edges = materialise(graph.prune(graph.click_edges(clicks(spark, sf_dir), "item_no")))
    vertices = graph.connected_vertices(graph.click_vertices(click_facts(spark, sf_dir), "item_no"), edges)
    return materialise(vertices), edges


@query("graph_edges", on_clicks("select src, dst, moves as weight from moves", EDGES_CTE))
def _(spark, sf_dir):
    return graph.click_edges(clicks(spark, sf_dir), "item_no")


@query("graph_pruned", on_clicks("select src, dst, round(weight, 9) as weight from edges", EDGES_CTE))
def _(spark, sf_dir):
    return graph.prune(graph.click_edges(clicks(spark, sf_dir), "item_no")).withColumn(
        "weight", F.round("weight", 9)
    )


@query(
    "graph_isolated",
    on_clicks(
        """select distinct item_no as id, colour, item_no in (select id from verts) as connected
        from clicks""",
        EDGES_CTE,
    ),
)
def _(spark, sf_dir):
    connected, _ = pruned(spark, sf_dir)
    everything = graph.click_vertices(click_facts(spark, sf_dir), "item_no", ("colour",))
    return everything.join(connected.withColumn("c", F.lit(True)), "id", "left").select(
        "id", "colour", F.coalesce("c", F.lit(False)).alias("connected")
    )


def _pagerank_sql(rounds):
    ctes = [EDGES_CTE, "links as (select src, dst, 1.0 / count(*) over (partition by src) as share from edges)",
            "r0 as (select id, cast(1 as double) as rank from verts)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""r{i} as materialized (select id, 0.15 + 0.85 * coalesce(sum(gain), 0) as rank from verts left join
            (select dst, rank * share as gain from links join r{i - 1} on src = id) on dst = verts.id group by id)"""
        )
    return on_clicks(f"select id, round(rank, 8) as rank from r{rounds}", ",".join(ctes))


@query("pagerank_5", _pagerank_sql(5))
def _(spark, sf_dir):
    ranks = graph.pagerank(*pruned(spark, sf_dir), rounds=5)
    return ranks.select("id", F.round("rank", 8).alias("rank"))


@query("pagerank_100", _pagerank_sql(100))
def _(spark, sf_dir):
    ranks = graph.pagerank(*pruned(spark, sf_dir), rounds=100)
    return ranks.select("id", F.round("rank", 8).alias("rank"))


@query(
    "components",
    on_clicks(
        "select id, min(other) as component from reach group by id",
        EDGES_CTE
        + """, near as (select src as id, dst as other from edges union select dst, src from edges),
        reach as (select id, id as other from verts
          union select reach.id, near.other from reach join near on reach.other = near.id)""",
    ),
)
def _(spark, sf_dir):
    return graph.components(*pruned(spark, sf_dir)).select("id", "component")


@query(
    "triangles",
    on_clicks(
        """select x.src as a, y.src as b, z.src as c from edges x join edges y on x.dst = y.src
        join edges z on y.dst = z.src and z.dst = x.src""",
        EDGES_CTE,
    ),
)
def _(spark, sf_dir):
    return graph.triangles(pruned(spark, sf_dir)[1])


def _label_cte(rounds):
    ctes = [EDGES_CTE, "ends as (select src as id, dst as other from edges union all select dst, src from edges)",
            "l0 as (select id, id as label from verts)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""l{i} as materialized (select id, label from (select ends.id, label, row_number() over
            (partition by ends.id order by count(*) desc, label) as rn
            from ends join l{i - 1} p on ends.other = p.id group by ends.id, label) where rn = 1)"""
        )
    return ",".join(ctes)


@query("label_prop_3", on_clicks("select id, label from l3", _label_cte(3)))
def label_prop_3(spark, sf_dir):
    return graph.label_propagation(*pruned(spark, sf_dir), rounds=3).select("id", "label")


@query("label_prop_10", on_clicks("select id, label from l10", _label_cte(10)))
def label_prop_10(spark, sf_dir):
    return graph.label_propagation(*pruned(spark, sf_dir), rounds=10).select("id", "label")


@query(
    "community_profile",
    on_clicks(
        " union all ".join(
            f"""select label, '{c}' as "column", mode, mode_rows, distinct_values, group_rows from (
            select label, cast({c} as varchar) as mode, count(*) as mode_rows,
            count(*) over (partition by label) as distinct_values,
            cast(sum(count(*)) over (partition by label) as bigint) as group_rows,
            row_number() over (partition by label order by count(*) desc, cast({c} as varchar)) as rn
            from clicks join l3 on item_no = id group by label, {c}) where rn = 1"""
            for c in ("colour", "category", "location")
        ),
        _label_cte(3),
    ),
)
def _(spark, sf_dir):
    members = label_prop_3(spark, sf_dir).withColumnRenamed("id", "item_no")
    labelled = click_facts(spark, sf_dir).join(members, "item_no")
    return profile.group_modes(labelled, "label", ["colour", "category", "location"])


LABELLED_CTE = _label_cte(10) + ", labelled as (select clicks.*, label from clicks join l10 on item_no = id)"


def labelled_clicks(spark, sf_dir):
    """Clicks with the community of their item."""
    members = label_prop_10(spark, sf_dir).withColumnRenamed("id", "item_no")
    return clicks(spark, sf_dir).join(bounded_side(members), "item_no")


@query(
    "community_full_profile",
    on_clicks(GROUP_PROFILE.replace("location", "label").replace("from clicks", "from labelled"), LABELLED_CTE),
)
def _(spark, sf_dir):
    out = profile.group_profile(labelled_clicks(spark, sf_dir), "label")
    return out.withColumns({c: F.round(c, 6) for c in ("price_std", "p05", "q1", "median_price", "q3", "p95")})


@query(
    "community_pair_counts",
    on_clicks("select label, colour, photo_type, count(*) as clicks from labelled group by all", LABELLED_CTE),
)
def _(spark, sf_dir):
    return profile.pair_counts(labelled_clicks(spark, sf_dir), ["label", "colour", "photo_type"])


@query(
    "community_sample",
    on_clicks(
        """select label, session_id, click_order, pick from (select *, cast(row_number() over (partition by label
        order by md5(concat('42:', session_id, ':', click_order)), session_id, click_order) as int) as pick from labelled)
        where pick <= 5""",
        LABELLED_CTE,
    ),
)
def _(spark, sf_dir):
    drawn = profile.sample_per_group(labelled_clicks(spark, sf_dir), "label", ["session_id", "click_order"], 5, seed=42)
    return drawn.select("label", "session_id", "click_order", "pick")


@query("power_iteration")
def _(spark, sf_dir):
    return graph.power_iteration(pruned(spark, sf_dir)[1], k=10, rounds=50)


@query(
    "path_counts",
    on_clicks(
        """select z.src, z.dst, count(*) as paths from edges x join edges y on x.dst = y.src
        join edges z on y.dst = z.src group by all""",
        EDGES_CTE,
    ),
)
def _(spark, sf_dir):
    return graph.path_counts(pruned(spark, sf_dir)[1]).select("src", "dst", "paths")


@query(
    "path_recs",
    on_clicks(
        """select session_id, n1, n2, n3, next, round(score, 9) as score, rank from (
        select session_id, n1, n2, n3, dst as next, weight as score,
        cast(row_number() over (partition by session_id order by weight desc, dst) as int) as rank
        from tails join edges on n3 = src
        where exists (from edges e where e.src = n1 and e.dst = n2)
          and exists (from edges e where e.src = n2 and e.dst = n3)) where rank <= 10""",
        EDGES_CTE
        + """, tails as (select session_id, n1, n2, n3 from (select session_id, item_no as n3,
          lag(item_no) over w as n2, lag(item_no, 2) over w as n1, lead(item_no) over w as nx
          from clicks window w as (partition by session_id order by click_order)) where nx is null and n1 is not null)""",
    ),
)
def _(spark, sf_dir):
    contexts = graph.last_clicks(clicks(spark, sf_dir), "item_no", 3)
    recs = graph.path_recommendations(contexts, pruned(spark, sf_dir)[1])
    return recs.select("session_id", "n1", "n2", "n3", "next", F.round("score", 9).alias("score"), "rank")


INDEX_CTE = """
idx as (select item_id, cast(row_number() over (order by count(*) desc, item_id) - 1 as int) as item_idx
  from clicks group by item_id)"""
TRACK_CTE = (
    SPLIT_CTE
    + ","
    + INDEX_CTE
    + """,
train as (select session_id, item_idx, count(*) as click_count from parted join idx using (item_id)
  where in_train group by all),
held as (select parted.*, item_idx, max(click_order) over (partition by session_id) as last_order
  from parted join idx using (item_id) where not in_train),
truth as (select session_id, item_idx, last_order = 2 as is_cold from held
  where click_order = last_order and last_order > 1),
ctx as (select session_id, item_idx, item_id, click_order, last_order = 2 as is_cold from held
  where click_order < last_order),
history as (select session_id, item_idx, count(*) as click_count, any_value(is_cold) as is_cold from ctx group by all)"""
)

SIM_CTE = """
norms as (select item_idx, sum(click_count * click_count) as n2 from train group by item_idx),
sims as (select * from (select *, cast(row_number() over (partition by seed_idx order by similarity desc, target_idx) as int)
    as neighbour_rank from (
  select a.item_idx as seed_idx, b.item_idx as target_idx,
    cast(sum(a.click_count * b.click_count) as double) / sqrt(cast(na.n2 as double) * cast(nb.n2 as double)) as similarity
  from train a join train b on a.session_id = b.session_id and a.item_idx <> b.item_idx
  join norms na on na.item_idx = a.item_idx join norms nb on nb.item_idx = b.item_idx
  group by a.item_idx, b.item_idx, na.n2, nb.n2)) where neighbour_rank <= 50)"""


def _ranked_sql(name, scores):
    """Top 10 of a (session_id, item_idx, score) select, seen items removed."""
    return f"""
{name} as (select session_id, item_idx, score, rank from (
  select *, cast(row_number() over (partition by session_id order by score desc, item_idx) as int) as rank from (
    select session_id, item_idx, round(score, 9) as score from ({scores}) s
    where not exists (from ctx where ctx.session_id = s.session_id and ctx.item_idx = s.item_idx)))
  where rank <= 10)"""


POPULAR = "select t.session_id, p.item_idx, cast(p.score as double) as score from truth t, (select item_idx, sum(click_count) as score from train group by item_idx) p"
KNN = "select session_id, target_idx as item_idx, sum(click_count * similarity) as score from history join sims on item_idx = seed_idx group by all"
MARKOV = """select c.session_id, d.item_idx, weight as score from (select session_id, max_by(item_id, click_order) as src
  from ctx group by session_id) c join trans using (src) join idx d on d.item_id = trans.dst"""
MARKOV_CTE = MOVES_CTE.replace("from clicks)", "from parted where in_train)")
POPULAR_CTE = TRACK_CTE + "," + _ranked_sql("popular", POPULAR)
KNN_CTE = TRACK_CTE + "," + SIM_CTE + "," + _ranked_sql("knn", KNN)
BOTH_CTE = KNN_CTE + "," + _ranked_sql("popular", POPULAR)


class Track:
    """Temporal train and test frames; each is written on first use and then read back."""

    def __init__(self, spark, sf_dir):
        self.raw = clicks(spark, sf_dir)

    @cached_property
    def split(self):
        used = ["session_id", "click_order", "item_id", "item_no", "click_date"]
        parted = splits.temporal_split(materialise(self.raw.select(used)), CUTOFF)
        return materialise(parted.drop("click_date"))

    @cached_property
    def index(self):
        return materialise(recommend.item_index(self.split))

    @property
    def train_clicks(self):
        return self.split.filter("in_train")

    @cached_property
    def train(self):
        return materialise(recommend.interactions(self.train_clicks, self.index))

    @cached_property
    def held(self):
        return materialise(splits.leave_last_out(self.split.filter("not in_train").drop("in_train")))

    @property
    def context(self):
        return splits.context(self.held)

    @cached_property
    def truth(self):
        found = splits.ground_truth(self.held).join(self.index, "item_id")
        return materialise(found.select("session_id", "item_idx", "is_cold"))

    @cached_property
    def history(self):
        return materialise(recommend.interactions(self.context, self.index))


def track(spark, sf_dir):
    return Track(spark, sf_dir)


@query("item_index", on_clicks("select * from idx", INDEX_CTE))
def _(spark, sf_dir):
    return recommend.item_index(click_facts(spark, sf_dir))


@query("interaction_counts", on_clicks("select * from train", TRACK_CTE))
def _(spark, sf_dir):
    return track(spark, sf_dir).train


@query("item_similarity", on_clicks("select * from sims", TRACK_CTE + "," + SIM_CTE))
def _(spark, sf_dir):
    return recommend.item_similarity(track(spark, sf_dir).train)


@query("popularity_recs", on_clicks("select * from popular", POPULAR_CTE))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    return recommend.popularity_recs(t.truth, t.train, t.history)


@query("knn_recs", on_clicks("select * from knn", KNN_CTE))
def knn(spark, sf_dir):
    t = track(spark, sf_dir)
    return recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)


COLD_CTE = TRACK_CTE + "," + SIM_CTE + "," + _ranked_sql("cold", KNN.replace("from history", "from (select * from history where is_cold) h"))


@query("cold_recs", on_clicks("select * from cold", COLD_CTE))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    cold = t.history.join(t.truth.filter("is_cold").select("session_id"), "session_id", "left_semi")
    return recommend.knn_recs(cold, recommend.item_similarity(t.train), cold)


@query("markov_recs", on_clicks("select * from markov", TRACK_CTE + "," + MARKOV_CTE + "," + _ranked_sql("markov", MARKOV)))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    recs = recommend.markov_recs(t.context, t.train_clicks, t.index)
    return recs.withColumn("score", F.round("score", 9))


def _metrics_sql(recs):
    return f"""select round(avg(coalesce(1.0 / rank, 0)), 9) as mrr, round(avg(case when rank is null then 0 else 1 end / 10.0), 9)
        as precision, round(avg(case when rank is null then 0.0 else 1.0 end), 9) as recall, count(*) as sessions
        from truth left join {recs} using (session_id, item_idx)"""


def _rounded(df):
    return df.withColumns({f.name: F.round(f.name, 9) for f in df.schema if f.dataType.typeName() == "double"})


@query(
    "rank_metrics",
    on_clicks(
        f"select 'knn' as model, * from ({_metrics_sql('knn')}) union all select 'popularity', * from ({_metrics_sql('popular')})",
        BOTH_CTE,
    ),
)
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    knn = recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)
    popular = recommend.popularity_recs(t.truth, t.train, t.history)
    frames = [
        evaluate.rank_metrics(recs, t.truth).withColumn("model", F.lit(name))
        for name, recs in (("knn", knn), ("popularity", popular))
    ]
    return _rounded(frames[0].unionByName(frames[1]))


NOVELTY = """select count(distinct k.item_idx) as unique_items,
        round(count(distinct k.item_idx) / cast(any_value(catalogue) as double), 9) as coverage,
        round(avg(-log2(p.c / cast(total as double))), 9) as novelty
        from {} k left join (select item_idx, sum(click_count) as c from train group by item_idx) p using (item_idx),
        (select sum(click_count) as total from train), (select count(*) as catalogue from idx)"""


@query("coverage_novelty", on_clicks(NOVELTY.format("knn"), KNN_CTE))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    recs = recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)
    return _rounded(evaluate.coverage_novelty(recs, t.train, t.index.count()))


@query(
    "prefix_metrics",
    on_clicks(
        """select round(avg(hit), 9) as recall, round(avg(ndcg), 9) as ndcg, count(*) as prefixes from (
        select k.session_id, max(cast(k.item_idx = t.item_idx as int)) as hit,
        max(case when k.item_idx = t.item_idx then 1.0 / log2(k.rank + 1.0) else 0.0 end) as ndcg
        from knn k join truth t on k.session_id = t.session_id group by k.session_id)""",
        KNN_CTE,
    ),
)
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    recs = recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)
    held = t.truth.select("session_id", F.col("item_idx").alias("next"), F.lit(0).alias("click_order"))
    return _rounded(evaluate.prefix_metrics(recs.join(held, "session_id")))


MODELS = ("popularity", "knn", "markov")


def model_recs(t):
    """Recommendations of the models whose results SQL can repeat, each written once."""
    return {
        "popularity": materialise(recommend.popularity_recs(t.truth, t.train, t.history)),
        "knn": materialise(recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)),
        "markov": materialise(recommend.markov_recs(t.context, t.train_clicks, t.index)),
    }


def metric_rows(t, models, tracks=("warm", "cold")):
    """All five metrics of every model, over all sessions and over those with one known click.

    The lists of all models are read twice, however many models and tracks there are.
    """
    lists = None
    for name, recs in models.items():
        part = recs.select("session_id", "item_idx", "rank", F.lit(name).alias("model"))
        lists = part if lists is None else lists.unionByName(part)
    marked = lists
    if "cold" in tracks:
        cold = t.truth.filter("is_cold").select("session_id").distinct().withColumn("cold", F.lit(True))
        marked = lists.join(bounded_side(cold), "session_id", "left")
    cells = [(track_name, name) for track_name in tracks for name in models]
    own = {(track_name, name): F.col("model") == name for track_name, name in cells}
    found = {cell: (own[cell], F.col("is_cold") if cell[0] == "cold" else F.lit(True)) for cell in cells}
    shown = {cell: own[cell] & F.coalesce("cold", F.lit(False)) if cell[0] == "cold" else own[cell] for cell in cells}
    frames = [
        evaluate.rank_metrics(lists, t.truth, cells=found).drop("sessions"),
        evaluate.coverage_novelty(marked, t.train, t.index.count(), cells=shown).drop("unique_items"),
    ]
    long = [evaluate.long_metrics(F.col("track"), F.col("model"), _rounded(f)) for f in frames]
    return long[0].unionByName(long[1])


def _long_sql(models, tracks):
    parts = []
    for track_name in tracks:
        cold = track_name == "cold"
        truth = "(select * from truth where is_cold)" if cold else "truth"
        for model, name in models.items():
            recs = f"(select * from {name} where session_id in (select session_id from truth where is_cold))" if cold else name
            for metric in ("mrr", "precision", "recall"):
                ranked = _metrics_sql(f"{recs} r").replace("from truth left join", f"from {truth} t left join")
                parts.append(f"select '{track_name}' as track, '{model}' as model, '{metric}' as metric, cast({metric} as double) as value from ({ranked})")
            for metric in ("coverage", "novelty"):
                parts.append(f"select '{track_name}', '{model}', '{metric}', {metric} from ({NOVELTY.format(recs)})")
    return " union all ".join(parts)


def _compared_sql(models, tracks):
    return f"""select track, model, metric, value, round(value - base, 9) as delta,
        round(case when base <> 0 then (value - base) / base end, 9) as change, model = best as is_best from (
        select *, max(case when model = 'popularity' then value end) over (partition by track, metric) as base,
        max_by(model, {{'v': value, 'm': model}}) over (partition by track, metric) as best from ({_long_sql(models, tracks)}))"""


@query("model_comparison", on_clicks(_compared_sql({"knn": "knn", "popularity": "popular"}, ["warm"]), BOTH_CTE))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    models = {
        "knn": materialise(recommend.knn_recs(t.history, recommend.item_similarity(t.train), t.history)),
        "popularity": materialise(recommend.popularity_recs(t.truth, t.train, t.history)),
    }
    return _rounded(evaluate.compare_models(metric_rows(t, models, ["warm"])))


ALL_CTE = BOTH_CTE + "," + MARKOV_CTE + "," + _ranked_sql("markov", MARKOV)
SQL_NAMES = {"popularity": "popular", "knn": "knn", "markov": "markov"}


@query("model_comparison_tracks", on_clicks(_compared_sql(SQL_NAMES, ["warm", "cold"]), ALL_CTE))
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    return _rounded(evaluate.compare_models(metric_rows(t, model_recs(t))))


@query(
    "top_items",
    on_clicks(
        """select item_idx, item_id, cast(sum(click_count) as bigint) as clicks from train join idx using (item_idx)
        group by all order by clicks desc, item_idx limit 10""",
        TRACK_CTE,
    ),
)
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    return evaluate.most_viewed(t.train, t.index).select("item_idx", "item_id", "clicks")


COLD_BOTH_CTE = (
    TRACK_CTE.replace("truth as (", "all_truth as (").replace(
        "ctx as (", "truth as (select * from all_truth where is_cold),\nctx as ("
    )
    + ","
    + SIM_CTE
    + ","
    + _ranked_sql("knn", KNN.replace("from history", "from (select * from history where is_cold) h"))
    + ","
    + _ranked_sql("popular", POPULAR)
)


@query(
    "cold_metrics",
    on_clicks(
        f"select 'knn' as model, * from ({_metrics_sql('knn')}) union all select 'popularity', * from ({_metrics_sql('popular')})",
        COLD_BOTH_CTE,
    ),
)
def _(spark, sf_dir):
    t = track(spark, sf_dir)
    truth = materialise(t.truth.filter("is_cold"))
    history = materialise(t.history.join(truth.select("session_id"), "session_id", "left_semi"))
    knn = recommend.knn_recs(history, recommend.item_similarity(t.train), history)
    popular = recommend.popularity_recs(truth, t.train, history)
    frames = [
        evaluate.rank_metrics(recs, truth).withColumn("model", F.lit(name))
        for name, recs in (("knn", knn), ("popularity", popular))
    ]
    return _rounded(frames[0].unionByName(frames[1]))
