"""Queries on tokens, sequences, splits, frequencies and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmill.operators import frequency, rules, sequences, splits
from trailmill.operators.cooccurrence import pair_sums
from trailmill.plans.registry import on_baskets, on_clicks, query
from trailmill.scale import materialise
from trailmill.sources.tables import baskets, click_facts, clicks

TOKEN_COLUMNS = ["category", "item_id", "colour", "location", "photo_type"]
TOKEN_SQL = "md5(concat_ws(chr(31), category, item_id, colour, location, photo_type))"
CUTOFF = "2024-01-20"


@query(
    "leave_last_out",
    on_clicks(
        """select session_id, click_order, item_id,
        click_order = max(click_order) over (partition by session_id) as is_truth from clicks"""
    ),
)
def _(spark, sf_dir):
    return splits.leave_last_out(clicks(spark, sf_dir)).select("session_id", "click_order", "item_id", "is_truth")


@query(
    "leave_last_out_gaps",
    on_clicks(
        """select session_id, click_order, nullif(item_id, 'K7') as item_id,
        click_order = max(click_order) over (partition by session_id) as is_truth from clicks"""
    ),
)
def _(spark, sf_dir):
    gaps = clicks(spark, sf_dir).withColumn("item_id", F.nullif("item_id", F.lit("K7")))
    return splits.leave_last_out(gaps).select("session_id", "click_order", "item_id", "is_truth")


@query(
    "next_click",
    on_clicks(
        """select session_id, click_order, item_id, lead(item_id) over w as next,
        lead(item_id, 3) over w as third from clicks window w as (partition by session_id order by click_order)"""
    ),
)
def _(spark, sf_dir):
    one = sequences.next_click(clicks(spark, sf_dir).select("session_id", "click_order", "item_id"))
    return sequences.next_click(one.withColumnRenamed("next", "n1"), ahead=3).select(
        "session_id", "click_order", "item_id", F.col("n1").alias("next"), F.col("next").alias("third")
    )


@query("tokens", on_clicks(f"select distinct {', '.join(TOKEN_COLUMNS)}, {TOKEN_SQL} as token from clicks"))
def _(spark, sf_dir):
    return sequences.tokens(click_facts(spark, sf_dir), TOKEN_COLUMNS)


@query(
    "tokenised_clicks",
    on_clicks(
        f"""select session_id, click_order, case when {TOKEN_SQL} in
        (select {TOKEN_SQL} from clicks where click_date < date '2024-01-05') then {TOKEN_SQL} end as token from clicks"""
    ),
)
def _(spark, sf_dir):
    early = click_facts(spark, sf_dir).filter(F.col("click_date") < F.lit("2024-01-05").cast("date"))
    known = sequences.tokens(early, TOKEN_COLUMNS)
    return sequences.tokenise(clicks(spark, sf_dir), TOKEN_COLUMNS, known).select(
        "session_id", "click_order", "token"
    )


@query(
    "session_sequences",
    on_clicks(
        """select session_id, cast(0 as bigint) as segment, string_agg(item_id, '>' order by click_order) as items,
        count(*) as n from clicks group by session_id"""
    ),
)
def _(spark, sf_dir):
    out = sequences.session_sequences(clicks(spark, sf_dir))
    return out.select(
        "session_id", "segment", F.array_join("sequence", ">").alias("items"),
        F.size("sequence").cast("long").alias("n"),
    )


@query(
    "prefix_sequences",
    on_clicks(
        """select * from (select session_id, click_order, cast(0 as bigint) as segment,
        string_agg(item_id, '>') over (partition by session_id order by click_order
          rows between unbounded preceding and current row) as prefix,
        lead(item_id) over (partition by session_id order by click_order) as next from clicks)
        where next is not null"""
    ),
)
def _(spark, sf_dir):
    return sequences.prefix_sequences(clicks(spark, sf_dir)).withColumn("prefix", F.array_join("prefix", ">"))


COLLAPSE = """select session_id, click_order, category from (select *,
        lead(category) over (partition by session_id order by click_order) as nxt from clicks)
        where {}"""


@query("collapse_repeats", on_clicks(COLLAPSE.format("nxt is null or nxt <> category")))
def _(spark, sf_dir):
    return sequences.collapse_repeats(clicks(spark, sf_dir), "category").select(
        "session_id", "click_order", "category"
    )


@query("collapse_drop_last", on_clicks(COLLAPSE.format("nxt <> category")))
def _(spark, sf_dir):
    return sequences.collapse_repeats(clicks(spark, sf_dir), "category", keep_last_run=False).select(
        "session_id", "click_order", "category"
    )


MOVES_CTE = """
moves as (
  select src, dst, count(*) as moves from (
    select item_id as src, lead(item_id) over (partition by session_id order by click_order) as dst from clicks)
  where dst is not null group by src, dst),
trans as (
  select src, dst, moves, moves / cast(total as double) as weight
  from (select *, cast(sum(moves) over (partition by src) as bigint) as total from moves) where src <> dst)"""


@query("transitions", on_clicks("select * from trans", MOVES_CTE))
def _(spark, sf_dir):
    return sequences.transitions(clicks(spark, sf_dir))


@query(
    "stratified_split_sizes",
    on_clicks(
        """select length, count(*) as sessions,
        count(case when substring(md5(concat('42:', session_id)), 1, 8) < 'cccccccd' then 1 end) as train_sessions
        from (select session_id, count(*) as length from clicks group by session_id) group by length"""
    ),
)
def _(spark, sf_dir):
    split = splits.stratified_split(clicks(spark, sf_dir), 0.8, seed=42)
    per_session = split.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("length"), F.first("in_train").alias("in_train")
    )
    return per_session.groupBy("length").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("in_train").alias("train_sessions")
    )


SPLIT_CTE = f"""
firsts as (select session_id, min(click_date) < date '{CUTOFF}' as in_train from clicks group by session_id),
parted as (select clicks.*, in_train from clicks join firsts using (session_id))"""


@query(
    "temporal_split_sizes",
    on_clicks(
        "select in_train, count(*) as clicks, count(distinct session_id) as sessions from parted group by in_train",
        SPLIT_CTE,
    ),
)
def _(spark, sf_dir):
    split = splits.temporal_split(clicks(spark, sf_dir), CUTOFF)
    return split.groupBy("in_train").agg(
        F.count(F.lit(1)).alias("clicks"), F.count_distinct("session_id").alias("sessions")
    )


@query(
    "warm_cold_sizes",
    on_clicks(
        """select n = 2 as is_cold, count(*) as sessions, cast(sum(n - 1) as bigint) as context_clicks from (
        select session_id, count(*) as n from parted where not in_train group by session_id) where n > 1 group by 1""",
        SPLIT_CTE,
    ),
)
def _(spark, sf_dir):
    test = splits.temporal_split(clicks(spark, sf_dir), CUTOFF).filter(~F.col("in_train"))
    truth = splits.ground_truth(splits.leave_last_out(test))
    return truth.groupBy("is_cold").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("n_context").alias("context_clicks")
    )


RANKED_CTE = """
ranked as (select item_id, clicks, cast(row_number() over (order by clicks desc, item_id) as bigint) as rank,
  cast(sum(clicks) over (order by clicks desc, item_id rows unbounded preceding) as bigint) as clicks_upto
  from (select item_id, count(*) as clicks from clicks group by item_id))"""
FIT_CTE = (
    RANKED_CTE
    + """,
logs as (select ln(rank + 10) as x, ln(clicks) as y from ranked where rank <= (select count(*) - 10 from ranked)),
fit as (select exp(regr_intercept(y, x)) as c, -regr_slope(y, x) as alpha, regr_r2(y, x) as r2,
  var_pop(y) - regr_slope(y, x) ** 2 * var_pop(x) as mse,
  regr_slope(y, x) ** 2 * var_pop(x) as explained_variance, count(*) as items from logs)"""
)


@query("ranked_frequencies", on_clicks("select * from ranked", RANKED_CTE))
def _(spark, sf_dir):
    return frequency.ranked_frequencies(click_facts(spark, sf_dir))


@query(
    "zipf_fit",
    on_clicks(
        """select round(c, 6) as c, round(alpha, 8) as alpha, round(r2, 8) as r2, round(mse, 8) as mse,
        round(explained_variance, 8) as explained_variance, items from fit""",
        FIT_CTE,
    ),
)
def _(spark, sf_dir):
    fit = frequency.zipf_fit(frequency.ranked_frequencies(click_facts(spark, sf_dir)), ignore_bottom=10)
    digits = {"c": 6, "alpha": 8, "r2": 8, "mse": 8, "explained_variance": 8}
    return fit.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "zipf_curve",
    on_clicks(
        """select item_id, clicks, rank, clicks_upto, round(ln(c) - alpha * ln(rank + 10), 8) as estimate,
        round(ln(clicks) - (ln(c) - alpha * ln(rank + 10)), 8) as residual,
        round(c / pow(rank + 10, alpha), 6) as density from ranked, fit""",
        FIT_CTE,
    ),
)
def _(spark, sf_dir):
    ranked = frequency.ranked_frequencies(click_facts(spark, sf_dir))
    curve = frequency.zipf_curve(ranked, frequency.zipf_fit(ranked, ignore_bottom=10))
    return curve.withColumns({c: F.round(c, d) for c, d in {"estimate": 8, "residual": 8, "density": 6}.items()})


@query(
    "half_mass_items",
    on_clicks(
        """select count(case when cast(clicks_upto as double) / total <= 0.5 then 1 end) as items,
        any_value(total) as clicks from ranked, (select cast(sum(clicks) as bigint) as total from ranked)""",
        RANKED_CTE,
    ),
)
def _(spark, sf_dir):
    return frequency.mass_items(frequency.ranked_frequencies(click_facts(spark, sf_dir)))


@query(
    "top_bottom_items",
    on_clicks(
        """select *, case when rank <= 10 then 'top' else 'bottom' end as "end" from ranked
        where rank <= 10 or rank > (select count(*) - 10 from ranked)""",
        RANKED_CTE,
    ),
)
def _(spark, sf_dir):
    return frequency.top_bottom(frequency.ranked_frequencies(click_facts(spark, sf_dir)))


@query(
    "length_distribution",
    on_clicks(
        """select length, sessions, cast(sessions as double) / sum(sessions) over () as probability,
        cast(sum(sessions) over (order by length rows unbounded preceding) as double) / sum(sessions) over () as cumulative
        from (select length, count(*) as sessions from
          (select session_id, count(*) as length from clicks group by session_id) group by length)"""
    ),
)
def _(spark, sf_dir):
    return frequency.length_distribution(clicks(spark, sf_dir))


def _rules_cte(item):
    return f"""
entries as (select distinct region, session_id, {item} as item from baskets),
totals as (select region, count(distinct session_id) as sessions from entries group by region),
singles as (select region, item, count(*) as n from entries group by region, item),
pairs as (select a.region, a.item as item_a, b.item as item_b, count(*) as pair_count
  from entries a join entries b on a.region = b.region and a.session_id = b.session_id and a.item < b.item
  group by all),
rules as (select region, item_a, item_b, pair_count, sessions, sa.n as count_a, sb.n as count_b,
  cast(pair_count as double) / sessions as support, cast(pair_count as double) / sa.n as confidence_ab,
  cast(pair_count as double) / sb.n as confidence_ba,
  cast(pair_count as double) / sa.n / (sb.n / cast(sessions as double)) as lift
  from pairs join totals using (region)
  join singles sa on sa.region = pairs.region and sa.item = item_a
  join singles sb on sb.region = pairs.region and sb.item = item_b)"""


@query("category_rules", on_baskets("select * from rules", _rules_cte("category")))
def category_rules(spark, sf_dir):
    return rules.pair_rules(baskets(spark, sf_dir), "category", "region")


@query("product_rules", on_baskets("select * from rules where pair_count >= 2", _rules_cte("item_id")))
def _(spark, sf_dir):
    return rules.pair_rules(baskets(spark, sf_dir), "item_id", "region", min_pairs=2)


@query("brand_rules", on_baskets("select * from rules", _rules_cte("colour")))
def _(spark, sf_dir):
    return rules.pair_rules(baskets(spark, sf_dir), "colour", "region")


@query("basket_entries", on_baskets("select region, session_id, item as colour from entries", _rules_cte("colour")))
def _(spark, sf_dir):
    return rules.basket_entries(baskets(spark, sf_dir), "colour", "region")


@query(
    "directed_rules",
    on_baskets(
        """select region, pair_count, support, item_a as antecedent, item_b as consequent,
        confidence_ab as confidence, count_b / cast(sessions as double) as consequent_probability,
        confidence_ab / (count_b / cast(sessions as double)) as lift, concat(item_a, ' → ', item_b) as rule from rules
        union all select region, pair_count, support, item_b, item_a, confidence_ba, count_a / cast(sessions as double),
        confidence_ba / (count_a / cast(sessions as double)), concat(item_b, ' → ', item_a) from rules""",
        _rules_cte("category"),
    ),
)
def _(spark, sf_dir):
    return rules.directed_rules(category_rules(spark, sf_dir), "region")


@query(
    "strong_rules",
    on_baskets("select * from rules where pair_count >= 5 and support > 0", _rules_cte("colour")),
)
def _(spark, sf_dir):
    return rules.strong_rules(rules.pair_rules(baskets(spark, sf_dir), "colour", "region", 5), 5)


@query(
    "region_rules",
    on_baskets(
        """select * replace (round(support, 4) as support, round(confidence_ab, 4) as confidence_ab,
        round(confidence_ba, 4) as confidence_ba, round(lift, 4) as lift) from rules where region = 'ASIA'""",
        _rules_cte("category"),
    ),
)
def _(spark, sf_dir):
    return rules.rules_within(baskets(spark, sf_dir), "category", "region", "ASIA")


@query(
    "selected_rule",
    on_baskets("select * from rules where item_a = 'ECONOMY' and item_b = 'SMALL'", _rules_cte("category")),
)
def _(spark, sf_dir):
    return rules.rule_of_two(baskets(spark, sf_dir), "category", "region", "SMALL", "ECONOMY")


@query(
    "product_pair_counts",
    on_clicks(
        """select a.item_id as item_a, b.item_id as item_b, count(*) as total
        from (select distinct session_id, item_id from clicks) a
        join (select distinct session_id, item_id from clicks) b
        on a.session_id = b.session_id and a.item_id < b.item_id group by all"""
    ),
)
def _(spark, sf_dir):
    entries = materialise(clicks(spark, sf_dir).select("session_id", "item_id").distinct())
    return pair_sums(entries, "item_id", tile=8)


@query(
    "pair_counts_gaps",
    on_clicks(
        """select a.item_id as item_a, b.item_id as item_b, count(*) as total from gaps a join gaps b
        on a.session_id = b.session_id and a.item_id < b.item_id group by all""",
        "gaps as (select distinct session_id, nullif(item_id, 'K7') as item_id from clicks)",
    ),
)
def _(spark, sf_dir):
    gaps = clicks(spark, sf_dir).select("session_id", F.nullif("item_id", F.lit("K7")).alias("item_id"))
    return pair_sums(materialise(gaps.distinct()), "item_id")
