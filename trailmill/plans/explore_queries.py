"""Queries over cleaned clicks, sessions and baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmill import schema as S
from trailmill.functions import scalars
from trailmill.functions.aggregates import code_count
from trailmill.operators import explore, profile, quality, sessions
from trailmill.plans.registry import SQL, mean_sql, on_baskets, on_clicks, query
from trailmill.scale import materialise
from trailmill.sources import io
from trailmill.sources.tables import baskets, click_facts, clicks, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def located(spark, sf_dir, premium=False):
    return clicks(spark, sf_dir, premium).withColumn("region", scalars.region_label(F.col("country")))


FEATURES_CTE = f"""
features as (
  select session_id, region, count(*) as n_clicks, count(distinct item_id) as n_products,
         count(distinct category) as n_categories, {mean_sql('price')} as avg_price,
         max(page) as max_page, max(click_order) as max_order,
         cast(count(case when price_above_avg then 1 end) as double) / count(*) as share_above_avg
  from located group by session_id, region)"""


@query(
    "clean_clicks",
    on_clicks(
        """select session_id, click_order, cast(month(click_date) as int) as month,
        make_date(year(click_date), month(click_date), day(click_date)) as click_date,
        cast(colour as varchar) as colour, cast(location as varchar) as location,
        cast(photo_type as varchar) as photo_type, photo_type = 1 as first_photo_type,
        case when photo_type = 1 then 1 else 0 end as label from clicks"""
    ),
)
def _(spark, sf_dir):
    d = F.col("click_date")
    parts = clicks(spark, sf_dir).withColumns({"year": F.year(d), "month": F.month(d), "day": F.day(d)})
    cleaned = scalars.with_click_date(parts.drop("click_date"))
    return cleaned.select(
        "session_id",
        "click_order",
        F.month("click_date").alias("month"),
        "click_date",
        *[F.col(c).cast("string").alias(c) for c in ("colour", "location", "photo_type")],
        (F.col("photo_type") == 1).alias("first_photo_type"),
        (F.col("photo_type") == 1).cast("int").alias("label"),
    )


@query(
    "region_bucket",
    on_clicks(
        """select country, region, case region when 'Poland' then 0 when 'Other_EU' then 1
        when 'Europe_non_EU' then 2 when 'Outside_Europe' then 3 else 4 end as region_code,
        count(*) as clicks from located group by all"""
    ),
)
def _(spark, sf_dir):
    c = F.col("country")
    return (
        click_facts(spark, sf_dir)
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("clicks"))
        .select("country", scalars.region_label(c).alias("region"), scalars.region_code(c).alias("region_code"), "clicks")
    )


def _case_sql(column, names):
    whens = " ".join(f"when {k} then '{v}'" for k, v in names.items())
    return f"case {column} {whens} end"


@query(
    "code_lookup",
    on_clicks(
        f"""select colour, location, {_case_sql('colour', S.COLOUR_NAMES)} as colour_name,
        coalesce({_case_sql('location', S.CATEGORY_NAMES)}, 'unknown') as category_name,
        {_case_sql('country', S.COUNTRY_NAMES)} as country_name, count(*) as clicks
        from clicks group by all"""
    ),
)
def _(spark, sf_dir):
    counts = profile.pair_counts(click_facts(spark, sf_dir), ["colour", "location", "country"])
    return counts.select(
        "colour",
        "location",
        scalars.code_name(F.col("colour"), S.COLOUR_NAMES).alias("colour_name"),
        scalars.code_name(F.col("location"), S.CATEGORY_NAMES, "unknown").alias("category_name"),
        scalars.code_name(F.col("country"), S.COUNTRY_NAMES).alias("country_name"),
        "clicks",
    )


@query(
    "calendar_parts",
    on_clicks(
        """select click_date, cast(month(click_date) as int) as month,
        cast(dayofweek(click_date) + 1 as int) as day_of_week, dayname(click_date) as day_name,
        count(*) as clicks from clicks group by all"""
    ),
)
def _(spark, sf_dir):
    d = F.col("click_date")
    counts = profile.pair_counts(click_facts(spark, sf_dir), ["click_date"])
    return counts.select(
        "click_date", F.month(d).alias("month"), F.dayofweek(d).alias("day_of_week"),
        scalars.day_name(d).alias("day_name"), "clicks",
    )


@query(
    "text_cleanup",
    on_clicks(
        """select session_id, click_order,
        regexp_replace(trim(concat('  ', cast(colour as varchar), '.0 ')), '\\.0$', '') as colour_text,
        substring(item_id, 1, 1) as letter, substring(item_id, 2, 3) as number,
        concat(substring(item_id, 1, 1), substring(item_id, 2, 3)) as model,
        concat(item_id, ' → ', category) as rule, least(click_order, 10) as clipped from clicks"""
    ),
)
def _(spark, sf_dir):
    item = F.col("item_id")
    padded = F.concat(F.lit("  "), F.col("colour").cast("string"), F.lit(".0 "))
    return clicks(spark, sf_dir).select(
        "session_id",
        "click_order",
        scalars.code_text(padded).alias("colour_text"),
        scalars.product_letter(item).alias("letter"),
        scalars.product_number(item).alias("number"),
        F.concat_ws("", scalars.product_letter(item), scalars.product_number(item)).alias("model"),
        scalars.rule_text(item, F.col("category")).alias("rule"),
        scalars.clip_upper(F.col("click_order"), 10).alias("clipped"),
    )


@query(
    "scalar_math",
    on_clicks(
        """select session_id, click_order, round(ln(price + 1), 8) as ln_price, round(log2(price + 1), 8) as log2_price,
        round(sqrt(price), 8) as sqrt_price, round(pow(0.8, click_order), 8) as decay,
        round(exp(-price / 100), 8) as exp_price from clicks where price >= 0"""
    ),
)
def _(spark, sf_dir):
    p = F.col("price")
    return clicks(spark, sf_dir).filter(p >= 0).select(
        "session_id",
        "click_order",
        F.round(F.ln(p + 1), 8).alias("ln_price"),
        F.round(F.log2(p + 1), 8).alias("log2_price"),
        F.round(F.sqrt(p), 8).alias("sqrt_price"),
        F.round(F.pow(F.lit(0.8), F.col("click_order")), 8).alias("decay"),
        F.round(F.exp(-p / 100), 8).alias("exp_price"),
    )


@query(
    "cyclic_day",
    on_clicks(
        """select click_date, round(sin(dayofweek(click_date) / 7.0 * 2 * pi()), 9) as day_sin,
        round(cos(dayofweek(click_date) / 7.0 * 2 * pi()), 9) as day_cos, count(*) as clicks
        from clicks group by all"""
    ),
)
def _(spark, sf_dir):
    counts = profile.pair_counts(click_facts(spark, sf_dir), ["click_date"])
    sine, cosine = scalars.cyclic(scalars.weekday(F.col("click_date")), 7)
    return counts.select(
        "click_date", F.round(sine, 9).alias("day_sin"), F.round(cosine, 9).alias("day_cos"), "clicks"
    )


@query(
    "minmax_day",
    on_clicks(
        """select click_date, cast(day(click_date) - lo as double) / (hi - lo) as day_scaled, count(*) as clicks
        from clicks, (select min(day(click_date)) as lo, max(day(click_date)) as hi from clicks) group by all"""
    ),
)
def _(spark, sf_dir):
    counts = profile.pair_counts(click_facts(spark, sf_dir), ["click_date"])
    low, high = counts.agg(F.min(F.day("click_date")), F.max(F.day("click_date"))).first()
    day = F.day("click_date").cast("double")
    return counts.select(
        "click_date", scalars.min_max(day, F.lit(low), F.lit(high)).alias("day_scaled"), "clicks"
    )


NULLABLE = ["session_id", "price", "category", "rare_colour"]


def _with_gaps(df):
    return df.withColumn("rare_colour", F.when(F.col("colour") > 10, F.col("colour")))


@query(
    "null_counts",
    on_clicks(
        """select 'session_id' as "column", count(*) - count(session_id) as nulls from clicks
        union all select 'price', count(*) - count(price) from clicks
        union all select 'category', count(*) - count(category) from clicks
        union all select 'rare_colour', count(*) - count(case when colour > 10 then 1 end) from clicks"""
    ),
)
def _(spark, sf_dir):
    return quality.null_counts(_with_gaps(clicks(spark, sf_dir)).select(*NULLABLE))


@query(
    "complete_rows",
    on_clicks("select session_id, click_order, colour as rare_colour from clicks where colour > 10"),
)
def _(spark, sf_dir):
    gaps = _with_gaps(clicks(spark, sf_dir)).select("session_id", "click_order", "rare_colour")
    return quality.drop_incomplete(gaps, ["rare_colour"])


@query(
    "null_fill",
    on_clicks("select session_id, click_order, case when colour > 10 then colour else 0 end as rare_colour from clicks"),
)
def _(spark, sf_dir):
    gaps = _with_gaps(clicks(spark, sf_dir)).select("session_id", "click_order", "rare_colour")
    return gaps.na.fill(0, subset=["rare_colour"])


@query(
    "distinct_counts",
    on_clicks(
        """select 'session_id' as "column", count(distinct session_id) as distinct_values from clicks
        union all select 'item_id', count(distinct item_id) from clicks
        union all select 'country', count(distinct country) from clicks
        union all select 'click_date', count(distinct click_date) from clicks"""
    ),
)
def _(spark, sf_dir):
    return quality.distinct_counts(
        clicks(spark, sf_dir).select("session_id", "item_id", "country", "click_date")
    )


@query(
    "duplicate_keys",
    on_clicks("select session_id, page, count(*) as copies from clicks group by all having count(*) > 1"),
)
def _(spark, sf_dir):
    return quality.duplicate_keys(clicks(spark, sf_dir), ["session_id", "page"])


@query(
    "contract_checks",
    on_clicks(
        """select 'rows' as "check", count(*) as found, count(*) > 0 as ok from clicks
        union all select 'session_id never null', count(*) - count(session_id), count(*) = count(session_id) from clicks
        union all select 'item_id never null', count(*) - count(item_id), count(*) = count(item_id) from clicks
        union all select 'category distinct', count(distinct category), count(distinct category) = 5 from clicks
        union all select 'item_id distinct', count(distinct item_id), count(distinct item_id) = 217 from clicks"""
    ),
)
def _(spark, sf_dir):
    return quality.contract_checks(
        clicks(spark, sf_dir), ["session_id", "item_id"], {"category": 5, "item_id": 217}
    )


@query(
    "describe_numeric",
    on_clicks(
        " union all ".join(
            f"""select '{c}' as "column", count({c}) as count, {mean_sql(c)} as mean,
            round(stddev_samp({c}), 6) as stddev, cast(min({c}) as double) as min,
            cast(max({c}) as double) as max from clicks"""
            for c in ("price", "page", "colour")
        )
    ),
)
def _(spark, sf_dir):
    described = quality.describe_columns(click_facts_with_page(spark, sf_dir), ["price", "page", "colour"])
    return described.withColumn("stddev", F.round("stddev", 6))


def click_facts_with_page(spark, sf_dir):
    return clicks(spark, sf_dir).select("price", "page", "colour")


@query(
    "transpose_stats",
    on_clicks(
        """select 'clicks' as key, cast(count(*) as double) as value from clicks
        union all select 'items', cast(count(distinct item_id) as double) from clicks
        union all select 'max_price', cast(max(price) as double) from clicks"""
    ),
)
def _(spark, sf_dir):
    row = click_facts(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("clicks"), F.count_distinct("item_id").alias("items"),
        F.max("price").alias("max_price"),
    )
    return quality.transpose_row(row)


@query(
    "predicate_filter",
    on_clicks(
        """select session_id, click_order, item_id, price from clicks where page = 1
        and price between 10 and 60 and colour in (2, 3, 14) and item_id like 'K1%'"""
    ),
)
def _(spark, sf_dir):
    return (
        clicks(spark, sf_dir)
        .filter((F.col("page") == 1) & F.col("price").between(10, 60))
        .filter(F.col("colour").isin(2, 3, 14) & F.col("item_id").startswith("K1"))
        .select("session_id", "click_order", "item_id", "price")
    )


@query(
    "distinct_attributes",
    on_clicks("select distinct category, item_id, colour, photo_type from clicks"),
)
def _(spark, sf_dir):
    return click_facts(spark, sf_dir).select("category", "item_id", "colour", "photo_type").distinct()


@query(
    "session_summary",
    on_clicks(
        f"""select session_id, count(*) as n_clicks, {mean_sql('price')} as avg_price,
        count(distinct category) as n_categories, count(distinct colour) as n_colours,
        bool_or(price_above_avg) as saw_premium, min_by(country, click_order) as country,
        min_by(click_date, click_order) as click_date from clicks group by session_id"""
    ),
)
def _(spark, sf_dir):
    return sessions.session_summary(clicks(spark, sf_dir, premium=True))


@query(
    "session_labels",
    on_clicks(
        """select session_id, min(click_date) as click_date, cast(month(min(click_date)) as int) as month,
        cast(dayofweek(min(click_date)) + 1 as int) as day_of_week,
        cast(bool_or(price_above_avg) as int) as label from clicks group by session_id"""
    ),
)
def _(spark, sf_dir):
    labelled = sessions.session_label(sessions.session_summary(clicks(spark, sf_dir, premium=True)))
    return labelled.select("session_id", "click_date", "month", "day_of_week", "label")


@query("session_region_features", on_clicks("select * from features", FEATURES_CTE))
def session_region_features(spark, sf_dir):
    return sessions.session_features(located(spark, sf_dir, premium=True))


@query(
    "region_session_stats",
    on_clicks(
        f"""select region, count(*) as sessions, {mean_sql('n_clicks')} as avg_clicks,
        {mean_sql('n_products')} as avg_products, round(avg(avg_price), 6) as avg_price,
        round(avg(share_above_avg), 6) as avg_share_above_avg,
        cast(count(case when max_page = 1 then 1 end) as double) / count(*) as share_page1_only,
        {mean_sql('max_page')} as avg_max_page from features group by region""",
        FEATURES_CTE,
    ),
)
def _(spark, sf_dir):
    stats = sessions.region_session_stats(session_region_features(spark, sf_dir))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_price", "avg_share_above_avg")})


@query(
    "dataset_totals",
    on_baskets(
        f"""select count(*) as clicks, count(distinct session_id) as sessions, count(distinct item_id) as products,
        count(distinct category) as categories, count(distinct country) as countries, min(price) as min_price,
        max(price) as max_price, {mean_sql('price')} as avg_price from baskets"""
    ),
)
def _(spark, sf_dir):
    return explore.dataset_totals(baskets(spark, sf_dir))


@query(
    "region_activity",
    on_baskets(
        """select region, count(*) as clicks, count(distinct session_id) as sessions,
        round(cast(count(*) as double) / count(distinct session_id), 2) as clicks_per_session
        from baskets group by region"""
    ),
)
def _(spark, sf_dir):
    return explore.region_activity(baskets(spark, sf_dir))


POPULARITY = "count(*) as clicks, count(distinct session_id) as sessions"


@query("category_popularity", on_baskets(f"select category, {POPULARITY} from baskets group by category"))
def _(spark, sf_dir):
    return explore.popularity(baskets(spark, sf_dir), ["category"])


@query("colour_popularity", on_baskets(f"select colour, {POPULARITY} from baskets group by colour"))
def _(spark, sf_dir):
    return explore.popularity(baskets(spark, sf_dir), ["colour"])


@query(
    "product_top10",
    on_baskets(f"select item_id, {POPULARITY} from baskets group by item_id order by clicks desc, item_id limit 10"),
)
def _(spark, sf_dir):
    return explore.top_rows(explore.popularity(baskets(spark, sf_dir), ["item_id"]), "clicks", ["item_id"], 10)


@query(
    "region_category_pivot",
    on_baskets(
        "select region, "
        + ", ".join(f"count(case when category = '{t}' then 1 end) as \"{t}\"" for t in PART_TYPES)
        + " from baskets group by region"
    ),
)
def _(spark, sf_dir):
    return explore.count_pivot(baskets(spark, sf_dir), "region", "category", PART_TYPES)


@query(
    "price_summary",
    on_clicks(
        f"""select min(price) as low, round(quantile_cont(price, 0.25), 6) as q1,
        round(quantile_cont(price, 0.5), 6) as median, round(quantile_cont(price, 0.75), 6) as q3,
        max(price) as high, {mean_sql('price')} as mean from clicks"""
    ),
)
def _(spark, sf_dir):
    summary = explore.value_summary(click_facts(spark, sf_dir), "price")
    return summary.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(
    "activity_sketches",
    on_baskets(
        """select region, count(distinct session_id) as sessions, count(price) as clicks, 0.0::double as sessions_off, 0.0::double as median_off
        from baskets group by region"""
    ),
)
def _(spark, sf_dir):
    """Sketches per day and region, written and merged per region, next to the exact answers.

    ``off`` columns count whole multiples of the error that each sketch states, so 0 means within it.
    """
    rows = materialise(baskets(spark, sf_dir).select("region", "click_date", "session_id", "price"))
    stored = materialise(explore.activity_sketches(rows, ["click_date", "region"], "session_id", "price"))
    merged = explore.merged_sketches(stored, ["region"])
    exact = rows.groupBy("region").agg(F.count_distinct("session_id").alias("sessions"), F.count("price").alias("clicks"))
    below = rows.join(F.broadcast(merged.select("region", "median")), "region").groupBy("region").agg(  # one row a region
        F.count_if(F.col("price") < F.col("median")).alias("below"), F.count_if(F.col("price") <= F.col("median")).alias("upto")
    )
    half = F.col("clicks") / 2
    missed = F.greatest(F.col("below") - half, half - F.col("upto"), F.lit(0.0)) / F.col("clicks")
    return exact.join(merged, "region").join(below, "region").select(
        "region", "sessions", "clicks",
        F.floor(F.abs(F.col("sessions_estimate") - F.col("sessions")) / F.col("sessions") / explore.COUNT_ERROR).cast("double").alias("sessions_off"),
        F.floor(missed / explore.RANK_ERROR).cast("double").alias("median_off"),
    )


@query("price_summary_approx")
def _(spark, sf_dir):
    return explore.approx_summary(click_facts(spark, sf_dir), "price")


@query(
    "price_histogram",
    on_clicks(
        """select cast(least(floor((price - lo) / (hi - lo) * 30), 29) as int) as bin, count(*) as rows,
        min(price) as low, max(price) as high
        from clicks, (select min(price) as lo, max(price) as hi from clicks) group by 1"""
    ),
)
def _(spark, sf_dir):
    return explore.histogram(click_facts(spark, sf_dir), "price", 30)


@query(
    "clicks_histogram",
    on_clicks(
        """select cast(least(floor(cast(n - lo as double) / cast(hi - lo as double) * 40), 39) as int) as bin,
        count(*) as rows, min(n) as low, max(n) as high
        from lengths, (select min(n) as lo, max(n) as hi from lengths) group by 1""",
        "lengths as (select session_id, least(count(*), 50) as n from clicks group by session_id)",
    ),
)
def _(spark, sf_dir):
    lengths = clicks(spark, sf_dir).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    return explore.histogram(lengths.withColumn("n", scalars.clip_upper(F.col("n"), 50)), "n", 40)


PREFERENCE = f"""cast(count(case when price_above_avg then 1 end) as double) / count(*) as share_above_avg,
        {mean_sql('price')} as avg_price, count(*) as clicks"""


@query("price_preference", on_clicks(f"select {PREFERENCE} from clicks"))
def _(spark, sf_dir):
    return explore.price_preference(clicks(spark, sf_dir, premium=True))


@query("price_preference_region", on_clicks(f"select region, {PREFERENCE} from located group by region"))
def _(spark, sf_dir):
    return explore.price_preference(located(spark, sf_dir, premium=True), ["region"])


@query(
    "session_depth",
    on_clicks(
        f"""select {mean_sql('n_clicks')} as avg_clicks, quantile_cont(n_clicks, 0.5) as median_clicks,
        {mean_sql('max_page')} as avg_max_page, quantile_cont(max_page, 0.5) as median_max_page,
        cast(count(case when max_page = 1 then 1 end) as double) / count(*) as share_page1_only from features""",
        FEATURES_CTE,
    ),
)
def _(spark, sf_dir):
    depth = clicks(spark, sf_dir).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_clicks"), F.max("page").alias("max_page")
    )
    return explore.session_depth(depth)


@query(
    "depth_distribution",
    on_clicks("select max_page, count(*) as sessions from features group by max_page", FEATURES_CTE),
)
def _(spark, sf_dir):
    depth = clicks(spark, sf_dir).groupBy("session_id").agg(F.max("page").alias("max_page"))
    return explore.session_distribution(depth, "max_page")


@query(
    "clicks_distribution",
    on_clicks("select n_clicks, count(*) as sessions from features group by n_clicks", FEATURES_CTE),
)
def _(spark, sf_dir):
    lengths = clicks(spark, sf_dir).groupBy("session_id").agg(F.count(F.lit(1)).alias("n_clicks"))
    return explore.session_distribution(lengths, "n_clicks")


@query(
    "products_distribution",
    on_clicks("select n_products, count(*) as sessions from features group by n_products", FEATURES_CTE),
)
def _(spark, sf_dir):
    breadth = clicks(spark, sf_dir).groupBy("session_id").agg(F.count_distinct("item_id").alias("n_products"))
    return explore.session_distribution(breadth, "n_products")


@query(
    "key_counts",
    on_clicks(
        " union all ".join(
            f"select '{k}' as key, cast({k} as varchar) as value, count(*) as clicks from clicks group by {k}"
            for k in ("category", "country", "item_id", "colour", "click_date")
        )
    ),
)
def _(spark, sf_dir):
    return explore.key_counts(
        click_facts(spark, sf_dir), ["category", "country", "item_id", "colour", "click_date"]
    )


@query(
    "sessions_per_country",
    on_clicks(
        f"""select country, count(distinct session_id) as sessions,
        {_case_sql('country', S.COUNTRY_NAMES)} as country_name from clicks group by country
        order by sessions desc, country limit 10"""
    ),
)
def _(spark, sf_dir):
    per = explore.sessions_per(clicks(spark, sf_dir), "country")
    top = explore.top_rows(per, "sessions", ["country"], 10)
    return top.withColumn("country_name", scalars.code_name(F.col("country"), S.COUNTRY_NAMES))


@query(
    "sparsity",
    on_clicks(
        """select count(*) as pairs, count(distinct session_id) as sessions, count(distinct item_id) as items,
        1 - cast(count(*) as double) / (cast(count(distinct session_id) as double) * count(distinct item_id)) as sparsity
        from (select distinct session_id, item_id from clicks)"""
    ),
)
def _(spark, sf_dir):
    return explore.sparsity(clicks(spark, sf_dir))


@query(
    "session_shares",
    on_clicks(
        f"""select cast(count(case when n_clicks = 1 then 1 end) as double) / count(*) as single_click_share,
        cast(count(case when n_categories > 1 then 1 end) as double) / count(*) as multi_category_share,
        {mean_sql('n_clicks')} as mean_clicks, max(n_clicks) as max_clicks,
        quantile_cont(n_clicks, 0.5) as median_clicks from features""",
        FEATURES_CTE,
    ),
)
def _(spark, sf_dir):
    per = clicks(spark, sf_dir).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_clicks"), code_count("category").alias("n_categories")
    )
    return explore.session_shares(per)


FIRST_DATES = "firsts as (select session_id, min_by(click_date, click_order) as click_date from clicks group by session_id)"


def first_dates(spark, sf_dir):
    return clicks(spark, sf_dir).groupBy("session_id").agg(
        F.min_by("click_date", "click_order").alias("click_date")
    )


@query(
    "sessions_by_day",
    on_clicks("select click_date, count(*) as sessions from firsts group by click_date", FIRST_DATES),
)
def _(spark, sf_dir):
    return explore.sessions_by_date(first_dates(spark, sf_dir))


@query(
    "sessions_by_weekday",
    on_clicks(
        """select dayname(click_date) as day_name, cast(dayofweek(click_date) as int) as weekday,
        count(*) as sessions from firsts group by all""",
        FIRST_DATES,
    ),
)
def _(spark, sf_dir):
    d = F.col("click_date")
    return (
        first_dates(spark, sf_dir)
        .groupBy(scalars.day_name(d).alias("day_name"), scalars.weekday(d).alias("weekday"))
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


@query("date_range", on_clicks("select min(click_date) as first_date, max(click_date) as last_date from clicks"))
def _(spark, sf_dir):
    return explore.date_range(click_facts(spark, sf_dir))


def _winner_sql(dimension, measure):
    return f"(select cast({dimension} as varchar) from baskets group by {dimension} order by {measure} desc, 1 limit 1)"


@query(
    "summary_row",
    on_baskets(
        f"""select (select count(*) from baskets) as clicks,
        {_winner_sql('region', 'count(distinct session_id)')} as top_region,
        (select max(n) from (select count(distinct session_id) as n from baskets group by region)) as top_region_sessions,
        {_winner_sql('category', 'count(*)')} as top_category,
        (select max(n) from (select count(*) as n from baskets group by category)) as top_category_clicks,
        {_winner_sql('colour', 'count(*)')} as top_colour,
        (select max(n) from (select count(*) as n from baskets group by colour)) as top_colour_clicks"""
    ),
)
def _(spark, sf_dir):
    return explore.summary_row(baskets(spark, sf_dir))


@query(
    "group_profile",
    on_clicks(
        f"""select location, count(*) as events, count(distinct session_id) as sessions,
        {mean_sql('price')} as avg_price, round(stddev_samp(price), 6) as price_std, {mean_sql('page')} as avg_page,
        {mean_sql('(photo_type - 1)')} as photo_share,
        round(quantile_cont(price, 0.05), 6) as p05, round(quantile_cont(price, 0.25), 6) as q1,
        round(quantile_cont(price, 0.5), 6) as median_price, round(quantile_cont(price, 0.75), 6) as q3,
        round(quantile_cont(price, 0.95), 6) as p95,
        any_value(top_item_id) as top_item_id, count(distinct item_id) as n_item_id,
        any_value(top_category) as top_category, count(distinct category) as n_category,
        any_value(top_colour) as top_colour, count(distinct colour) as n_colour,
        any_value(top_country) as top_country, count(distinct country) as n_country,
        any_value(top_price) as top_price
        from clicks """
        + " ".join(
            f"""join (select location, top_{c} from (select location, {expr} as top_{c},
            row_number() over (partition by location order by count(*) desc, {expr}) as rn
            from clicks group by location, {expr}) where rn = 1) using (location)"""
            for c, expr in (
                ("item_id", "item_id"), ("category", "category"), ("colour", "cast(colour as varchar)"),
                ("country", "cast(country as varchar)"), ("price", "price"),
            )
        )
        + " group by location"
    ),
)
def _(spark, sf_dir):
    out = profile.group_profile(clicks(spark, sf_dir), "location")
    return out.withColumns({c: F.round(c, 6) for c in ("price_std", "p05", "q1", "median_price", "q3", "p95")})


#: The select of the profile by location, for profiles by another key.
GROUP_PROFILE = SQL["group_profile"][len(on_clicks("")) :]


@query(
    "group_modes",
    on_clicks(
        " union all ".join(
            f"""select location, '{c}' as "column", mode, mode_rows, distinct_values, group_rows from (
            select location, cast({c} as varchar) as mode, count(*) as mode_rows,
            count(*) over (partition by location) as distinct_values,
            cast(sum(count(*)) over (partition by location) as bigint) as group_rows,
            row_number() over (partition by location order by count(*) desc, cast({c} as varchar)) as rn
            from clicks group by location, {c}) where rn = 1"""
            for c in ("item_id", "category", "colour", "country")
        )
    ),
)
def _(spark, sf_dir):
    return profile.group_modes(click_facts(spark, sf_dir), "location", ["item_id", "category", "colour", "country"])


@query(
    "group_members",
    on_clicks(
        """select distinct location, 'item_id' as "column", item_id as value from clicks
        union all select distinct location, 'colour', cast(colour as varchar) from clicks"""
    ),
)
def _(spark, sf_dir):
    return profile.group_members(click_facts(spark, sf_dir), "location", ["item_id", "colour"])


@query(
    "group_code_sets",
    on_clicks(
        """select location, array_to_string(list_sort(list(distinct cast(colour as varchar))), ',') as colour_set,
        array_to_string(list_sort(list(distinct category)), ',') as category_set from clicks group by location"""
    ),
)
def _(spark, sf_dir):
    sets = profile.code_sets(click_facts(spark, sf_dir), "location", ["colour", "category"])
    return sets.select("location", *[F.array_join(c, ",").alias(c) for c in ("colour_set", "category_set")])


@query(
    "group_distinct_rows",
    on_clicks(
        """select location, count(*) as distinct_rows
        from (select distinct location, category, item_id, price from clicks) group by location"""
    ),
)
def _(spark, sf_dir):
    return profile.distinct_rows(click_facts(spark, sf_dir), "location", ["category", "item_id", "price"])


@query(
    "group_pair_counts",
    on_clicks("select location, colour, photo_type, count(*) as clicks from clicks group by all"),
)
def _(spark, sf_dir):
    return profile.pair_counts(click_facts(spark, sf_dir), ["location", "colour", "photo_type"])


TOP5 = """select region, item_id, clicks, cast(rank as int) as rank from (
        select region, item_id, count(*) as clicks,
        row_number() over (partition by region order by count(*) desc, item_id) as rank
        from baskets group by region, item_id) where rank <= 5"""


@query("top_items_per_group", on_baskets(TOP5))
def _(spark, sf_dir):
    return profile.top_values(baskets(spark, sf_dir), "region", "item_id", 5)


@query(
    "group_scaled_counts",
    on_baskets(
        f"""select *, cast(clicks as double) / max(clicks) over (partition by region) as scaled
        from ({TOP5.replace('item_id', 'colour')})"""
    ),
)
def _(spark, sf_dir):
    return profile.scaled_counts(baskets(spark, sf_dir), "region", "colour", 5)


@query(
    "dominant_category",
    on_clicks(
        """select session_id, category, clicks from (select session_id, category, count(*) as clicks,
        row_number() over (partition by session_id order by count(*) desc, category) as rn
        from clicks group by session_id, category) where rn = 1"""
    ),
)
def _(spark, sf_dir):
    return profile.dominant_value(clicks(spark, sf_dir), "session_id", "category")


@query(
    "sample_per_group",
    on_clicks(
        """select * exclude (price_above_avg) from (select *, cast(row_number() over (partition by location
        order by md5(concat('42:', session_id, ':', click_order)), session_id, click_order) as int) as pick from clicks)
        where pick <= 5"""
    ),
)
def _(spark, sf_dir):
    return profile.sample_per_group(
        clicks(spark, sf_dir), "location", ["session_id", "click_order"], 5, seed=42
    )


@query(
    "sorted_preview",
    on_baskets(
        """select region, category, count(*) as clicks from baskets group by all
        order by region, clicks desc, category limit 12"""
    ),
)
def _(spark, sf_dir):
    counts = profile.pair_counts(baskets(spark, sf_dir), ["region", "category"])
    return counts.orderBy(F.asc("region"), F.desc("clicks"), F.asc("category")).limit(12)


@query(
    "table_preview",
    """with s as (select column_name as "column", lower(column_type) as kind from (describe select n_nationkey, n_name, n_regionkey from nation))
    select "column", case kind when 'varchar' then 'string' when 'integer' then 'int' else kind end as kind,
    (select count(*) from nation) as "rows", case "column" when 'n_name' then (select min(n_name) from nation)
      when 'n_nationkey' then (select cast(min(n_nationkey) as varchar) from nation)
      else (select cast(arg_min(n_regionkey, n_nationkey) as varchar) from nation) end as first_value from s""",
)
def _(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey")
    return io.described(nation, 5)
