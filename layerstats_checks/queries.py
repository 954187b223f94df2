"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerstats_checks.oracles import FOOTBALL_NAMES
from layerstats_checks.raw import FINE_PERCENT, PERCENTS, STATISTICS, TOKEN, raw_columns
from layerstats import (
    BRONZE,
    GOLD,
    SILVER,
    ConformSpec,
    LayerConfig,
    LayerPlan,
    Measure,
    Report,
    Summary,
    build_bronze,
    build_silver,
    conform,
    count_value,
    football_plan,
    ingest_csv,
    integer_text,
    latest,
    percent_value,
    profile,
    publish,
    read_layer,
    remove_dir,
    round_of,
    run_layers,
    run_report,
    run_reports,
    season_of,
    shared_dir,
    shared_summaries,
    summarise,
    top_n,
    totals,
    verify_layer,
)
from layerstats.sources.shared import finer_splits

BY_CLUB, BY_ROUND = ("season", "club"), ("season", "round_no")
MEANS = {name: f"avg_{name}" for name in STATISTICS}
SUMS = {"yellow_cards": "total_yellow_cards", "red_cards": "total_red_cards"}
BEST_FIRST = (("avg_shots_on_target", "desc"),)
SHOTS = ("season", "club", "matches", "avg_shots", "avg_shots_on_target", "avg_possession")
DISCIPLINE = ("avg_fouls", "avg_yellow_cards", "avg_red_cards")


def statistics_spec(season: Column) -> ConformSpec:
    return ConformSpec(
        event="match_id",
        entity="club",
        period_text="round_text",
        period_number="round_no",
        measures=tuple(
            Measure(name, "percent" if name in PERCENTS else "count") for name in STATISTICS
        ),
        season=season,
    )


SUMMARIES = (
    Summary("club_profile", BY_CLUB, {"match_id": "matches"}, MEANS),
    Summary("round_summary", BY_ROUND, {"match_id": "entries"}, MEANS),
    Summary("club_totals", BY_CLUB, sums=SUMS),
)
TOP_PROFILE = Report("top_profile", "club_profile", "season", SHOTS, BEST_FIRST, ("club",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*raw_columns())


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw(spark, sf_dir), statistics_spec(F.col("season")))


def write_csv(df: DataFrame, path: str) -> str:
    """Write all columns as full text; Spark's CSV writer trims and cuts off microseconds."""
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with finer_splits(df.sparkSession):
        df.select(*[F.col(name).cast("string") for name in df.columns]).write.options(**keep).csv(path)
    return path


def scratch_config(spark: SparkSession, label: str) -> LayerConfig:
    """A place of its own for one query's tables, in the catalog as well."""
    base = shared_dir(spark, label)
    database = base.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"create database if not exists {database} location '{base}/catalog'")
    return LayerConfig(base, database=database)


def keep_gold(spark: SparkSession, cfg: LayerConfig, plan: LayerPlan) -> None:
    """Give back the space of what the Gold tables were made from."""
    for layer, name in ((BRONZE, plan.bronze), (SILVER, plan.silver)):
        spark.sql(f"drop table {cfg.table(name)}")
        remove_dir(spark, cfg.path(layer, name))
    remove_dir(spark, f"{cfg.base}/landing")


def folder_of(path: str) -> Column:
    """The folder a file is in, without a regular expression that starts anew at every character."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def typed_like(df: DataFrame, model: DataFrame, *extra: Column) -> DataFrame:
    """Text columns read back as the types they were written from."""
    return df.select(*[F.col(f.name).try_cast(f.dataType) for f in model.schema], *extra)


# -- sources and sinks -------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = write_csv(part, shared_dir(spark, "csv_roundtrip"))
    return typed_like(ingest_csv(spark, path, schema=_text_schema(part)), part)


def csv_inferred(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer, shared_dir(spark, "csv_inferred"))
    inferred = ingest_csv(spark, path, infer_schema=True)
    types = ", ".join(f"{name} {kind}" for name, kind in inferred.drop("source_file").dtypes)
    return typed_like(inferred, customer, F.lit(types).alias("inferred_types"))


def ingest_provenance(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = write_csv(events, f"{shared_dir(spark, 'provenance')}/events_csv")
    return typed_like(
        ingest_csv(spark, path), events, folder_of("source_file").alias("source_folder")
    )


def layer_readback(spark, sf_dir):
    cfg = scratch_config(spark, "layer_readback")
    publish(table(spark, sf_dir, "orders"), cfg, BRONZE, "orders")
    return read_layer(spark, cfg, BRONZE, "orders")


def publish_overwrite(spark, sf_dir):
    """The second version has other columns and rows, and is sorted."""
    cfg = scratch_config(spark, "publish_overwrite")
    rows = silver(spark, sf_dir)
    publish(profile(rows, BY_ROUND, "match_id", STATISTICS), cfg, GOLD, "statistics")
    second = totals(rows, BY_CLUB, SUMS)
    publish(second, cfg, GOLD, "statistics", sort_by=BY_CLUB)
    return spark.table(cfg.table("statistics"))


def refused(work: Callable[[], object]) -> Column:
    """Whether some work ends in an error of Spark's, also one that comes as it is from the JVM."""
    try:
        work()
    except (PySparkException, Py4JError):
        return F.lit(True).alias("refused")
    return F.lit(False).alias("refused")


def publish_refused(spark, sf_dir):
    """What is left of a table after a version that fails while it is written."""
    cfg = scratch_config(spark, "publish_refused")
    sums = totals(silver(spark, sf_dir), BY_CLUB, SUMS)
    publish(sums, cfg, GOLD, "statistics")
    bad = F.when(F.col("total_red_cards") > -1, F.raise_error(F.lit("unreadable")).cast("int"))
    error = refused(lambda: publish(sums.withColumn("season", bad), cfg, GOLD, "statistics"))
    return spark.table(cfg.table("statistics")).select("*", error)


def bronze_refused(spark, sf_dir):
    """What is left of Bronze after files of another header."""
    cfg = scratch_config(spark, "bronze_refused")
    part = table(spark, sf_dir, "part")
    plan = LayerPlan("bronze_parts", "silver_parts", statistics_spec(F.lit(1)), ())
    build_bronze(spark, write_csv(part, f"{cfg.base}/landing/parts"), cfg, plan)
    write_csv(table(spark, sf_dir, "region"), f"{cfg.base}/landing/regions")
    error = refused(lambda: build_bronze(spark, f"{cfg.base}/landing/*", cfg, plan))
    return typed_like(spark.table(cfg.table(plan.bronze)), part, error)


def silver_refused(spark, sf_dir):
    """What is left of Silver after a run that found no Bronze."""
    cfg = scratch_config(spark, "silver_refused")
    plan = LayerPlan("bronze_statistics", "silver_statistics", statistics_spec(F.col("season")), ())
    publish(raw(spark, sf_dir), cfg, BRONZE, plan.bronze)
    build_silver(spark, cfg, plan)
    remove_dir(spark, cfg.path(BRONZE, plan.bronze))
    error = refused(lambda: build_silver(spark, cfg, plan))
    return spark.table(cfg.table(plan.silver)).select("*", error)


def publish_sorted(spark, sf_dir):
    """Whether each row comes after those before it, in its file and in the files before."""
    cfg = scratch_config(spark, "publish_sorted")
    sums = totals(silver(spark, sf_dir), BY_CLUB, SUMS)
    rows = publish(sums, cfg, GOLD, "statistics", sort_by=BY_CLUB).select(
        "*",
        F.struct(*BY_CLUB).alias("key"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    files = rows.groupBy("file").agg(F.max("key").alias("last"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.max("last").over(earlier).alias("before"))
    above = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    rows = rows.withColumn("above", above).join(files, "file")
    return rows.select(
        *sums.columns, (F.col("key") > F.coalesce("above", "before")).alias("in_order")
    ).na.fill({"in_order": True})


def publish_partitioned(spark, sf_dir):
    cfg = scratch_config(spark, "publish_partitioned")
    return publish(silver(spark, sf_dir), cfg, SILVER, "statistics", partition_by=("season",))


# -- cleaning ----------------------------------------------------------------


def clean_counts_brand(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", count_value("p_brand").alias("brand_no")
    )


def clean_counts_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", count_value("p_name").alias("name_no"))


def clean_counts_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", count_value("props").alias("props_no"))


def clean_counts_priority(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", count_value("o_orderpriority").alias("priority_no")
    )


def clean_counts_typed(spark, sf_dir):
    """On an inferred double the digits of ``17.0`` are 170."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", count_value("l_quantity").alias("quantity_no")
    )


def clean_percent(spark, sf_dir):
    percent = lambda name: F.concat(F.round(F.col(name) * 100).cast("string"), F.lit("%"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        percent_value(percent("l_discount")).alias("discount_pct"),
        percent_value(percent("l_tax")).alias("tax_pct"),
    )


def clean_percent_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", percent_value("p_brand").alias("brand_pct")
    )


def integer_text_query(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        integer_text("l_quantity").alias("quantity"),
        integer_text("l_extendedprice").alias("price"),
        integer_text("l_returnflag").alias("flag"),
    )


def trim_entity(spark, sf_dir):
    """Spaces go, at both ends; a tab stays."""
    ending = F.when(F.col("c_custkey") % 2 == 0, F.lit("\t ")).otherwise(" ")
    padded = F.concat(F.lit("  "), F.col("c_name"), ending)
    rows = table(spark, sf_dir, "customer").withColumn("name", padded)
    spec = ConformSpec("c_custkey", "name", "c_nationkey", "nation_no", (), 2023)
    return conform(rows, spec).select("c_custkey", "name")


def rename_columns(spark, sf_dir):
    """Absent names are skipped, case does not matter."""
    spec = ConformSpec(
        event="id",
        entity="supplier_name",
        period_text="nation",
        period_number="nation_no",
        measures=(Measure("balance", "strict_double"),),
        season=2023,
        renames={
            "S_SUPPKEY": "id",
            "s_name": "supplier_name",
            "s_nationkey": "nation",
            "s_acctbal": "balance",
            "s_phone": "phone",
        },
    )
    return conform(table(spark, sf_dir, "supplier"), spec)


def season_token(spark, sf_dir):
    token = F.date_format("o_orderdate", "yyyy-M")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", season_of(token).alias("season"), round_of(token).alias("round_no")
    )


def season_token_wide(spark, sf_dir):
    """Rounds of up to three digits, with white space around the token."""
    token = F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-D"), F.lit(" "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", season_of(token).alias("season"), round_of(token).alias("round_no")
    )


def season_token_inferred(spark, sf_dir):
    """Tokens that look like dates, through a Bronze with inferred types."""
    cfg = scratch_config(spark, "season_token_inferred")
    path = write_csv(football_raw(spark, sf_dir, round_text=TOKEN), f"{cfg.base}/landing")
    plan = football_plan(
        season=season_of("rodada_texto", 1900),
        period_expression=round_of("rodada_texto"),
        infer_schema=True,
    )
    tables = run_layers(spark, path, cfg, plan)
    keep_gold(spark, cfg, plan)
    return tables[plan.summaries[1].name].select(
        "ano_temporada", "rodada_numero", "total_entradas_rodada"
    )


# -- summaries ---------------------------------------------------------------


def club_profile(spark, sf_dir):
    return profile(silver(spark, sf_dir), BY_CLUB, "match_id", STATISTICS)


def round_summary(spark, sf_dir):
    return profile(
        silver(spark, sf_dir), BY_ROUND, "match_id", STATISTICS, count_name="entries"
    )


def club_totals(spark, sf_dir):
    return totals(silver(spark, sf_dir), BY_CLUB, SUMS)


def profile_exact(spark, sf_dir):
    """Fractional metrics, the same digits in whatever order rows arrive."""
    return profile(
        table(spark, sf_dir, "lineitem"),
        ("l_returnflag", "l_linestatus"),
        "l_orderkey",
        ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        count_name="lines",
        exact=True,
    )


def profile_exact_fine(spark, sf_dir):
    """Values and means of more than six decimals."""
    value = (F.col("l_linenumber") / F.lit(10_000_000)).alias("value")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", value)
    keys = ("l_returnflag",)
    return profile(rows, keys, "l_orderkey", ("value",), count_name="lines", scale=8, exact=True)


def summaries_one_pass(spark, sf_dir):
    """Tables of two levels, with means and totals, from one aggregation."""
    cfg = scratch_config(spark, "summaries_one_pass")
    means = {name: f"avg_{name}" for name in ("shots", "possession", "passes")}
    clubs = Summary("clubs", BY_CLUB, {"match_id": "events"}, means, SUMS)
    rounds = Summary("rounds", BY_ROUND, {"match_id": "events"}, means)
    with shared_summaries(silver(spark, sf_dir), (clubs, rounds)) as tables:
        published = {name: publish(df, cfg, GOLD, name) for name, df in tables.items()}
    label = lambda level: F.lit(level).alias("level")
    member = lambda name: F.col(name).cast("string").alias("member")
    values = ["events", *means.values()]
    return (
        published["clubs"]
        .select(label("club"), "season", member("club"), *values, *SUMS.values())
        .unionByName(
            published["rounds"].select(label("round"), "season", member("round_no"), *values),
            allowMissingColumns=True,
        )
    )


# -- reports -----------------------------------------------------------------


def latest_season(spark, sf_dir):
    return latest(silver(spark, sf_dir), "season")


def top_profile(spark, sf_dir):
    rows = latest(silver(spark, sf_dir), "season")
    return top_n(
        profile(rows, BY_CLUB, "match_id", STATISTICS), BEST_FIRST, tie_break=("club",)
    ).select(*SHOTS)


def top_profile_wide(spark, sf_dir):
    rows = latest(silver(spark, sf_dir), "season")
    return top_n(
        profile(rows, BY_CLUB, "match_id", STATISTICS), BEST_FIRST, tie_break=("club",)
    ).select(*SHOTS, *DISCIPLINE)


def top_rounds(spark, sf_dir):
    rows = latest(silver(spark, sf_dir), "season")
    summary = profile(rows, BY_ROUND, "match_id", STATISTICS)
    return top_n(summary, (("round_no", "asc"),)).select(*BY_ROUND, *DISCIPLINE)


def top_totals(spark, sf_dir):
    rows = latest(silver(spark, sf_dir), "season")
    worst_first = (("total_red_cards", "desc"), ("total_yellow_cards", "desc"))
    return top_n(totals(rows, BY_CLUB, SUMS), worst_first, tie_break=("club",))


# -- verification and whole runs ---------------------------------------------


def verify_silver(spark, sf_dir):
    cfg = scratch_config(spark, "verify_layer")
    publish(silver(spark, sf_dir), cfg, SILVER, "statistics")
    columns = verify_layer(read_layer(spark, cfg, SILVER, "statistics")).schema
    remove_dir(spark, cfg.base)
    return columns


def layer_sample(spark, sf_dir):
    """A sample has no set rows, so count those that the table does hold."""
    cfg = scratch_config(spark, "layer_sample")
    orders = table(spark, sf_dir, "orders")
    publish(orders, cfg, BRONZE, "orders")
    sample = verify_layer(read_layer(spark, cfg, BRONZE, "orders"), rows=5).sample
    sample = sample.toDF(*[f"s_{name}" for name in orders.columns])
    same = [F.col(name).eqNullSafe(F.col(f"s_{name}")) for name in orders.columns]
    # Five rows at any scale: the one side that may be broadcast unseen.
    return orders.join(F.broadcast(sample), same, "left_semi").agg(
        F.count("*").alias("found_rows")
    )


def layers_end_to_end(spark, sf_dir):
    """CSV files to Bronze, Silver, Gold and a report read by table name."""
    cfg = scratch_config(spark, "layers")
    path = write_csv(raw(spark, sf_dir), f"{cfg.base}/landing")
    plan = LayerPlan(
        "bronze_statistics",
        "silver_statistics",
        statistics_spec(F.col("season")),
        SUMMARIES,
        (TOP_PROFILE,),
    )
    run_layers(spark, path, cfg, plan)
    keep_gold(spark, cfg, plan)
    return run_reports(spark, cfg, plan)["top_profile"]


def football_raw(spark, sf_dir, **instead):
    columns = raw_columns(FOOTBALL_NAMES, **instead)
    return table(spark, sf_dir, "lineitem").selectExpr(*columns)


def football_summary(index: int, exact: bool = False, **instead: str):
    """A football summary straight from the raw rows."""

    def query(spark, sf_dir):
        plan = football_plan(exact=exact)
        rows = football_raw(spark, sf_dir, **instead).withColumn("source_file", F.lit("lineitem"))
        return summarise(conform(rows, plan.spec), plan.summaries[index])

    return query


def football_inferred(spark, sf_dir):
    """CSV files to Gold through a Bronze with inferred types."""
    cfg = scratch_config(spark, "football_inferred")
    path = write_csv(football_raw(spark, sf_dir), f"{cfg.base}/landing")
    plan = football_plan(infer_schema=True)
    tables = run_layers(spark, path, cfg, plan)
    keep_gold(spark, cfg, plan)
    return tables[plan.summaries[0].name]


def football_source(spark, sf_dir):
    """The folder in ``origem_arquivo`` of Silver rows that came from two folders."""
    cfg = scratch_config(spark, "football_source")
    rows, odd = football_raw(spark, sf_dir), F.col("chutes_no_alvo") % 2 == 1
    write_csv(rows.where(odd), f"{cfg.base}/landing/odd")
    write_csv(rows.where(~odd), f"{cfg.base}/landing/even")
    plan = football_plan()
    build_bronze(spark, f"{cfg.base}/landing/*", cfg, plan)
    folder = folder_of("origem_arquivo").alias("origem_arquivo")
    return build_silver(spark, cfg, plan).select("id_partida", "clube", "chutes_no_alvo", folder)


def football_report(name: str):
    """A football report over tables built by a whole run from CSV files."""

    def query(spark, sf_dir):
        cfg = scratch_config(spark, name)
        path = write_csv(football_raw(spark, sf_dir), f"{cfg.base}/landing")
        plan = football_plan()
        tables = run_layers(spark, path, cfg, plan)
        keep_gold(spark, cfg, plan)
        report = next(report for report in plan.reports if report.name == name)
        return run_report(tables[report.table], report)

    return query


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_inferred": csv_inferred,
    "ingest_provenance": ingest_provenance,
    "layer_readback": layer_readback,
    "publish_overwrite": publish_overwrite,
    "publish_refused": publish_refused,
    "bronze_refused": bronze_refused,
    "silver_refused": silver_refused,
    "publish_sorted": publish_sorted,
    "publish_partitioned": publish_partitioned,
    "clean_counts_brand": clean_counts_brand,
    "clean_counts_name": clean_counts_name,
    "clean_counts_props": clean_counts_props,
    "clean_counts_priority": clean_counts_priority,
    "clean_counts_typed": clean_counts_typed,
    "clean_percent": clean_percent,
    "clean_percent_text": clean_percent_text,
    "integer_text": integer_text_query,
    "trim_entity": trim_entity,
    "rename_columns": rename_columns,
    "conform": silver,
    "season_token": season_token,
    "season_token_wide": season_token_wide,
    "season_token_inferred": season_token_inferred,
    "profile": club_profile,
    "round_summary": round_summary,
    "totals": club_totals,
    "profile_exact": profile_exact,
    "profile_exact_fine": profile_exact_fine,
    "summaries_one_pass": summaries_one_pass,
    "latest_season": latest_season,
    "top_profile": top_profile,
    "top_profile_wide": top_profile_wide,
    "top_rounds": top_rounds,
    "top_totals": top_totals,
    "verify_layer": verify_silver,
    "layer_sample": layer_sample,
    "layers_end_to_end": layers_end_to_end,
    "football_clubs": football_summary(0),
    "football_clubs_exact": football_summary(0, exact=True, pass_accuracy=FINE_PERCENT),
    "football_inferred": football_inferred,
    "football_source": football_source,
    "football_rounds": football_summary(1),
    "football_cards": football_summary(2),
    "football_club_shots": football_report("club_shots"),
    "football_club_overview": football_report("club_overview"),
    "football_round_discipline": football_report("round_discipline"),
    "football_club_cards": football_report("club_cards"),
}


def _text_schema(df: DataFrame) -> str:
    return ", ".join(f"{name} string" for name in df.columns)
