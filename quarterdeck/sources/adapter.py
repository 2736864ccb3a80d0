"""Adapter: the driver's star-schema tables → retail sales entities.

Every entity is derived by Spark from the given tables, so each query's work grows with
them. Mapping (a line item is a POS sales line, an order a transaction, a supplier a
trading unit in its nation/region, a part a product):

* sales lines = lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation ⋈ region
* intraday sales and energy readings = ``events`` (its timestamps carry a time of day)
* unit / product / country masters and their business overrides = supplier / part / nation
* daily budget and forecast = per (ship date, unit) shipped totals scaled by fixed factors

Join strategy: lineitem ⋈ orders is the one large-to-large join (sort-merge on the order
key). part is left to the optimizer's size estimate and AQE's runtime statistics; it is joined
first and on the product id, so that a shuffle by that id moves narrow lines and also serves a
later join with the product dimension. supplier goes along with the joins up to a checked number
of rows; nation and region are bounded by definition (25 and 5 rows) and are broadcast explicitly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators.dedupe import latest_per_key
from quarterdeck.session import ensure_utc

# Fixed values of the mapping (kept identical in the oracle SQL).
TRADING_DAY_START_SECONDS = 5 * 3600  # first sale 05:00
TRADING_DAY_LENGTH_SECONDS = 18 * 3600  # last sale before 23:00
TIME_OF_DAY_MULTIPLIER = 7919
NEW_UNIT_REGION = "MIDDLE EAST"  # units onboarded through the JSON route
ROUTE_JSON = "new_unit_json_files"
ROUTE_DB = "pos_db_extract"
USERS_PER_UNIT = 15  # events: unit = user_id div 15, so units grow with the users
METER_EVENTS = ("view", "click")  # events that are meter readings; all others are sales lines
ENERGY_UNIT_RATE = "0.20"  # currency per kWh
BUDGET_FACTOR = "1.05"
FORECAST_FACTOR = "0.97"
FORECAST_DAYS_AHEAD = 7  # the forecast of a day comes from the figures of a week before
CURRENCY_BY_REGION = {
    "AFRICA": "ZAR",
    "AMERICA": "USD",
    "ASIA": "JPY",
    "EUROPE": "EUR",
    "MIDDLE EAST": "AED",
}
MEAL_DEAL_SOURCE_TYPE = "PROMO"
MEAL_DEAL_CATEGORY = "Meal Deal"
EXCLUDED_BRAND = "Brand#1"
EXCLUSION_REASON = "Not priced for ATV"
EXCLUSION_ACTIVE_MIN_SIZE = 26
OVERRIDE_BRAND = "Brand#2"
OVERRIDE_ACTIVE_MAX_SIZE = 40
OVERRIDE_PRICE_FACTOR = "0.90"
RENAMED_SUFFIX = " (renamed)"
FAULT_DAYS = 2000

# Fixed values of the plans: lines of one task after they are dealt (below FEW_TASKS tasks Spark's
# own sizing does), and the rows of units (a few short columns) that are sent along with a join.
LINES_PER_TASK = 250_000
FEW_TASKS = 8
BROADCAST_UNITS = 500_000

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(c: str) -> Column:
    """Driver timestamps have no zone: read them as UTC wall-clock time."""
    return F.col(c).cast("timestamp")


def _dec(c: str | Column, precision: int = 18, scale: int = 2) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal({precision},{scale})")


def unit_id_expr(suppkey: Column) -> Column:
    return F.concat(F.lit("U"), suppkey.cast("string"))


def location_id_expr(nationkey: Column) -> Column:
    return F.concat(F.lit("LOC"), F.lpad(nationkey.cast("string"), 3, "0"))


def product_id_expr(partkey: Column) -> Column:
    return F.concat(F.lit("P"), partkey.cast("string"))


def sent_along(units: DataFrame) -> DataFrame:
    """A table of one row per unit, broadcast with its joins if it has at most ``BROADCAST_UNITS``
    rows; a larger one is joined by shuffle or as Spark's statistics say."""
    return F.broadcast(units) if units.count() <= BROADCAST_UNITS else units


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region, 25 rows by definition of the schema."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders, the two columns that make the version order beside the given ones.

    Lines are dealt by their order key before anything else: the join needs that shuffle at size,
    deduplication reuses it, and the mapping then runs in as many tasks, however few files hold
    the table. A large table is dealt over a number of tasks that follows its rows, so what one task
    sorts does not grow with the table.
    """
    li = read_table(spark, sf_dir, "lineitem")
    tasks = math.ceil(li.count() / LINES_PER_TASK)
    li = li.repartition(tasks, "l_orderkey") if tasks > FEW_TASKS else li.repartition("l_orderkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).cast("long")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).withColumns(
        {"source_sequence": days, "source_update_ts": _ts("l_shipdate")}
    )


def sales_lines(spark: SparkSession, sf_dir: str, regions: Column | None = None) -> DataFrame:
    """Bronze sales lines of both ingestion routes (or of some regions), typed, with the route tag."""
    return mapped_lines(spark, sf_dir, order_lines(spark, sf_dir), regions)


def current_sales_lines(spark: SparkSession, sf_dir: str, by_product: bool = False) -> DataFrame:
    """The current version of each sales line, on request partitioned by product id.

    A line's business key is its order and line number, so versions are compared on these native
    keys, in the partitioning of the join, and only the survivors are mapped. Ties fall to the
    larger product and unit id, as text.
    """
    lines = order_lines(spark, sf_dir).withColumns({"__product": F.col("l_partkey").cast("string"), "__unit": F.col("l_suppkey").cast("string")})
    newest = latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["source_sequence", "source_update_ts"], tiebreak=["__product", "__unit"])
    return mapped_lines(spark, sf_dir, newest.drop("__product", "__unit"), by_product=by_product)


def mapped_lines(spark: SparkSession, sf_dir: str, lines: DataFrame, regions: Column | None = None, by_product: bool = False) -> DataFrame:
    """Order lines as sales lines under the sales contract.

    ``by_product`` deals the lines by product id while they are still a few numbers wide, for a
    caller that joins the mapped lines with the product dimension next.
    """
    part = read_table(spark, sf_dir, "part").select(
        product_id_expr(F.col("p_partkey")).alias("product_id"), "p_name", "p_type", "p_size"
    )
    supplier = sent_along(read_table(spark, sf_dir, "supplier")).select("s_suppkey", "s_name", "s_nationkey")
    geo = _geo(spark, sf_dir)
    geo = geo if regions is None else geo.where(regions)

    joined = (
        lines.withColumn("product_id", product_id_expr(F.col("l_partkey")))
        .join(part.hint("merge") if by_product else part, "product_id")
        .join(supplier, F.col("l_suppkey") == supplier.s_suppkey)
        .join(F.broadcast(geo), F.col("s_nationkey") == geo.n_nationkey)
    )

    # Money in exact 64-bit cents: discount = round_half_up(gross × rate), tax likewise on
    # (gross − discount); rates have two decimals, so every step is an integer operation.
    gross_c = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc_rate = F.round(F.col("l_discount") * 100).cast("long")
    tax_rate = F.round(F.col("l_tax") * 100).cast("long")
    discount_c = F.floor((gross_c * disc_rate + 50) / 100)
    tax_c = F.floor(((gross_c - discount_c) * tax_rate + 50) / 100)
    order_date = F.col("o_orderdate").cast("date")
    ship_date = F.col("l_shipdate").cast("date")
    time_of_day = F.lit(TRADING_DAY_START_SECONDS) + (
        F.col("o_orderkey") * TIME_OF_DAY_MULTIPLIER
    ) % F.lit(TRADING_DAY_LENGTH_SECONDS)
    # zone-free arithmetic on the driver's TIMESTAMP_NTZ values, one cast to UTC at the end
    completed = F.col("o_orderdate") + F.make_dt_interval(secs=time_of_day)
    is_json = F.col("r_name") == NEW_UNIT_REGION
    d = F.col("l_discount")

    return joined.select(
        order_date.alias("business_date"),
        F.col("n_name").alias("country_code"),
        location_id_expr(F.col("n_nationkey")).alias("location_id"),
        F.concat(F.col("n_name"), F.lit(" Terminal")).alias("location_name"),
        unit_id_expr(F.col("l_suppkey")).alias("unit_id"),
        F.col("s_name").alias("unit_name"),
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("transaction_id"),
        F.concat(
            F.lit("T"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ).alias("transaction_line_id"),
        completed.cast("timestamp").alias("transaction_completed_ts"),
        "product_id",
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        (F.col("l_linestatus") == "O").alias("is_combo"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("gross_sales"),
        (discount_c / 100).alias("discount_amount"),
        (tax_c / 100).alias("tax_amount"),
        F.when(d == 0, "NONE")
        .when(d < 0.03, "LOYALTY")
        .when(d < 0.06, "STAFF")
        .when(d < 0.09, "PROMO")
        .otherwise("WASTE")
        .alias("discount_type"),
        F.col("o_orderpriority").alias("discount_name"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "returned")
        .when((F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "N"), "cancelled")
        .otherwise("completed")
        .alias("line_status"),
        (F.col("p_size") > 3).alias("is_priced_product"),
        ((F.col("p_type") == "ECONOMY") & (F.col("p_size") <= 10)).alias("is_kitchen_instruction"),
        "source_sequence",
        "source_update_ts",
        (F.col("source_update_ts") + F.expr("INTERVAL 2 HOURS")).alias("extraction_ts"),
        F.when(is_json, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("pos_extract_"), F.translate(ship_date.cast("string"), "-", ""), F.lit(".csv")))
        .alias("source_file_name"),
        F.when(is_json, ROUTE_JSON).otherwise(ROUTE_DB).alias("_source_ingestion_route"),
    )


def pos_extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the database route, as its extract files hold them (with their file name)."""
    return sales_lines(spark, sf_dir, F.col("r_name") != NEW_UNIT_REGION)


def new_unit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the JSON route, whose files carry no extract file name."""
    return sales_lines(spark, sf_dir, F.col("r_name") == NEW_UNIT_REGION).drop("source_file_name")


# Total version order on the adapter's lines: two lines of one key can share a ship date,
# then product and unit decide (no ties remain on the driver data).
ADAPTER_TIEBREAK = ["product_id", "unit_id"]


def _event_units(df: DataFrame) -> DataFrame:
    u = F.floor(F.col("user_id") / USERS_PER_UNIT)
    return df.withColumns(
        {
            "country_code": F.concat(F.lit("EVT_"), (u % 5).cast("string")),
            "location_id": location_id_expr(u % 5),
            "unit_id": F.concat(F.lit("E"), u.cast("string")),
        }
    )


def event_sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw sales lines with real intraday timestamps (one line per event).

    All events but the meter readings: a failed one is a cancelled line, the others completed.
    """
    ev = read_table(spark, sf_dir, "events").filter(~F.col("event_type").isin(*METER_EVENTS))
    ts = _ts("ts")
    return _event_units(ev).select(
        F.to_date(ts).alias("business_date"),
        "country_code",
        "location_id",
        "unit_id",
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("E"), F.col("event_id").cast("string"), F.lit("-1")).alias("transaction_line_id"),
        ts.alias("transaction_completed_ts"),
        F.col("value").alias("gross_sales"),
        F.lit(0.0).alias("discount_amount"),
        F.lit(0.0).alias("tax_amount"),
        F.when(F.col("event_type") == "error", "cancelled").otherwise("completed").alias("line_status"),
        F.lit(1.0).alias("quantity"),
        F.lit(True).alias("is_priced_product"),
        F.lit(False).alias("is_kitchen_instruction"),
    )


def energy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks as meter readings: kWh = value, cost = kWh × rate (exact decimal)."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(*METER_EVENTS))
    return _event_units(ev).select(
        "unit_id",
        _ts("ts").alias("reading_ts"),
        F.col("value").alias("kwh_consumed"),
        F.lit(float(ENERGY_UNIT_RATE)).alias("energy_unit_rate"),
        F.round(_dec("value") * F.lit(ENERGY_UNIT_RATE).cast("decimal(4,2)"), 2)
        .cast("double")
        .alias("estimated_running_cost"),
    )


def unit_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    geo = _geo(spark, sf_dir)
    currency = F.create_map(*[F.lit(x) for kv in CURRENCY_BY_REGION.items() for x in kv])
    return supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey).select(
        F.col("n_name").alias("country_code"),
        location_id_expr(F.col("n_nationkey")).alias("location_id"),
        F.concat(F.col("n_name"), F.lit(" Terminal")).alias("location_name"),
        unit_id_expr(F.col("s_suppkey")).alias("unit_id"),
        F.col("s_name").alias("unit_name"),
        currency[F.col("r_name")].alias("currency_code"),
    )


def unit_mapping_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units the business renamed: suppliers with a negative account balance."""
    supplier = read_table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") < 0)
    return supplier.select(
        unit_id_expr(F.col("s_suppkey")).alias("unit_id"),
        F.concat(F.col("s_name"), F.lit(RENAMED_SUFFIX)).alias("corrected_unit_name"),
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(
        product_id_expr(F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("standard_unit_price"),
        (F.col("p_size") > 3).alias("is_priced_product"),
        ((F.col("p_type") == "ECONOMY") & (F.col("p_size") <= 10)).alias("is_kitchen_instruction"),
    )


def product_hierarchy_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").filter(F.col("p_type") == MEAL_DEAL_SOURCE_TYPE)
    return part.select(
        product_id_expr(F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.lit(MEAL_DEAL_CATEGORY).alias("corrected_category"),
    )


def product_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").filter(F.col("p_brand") == EXCLUDED_BRAND)
    return part.select(
        product_id_expr(F.col("p_partkey")).alias("product_id"),
        F.lit(EXCLUSION_REASON).alias("exclusion_reason"),
        (F.col("p_size") >= EXCLUSION_ACTIVE_MIN_SIZE).alias("is_active"),
    )


def combo_price_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").filter(F.col("p_brand") == OVERRIDE_BRAND)
    price = F.round(_dec("p_retailprice") * F.lit(OVERRIDE_PRICE_FACTOR).cast("decimal(4,2)"), 2)
    return part.select(
        product_id_expr(F.col("p_partkey")).alias("product_id"),
        price.cast("string").alias("override_unit_price"),
        (F.col("p_size") <= OVERRIDE_ACTIVE_MAX_SIZE).alias("is_active"),
    )


def country_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).select(
        F.col("n_name").alias("country_code"),
        F.initcap(F.col("n_name")).alias("country_name"),
        F.col("r_name").alias("region"),
    )


def _daily_unit_gross_cents(spark: SparkSession, sf_dir: str, days_ahead: int = 0) -> DataFrame:
    """Shipped gross cents per (date, unit), some days ahead: the plan figures are scaled from it.

    Three columns of lineitem only, reduced map-side by a partial aggregate. Lines are grouped by the
    plan's own key, so the shuffle of the sums serves the join of the plans as well.
    """
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select("l_shipdate", "l_suppkey", "l_extendedprice")
    shipped = F.col("l_shipdate").cast("date")
    day = F.date_add(shipped, days_ahead) if days_ahead else shipped
    return li.groupBy(day.alias("business_date"), unit_id_expr(F.col("l_suppkey")).alias("unit_id")).agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("gross_c")
    )


def _scaled(cents_col: str, factor: str) -> Column:
    """cents × factor (two decimals), rounded half up to a cent, as a double amount."""
    basis = int(round(float(factor) * 100))
    return F.floor((F.col(cents_col) * basis + 50) / 100) / 100


def daily_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget: the day's shipped gross by a fixed factor."""
    shipped = _daily_unit_gross_cents(spark, sf_dir)
    return shipped.select("business_date", "unit_id", _scaled("gross_c", BUDGET_FACTOR).alias("daily_budget_net_sales"))


def daily_forecast(spark: SparkSession, sf_dir: str, partitioned: bool = True) -> DataFrame:
    """Forecast: the shipped gross of a week before by a fixed factor, so either plan has
    days that the other lacks.

    Not ``partitioned``, the budget's sums are moved ahead: beside the budget they are not taken
    from the lines a second time, but shuffled once more for a join by date and unit.
    """
    if partitioned:
        shipped = _daily_unit_gross_cents(spark, sf_dir, FORECAST_DAYS_AHEAD)
    else:
        shipped = _daily_unit_gross_cents(spark, sf_dir).withColumn("business_date", F.date_add("business_date", FORECAST_DAYS_AHEAD))
    return shipped.select("business_date", "unit_id", _scaled("gross_c", FORECAST_FACTOR).alias("forecast_net_sales"))


def faulty_sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as a faulty extract would deliver them, for the landing and Bronze rules.

    Untaxed lines without discount lost their transaction id, lines shipped more than 2,000
    days before their order the business date, and unpriced products post negative amounts.
    """
    lines = sales_lines(spark, sf_dir)
    untaxed = (F.col("tax_amount") == 0) & (F.col("discount_amount") == 0)
    return lines.withColumns(
        {
            "transaction_id": F.when(~untaxed, F.col("transaction_id")),
            "business_date": F.when(F.col("source_sequence") >= -FAULT_DAYS, F.col("business_date")),
            "gross_sales": F.when(F.col("is_priced_product"), F.col("gross_sales")).otherwise(-F.col("gross_sales")),
        }
    )


def faulty_energy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a unit (users under one unit's count) and with credited cost."""
    readings = energy_readings(spark, sf_dir)
    return readings.withColumns(
        {
            "unit_id": F.when(F.col("unit_id") != "E0", F.col("unit_id")),
            "estimated_running_cost": F.when(F.col("kwh_consumed") < 100, F.col("estimated_running_cost")).otherwise(-F.col("estimated_running_cost")),
        }
    )
