"""Macro-economic source landings as Spark jobs that start from landed files.

* CBP county file (delimited text, latin1, all strings; ``N`` = suppressed)
* BLS CPI API body (object -> series array -> data array -> footnotes)
* FRED observation bodies (one per series), concatenated
* FRPS "Table 1" cell rows (row, indent level, label, 3 measures x 4 years):
  breadcrumb path per row, then wide -> long
* latest value per series; CBP -> industry / region / size weights

Sentinels (``-``, ``.``, empty, null) drop the row *before* any cast, since
ANSI casts raise on them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference source definitions).
CPI_SERIES = {"CUUR0000SA0": "not_seasonally_adjusted", "CUSR0000SA0": "seasonally_adjusted"}
FRED_SERIES = {"FEDFUNDS": "effective_federal_funds_rate", "MPRIME": "bank_prime_loan_rate"}
# Fixed values (must equal the reference): CBP size-class columns -> employer size class.
CBP_SIZE_COLUMNS = {"n<5": "1-4", "n5_9": "5-9", "n10_19": "10-19", "n20_49": "20-49", "n50_99": "50-99",
                    "n100_249": "100-249", "n250_499": "250-499", "n500_999": "500-999", "n1000": "1000+"}
# CBP source columns -> names of the landed table.
CBP_RENAMES = {"fipstate": "state_fips", "fipscty": "county_fips", "naics": "naics_code", "emp": "employment",
               "qp1": "q1_payroll_usd_thousands", "ap": "annual_payroll_usd_thousands", "est": "establishment_count"}
CBP_NUMERIC = ["emp", "qp1", "ap", "est"] + list(CBP_SIZE_COLUMNS)
FRPS_YEARS = [2015, 2018, 2021, 2024]  # fixed values: collection years of the sheet
# Fixed values (must equal the reference): NAICS sector -> industry; retail (44, incl. nonstore) is split 80/20;
# "other" is fixed at 5 %.
NAICS_TO_INDUSTRY = {"72----": "restaurant_food_service", "54----": "professional_services",
                     "62----": "health_wellness", "23----": "home_trade_services", "81----": "auto_services"}
RETAIL_COMBINED = "44----"
RETAIL_SPLIT = {"retail": 0.80, "ecommerce_online_retail": 0.20}
OTHER_SHARE = 0.05
# Fixed values (public codes): state FIPS -> postal code, census region -> states.
FIPS_TO_STATE = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT",
    "10": "DE", "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL",
    "18": "IN", "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD",
    "25": "MA", "26": "MI", "27": "MN", "28": "MS", "29": "MO", "30": "MT", "31": "NE",
    "32": "NV", "33": "NH", "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND",
    "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC", "46": "SD",
    "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV",
    "55": "WI", "56": "WY",
}
REGION_STATES = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX"],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}


def _lookup(col: Column, mapping: dict, default=None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = m[col]
    return F.coalesce(out, F.lit(default)) if default is not None else out


# ---------------------------------------------------------------- CBP
def naics_at_level(naics: Column, digits: int) -> Column:
    """Code padded to 6 with '-'/'/' that keeps exactly ``digits`` significant characters."""
    significant = F.regexp_replace(naics, "[-/]+$", "")
    return (F.length(significant) == digits) & naics.endswith("-" * (6 - digits))


def read_cbp(spark: SparkSession, path: str, naics_digits: int = 2, vintage_year: int = 2023) -> DataFrame:
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("inferSchema", False).csv(path)
    raw = raw.toDF(*[c.strip().lower() for c in raw.columns])
    return parse_cbp(raw, naics_digits, vintage_year, source_file=path)


def parse_cbp(raw: DataFrame, naics_digits: int = 2, vintage_year: int = 2023, source_file: str = "") -> DataFrame:
    df = raw.where(naics_at_level(F.col("naics"), naics_digits))
    for c in CBP_NUMERIC:  # "N" = withheld: a real null, never a zero
        df = df.withColumn(c, F.when(F.col(c) == "N", None).otherwise(F.col(c)).cast("double"))
    df = df.withColumnsRenamed({**CBP_RENAMES, **CBP_SIZE_COLUMNS})
    return df.withColumn("vintage_year", F.lit(vintage_year)).withColumn("source_file", F.lit(source_file))


# ---------------------------------------------------------------- CPI
CPI_BODY_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("Results", T.StructType([T.StructField("series", T.ArrayType(T.StructType([
        T.StructField("seriesID", T.StringType()),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("year", T.StringType()), T.StructField("period", T.StringType()),
            T.StructField("periodName", T.StringType()), T.StructField("value", T.StringType()),
            T.StructField("footnotes", T.ArrayType(T.StructType([T.StructField("code", T.StringType())])))])))])))])),
])


def parse_cpi(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """One row per (series, year, period) with a released value; ``bodies`` holds raw JSON strings."""
    b = bodies.select(F.from_json(F.col(body_col), CPI_BODY_SCHEMA).alias("b"))
    s = b.select(F.explode("b.Results.series").alias("s"))
    d = s.select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("d"))
    d = d.where(F.col("d.value").isNotNull() & ~F.col("d.value").isin("-", ""))
    codes = F.filter(F.transform(F.coalesce(F.col("d.footnotes"), F.array()), lambda f: f["code"]),
                     lambda c: c.isNotNull() & (c != ""))
    return d.select(
        "series_id", _lookup(F.col("series_id"), CPI_SERIES, "unknown").alias("series_type"),
        F.col("d.year").cast("int").alias("year"), F.col("d.period").alias("period"),
        F.col("d.periodName").alias("period_name"), F.col("d.value").cast("double").alias("value"),
        F.array_join(codes, ",").alias("footnote_codes"))


def read_cpi(spark: SparkSession, path: str) -> DataFrame:
    return parse_cpi(spark.read.text(path, wholetext=True).withColumnRenamed("value", "body"))


# ---------------------------------------------------------------- FRED
FRED_BODY_SCHEMA = T.StructType([T.StructField("observations", T.ArrayType(T.StructType([
    T.StructField("realtime_start", T.StringType()), T.StructField("realtime_end", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("value", T.StringType())])))])


def parse_fred(bodies: DataFrame, series_id: str, series_type: str, body_col: str = "body") -> DataFrame:
    o = bodies.select(F.explode(F.from_json(F.col(body_col), FRED_BODY_SCHEMA)["observations"]).alias("o"))
    o = o.where(F.col("o.value").isNotNull() & ~F.col("o.value").isin(".", ""))
    return o.select(F.lit(series_id).alias("series_id"), F.lit(series_type).alias("series_type"),
                    F.col("o.date").alias("observation_date"), F.col("o.value").cast("double").alias("value"))


def read_fred(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``paths``: series id -> landed body file; all series concatenated."""
    frames = [parse_fred(spark.read.text(p, wholetext=True).withColumnRenamed("value", "body"), sid,
                         FRED_SERIES.get(sid, "unknown")) for sid, p in paths.items()]
    return reduce(DataFrame.unionByName, frames)


def latest_per_series(df: DataFrame, order_cols: list[str], exclude_annual: bool = False) -> DataFrame:
    """The row with the greatest ``order_cols`` per series (a max_by, no sort)."""
    if exclude_annual and "period" in df.columns:
        df = df.where(F.col("period") != "M13")
    key = F.struct(*order_cols)
    return df.groupBy("series_id").agg(F.max_by(F.struct(*df.columns), key).alias("r")).select("r.*")


# ---------------------------------------------------------------- FRPS
def frps_cell_schema() -> T.StructType:
    fields = [T.StructField("row_number", T.IntegerType()), T.StructField("level", T.IntegerType()),
              T.StructField("label", T.StringType())]
    for y in FRPS_YEARS:
        fields += [T.StructField(f"count_{y}", T.DoubleType()), T.StructField(f"value_{y}", T.DoubleType()),
                   T.StructField(f"avg_{y}", T.DoubleType())]
    return T.StructType(fields)


def _breadcrumbs(rows: DataFrame, sheet: list[str]) -> DataFrame:
    """``category_path`` of every row: the labels of the open levels above it, and its own.

    The running stack holds, per level that occurs, the last row on it; a row
    is still open if no shallower row came after it. So a row carries as many
    entries as the sheets have levels (a sheet indents a few times, the
    distinct levels are collected), in one window over its own sheet.
    """
    depths = sorted(r["level"] for r in rows.select("level").where("level IS NOT NULL").distinct().collect())
    so_far = Window.partitionBy(*sheet).orderBy("row_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(F.when(F.col("level") == d, F.struct("row_number", "label")), ignorenulls=True).over(so_far) for d in depths]
    entries = F.array(*[F.struct(F.lit(d).alias("level"), e["row_number"].alias("at"), e["label"].alias("label")) for d, e in zip(depths, last)])
    start = F.struct(F.array().cast("array<string>").alias("path"), F.lit(-1).cast("long").alias("newest"))

    def step(acc, e):
        is_open = e.at.isNotNull() & (e.level <= F.col("level")) & (e.at > acc.newest)
        return F.struct(F.when(is_open, F.concat(acc.path, F.array(e.label))).otherwise(acc.path).alias("path"),
                        F.greatest(acc.newest, F.coalesce(e.at.cast("long"), F.lit(-1))).alias("newest"))
    rows = rows.withColumn("_entries", entries if depths else F.array().cast("array<struct<level:int,at:int,label:string>>"))
    path = F.aggregate("_entries", start, step, lambda acc: F.concat_ws(" > ", acc.path))
    return rows.withColumn("category_path", F.when(F.col("level").isNull(), "").otherwise(path)).drop("_entries")


def frps_long(cells: DataFrame) -> DataFrame:
    """Breadcrumb path per row, then one row per (row, collection year).

    A row with no data (section header, note) is dropped first. Several sheets
    are told apart by a column ``sheet``, which is kept if there is one; there
    is no limit of depth or of rows.
    """
    sheet = [c for c in ("sheet",) if c in cells.columns]
    measures = [c for c in cells.columns if c.split("_")[0] in ("count", "value", "avg")]
    df = cells.where(F.col("label").isNotNull() & reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures]))
    df = _breadcrumbs(df.withColumn("label", F.trim("label")), sheet)
    years = F.array(*[F.struct(F.lit(y).alias("collection_year"), F.col(f"count_{y}").alias("count_billions"),
                               F.col(f"value_{y}").alias("value_trillions_usd"),
                               F.col(f"avg_{y}").alias("avg_transaction_amount_usd")) for y in FRPS_YEARS])
    long = df.select(*sheet, "row_number", F.col("level").alias("hierarchy_level"), F.col("label").alias("payment_type_label"),
                     "category_path", F.inline(years))
    return long.where(F.col("count_billions").isNotNull() | F.col("value_trillions_usd").isNotNull())


# ---------------------------------------------------------------- CBP -> weights
def segment_weights(cbp: DataFrame) -> DataFrame:
    """(dimension, segment, weight) shares of establishments, rounded to 4."""
    est = F.col("establishment_count")
    ind = cbp.select(_lookup(F.col("naics_code"), NAICS_TO_INDUSTRY).alias("segment"), est) \
        .where(F.col("segment").isNotNull()).groupBy("segment").agg(F.sum(est).alias("n"))
    retail_total = cbp.where(F.col("naics_code") == RETAIL_COMBINED).agg(F.sum(est)).scalar()
    split = cbp.sparkSession.createDataFrame(list(RETAIL_SPLIT.items()), "segment string, share double") \
        .select("segment", (F.col("share") * retail_total).alias("n"))
    counts = ind.unionByName(split)
    mapped_sum = counts.agg(F.sum("n")).scalar()
    named = counts.select(F.lit("industry").alias("dimension"), "segment",
                          F.round(F.col("n") * (1 - OTHER_SHARE) / mapped_sum, 4).alias("weight"))
    other = named.agg(F.round(F.lit(1.0) - F.sum("weight"), 4).alias("weight")) \
        .select(F.lit("industry").alias("dimension"), F.lit("other").alias("segment"), "weight")

    state_region = {s: r for r, states in REGION_STATES.items() for s in states}
    reg = cbp.select(_lookup(_lookup(F.col("state_fips"), FIPS_TO_STATE), state_region).alias("segment"), est) \
        .where(F.col("segment").isNotNull()).groupBy("segment").agg(F.sum(est).alias("n"))
    reg_total = reg.agg(F.sum("n")).scalar()
    regions = reg.select(F.lit("region").alias("dimension"), "segment", F.round(F.col("n") / reg_total, 4).alias("weight"))

    raw = list(CBP_SIZE_COLUMNS.values())
    sums = cbp.agg(*[F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).alias(c) for c in raw])  # nulls (suppressed) skipped
    merged = sums.select(*[F.col(f"`{c}`") for c in raw[:-2]],
                         (F.col("`500-999`") + F.col("`1000+`")).alias("500+"))
    classes = raw[:-2] + ["500+"]
    long = merged.select(F.inline(F.array(*[F.struct(F.lit(c).alias("segment"), F.col(f"`{c}`").alias("n"))
                                             for c in classes])))
    size_total = long.agg(F.sum("n")).scalar()
    sizes = long.select(F.lit("employer_size_class").alias("dimension"), "segment",
                        F.round(F.col("n") / size_total, 4).alias("weight"))
    return named.unionByName(other).unionByName(regions).unionByName(sizes)


# ---------------------------------------------------------------- runner
def land_all(spark: SparkSession, out_dir: str, run_id: str, ingested_at, cbp_path: str | None = None,
             cpi_path: str | None = None, fred_paths: dict[str, str] | None = None,
             frps_cells: DataFrame | None = None, logger=None) -> dict[str, int]:
    """Land every available macro source as Bronze (lineage stamped); skip missing ones with a warning.

    Returns {table: rows landed}. CPI passes the boundary contract first.
    """
    import logging

    from tillbook.operators.quality import guard
    from tillbook.sources import bronze
    from tillbook.sources.landing import add_lineage

    log = logger or logging.getLogger(__name__)
    parsed: dict[str, DataFrame] = {}
    if frps_cells is not None:
        parsed["frps_payment_volumes"] = frps_long(frps_cells)
    if cbp_path:
        parsed["cbp_establishments"] = read_cbp(spark, cbp_path)
    if cpi_path:
        cpi = read_cpi(spark, cpi_path)
        guard(cpi, "cpi_monthly", logger=log, stop=False)
        parsed["cpi_monthly"] = cpi
    if fred_paths:
        parsed["fred_rates"] = read_fred(spark, fred_paths)
    for name in ("frps_payment_volumes", "cbp_establishments", "cpi_monthly", "fred_rates"):
        if name not in parsed:
            log.warning("macro source %s not available; skipped", name)
    stamped = {name: add_lineage(df, name.split("_")[0] + "_ingest", run_id, ingested_at) for name, df in parsed.items()}
    return bronze.land(stamped, out_dir, run_id, ingested_at) if stamped else {}


def series_latest(cpi: DataFrame | None = None, fred: DataFrame | None = None) -> DataFrame:
    """Latest value per series across the CPI and FRED landings (series_id, period label, value)."""
    parts = []
    if cpi is not None:
        parts.append(latest_per_series(cpi, ["year", "period"]).select(
            "series_id", "series_type", F.concat_ws("-", F.col("year").cast("string"), "period").alias("as_of"),
            "value"))
    if fred is not None:
        parts.append(latest_per_series(fred, ["observation_date"]).select(
            "series_id", "series_type", F.col("observation_date").alias("as_of"), "value"))
    return reduce(DataFrame.unionByName, parts)
