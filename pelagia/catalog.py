"""One query per operator on the shared test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pelagia.functions.expressions import cluster_name, concat_key, group_label
from pelagia.operators import clean, dbscan as density, features, hierarchy, joins, kmeans as km, neighbors
from pelagia.operators import niche, sampling, silhouette, sketches, stats
from pelagia.plans import clusters as cluster_plans, niche as niche_plan, occurrence, taxon
from pelagia.runtime import scratch_path, stage
from pelagia.sources import delimited, paged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Positions derived from the customer table; the same text runs in Spark and in the checking engine.
GEO_POINTS = """
select c_custkey as rid, c_mktsegment as species, c_acctbal as sst,
  case when c_custkey % 97 = 5 then 95e0
       when c_custkey % 10 = 3 then ((c_custkey*48271) % 180000) / 1e3 - 90e0
       else ((c_nationkey*7) % 120 - 60) + ((c_custkey*7919) % 1000) / 1e3 end as lat,
  case when c_custkey % 101 = 7 then null
       when c_custkey % 10 = 3 then ((c_custkey*69621) % 360000) / 1e3 - 180e0
       else ((c_nationkey*53) % 340 - 170) + ((c_custkey*104729) % 1000) / 1e3 end as lon,
  case when c_custkey % 10 = 3 then -1 else c_nationkey end as cluster
from {customer}"""
GEO_SQL = "geo as (" + GEO_POINTS.format(customer="customer") + ")"
VALID_SQL = GEO_SQL + ", valid as (select * from geo where lat between -90 and 90 and lon between -180 and 180)"


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that checks it."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f
    return add


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def geo_points(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(GEO_POINTS, customer=read(spark, folder, "customer"))


def valid_points(spark: SparkSession, folder: str) -> DataFrame:
    return clean.valid_coordinates(geo_points(spark, folder), "lat", "lon")


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


# --- cleaning ----------------------------------------------------------------------------------------

@query(f"with {VALID_SQL} select rid, species, lat as latitude, lon as longitude from valid")
def clean_valid_coordinates(spark, folder):
    raw = geo_points(spark, folder).select(
        "rid", "species", F.col("lat").cast("string").alias("decimalLatitude"),
        F.coalesce(F.col("lon").cast("string"), F.lit("unknown")).alias("decimalLongitude"))
    typed = clean.cast_select(raw, {
        "rid": ("rid", "bigint"), "species": ("species", "string"),
        "decimalLatitude": ("latitude", "double"), "decimalLongitude": ("longitude", "double")})
    return clean.valid_coordinates(typed)


@query(f"with {VALID_SQL} select lat as decimalLatitude, lon as decimalLongitude, species, sst from valid")
def enriched_occurrences(spark, folder):
    raw = geo_points(spark, folder).withColumnsRenamed({"lat": "decimalLatitude", "lon": "decimalLongitude"})
    return occurrence.enriched_occurrences(raw)


@query(f"""with {GEO_SQL}, flags as (
  select lat is not null and lon is not null as a, coalesce(lat between -90 and 90, false) as b,
         coalesce(lon between -180 and 180, false) as c from geo),
n as (select count(*) as n0, count(*) filter (a) as n1, count(*) filter (a and b) as n2,
             count(*) filter (a and b and c) as n3 from flags)
select 1 as step, 'present' as filter, n0 as rows_before, n1 as rows_after, n0 - n1 as rows_dropped from n
union all select 2, 'latitude', n1, n2, n1 - n2 from n
union all select 3, 'longitude', n2, n3, n2 - n3 from n""")
def cleaning_report(spark, folder):
    return stats.cleaning_report(geo_points(spark, folder), {
        "present": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
        "latitude": F.col("lat").between(-90, 90), "longitude": F.col("lon").between(-180, 180)})


BLANKS = """select cast(p_partkey as {text}) as taxonID,
  case when p_partkey % 7 = 0 then '' when p_partkey % 11 = 0 then '  ' when p_partkey % 13 = 0 then null
       else concat(' ', p_name) end as scientificName,
  p_brand as kingdom, case when p_partkey % 17 = 0 then '' else p_type end as phylum from {part}"""


@query("with t as (" + BLANKS.format(text="varchar", part="part") + """)
select taxonID, trim(scientificName, ' ') as scientificName, kingdom, phylum from t
where scientificName is not null and trim(scientificName, ' ') != '' and phylum != ''""")
def clean_blank_rows(spark, folder):
    raw = spark.sql(BLANKS.format(text="string", part="{part}"), part=read(spark, folder, "part"))
    return taxon.clean_taxon_csv(raw, trim=True)


@query("with t as (" + BLANKS.format(text="varchar", part="part") + """)
select * from t where scientificName is not null and scientificName != '' and phylum != ''""")
def complete_rows(spark, folder):
    raw = spark.sql(BLANKS.format(text="string", part="{part}"), part=read(spark, folder, "part"))
    return taxon.clean_taxon_csv(raw)


@query("select doc_id, text, lang as language from documents where lang = 'en' and text is not null")
def language_subset(spark, folder):
    raw = read(spark, folder, "documents").withColumnRenamed("lang", " language ")
    named = clean.select_existing(clean.strip_column_names(raw), ["doc_id", "text", "vernacularName", "language"])
    return clean.drop_null(clean.filter_equals(named, "language", "en"), ["doc_id", "text"])


@query("""select conv_id, turn, role, text from (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from conversations)
where n = 1""")
def dedupe_by_key(spark, folder):
    return clean.dedupe(read(spark, folder, "conversations"), ["conv_id"], ["turn"])


@query("""select 'supplier' as origin, s_suppkey as id, s_name as name, s_acctbal as balance, null as segment
from supplier union all select 'customer', c_custkey, c_name, c_acctbal, c_mktsegment from customer""")
def append_by_name(spark, folder):
    s = clean.with_columns(clean.rename_columns(
        read(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"),
        {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}), {"origin": F.lit("supplier")})
    c = clean.with_columns(clean.rename_columns(
        read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}),
        {"origin": F.lit("customer")})
    return clean.append_by_name([s, c])


# --- joins -------------------------------------------------------------------------------------------

@query("""with sizes as (select c_nationkey as k, c_mktsegment as name, count(*) as customers from customer group by 1, 2)
select n_nationkey as nationkey, n_name as name, s_suppkey, s_name as name_sup, sizes.name as name_cust, customers,
       r_name as name_reg
from nation left join supplier on n_nationkey = s_nationkey left join sizes on n_nationkey = k
left join region on n_regionkey = r_regionkey""")
def left_join_chain(spark, folder):
    nation = read(spark, folder, "nation")
    base = nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), "s_suppkey", F.col("s_name").alias("name"))
    customers = read(spark, folder, "customer").groupBy(
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("customers"))
    regions = nation.join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("name"))
    nothing = customers.where(F.lit(False)).withColumn("unused", F.lit(1))
    return joins.left_join_chain(
        base, [(suppliers, "_sup"), (nothing, "_none"), (customers, "_cust"), (regions, "_reg")], "nationkey")


@query("select c_custkey as custkey, o_orderkey, o_totalprice, c_mktsegment "
       "from orders join customer on o_custkey = c_custkey")
def join_on_key(spark, folder):
    o = read(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    c = read(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    return joins.join_on_key(o, c, "custkey")


@query("""select custkey, o_orderkey, o_totalprice, c_name from (
  select c_custkey as custkey, o_orderkey, o_totalprice, c_name,
         row_number() over (partition by c_custkey order by o_orderkey) as n
  from orders join customer on o_custkey = c_custkey) where n = 1""")
def inner_join_dedupe(spark, folder):
    o = read(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    c = read(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.join_one_per_key(o, c, "custkey")


@query("""select event_id, user_id, event_type, value from events where user_id in (
  select user_id from events where user_id is not null group by user_id having count(value) >= 65)""")
def semi_join_groups(spark, folder):
    events = read(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return clean.min_group_size(events, "user_id", "value", 65)


@query("select c_nationkey, c_custkey, n_name from customer "
       "left join (select * from nation where n_regionkey < 4) on n_nationkey = c_nationkey")
def lookup(spark, folder):
    names = read(spark, folder, "nation").where("n_regionkey < 4").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup(read(spark, folder, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey")


@query("""with long as (
  select 'p_brand' as taxonomic_level, p_brand as taxonomic_group, p_partkey, p_retailprice from part
  union all select 'p_type', p_type, p_partkey, p_retailprice from part),
sizes as (select taxonomic_level, taxonomic_group, count(*) as n from long group by 1, 2)
select long.* from long join sizes using (taxonomic_level, taxonomic_group) where n >= 80""")
def match_groups(spark, folder):
    part = read(spark, folder, "part").select("p_partkey", "p_retailprice", "p_brand", "p_type")
    levels = ["p_brand", "p_type"]
    sizes = joins.unpivot_levels(part, levels, ["p_partkey"]).groupBy("taxonomic_level", "taxonomic_group").agg(
        F.count("*").alias("n")).where("n >= 80").drop("n")
    return joins.match_groups(part, sizes, levels, ["p_partkey", "p_retailprice"])


HAVERSINE_SQL = """2 * 6371.0088 * asin(sqrt(least(1.0,
  pow(sin((radians({lat}) - radians(avg_lat)) / 2), 2)
  + cos(radians(avg_lat)) * cos(radians({lat})) * pow(sin((radians({lon}) - radians(avg_lon)) / 2), 2))))"""


@query(f"""with {VALID_SQL},
centre as (select cluster, avg(lat) as avg_lat, avg(lon) as avg_lon from valid group by cluster)
select rid, cluster, round({HAVERSINE_SQL.format(lat="lat", lon="lon")}, 6) as distance_km
from valid join centre using (cluster)""")
def distance_to_centroid(spark, folder):
    points = valid_points(spark, folder)
    centres = stats.cluster_extent(points, "lat", "lon", "species")
    return rounded(joins.distance_to_centroid(points, centres, "lat", "lon").select("rid", "cluster", "distance_km"),
                   ["distance_km"])


# --- aggregates --------------------------------------------------------------------------------------

@query("select count(*) as rows from lineitem")
def row_count(spark, folder):
    return stats.row_count(read(spark, folder, "lineitem"))


@query("""with g as (select p_brand as countryCode, p_type as locality, count(p_partkey) as species_count
  from part group by 1, 2)
select countryCode, locality, species_count, dense_rank() over (order by countryCode) - 1 as country_encoded,
       concat(countryCode, '_', locality) as country_locality from g""")
def group_counts_encoded(spark, folder):
    part = read(spark, folder, "part").select(
        F.col("p_brand").alias("countryCode"), F.col("p_type").alias("locality"), F.col("p_partkey").alias("taxonID"))
    counts = stage(stats.count_per_group(part, ["countryCode", "locality"], "taxonID"))
    coded = features.ordinal_encode(counts, ["countryCode"]).withColumnRenamed("countryCode_encoded", "country_encoded")
    return coded.withColumn("country_locality", concat_key(["countryCode", "locality"]))


STATISTICS_SQL = f"""with {VALID_SQL},
extent as (select cluster, count(species) as count, avg(lat) as avg_lat, avg(lon) as avg_lon, min(lat) as min_lat,
  max(lat) as max_lat, min(lon) as min_lon, max(lon) as max_lon from valid group by cluster),
radius as (select cluster, case when cluster = -1 then 0e0
  else max({HAVERSINE_SQL.format(lat="lat", lon="lon")}) end as radius_km from valid join extent using (cluster) group by cluster),
area as (select *, pi() * radius_km * radius_km as area_km2 from extent join radius using (cluster)),
cluster_stats as (select *, case when cluster = -1 then 0e0 else count / (case when area_km2 = 0 then 1 else area_km2 end) end as density,
  case when cluster = -1 then 'Noise' else concat('Cluster ', cluster) end as cluster_name from area)"""


@query(STATISTICS_SQL + """
select cluster, count, round(avg_lat, 6) as avg_lat, round(avg_lon, 6) as avg_lon, min_lat, max_lat, min_lon, max_lon,
  round(radius_km, 6) as radius_km, round(area_km2, 3) as area_km2, round(density, 6) as density, cluster_name
from cluster_stats""")
def cluster_extent(spark, folder):
    table = stats.cluster_statistics(valid_points(spark, folder), "lat", "lon", "species")
    return rounded(rounded(table, ["avg_lat", "avg_lon", "radius_km", "density"]), ["area_km2"], 3)


@query(f"""with {VALID_SQL}, n as (
  select count(distinct cluster) filter (cluster != -1) as n_clusters,
         count(*) filter (cluster = -1) as n_noise, count(*) as n_rows from valid)
select *, round(n_noise * 100.0 / n_rows, 6) as noise_percent,
       format('{{:.2f}}%', cast(n_noise as double) * 100.0 / n_rows) as noise_text from n""")
def clustering_summary(spark, folder):
    return rounded(stats.clustering_summary(valid_points(spark, folder)), ["noise_percent"])


@query(f"with {VALID_SQL} select cluster, count(*) as rows from valid group by cluster")
def cluster_sizes(spark, folder):
    return stats.cluster_sizes(valid_points(spark, folder))


@query("select distinct p_type from part")
def distinct_values(spark, folder):
    return stats.distinct_values(read(spark, folder, "part"), "p_type")


ENVIRONMENT = ["l_quantity", "l_extendedprice", "l_discount"]


@query("select l_returnflag, " + ", ".join(
    f"round(avg({c}), 6) as {c}_mean, min({c}) as {c}_min, max({c}) as {c}_max, round(stddev_samp({c}), 6) as {c}_std"
    for c in ENVIRONMENT) + " from lineitem group by l_returnflag")
def environment_stats(spark, folder):
    table = stats.environment_stats(read(spark, folder, "lineitem"), [*ENVIRONMENT, "absent"], "l_returnflag")
    return rounded(table, [f"{c}_{s}" for c in ENVIRONMENT for s in ("mean", "std")])


RANK_SQL = """{r}_n as (select l_returnflag, {r} as taxon, count({r}) as n from items group by 1, 2),
{r}_s as (select l_returnflag, count(taxon) as unique_{r}_count,
  coalesce(ln(sum(n)) - sum(case when n > 0 then n * ln(n) else 0 end) / nullif(sum(n), 0), 0) as {r}_diversity
  from {r}_n group by 1)"""


@query("with items as (select l_returnflag, p_type, p_brand from lineitem join part on l_partkey = p_partkey), "
       + ", ".join(RANK_SQL.format(r=r_) for r_ in ("p_type", "p_brand"))
       + """ select l_returnflag, unique_p_type_count, round(p_type_diversity, 6) as p_type_diversity,
  unique_p_brand_count, round(p_brand_diversity, 6) as p_brand_diversity
from p_type_s join p_brand_s using (l_returnflag)""")
def shannon_diversity(spark, folder):
    items = read(spark, folder, "lineitem").join(read(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    table = stats.taxonomy_stats(items, ["p_type", "p_brand"], "l_returnflag")
    return rounded(table, ["p_type_diversity", "p_brand_diversity"])


@query("select l_returnflag, count(distinct l_suppkey) as unique_l_suppkey_count, "
       "count(distinct l_linestatus) as unique_l_linestatus_count from lineitem group by 1")
def unique_counts(spark, folder):
    return stats.unique_counts(read(spark, folder, "lineitem"), ["l_suppkey", "l_linestatus"], "l_returnflag")


@query("select l_returnflag, count(distinct l_partkey) as parts, true as within_error from lineitem group by 1")
def distinct_sketches(spark, folder):
    """Sketches per flag and supplier, merged per flag: within four standard errors of the exact count."""
    items = read(spark, folder, "lineitem")
    merged = sketches.merge_sketches(sketches.distinct_sketches(items, ["l_returnflag", "l_suppkey"], ["l_partkey"]), ["l_returnflag"])
    exact = items.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    both = exact.join(sketches.distinct_estimates(merged), "l_returnflag")
    off = F.abs(F.col("l_partkey_distinct") - F.col("parts"))
    return both.select("l_returnflag", "parts", (off <= F.col("parts") * (4 / 2 ** (sketches.BITS / 2))).alias("within_error"))


@query("select l_returnflag, count(l_quantity) as n, true as within_error from lineitem group by 1")
def quantile_sketches(spark, folder):
    """Sketches per flag and line number, merged per flag: the rank of every quantile within its error of the exact one."""
    items = read(spark, folder, "lineitem")
    wanted = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
    fine = sketches.quantile_sketches(items, ["l_returnflag", "l_linenumber"], ["l_extendedprice"])
    found = sketches.quantile_estimates(sketches.merge_sketches(fine, ["l_returnflag"]), "l_extendedprice", wanted)
    ranked = items.join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag").agg(
        F.count("l_quantity").alias("n"), *[F.avg((F.col("l_extendedprice") <= F.col(c)).cast("double")).alias(f"rank_{c}") for c in wanted])
    worst = F.greatest(*[F.abs(F.col(f"rank_{c}") - q) for c, q in wanted.items()])
    return ranked.select("l_returnflag", "n", (worst <= 0.03).alias("within_error"))


# --- value profiles ----------------------------------------------------------------------------------

def profile_sql(source: str, keys: str, digits: int, min_obs: int) -> str:
    """Value profile per group of ``source(keys…, v)``: the same definitions, written as SQL."""
    on = keys
    return f"""src as ({source}),
m as (select {keys}, count(v) as observations, avg(v) as mean, median(v) as median, min(v) as lo, max(v) as hi,
  stddev_samp(v) as std, quantile_cont(v, 0.05) as p05, quantile_cont(v, 0.95) as p95, quantile_cont(v, 0.25) as q1,
  quantile_cont(v, 0.75) as q3 from src group by {keys} having count(v) >= {min_obs}),
modes as (select {keys}, v as mode from (select {keys}, v, row_number() over (partition by {keys} order by count(*) desc, v) as n
  from src group by {keys}, v) where n = 1),
b0 as (select *, case when lo = hi then lo - 0.5 else lo end as l, case when lo = hi then hi + 0.5 else hi end as h
  from src join m using ({on})),
b1 as (select *, (h - l) / 20.0 as step, least(cast(floor((v - l) / (h - l) * 20.0) as integer), 19) as i from b0),
b2 as (select *, case when v < l + i * step then i - 1
  when i < 19 and v >= l + (i + 1) * step then i + 1 else i end as bin from b1),
b3 as (select {keys}, bin, count(*) as n, min(l) as l, min(h) as h, min(step) as step from b2 group by {keys}, bin),
peaks as (select {keys}, bin, n as peak_rows, ((l + bin * step) + (case when bin = 19 then h else l + (bin + 1) * step end)) / 2 as peak
  from (select *, row_number() over (partition by {keys} order by n desc, bin) as k from b3) where k = 1),
profile as (select {keys}, observations, round(mean, {digits}) as mean, round(median, {digits}) as median,
  mode, round(peak, {digits}) as peak, lo as min, hi as max, round(std, {digits}) as std, round(p05, {digits}) as p05,
  round(p95, {digits}) as p95, round(q1, {digits}) as q1, round(q3, {digits}) as q3, round(q1, {digits}) as optimal_min,
  round(q3, {digits}) as optimal_max, round(hi - lo, {digits}) as range_width, round(q3 - q1, {digits}) as optimal_width,
  bin as peak_bin, peak_rows
  from m join modes using ({on}) join peaks using ({on}))"""


EVENT_PROFILE = "with " + profile_sql("select event_type, value as v from events", "event_type", 6, 1)
PROFILE_DOUBLES = ["mean", "median", "peak", "std", "p05", "p95", "q1", "q3", "optimal_min", "optimal_max",
                   "range_width", "optimal_width"]


@query(EVENT_PROFILE + " select event_type, observations, mean, median, min, max, std from profile")
def describe_by_group(spark, folder):
    return rounded(niche.describe_by_group(read(spark, folder, "events"), ["event_type"], "value"), ["mean", "median", "std"])


@query(EVENT_PROFILE + " select event_type, p05, q1, median, q3, p95 from profile")
def percentiles_by_group(spark, folder):
    table = niche.percentiles_by_group(read(spark, folder, "events"), ["event_type"], "value")
    return rounded(table, ["p05", "q1", "median", "q3", "p95"])


@query(EVENT_PROFILE + " select event_type, mode from profile")
def mode_by_group(spark, folder):
    return niche.mode_by_group(read(spark, folder, "events"), ["event_type"], "value")


@query(EVENT_PROFILE + " select event_type, peak, peak_bin, peak_rows from profile")
def histogram_peak(spark, folder):
    return rounded(niche.histogram_peak(read(spark, folder, "events"), ["event_type"], "value"), ["peak"])


@query(EVENT_PROFILE + " select event_type, min, max, optimal_min, optimal_max, range_width, optimal_width from profile")
def range_widths(spark, folder):
    table = niche.value_profile(read(spark, folder, "events"), ["event_type"], "value")
    return rounded(table, PROFILE_DOUBLES).select(
        "event_type", "min", "max", "optimal_min", "optimal_max", "range_width", "optimal_width")


@query("""select l_suppkey, l_returnflag from (select l_suppkey, l_returnflag,
  row_number() over (partition by l_suppkey order by count(*) desc, l_returnflag) as k
  from lineitem where l_returnflag is not null group by 1, 2) where k = 1""")
def dominant_parent(spark, folder):
    return niche.dominant_value(read(spark, folder, "lineitem"), ["l_suppkey"], "l_returnflag", "l_returnflag")


LEVELS = ["region", "nation", "segment"]
SALES_SQL = """sales as (select o_orderkey as rid, r_name as region, n_name as nation, c_mktsegment as segment,
  o_totalprice as sst from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)"""
LONG_SQL = " union all ".join(
    f"select '{c}' as taxonomic_level, {c} as taxonomic_group, sst as v from sales" for c in LEVELS)
PARENT_SQL = ", ".join(f"""parent_{c}_t as (select taxonomic_level, taxonomic_group, name as parent_{c} from (
  select taxonomic_level, taxonomic_group, name, row_number() over (
    partition by taxonomic_level, taxonomic_group order by count(*) desc, name) as k
  from (""" + " union all ".join(
    f"select '{f}' as taxonomic_level, {f} as taxonomic_group, {c} as name from sales"
    for f in LEVELS[i + 1:]) + ") group by 1, 2, 3) where k = 1)" for i, c in enumerate(LEVELS[:-1]))
NICHE_NAMES = ", ".join(f"{a} as {b}" for a, b in niche.NICHE_COLUMNS.items())
KEYS_SQL = "taxonomic_level, taxonomic_group"
NICHE_SQL = (f"with {SALES_SQL}, {profile_sql(LONG_SQL, KEYS_SQL, 6, 10)}, {PARENT_SQL}, "
             f"niche as (select {KEYS_SQL}, {NICHE_NAMES}, parent_region, parent_nation from profile "
             f"left join parent_region_t using ({KEYS_SQL}) left join parent_nation_t using ({KEYS_SQL}))")


def sales(spark, folder):
    return (read(spark, folder, "orders")
            .join(read(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("o_orderkey").alias("rid"), F.col("r_name").alias("region"), F.col("n_name").alias("nation"),
                    F.col("c_mktsegment").alias("segment"), F.col("o_totalprice").alias("sst")))


NICHE_DOUBLES = [niche.NICHE_COLUMNS[c] for c in PROFILE_DOUBLES]


@query(NICHE_SQL + " select * from niche")
def niche_multi_level(spark, folder):
    return rounded(niche.multi_level_stats(sales(spark, folder), LEVELS, "sst"), NICHE_DOUBLES)


@query(NICHE_SQL + f""" select {KEYS_SQL}, observation_count,
  concat(substring(taxonomic_group, 1, 25), ' (', observation_count, ' obs)') as label
from niche order by observation_count desc, {KEYS_SQL} limit 20""")
def top_groups(spark, folder):
    table = niche.multi_level_stats(sales(spark, folder), LEVELS, "sst")
    return sampling.top_groups(table, "observation_count", niche_plan.KEYS).select(
        *niche_plan.KEYS, "observation_count", group_label("taxonomic_group", "observation_count").alias("label"))


@query(NICHE_SQL + f""", long as ({LONG_SQL.replace('sst as v', 'sst as v, rid')}),
shown as (select * from niche order by observation_count desc, {KEYS_SQL} limit 100),
firsts as (select *, row_number() over (partition by {KEYS_SQL} order by rid) as k from long),
lists as (select {KEYS_SQL}, count(*) as values_shown, round(sum(v), 2) as total from firsts where k <= 1000 group by {KEYS_SQL})
select {KEYS_SQL}, observation_count as count, optimal_temp_min as optimal_min, optimal_temp_max as optimal_max,
  peak_temperature as peak, values_shown, total from shown join lists using ({KEYS_SQL})""")
def niche_distributions(spark, folder):
    df = sales(spark, folder)
    table = stage(niche.multi_level_stats(df, LEVELS, "sst"), "niche")
    lists = niche_plan.niche_distributions(df, table, LEVELS, "sst", "rid")
    total = F.aggregate("all_temperatures", F.lit(0.0), lambda a, v: a + v)
    return rounded(lists, ["optimal_min", "optimal_max", "peak"]).select(
        *niche_plan.KEYS, "count", "optimal_min", "optimal_max", "peak",
        F.size("all_temperatures").cast("bigint").alias("values_shown"), r(total, 2).alias("total"))


@query("""select event_type, count(*) as values_shown, round(sum(value), 4) as total,
  max(value) filter (k = 1) as first_value, max(value) filter (k = n) as last_value
from (select *, least(1000, count(*) over (partition by event_type)) as n from (
  select *, row_number() over (partition by event_type order by event_id) as k from events where value is not null))
where k <= 1000 group by event_type""")
def capped_values(spark, folder):
    lists = sampling.collect_values(read(spark, folder, "events"), ["event_type"], "value", "event_id")
    v = F.col("all_values")
    return lists.select(
        "event_type", F.size(v).cast("bigint").alias("values_shown"),
        r(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        F.get(v, F.lit(0)).alias("first_value"), F.get(v, F.size(v) - 1).alias("last_value"))


# --- ordering and samples ----------------------------------------------------------------------------

@query("select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def sort_and_preview(spark, folder):
    rows = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.preview(sampling.sort_by_count(rows, "o_totalprice", ["o_orderkey"]), 10)


@query("select o_orderkey, o_custkey from orders order by o_orderkey limit 1000")
def cap_rows(spark, folder):
    return sampling.cap_rows(read(spark, folder, "orders").select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"])


@query(f"""with {VALID_SQL} select rid, lat, lon from valid
order by md5(concat(cast(rid as varchar), ':7')), rid limit 500""")
def sample_n(spark, folder):
    return sampling.sample_n(valid_points(spark, folder).select("rid", "lat", "lon"), "rid", 500, seed=7)


@query(f"""with {VALID_SQL}, ranked as (select rid, cluster, cluster = -1 as is_noise,
  row_number() over (partition by cluster = -1 order by md5(concat(cast(rid as varchar), ':7')), rid) as k from valid)
select rid, cluster, is_noise from ranked where k <= case when is_noise then 50 else 300 end""")
def preview_sample(spark, folder):
    points = clean.with_noise_flag(valid_points(spark, folder).select("rid", "cluster"))
    return sampling.preview_sample(points, "rid", points=300, noise=50, seed=7)


# --- features and k-means ----------------------------------------------------------------------------

@query("""select n_name, n_regionkey, dense_rank() over (order by n_name) - 1 as n_name_encoded,
  dense_rank() over (order by n_regionkey) - 1 as n_regionkey_encoded from nation""")
def ordinal_encode(spark, folder):
    nation = read(spark, folder, "nation").select("n_name", "n_regionkey")
    return features.ordinal_encode(nation, ["n_name", "n_regionkey"])


@query("""select p_partkey, dense_rank() over (order by p_name) - 1 as p_name_encoded,
  dense_rank() over (order by p_brand) - 1 as p_brand_encoded from part""")
def encode_part_names(spark, folder):
    part = read(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return features.ordinal_encode(part, ["p_name", "p_brand"]).select("p_partkey", "p_name_encoded", "p_brand_encoded")


@query("""select p_partkey, round((p_retailprice - m) / s, 6) as p_retailprice_scaled, round((p_size - ms) / ss, 6) as p_size_scaled
from part, (select avg(p_retailprice) as m, stddev_pop(p_retailprice) as s, avg(p_size) as ms, stddev_pop(p_size) as ss from part)""")
def standard_scale(spark, folder):
    scaled = features.standard_scale(read(spark, folder, "part"), ["p_retailprice", "p_size"])
    return rounded(scaled.select("p_partkey", "p_retailprice_scaled", "p_size_scaled"),
                   ["p_retailprice_scaled", "p_size_scaled"])


@query("select c_custkey, round(c_acctbal, 6) as c_acctbal from customer")
def unscale(spark, folder):
    df = read(spark, folder, "customer").select("c_custkey", "c_acctbal")
    params = features.fit_scaler(df, ["c_acctbal"])
    back = features.standard_unscale(features.standard_scale(df, ["c_acctbal"], params), params)
    return back.select("c_custkey", r(F.col("c_acctbal_unscaled")).alias("c_acctbal"))


def embedding_columns(spark, folder):
    """The vectors as one numeric column per position."""
    vectors = read(spark, folder, "embeddings")
    return vectors.selectExpr("vec_id", *[f"double(embedding[{i}]) AS e{i}" for i in range(64)])


EMBEDDING = [f"e{i}" for i in range(64)]


@query()
def kmeans(spark, folder):
    return km.kmeans(embedding_columns(spark, folder), EMBEDDING, 4, seed=1).select("vec_id", "cluster")


@query()
def kmeans_cost_curve(spark, folder):
    part = read(spark, folder, "part").select("p_size", "p_retailprice")
    return rounded(km.kmeans_cost_curve(part, ["p_size", "p_retailprice"], list(range(1, 11)), seed=42), ["cost"], 3)


@query()
def silhouette_squared(spark, folder):
    points = km.kmeans(read(spark, folder, "part"), ["p_size", "p_retailprice"], 4, seed=1)
    return rounded(km.silhouette_squared(points, ["p_size", "p_retailprice"]), ["silhouette_squared"])


@query()
def silhouette_curve(spark, folder):
    coded = features.ordinal_encode(read(spark, folder, "part").select("p_name"), ["p_name"])
    return rounded(km.silhouette_curve(coded, ["p_name_encoded"], list(range(2, 11)), seed=42), ["silhouette"])


@query()
def hierarchical_cluster(spark, folder):
    part = read(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    coded = features.ordinal_encode(part, ["p_brand", "p_type"])
    return hierarchy.hierarchical_cluster(coded, ["p_brand_encoded", "p_type_encoded", "p_size"], 7).select(
        "p_partkey", "cluster")


SPREAD_SQL = ("select c_custkey, c_nationkey, c_nationkey * 1000 + (c_custkey % 7) / 7e0 as x, "
              "(c_nationkey % 5) * 3000 + (c_custkey % 11) / 11e0 as y from {customer}")


@query(f"with far as ({SPREAD_SQL.format(customer='customer')}) "
       "select c_custkey, cast(dense_rank() over (order by c_nationkey) - 1 as int) as cluster from far")
def hierarchical_groups(spark, folder):
    """Groups far from each other are the clusters, whatever the order of merges inside them."""
    points = spark.sql(SPREAD_SQL, customer=read(spark, folder, "customer"))
    groups = points.select("c_nationkey").distinct().count()
    return hierarchy.hierarchical_cluster(points, ["x", "y"], groups).select("c_custkey", "cluster")


@query("select 1 as k, 1 as clusters, round(count(*) * (var_pop(cast(p_size as double)) + var_pop(p_retailprice)), 2) as cost from part")
def kmeans_single_cluster_cost(spark, folder):
    return rounded(km.kmeans_cost_curve(read(spark, folder, "part"), ["p_size", "p_retailprice"], [1]), ["cost"], 2)


@query(f"""with far as ({SPREAD_SQL.format(customer='customer')}),
  costs as (select c_nationkey, count(*) * (var_pop(x) + var_pop(y)) as cost from far group by c_nationkey)
  select cast(count(*) as int) as k, cast(count(*) as int) as clusters, round(sum(cost), 6) as cost from costs""")
def kmeans_group_cost(spark, folder):
    """Groups far from each other are the clusters of least cost, so the curve has their variance there."""
    points = spark.sql(SPREAD_SQL, customer=read(spark, folder, "customer"))
    groups = points.select("c_nationkey").distinct().count()
    return rounded(km.kmeans_cost_curve(points, ["x", "y"], [groups]), ["cost"], 6)


# --- distances and density clusters ------------------------------------------------------------------

PAIRS_SQL = "pairs as (select a.rid as a, b.rid as b from valid a join valid b on b.lat between a.lat - 1 and a.lat + 1 " \
    "and sqrt((a.lat-b.lat)*(a.lat-b.lat) + (a.lon-b.lon)*(a.lon-b.lon)) <= {eps})"


@query(f"with {VALID_SQL}, {PAIRS_SQL.format(eps='0.3')} select a as rid, count(*) as neighbors from pairs group by a")
def neighbors_within(spark, folder):
    return neighbors.neighbors_within(valid_points(spark, folder), ["lat", "lon"], 0.3, "rid")


DBSCAN_SQL = f"""with recursive {VALID_SQL}, {PAIRS_SQL.format(eps='0.2')},
core as (select a as rid from pairs group by a having count(*) >= 5),
edges as (select a, b from pairs where a in (select rid from core) and b in (select rid from core)),
reach(node, label) as (select rid, rid from core union select e.b, r.label from reach r join edges e on e.a = r.node),
comp as (select node, min(label) as root from reach group by node),
numbered as (select node, dense_rank() over (order by root) - 1 as cluster from comp),
border as (select a as node, min(cluster) as cluster from pairs join numbered on b = node
  where a not in (select rid from core) group by a),
labels as (select * from numbered union all select * from border)
"""


@query(DBSCAN_SQL + "select rid, lat, lon, coalesce(labels.cluster, -1) as cluster from valid left join labels on rid = node")
def dbscan(spark, folder):
    return density.dbscan(valid_points(spark, folder).select("rid", "lat", "lon"), ["lat", "lon"], 0.2, 5, "rid")


def silhouette_sql(x: str, distance: str, result: str = """select (select count(distinct cluster) from pts) as clusters,
  (select count(*) from pts) as points, round((select s from score), 6) as silhouette""") -> str:
    return f"""sums as (select a.rid, a.cluster as own, b.cluster as other, sum({distance}) as total, count(*) as n
  from pts a, pts b group by 1, 2, 3),
ab as (select rid, own, max(total / nullif(n - 1, 0)) filter (own = other) as a,
  min(total / n) filter (own != other) as b from sums group by rid, own),
score as (select avg(case when a is null then 0 when greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end) as s from ab)
{result}"""


@query(f"with {VALID_SQL}, pts as (select * from valid where cluster != -1), " + silhouette_sql(
    "lat", "sqrt((a.lat-b.lat)*(a.lat-b.lat) + (a.lon-b.lon)*(a.lon-b.lon))"))
def silhouette_euclidean(spark, folder):
    return rounded(silhouette.silhouette_without_noise(valid_points(spark, folder), ["lat", "lon"]), ["silhouette"])


@query(f"with {VALID_SQL}, pts as (select * from valid where cluster != -1), " + silhouette_sql(
    "lat", "((a.lat-b.lat)*(a.lat-b.lat) + (a.lon-b.lon)*(a.lon-b.lon))",
    "select round((select s from score), 6) as silhouette_squared"))
def silhouette_squared_labels(spark, folder):
    points = clean.without_noise(valid_points(spark, folder))
    return rounded(km.silhouette_squared(points, ["lat", "lon"]), ["silhouette_squared"])


@query(f"with {VALID_SQL}, pts as (select * from valid where cluster != -1), " + silhouette_sql("lat", "abs(a.lat-b.lat)"))
def silhouette_line(spark, folder):
    return rounded(silhouette.silhouette_without_noise(valid_points(spark, folder), ["lat"]), ["silhouette"])


@query()
def dbscan_grid(spark, folder):
    points = valid_points(spark, folder)
    scaled = features.standard_scale(points, ["lat", "lon"])
    grid = density.GRID_COARSE
    return rounded(density.dbscan_grid(scaled, ["lat_scaled", "lon_scaled"], "rid", grid["eps"], grid["min_samples"]),
                   ["score"])


GRID_EPS, GRID_MIN = [0.15, 0.2, 0.3], [5, 10]
GRID_RUNS = ", ".join(f"({i * len(GRID_MIN) + j}, {e!r}::double, {m})"
                      for i, e in enumerate(GRID_EPS) for j, m in enumerate(GRID_MIN))
GRID_SQL = f"""with recursive {VALID_SQL}, runs(run, eps, min_samples) as (values {GRID_RUNS}),
near as (select a.rid as a, b.rid as b, sqrt((a.lat-b.lat)*(a.lat-b.lat) + (a.lon-b.lon)*(a.lon-b.lon)) as dist
  from valid a join valid b on b.lat between a.lat - 1 and a.lat + 1),
pairs as (select run, min_samples, a, b from near join runs on dist <= eps),
core as (select run, a as rid from pairs group by run, min_samples, a having count(*) >= min_samples),
edges as (select pairs.run, a, b from pairs join core x on x.run = pairs.run and x.rid = a
  join core y on y.run = pairs.run and y.rid = b),
reach(run, node, label) as (select run, rid, rid from core
  union select r.run, e.b, r.label from reach r join edges e on e.run = r.run and e.a = r.node),
comp as (select run, node, min(label) as root from reach group by run, node),
numbered as (select run, node, dense_rank() over (partition by run order by root) - 1 as cluster from comp),
border as (select p.run, p.a as node, min(n.cluster) as cluster from pairs p join numbered n on p.b = n.node and n.run = p.run
  where not exists (select 1 from core c where c.run = p.run and c.rid = p.a) group by p.run, p.a),
labels as (select * from numbered union all select * from border),
pts as (select run, rid, lat, lon, labels.cluster from labels join valid on rid = node),
sums as (select a.run, a.rid, a.cluster as own, b.cluster as other,
  sum(sqrt((a.lat-b.lat)*(a.lat-b.lat) + (a.lon-b.lon)*(a.lon-b.lon))) as total, count(*) as n
  from pts a join pts b on a.run = b.run group by 1, 2, 3, 4),
ab as (select run, rid, own, max(total / nullif(n - 1, 0)) filter (own = other) as a,
  min(total / n) filter (own != other) as b from sums group by run, rid, own),
scores as (select run, avg(case when a is null then 0 when greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end) as s
  from ab group by run),
counts as (select run, cast(count(distinct cluster) as integer) as n_clusters, count(*) as n_clustered from pts group by run)
select runs.run, eps, min_samples, coalesce(n_clusters, 0) as n_clusters, (select count(*) from valid) - coalesce(n_clustered, 0) as n_noise,
  coalesce(n_clustered, 0) as n_clustered, case when n_clusters >= 2 and n_clustered > n_clusters then round(s, 6) end as score
from runs left join counts using (run) left join scores using (run)"""


@query(GRID_SQL)
def dbscan_grid_degrees(spark, folder):
    points = valid_points(spark, folder)
    grid = density.dbscan_grid(points, ["lat", "lon"], "rid", GRID_EPS, GRID_MIN)
    return rounded(grid, ["score"])


# --- plans -------------------------------------------------------------------------------------------

@query("""with combined as (
  select p_partkey as id, p_name, p_brand, p_type, s_name, case when s_suppkey is null then null else 'ENG' end as lang, q.locality, q.code
  from part left join supplier on p_partkey = s_suppkey
  left join (select distinct l_partkey, l_returnflag as locality, l_linestatus as code from lineitem) q on l_partkey = p_partkey)
select cast(id as varchar) as "taxonID", p_name as "scientificName", p_brand as kingdom, p_type as phylum,
       s_name as "vernacularName", lang as language, locality, code as "countryCode" from combined""")
def taxon_table(spark, folder):
    part = read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias(" taxonID "), F.col("p_name").alias("scientificName"),
        F.col("p_brand").alias("kingdom"), F.col("p_type").alias("phylum"), F.col("p_size"))
    names = read(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("taxonID"), F.col("s_name").alias("vernacularName"), F.lit("ENG").alias("language"))
    other = names.withColumn("language", F.lit("FRA"))
    places = read(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("taxonID"), F.col("l_returnflag").alias("locality"),
        F.col("l_linestatus").alias("countryCode")).distinct()
    no_profiles = part.where(F.lit(False)).select(F.col(" taxonID ").alias("taxonID"))
    return taxon.build_taxon_table(part.unionByName(part), names.unionByName(other), no_profiles, places)


def part_flags(spark, folder):
    flag = lambda test: F.when(test, 1).otherwise(0)
    return read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("taxonID"), flag(F.col("p_size") > 25).alias("isMarine"),
        flag(F.col("p_type") == "ECONOMY").alias("isFreshwater"), flag(F.col("p_retailprice") > 950).alias("isTerrestrial"),
        flag(F.col("p_brand") == "Brand#1").alias("isExtinct"), flag(F.col("p_size") % 5 == 0).alias("isBrackish"))


@query("""select cast(p_partkey as varchar) as "taxonID", p_name as "scientificName", s_name as "vernacularName",
  cast(p_size > 25 as integer) as "isMarine", cast(p_size % 5 = 0 as integer) as "isBrackish", q.code as "countryCode"
from part left join supplier on p_partkey = s_suppkey
left join (select distinct l_partkey, l_linestatus as code from lineitem) q on l_partkey = p_partkey""")
def taxon_table_profiles(spark, folder):
    part = read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("taxonID"), F.col("p_name").alias("scientificName"))
    names = read(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("taxonID"), F.col("s_name").alias("vernacularName"), F.lit("ENG").alias("language"))
    places = read(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("taxonID"), F.col("l_linestatus").alias("countryCode")).distinct()
    table = taxon.build_taxon_table(part, names, part_flags(spark, folder), places)
    return table.select("taxonID", "scientificName", "vernacularName", "isMarine", "isBrackish", "countryCode")


@query()
def habitat_profile_clusters(spark, folder):
    names = read(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("taxonID"), "p_name")
    return cluster_plans.habitat_profile_clusters(part_flags(spark, folder), names).taxa


@query()
def habitat_cost_curve(spark, folder):
    names = read(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("taxonID"), "p_name")
    return rounded(cluster_plans.habitat_profile_clusters(part_flags(spark, folder), names).cost_curve, ["cost"], 3)


def part_places(spark, folder):
    return read(spark, folder, "part").select(
        F.col("p_brand").alias("countryCode"), F.concat_ws(" ", "p_type", "p_size").alias("locality"),
        F.col("p_partkey").alias("taxonID"))


@query()
def locality_clusters(spark, folder):
    return cluster_plans.locality_clusters(part_places(spark, folder))


@query()
def locality_curves(spark, folder):
    curves = cluster_plans.locality_curves(part_places(spark, folder))
    both = curves.cost_curve.join(curves.silhouettes.select("k", "silhouette"), "k", "left")
    return rounded(rounded(both, ["cost"], 3), ["silhouette"])


@query()
def taxonomy_clusters(spark, folder):
    part = read(spark, folder, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("taxonID"), F.col("p_name").alias("scientificName"),
        F.col("p_name").alias("vernacularName"), F.lit("all").alias("kingdom"), F.col("p_type").alias("phylum"),
        F.col("p_brand").alias("class"), F.col("p_size").cast("string").alias("order"),
        F.substring("p_name", 1, 3).alias("family"), F.col("p_name").alias("genus"))
    return cluster_plans.taxonomy_clusters(rows).sizes


@query()
def occurrence_clusters(spark, folder):
    points = valid_points(spark, folder).withColumnsRenamed({"lat": "latitude", "lon": "longitude"}).drop("cluster")
    done = occurrence.occurrence_clusters(points, count_col="species", row_id="rid")
    return rounded(done.stats.select("cluster", "count", "radius_km", "density", "sst_mean", "species_diversity"),
                   ["radius_km", "density", "sst_mean", "species_diversity"])


@query()
def cluster_stats_kmeans(spark, folder):
    points = valid_points(spark, folder)
    table = stats.cluster_statistics(points, "lat", "lon", "species")
    table = joins.attach_group_stats(table, stats.environment_stats(points))
    return occurrence.cluster_stats_kmeans(table).rows


@query(f"""with {VALID_SQL}, k as (select cluster, case when cluster = -1 then 'Noise' else 'Cluster ' || cluster end as cluster_name, count(*) as n
  from valid group by 1, 2) select cluster_name, n, cluster_name || ' (n=' || n || ')' as label from k""")
def preview_legend(spark, folder):
    """Legend of a preview that holds every row."""
    points = valid_points(spark, folder).withColumn("cluster_name", cluster_name())
    rows = points.count()
    return sampling.preview_legend(points, sampling.preview_sample(points, "rid", rows, rows))


@query(f"""with {VALID_SQL}, named as (select *, cluster = -1 as is_noise from valid),
stat as (select cluster, count(*) as points, round(avg(sst), 6) as sst_mean, round(stddev_samp(sst), 6) as sst_std from valid group by cluster)
select rid, cluster, is_noise, points, sst_mean, sst_std from named join stat using (cluster)""")
def cluster_outputs(spark, folder):
    """Rows with labels and statistics per group, written as two tables and joined again."""
    points = clean.with_noise_flag(valid_points(spark, folder)).select("rid", "cluster", "is_noise", "sst")
    sizes = stats.cluster_sizes(points).withColumnRenamed("rows", "points")
    table = joins.attach_group_stats(sizes, stats.environment_stats(points, ["sst"]))
    path = scratch_path(spark, "outputs")
    delimited.write_cluster_outputs(points, table.select("cluster", "points", "sst_mean", "sst_std"), path)
    rows = delimited.read_delimited(spark, f"{path}/clusters", sep=",", schema="rid bigint, cluster int, is_noise boolean")
    back = delimited.read_delimited(spark, f"{path}/cluster_stats", sep=",", schema="cluster int, points bigint, sst_mean double, sst_std double")
    return rounded(joins.join_on_key(rows, back, "cluster"), ["sst_mean", "sst_std"])


@query(NICHE_SQL + " select * from niche")
def temperature_niche(spark, folder):
    """The whole plan: value column by name, all ranks, sorted table."""
    done = niche_plan.temperature_niche(sales(spark, folder), LEVELS, "rid")
    return rounded(done.table, NICHE_DOUBLES)


# --- files and feeds ---------------------------------------------------------------------------------

@query("select s_suppkey, s_name, s_nationkey, s_acctbal, case when s_suppkey % 9 = 0 then null else 'a, \"b\"' end as note from supplier")
def roundtrip_delimited(spark, folder):
    supplier = read(spark, folder, "supplier").withColumn(
        "note", F.when(F.col("s_suppkey") % 9 == 0, F.lit("NA")).otherwise(F.lit('a, "b"')))
    first, second = scratch_path(spark, "tsv"), scratch_path(spark, "csv")
    delimited.write_delimited(supplier, first, sep="\t")
    delimited.convert_delimited(spark, first, second)
    return delimited.read_delimited(
        spark, second, sep="auto", schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double, note string",
        null_tokens=delimited.MISSING_TOKENS)


@query("select cast(r_regionkey as bigint) as r_regionkey, r_name from region")
def roundtrip_single_file(spark, folder):
    region = read(spark, folder, "region")
    path = scratch_path(spark, "csv")
    delimited.write_delimited(region, path, single_file=True)
    delimited.write_delimited(region, path, single_file=True, mode="overwrite")
    table = clean.strip_column_names(delimited.read_delimited(spark, path, sep=",", infer=True, null_tokens=[""]))
    return clean.require_columns(table, ["r_regionkey"]).select("r_regionkey", clean.resolve_column(table, "r_title", "name"))


@query("""select event_type, count(*) as values_shown, round(sum(value), 4) as total from (
  select event_type, value, row_number() over (partition by event_type order by event_id) as k from events) where k <= 1000
group by event_type""")
def roundtrip_json(spark, folder):
    path = scratch_path(spark, "json")
    lists = sampling.collect_values(read(spark, folder, "events"), ["event_type"], "value", "event_id")
    delimited.write_distributions_json(lists, path)
    back = spark.read.json(path)
    return back.select("event_type", F.size("all_values").cast("bigint").alias("values_shown"),
                       r(F.aggregate("all_values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("select doc_id, source, length(text) as n_chars, md5(text) as text_md5 from documents")
def read_line_breaks(spark, folder):
    """Texts with line breaks and quotes, as quoted fields of one large file and back."""
    path = scratch_path(spark, "texts")
    delimited.write_delimited(read(spark, folder, "documents").select("doc_id", "source", "text"), path)
    back = delimited.read_delimited(spark, path, sep=",", schema="doc_id bigint, source string, text string", multi_line=True)
    return back.select("doc_id", "source", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


def event_feed(spark: SparkSession, folder: str, chunk: int = 250):
    """The events table as a feed: written by Spark in chunks of records; a request reads the chunks it needs."""
    path = scratch_path(spark, "feed")
    events = read(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    placed = features.rank_within(events, [], ["event_id"], "place").withColumn("chunk", F.floor(F.col("place") / chunk))
    placed.repartition("chunk").sortWithinPartitions("chunk", "place").drop("place").write.partitionBy("chunk").json(path)

    def fetch(offset: int, limit: int) -> list[dict]:
        import json

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path.replace("file:/", "/", 1) if path.startswith("file:/") and path[6] != "/" else path)
        out = []
        for i in range(offset // chunk, (offset + limit - 1) // chunk + 1):
            if system.get_file_info(f"{root}/chunk={i}").type == fs.FileType.NotFound:
                break
            rows = []
            for file in system.get_file_info(fs.FileSelector(f"{root}/chunk={i}")):
                if file.base_name.startswith("part-"):
                    with system.open_input_stream(file.path, compression=None) as lines:
                        rows += [json.loads(line) for line in lines.read().decode().splitlines()]
            out += rows[max(offset - i * chunk, 0):offset + limit - i * chunk]
        return out
    return fetch


@query("select event_id, user_id, event_type, value from events")
def read_paged(spark, folder):
    rows = read(spark, folder, "events").count()
    pages = paged.read_paged(spark, event_feed(spark, folder), page_size=1000, target=rows + 1, stop="empty")
    return paged.records_to_table(pages).select("event_id", "user_id", "event_type", "value")


@query("select event_id, user_id, event_type, value from events")
def read_paged_parallel(spark, folder):
    rows = read(spark, folder, "events").count()
    pages = paged.read_paged(spark, event_feed(spark, folder), page_size=700, target=rows, stop="short", cap=True, partitions=8)
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return paged.records_to_table(pages, schema).drop("page", "position")
