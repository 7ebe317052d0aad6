"""Sources and sinks, relational operators, data quality."""

from pyspark.sql import functions as F

from equisite.operators import load as ld
from equisite.operators import ranking as rk
from equisite.operators import reports as rp
from equisite.operators import snapshot
from equisite.operators import violations as vi
from equisite.plans import settings as cfg
from equisite.plans.session import fresh_path, materialise
from equisite.sources import files
from fixtures import Raw
from suite.linkage_queries import APPORTION, apportioned
from suite.prelude import RAW, sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()


# -- sources and sinks --------------------------------------------------------------------------

_PART = ["p_partkey", "p_name", "p_type", "p_size"]


@register("src_csv", "SELECT p_partkey, p_name, p_type, CAST(p_size AS BIGINT) AS p_size FROM part")
def _(d):
    path = fresh_path(d.spark, "part-csv")
    files.write_csv(d.table("part").select(*_PART), path)
    text = files.read_csv(d.spark, path, _PART)
    return text.select(F.col("p_partkey").try_cast("long").alias("p_partkey"), "p_name", "p_type",
                       F.col("p_size").try_cast("long").alias("p_size"))


@register("src_parquet", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey < 5")
def _(d):
    path = fresh_path(d.spark, "customer")
    d.table("customer").write.mode("overwrite").parquet(path)
    return d.spark.read.parquet(path).filter("c_nationkey < 5").select("c_custkey", "c_name", "c_mktsegment")


@register("project_rename", "SELECT s_suppkey AS parent_code, s_name AS parent_name, s_nationkey AS parent_group FROM supplier")
def _(d):
    return files.rename(d.table("supplier"), {
        "s_suppkey": "parent_code", "s_name": "parent_name", "s_nationkey": "parent_group"})


@register("param_sql", sql(f"""SELECT unit_id, need_e9, gain_population AS gain FROM fx_scored
    WHERE scheme = 'maternal_priority' AND need_e9 >= 500000000"""))
def _(d):
    return d.spark.sql("SELECT unit_id, need_e9, gain_population AS gain FROM {score} "
                       "WHERE scheme = :scheme AND need_e9 >= :low", {"scheme": "maternal_priority", "low": 500_000_000},
                       score=d.score)


@register("source_fallback", "SELECT n_nationkey, n_name, 'snapshot' AS source_kind FROM nation")
def _(d):
    return files.table_or_snapshot(d.spark, "no_such_units", f"{d.dir}/nation.parquet").select(
        "n_nationkey", "n_name", "source_kind")


@register("param_lookup", sql("""SELECT key, value, (SELECT count(*) FROM fx_need WHERE scheme = 'equal_per_indicator'
      AND indicators_present >= value) AS units_at_or_above FROM (VALUES ('min_indicators_present', 5::BIGINT)) t(key, value)"""))
def _(d):
    floor = cfg.get_param("min_indicators_present")
    need = d.need.filter(F.col("scheme") == cfg.DEFAULT_SCHEME)
    return need.agg(F.count_if(F.col("indicators_present") >= floor).alias("units_at_or_above")).select(
        F.lit("min_indicators_present").alias("key"), F.lit(floor).cast("long").alias("value"), "units_at_or_above")


@register("file_manifest")
def _(d):
    return files.file_manifest(d.spark, d.dir, "*.parquet")


TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


@register("load_audit", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS filename, count(*) AS rows_loaded, true AS has_checksum FROM {t}" for t in TABLES))
def _(d):
    counts = None
    for t in TABLES:
        one = d.table(t).agg(F.count("*").alias("rows_loaded")).select(F.lit(f"{t}.parquet").alias("filename"), "rows_loaded")
        counts = one if counts is None else counts.unionByName(one)
    audit = ld.load_audit(counts, files.file_manifest(d.spark, d.dir, "*.parquet"))
    return audit.select("filename", "rows_loaded", (F.length("sha256") == 64).alias("has_checksum"))


@register("src_csv_comments", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders")
def _(d):
    """Orders as CSV beside files with a comment line for every seventh of them, read without the comments."""
    path = fresh_path(d.spark, "commented")
    files.write_csv(d.table("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus"), path)
    notes = d.table("orders").filter("o_orderkey % 7 = 0").select(F.concat(F.lit("# note on "), "o_orderkey", F.lit(",x")))
    notes.write.mode("append").text(path)
    return files.read_csv(d.spark, path, ["o_orderkey", "o_orderstatus"], comment="#")


@register("reload_table", "SELECT o_orderpriority AS load_id, count(*) AS n_rows, true AS same FROM orders GROUP BY 1")
def _(d):
    """Loads of orders in a managed table; two of them come again, and every load is as it was."""
    rows = d.table("orders").withColumnRenamed("o_orderpriority", "load_id")
    table = "loads_" + fresh_path(d.spark, "t")[-12:]

    def state(label):
        found = d.spark.table(table)
        row = F.xxhash64(*sorted(found.columns)).cast("decimal(38,0)")
        return materialise(found.groupBy("load_id").agg(F.count("*").alias("n_rows"), F.sum(row).alias("checksum")), label)
    files.replace_loads(rows, table, "load_id")
    before = state("loads-before")
    for _ in range(2):
        files.replace_loads(rows.filter("load_id like '1%' or load_id like '3%'"), table, "load_id")
    after = state("loads-after")
    d.spark.sql(f"DROP TABLE {table}")
    both = before.join(after.select("load_id", F.col("n_rows").alias("_n"), F.col("checksum").alias("_c")), "load_id", "full")
    return both.select("load_id", "n_rows", F.coalesce((F.col("n_rows") == F.col("_n")) & (F.col("checksum") == F.col("_c")), F.lit(False)).alias("same"))


@register("utc_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def _(d):
    return d.table("events").select("event_id", snapshot.utc_text(F.col("ts")).alias("stamp"))


@register("shape_checks", sql("""SELECT check_name, passed, detail FROM (
    SELECT 'required columns' AS check_name, false AS passed, 'missing: no_such_column' AS detail UNION ALL
    SELECT 'min rows', count(*) >= 100, count(*) || ' (need 100)' FROM fx_raw UNION ALL
    SELECT 'exact rows', count(*) = 640, count(*) || ' (need 640)' FROM fx_raw UNION ALL
    SELECT 'distinct units', count(DISTINCT (grp, unit_name)) >= 650, count(DISTINCT (grp, unit_name)) || ' (need 650)' FROM fx_raw UNION ALL
    SELECT 'distinct labels', count(DISTINCT indicator_text) >= 7, count(DISTINCT indicator_text) || ' (need 7)' FROM fx_raw)""", **RAW))
def _(d):
    return files.shape_checks(Raw(d).rows, {
        "required_columns": ["grp", "unit_name", "no_such_column"], "min_rows": 100, "exact_rows": 640,
        "min_distinct": {"units": (["grp", "unit_name"], 650), "labels": (["indicator_text"], 7)}})


# -- filters ------------------------------------------------------------------------------------

@register("filter_present", sql("SELECT unit_id, indicator_id, value_bp FROM fx_typed WHERE value_bp IS NOT NULL", **RAW))
def _(d):
    facts = ld.fact_build(ld.parse_rows(Raw(d).rows), d.unit_dim)
    return facts.filter(F.col("value_bp").isNotNull()).select("unit_id", "indicator_id", "value_bp")


@register("filter_between", sql("SELECT line, indicator_id FROM fx_parsed WHERE indicator_id BETWEEN 1 AND 104", **RAW))
def _(d):
    return ld.in_range(ld.parse_rows(Raw(d).rows)).select("line", "indicator_id")


@register("filter_isin", sql("SELECT unit_id, grp FROM fx_unit WHERE grp IN ('NATION_2', 'NATION_11', 'NATION_20')"))
def _(d):
    return d.unit_dim.filter(F.col("grp").isin(cfg.HILL_GROUPS)).select("unit_id", "grp")


@register("drop_null_rows", sql("SELECT * FROM fx_wide WHERE p1 IS NOT NULL AND p5 IS NOT NULL AND p6 IS NOT NULL"))
def _(d):
    return d.wide.dropna(subset=["p1", "p5", "p6"])


@register("member_flag", sql("""SELECT unit_id, unit_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS flagged
    FROM fx_unit"""))
def _(d):
    urgent = d.order_facts.filter("priority = 1 and status = 'P'").select("unit_id")
    return rp.member_flag(d.unit_dim.select("unit_id"), urgent, "unit_id", "flagged")


# -- joins and aggregates -----------------------------------------------------------------------

@register("join_inner", sql("SELECT unit_id, indicator_id, indicator_key, domain FROM fx_fact JOIN fx_indicator USING (indicator_id)"))
def _(d):
    return d.facts.join(d.indicators, "indicator_id").select("unit_id", "indicator_id", "indicator_key", "domain")


@register("join_multikey", sql("SELECT unit_id, line FROM fx_raw JOIN fx_unit USING (grp, unit_name, unit_id)", **RAW))
def _(d):
    return Raw(d).rows.join(d.unit_dim, ["grp", "unit_name", "unit_id"]).select("unit_id", "line")


@register("join_semi", sql("SELECT unit_id, indicator_id, pct_e9 FROM fx_pct WHERE unit_id IN (SELECT unit_id FROM fx_cand)"))
def _(d):
    return (d.percentile.join(d.default_score.select("unit_id"), "unit_id", "left_semi")
            .select("unit_id", "indicator_id", "pct_e9"))


@register("join_anti", sql("SELECT unit_id, grp FROM fx_unit WHERE unit_id NOT IN (SELECT unit_id FROM fx_scored)"))
def _(d):
    return d.unit_dim.join(d.default_score.select("unit_id"), "unit_id", "left_anti").select("unit_id", "grp")


@register("count_distinct", """SELECT p_type, count(DISTINCT p_name) AS names, count(DISTINCT (p_name, p_brand)) AS pairs FROM part GROUP BY 1""")
def _(d):
    return d.table("part").groupBy("p_type").agg(
        F.count_distinct("p_name").alias("names"), F.count_distinct(F.struct("p_name", "p_brand")).alias("pairs"))


@register("agg_filter", sql("""SELECT zone, count(*) FILTER (WHERE terrain <> 'plains') AS not_plains,
    CAST(sum(CASE WHEN rural_population < catchment_norm THEN 1 ELSE 0 END) AS BIGINT) AS below_norm FROM fx_district GROUP BY 1"""))
def _(d):
    return d.units.groupBy("zone").agg(
        F.count_if(F.col("terrain") != "plains").alias("not_plains"),
        F.count_if(F.col("rural_population") < F.col("catchment_norm")).alias("below_norm"))


@register("dedup_first", """SELECT o_custkey AS unit_id, o_orderkey, o_orderstatus FROM (SELECT *,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1""")
def _(d):
    rows = d.table("orders").select(F.col("o_custkey").alias("unit_id"), "o_orderkey", "o_orderstatus", "o_orderdate")
    return rk.keep_first(rows, ["unit_id"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@register("argmax_per_group", """SELECT o_custkey AS unit_id, o_orderkey, cents FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(round(o_totalprice * 100) AS BIGINT) DESC, o_orderkey) AS k FROM orders) WHERE k = 1""")
def _(d):
    best = F.min_by(F.struct("o_orderkey", "cents"), F.struct((-F.col("cents")).alias("a"), F.col("o_orderkey").alias("b")))
    return d.order_facts.groupBy("unit_id").agg(best.alias("m")).select("unit_id", "m.o_orderkey", "m.cents")


@register("distinct_units", sql("SELECT DISTINCT grp, unit_name FROM fx_raw", **RAW))
def _(d):
    return Raw(d).rows.select("grp", "unit_name").distinct()


@register("set_difference", sql("SELECT unit_id FROM fx_unit EXCEPT SELECT unit_id FROM fx_cand"))
def _(d):
    return d.unit_dim.select("unit_id").subtract(d.default_score.select("unit_id"))


# -- constraints --------------------------------------------------------------------------------

_BAD_UNIT = """SELECT *, CASE WHEN unit_id % 41 = 0 THEN rural_population + population ELSE rural_population END AS rural_claimed,
    CASE WHEN unit_id % 43 = 0 THEN 'marsh' ELSE terrain END AS terrain_claimed FROM fx_district"""


@register("violations", sql("""SELECT rule, key, detail FROM (
    SELECT 'unique line key' AS rule, unit_id || '|' || indicator_id AS key, count(*) || ' rows' AS detail FROM fx_parsed
      WHERE indicator_id IS NOT NULL GROUP BY unit_id, indicator_id HAVING count(*) > 1 UNION ALL
    SELECT 'indicator known', CAST(line AS VARCHAR), CAST(indicator_id AS VARCHAR) FROM fx_parsed
      WHERE indicator_id IS NOT NULL AND indicator_id NOT IN (SELECT indicator_id FROM fx_indicator WHERE indicator_id <> 6) UNION ALL
    SELECT 'indicator parsed', CAST(line AS VARCHAR), 'indicator_id is null' FROM fx_parsed WHERE indicator_id IS NULL UNION ALL
    SELECT 'rural within total', CAST(unit_id AS VARCHAR), rural_claimed || ' of ' || population FROM bad_unit WHERE rural_claimed > population UNION ALL
    SELECT 'terrain known', CAST(unit_id AS VARCHAR), terrain_claimed FROM bad_unit
      WHERE terrain_claimed NOT IN ('plains', 'hilly', 'tribal', 'desert') UNION ALL
    SELECT 'value in range', line || '', CAST(try_cast(value_text AS BIGINT) AS VARCHAR) FROM fx_raw
      WHERE try_cast(value_text AS BIGINT) NOT BETWEEN 0 AND 9000)""", **RAW, bad_unit=_BAD_UNIT))
def _(d):
    parsed = ld.parse_rows(Raw(d).rows)
    units = (d.units.withColumn("rural_claimed", F.when(F.col("unit_id") % 41 == 0, F.col("rural_population") + F.col("population"))
                                .otherwise(F.col("rural_population")))
             .withColumn("terrain_claimed", F.when(F.col("unit_id") % 43 == 0, F.lit("marsh")).otherwise(F.col("terrain"))))
    typed = parsed.withColumn("value_bp", F.col("value_text").try_cast("long"))
    return vi.all_of(
        vi.unique(parsed, "unique line key", ["unit_id", "indicator_id"]),
        vi.foreign_key(parsed, "indicator known", "line", "indicator_id", d.indicators.filter("indicator_id <> 6")),
        vi.not_null(parsed, "indicator parsed", "line", "indicator_id"),
        vi.holds(units, "rural within total", "unit_id", F.col("rural_claimed") <= F.col("population"),
                 F.concat_ws(" of ", F.col("rural_claimed").cast("string"), F.col("population").cast("string"))),
        vi.holds(units, "terrain known", "unit_id", F.col("terrain_claimed").isin("plains", "hilly", "tribal", "desert"),
                 F.col("terrain_claimed")),
        vi.holds(typed, "value in range", "line", F.col("value_bp").between(0, 9000), F.col("value_bp").cast("string")))


def _count_rows(rule, text):
    return f"SELECT '{rule}' AS rule, count(*) AS broken FROM ({text})"


_RULES = " UNION ALL ".join(_count_rows(r, t) for r, t in {
    "unit key": "SELECT unit_id FROM fx_district GROUP BY 1 HAVING count(*) > 1",
    "unit natural key": "SELECT grp, unit_name FROM fx_district GROUP BY 1, 2 HAVING count(*) > 1",
    "indicator key": "SELECT indicator_key FROM fx_indicator GROUP BY 1 HAVING count(*) > 1",
    "fact key": "SELECT unit_id, indicator_id FROM fx_fact GROUP BY 1, 2 HAVING count(*) > 1",
    "weight key": "SELECT scheme, indicator_id FROM fx_weight GROUP BY 1, 2 HAVING count(*) > 1",
    "score key": "SELECT scheme, unit_id FROM fx_scored GROUP BY 1, 2 HAVING count(*) > 1",
    "fact unit": "SELECT 1 FROM fx_fact WHERE unit_id NOT IN (SELECT unit_id FROM fx_district)",
    "fact indicator": "SELECT 1 FROM fx_fact WHERE indicator_id NOT IN (SELECT indicator_id FROM fx_indicator)",
    "unit zone": "SELECT 1 FROM fx_district WHERE zone IS NULL",
    "unit terrain": "SELECT 1 FROM fx_district WHERE terrain IS NULL",
    "indicator range": "SELECT 1 FROM fx_indicator WHERE indicator_id NOT BETWEEN 1 AND 104",
    "index member specified": "SELECT 1 FROM fx_indicator WHERE indicator_key IS NULL OR domain IS NULL OR higher_is_worse IS NULL",
    "terrain known": "SELECT 1 FROM fx_district WHERE terrain NOT IN ('plains', 'hilly', 'tribal', 'desert')",
    "norm agrees with terrain": "SELECT 1 FROM fx_district WHERE (terrain = 'plains') <> (catchment_norm = 2000000)",
    "rural within total": "SELECT 1 FROM fx_district WHERE rural_population > population",
    "weight not negative": "SELECT 1 FROM fx_weight WHERE w_ppm < 0",
    "value in range": "SELECT 1 FROM fx_fact WHERE value_bp NOT BETWEEN 0 AND 10000",
    "weights sum to one": "SELECT scheme FROM fx_weight GROUP BY 1 HAVING sum(w_ppm) <> 1000000",
    "scheme covers the index": "SELECT scheme FROM fx_weight GROUP BY 1 HAVING count(DISTINCT indicator_id) <> 7",
    "apportioned means siblings": "SELECT 1 FROM (SELECT *, count(*) OVER (PARTITION BY parent_id) AS n FROM ap WHERE parent_id IS NOT NULL) WHERE n <> n_sharing_parent",
}.items())


@register("schema_rules", sql(_RULES, **APPORTION))
def _(d):
    """The standing constraints on the derived relations, with how many rows break each."""
    rules = vi.standing_rules(d.units, d.indicators, d.weights, d.facts, d.score, cfg.NORMS)
    return vi.rule_counts(rules | {"apportioned means siblings": vi.apportioned_rule(apportioned(d)[0])})
