"""Names, number parsing, loading and the crosswalk between vintages."""

from pyspark.sql import functions as F

from equisite.functions import names as nm
from equisite.functions import numbers as nb
from equisite.operators import allocation as al
from equisite.operators import index as ix
from equisite.operators import linkage as lk
from equisite.operators import load as ld
from equisite.operators import reports as rp
from equisite.plans import settings as cfg
from equisite.plans.session import materialise
from fixtures import ADJECTIVES, SYLLABLES, ManyNames, Names, Raw
from suite import prelude as pre
from suite.allocation_queries import BUDGET, CAP, FLOOR, SCENARIOS, optimal, optimal_ctes
from suite.prelude import NAMES, RAW, sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()


# -- scalar functions ---------------------------------------------------------------------------

@register("normalize_name", f"SELECT doc_id, {pre.normalised('text')} AS norm FROM documents")
def _(d):
    return d.table("documents").select("doc_id", nm.normalise("text").alias("norm"))


@register("qualifier_tokens", f"""SELECT p_partkey, array_to_string({pre.qualifiers(pre.normalised("p_name || ' ' || p_type"), ADJECTIVES)}, ',') AS tokens
    FROM part""")
def _(d):
    named = d.table("part").withColumn("norm", nm.normalise(F.concat_ws(" ", "p_name", "p_type")))
    return named.select("p_partkey", F.array_join(nm.qualifier_tokens("norm", ADJECTIVES), ",").alias("tokens"))


@register("parse_leading_number", sql("SELECT line, indicator_id FROM fx_parsed", **RAW))
def _(d):
    return ld.parse_rows(Raw(d).rows).select("line", "indicator_id")


@register("lenient_cast", sql("""SELECT line, try_cast(value_text AS BIGINT) AS value_bp,
    CASE value_text WHEN '*' THEN 'suppressed' WHEN 'NA' THEN 'absent' ELSE 'present' END AS flag FROM fx_raw""", **RAW))
def _(d):
    return Raw(d).rows.select("line", nb.lenient("value_text", "long").alias("value_bp"),
                              nb.missing_flag("value_text").alias("flag"))


@register("rounding_modes", """SELECT o_orderkey, CAST(round_even(v, 0) AS BIGINT) AS half_even, CAST(round(v, 0) AS BIGINT) AS half_up
    FROM (SELECT o_orderkey, CAST(CAST(o_orderkey % 1000 AS DECIMAL(10,1)) / 2 AS DECIMAL(10,1)) AS v FROM orders)""")
def _(d):
    v = (F.col("o_orderkey") % 1000).cast("decimal(10,0)") * F.lit("0.5").cast("decimal(2,1)")
    return d.table("orders").select("o_orderkey", F.bround(v, 0).cast("long").alias("half_even"),
                                    F.round(v, 0).cast("long").alias("half_up"))


@register("clip_share", """SELECT l_orderkey, l_linenumber, CASE WHEN x IS NULL THEN NULL ELSE greatest(least(x, 100), 0) END AS clipped
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS BIGINT) * 3 - 20 END AS x FROM lineitem)""")
def _(d):
    x = F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("long") * 3 - 20)
    return d.table("lineitem").select("l_orderkey", "l_linenumber", nb.clip(x, 0, 100).alias("clipped"))


@register("safe_ratio", """SELECT l_orderkey, l_linenumber, CAST(q * 10000 // nullif(q % 7, 0) AS BIGINT) AS ratio_bp
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""")
def _(d):
    q = F.col("l_quantity").cast("long")
    return d.table("lineitem").select("l_orderkey", "l_linenumber", nb.div(q * 10_000, q % 7).alias("ratio_bp"))


_PAIRS = {"pairs": f"""SELECT {pre.sorted_tokens(pre.normalised('unit_name'))} AS a, {pre.sorted_tokens(pre.normalised('parent_name'))} AS b,
    unit_id FROM nm_unit JOIN nm_parent ON parent_code = unit_id"""}


@register("token_sort_ratio", sql("SELECT unit_id, score_e4 FROM pairs JOIN scores USING (a, b)", recursive=True,
                                  **NAMES, **_PAIRS, **pre.similarity_ctes("pairs")))
def _(d):
    n = Names(d)
    both = n.units.join(n.parents, F.col("unit_id") == F.col("parent_code"))
    both = both.select("unit_id", nm.token_sort(nm.normalise("unit_name")).alias("a"),
                       nm.token_sort(nm.normalise("parent_name")).alias("b"))
    return both.withColumn("m", nm.position_masks("b")).select(
        "unit_id", nm.similarity_e4(F.col("a"), F.col("b"), F.col("m")).alias("score_e4"))


# -- loading ------------------------------------------------------------------------------------

@register("modal_name", sql("""SELECT indicator_id, indicator_text AS name_as_published, name_variants FROM (
    SELECT indicator_id, indicator_text, row_number() OVER (PARTITION BY indicator_id ORDER BY count(*) DESC, indicator_text) AS k,
      count(*) OVER (PARTITION BY indicator_id) AS name_variants
    FROM fx_parsed WHERE indicator_id BETWEEN 1 AND 104 GROUP BY 1, 2) WHERE k = 1""", **RAW))
def _(d):
    return ld.modal_name(ld.parse_rows(Raw(d).rows))


@register("indicator_catalogue", sql("""SELECT indicator_id, indicator_text AS name_as_published, name_variants, indicator_key, domain,
      higher_is_worse, indicator_key IS NOT NULL AS in_index, (SELECT count(*) FROM fx_parsed WHERE indicator_id IS NULL) AS unparsed FROM (
    SELECT indicator_id, indicator_text, row_number() OVER (PARTITION BY indicator_id ORDER BY count(*) DESC, indicator_text) AS k,
      count(*) OVER (PARTITION BY indicator_id) AS name_variants
    FROM fx_parsed WHERE indicator_id BETWEEN 1 AND 104 GROUP BY 1, 2) LEFT JOIN fx_indicator USING (indicator_id) WHERE k = 1""", **RAW))
def _(d):
    parsed = ld.parse_rows(Raw(d).rows)
    return ld.catalogue(parsed, d.indicators).crossJoin(ld.unparsed(parsed))


@register("fact_build", sql("SELECT * FROM fx_typed", **RAW))
def _(d):
    return ld.fact_build(ld.parse_rows(Raw(d).rows), d.unit_dim)


@register("indicator_coverage", sql("""SELECT indicator_id, indicator_key, domain, count(value_bp) AS present, count(*) - count(value_bp) AS missing,
    min(value_bp) AS min_v, max(value_bp) AS max_v, CAST(sum(value_bp) // count(value_bp) AS BIGINT) AS mean_v
    FROM fx_typed JOIN fx_indicator USING (indicator_id) GROUP BY 1, 2, 3""", **RAW))
def _(d):
    return rp.indicator_coverage(ld.fact_build(ld.parse_rows(Raw(d).rows), d.unit_dim), d.indicators)


@register("below_floor", sql("""SELECT unit_id, count(value_bp) AS n_present FROM fx_typed GROUP BY 1 HAVING count(value_bp) < 5""", **RAW))
def _(d):
    return rp.below_floor(ld.fact_build(ld.parse_rows(Raw(d).rows), d.unit_dim), cfg.get_param("min_indicators_present"))


@register("volume_totals", sql("""SELECT (SELECT count(*) FROM fx_district) AS units, (SELECT count(*) FROM fx_indicator) AS indicators,
    (SELECT count(*) FROM fx_typed) AS facts, (SELECT CAST(sum(rural_population) AS BIGINT) FROM fx_district) AS rural_population""", **RAW))
def _(d):
    return rp.volume_totals(d.units, d.indicators, ld.fact_build(ld.parse_rows(Raw(d).rows), d.unit_dim))


# -- crosswalk ----------------------------------------------------------------------------------

_NORM = {
    "nm_left": f"SELECT *, {pre.normalised('unit_name')} AS norm, {pre.sorted_tokens(pre.normalised('unit_name'))} AS a FROM nm_unit",
    "nm_right": f"""SELECT *, {pre.normalised('parent_name')} AS parent_norm,
        {pre.sorted_tokens(pre.normalised('parent_name'))} AS b FROM nm_parent""",
    "cand": "SELECT l.*, r.parent_code, r.parent_name, r.parent_norm, r.b FROM nm_left l JOIN nm_block USING (grp) JOIN nm_right r USING (parent_grp)",
    **pre.similarity_ctes("cand"),
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY score_e4 DESC, parent_code) AS k
        FROM cand JOIN scores USING (a, b)) WHERE k = 1""",
}
_MANUAL = {
    "manual": f"""SELECT u.*, o.target_grp, o.target_name, o.rule, o.override_note, r.parent_code, r.parent_name FROM nm_unit u
        JOIN nm_override o USING (grp, unit_name) LEFT JOIN nm_right r ON r.parent_grp = o.target_grp
          AND r.parent_norm = {pre.normalised('o.target_name')}""",
}
_QL, _QR = pre.qualifiers("norm", ADJECTIVES), pre.qualifiers("parent_norm", ADJECTIVES)
_XWALK = {
    "fuzzy_": f"""SELECT unit_id, grp, unit_name, parent_code, parent_name, score_e4,
        CASE WHEN score_e4 >= 800000 AND {_QL} <> {_QR} THEN 'unmatched' WHEN score_e4 >= 900000 THEN 'fuzzy'
             WHEN score_e4 >= 800000 THEN 'fuzzy_review' ELSE 'unmatched' END AS tier,
        CASE WHEN score_e4 >= 800000 AND {_QL} <> {_QR} THEN 'SIBLING|' || parent_name || '|' || score_e4
             WHEN score_e4 < 800000 THEN 'BELOW|' || parent_name || '|' || score_e4 END AS note FROM best""",
    "xwalk": """SELECT unit_id, grp, unit_name, CASE WHEN rule <> 'exclude' THEN parent_code END AS match_code,
          CASE WHEN rule <> 'exclude' THEN parent_name END AS match_name,
          CASE WHEN rule <> 'exclude' THEN 1000000::BIGINT END AS match_e4,
          CASE WHEN rule = 'exclude' THEN 'excluded' ELSE 'override:' || rule END AS tier, override_note AS note
        FROM manual WHERE rule = 'exclude' OR parent_code IS NOT NULL
        UNION ALL SELECT f.unit_id, f.grp, f.unit_name, CASE WHEN tier <> 'unmatched' THEN f.parent_code END,
          CASE WHEN tier <> 'unmatched' THEN f.parent_name END, CASE WHEN tier <> 'unmatched' THEN score_e4 END, tier,
          coalesce(note, CASE WHEN m.unit_id IS NOT NULL THEN 'NO_TARGET|' || target_grp || '|' || target_name END)
        FROM fuzzy_ f LEFT JOIN manual m USING (unit_id)
        WHERE m.unit_id IS NULL OR (m.rule <> 'exclude' AND m.parent_code IS NULL)""",
}
_ALL = {**NAMES, **_NORM, **_MANUAL, **_XWALK}


def crosswalk(d):
    n = Names(d)
    lk.require_known_groups(n.units, n.group_map)
    return lk.crosswalk(n.units, n.parents, lk.explode_map(n.group_map), n.overrides, qualifiers=ADJECTIVES)


@register("crosswalk_override", sql("""SELECT unit_id, rule, CASE WHEN rule = 'exclude' THEN 'excluded'
    WHEN parent_code IS NOT NULL THEN 'override:' || rule END AS tier, CASE WHEN rule <> 'exclude' THEN parent_code END AS match_code,
    CASE WHEN rule = 'exclude' OR parent_code IS NOT NULL THEN override_note
         ELSE 'NO_TARGET|' || target_grp || '|' || target_name END AS note FROM manual""",
    recursive=True, **_ALL))
def _(d):
    n = Names(d)
    return lk.resolve_overrides(n.units, n.overrides, n.parents).select("unit_id", "rule", "tier", "match_code", "note")


@register("crosswalk_candidates", sql("""SELECT unit_id, grp, count(*) AS candidates FROM nm_unit JOIN nm_block USING (grp)
    JOIN nm_parent USING (parent_grp) GROUP BY 1, 2""", **NAMES))
def _(d):
    n = Names(d)
    return lk.candidate_counts(n.units, n.parents, lk.explode_map(n.group_map)).select("unit_id", "grp", "candidates")


@register("crosswalk_scores", sql("SELECT unit_id, parent_code, score_e4 FROM best", recursive=True, **_ALL))
def _(d):
    n = Names(d)
    return lk.best_match(n.units, n.parents, lk.explode_map(n.group_map)).select("unit_id", "parent_code", "score_e4")


@register("crosswalk", sql("SELECT * FROM xwalk", recursive=True, **_ALL))
def _(d):
    return crosswalk(d)


@register("tier_counts", sql("SELECT tier, count(*) AS n FROM xwalk GROUP BY 1", recursive=True, **_ALL))
def _(d):
    return lk.tier_counts(crosswalk(d))


@register("crosswalk_coverage", sql("""SELECT units, matched, sharing_parent, units - matched AS unmatched, matched * 100 < units * 85 AS below_warning
    FROM (SELECT count(*) AS units, count(match_code) AS matched FROM xwalk),
    (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS sharing_parent FROM (SELECT count(*) AS n FROM xwalk WHERE match_code IS NOT NULL
      GROUP BY match_code HAVING count(*) > 1))""", recursive=True, **_ALL))
def _(d):
    return lk.coverage(crosswalk(d))


@register("crosswalk_lists", sql("""SELECT 'unmatched' AS list, unit_id, grp, unit_name, match_name, coalesce(note, 'NO_CANDIDATE') AS detail
      FROM xwalk WHERE tier = 'unmatched' UNION ALL
    SELECT 'review', unit_id, grp, unit_name, match_name, CAST(match_e4 AS VARCHAR) FROM xwalk WHERE tier = 'fuzzy_review' UNION ALL
    SELECT 'shared parent', unit_id, grp, unit_name, match_name, CAST(n AS VARCHAR) FROM (SELECT *, count(*) OVER (PARTITION BY match_code) AS n
      FROM xwalk WHERE match_code IS NOT NULL) WHERE n > 1""", recursive=True, **_ALL))
def _(d):
    return lk.review_lists(materialise(crosswalk(d), "crosswalk"))


@register("name_instability", sql("""SELECT indicator_id, count(DISTINCT indicator_text) AS name_variants FROM fx_parsed
    WHERE indicator_id BETWEEN 1 AND 104 GROUP BY 1 HAVING count(DISTINCT indicator_text) > 1""", **RAW))
def _(d):
    return rp.unstable_names(ld.modal_name(ld.parse_rows(Raw(d).rows))).select("indicator_id", "name_variants")


@register("population_total", sql("""SELECT CAST(sum(population) AS BIGINT) AS total, (SELECT CAST(sum(cents) // 100 AS BIGINT) FROM fx_orders) AS expected,
    abs(sum(population) - (SELECT sum(cents) // 100 FROM fx_orders)) * 10000 <= (SELECT sum(cents) // 100 FROM fx_orders) * 10 AS within FROM fx_population"""))
def _(d):
    stated = d.order_facts.agg(nb.div(F.sum("cents"), F.lit(100))).head()[0]
    return rp.total_check(d.population, "population", stated, tolerance_bp=10)


# -- apportionment ------------------------------------------------------------------------------

APPORTION = {
    "ap_unit": "SELECT unit_id, CASE WHEN unit_id % 7 = 0 THEN unit_id + 1 ELSE unit_id END AS parent_id FROM fx_unit",
    "ap_joined": """SELECT u.unit_id, p.unit_id AS parent_id, p.population, p.rural_hh, p.total_hh,
          p.population * p.minority_bp // 10000 AS minority, count(*) OVER (PARTITION BY u.parent_id) AS n
        FROM ap_unit u LEFT JOIN fx_population p ON p.unit_id = u.parent_id""",
    "ap": """SELECT unit_id, parent_id, CASE WHEN parent_id IS NULL THEN 0 ELSE n END AS n_sharing_parent,
          CAST(round_even(CAST(population AS DECIMAL(30,6)) / n, 0) AS BIGINT) AS population_alloc, population AS parent_population,
          CAST(round_even(rural_hh * 10000.0 / total_hh, 0) AS BIGINT) AS rural_share_bp, rural_hh, total_hh,
          CAST(round_even(minority * 10000.0 / population, 0) AS BIGINT) AS minority_share_bp FROM ap_joined""",
}


def apportioned(d):
    units = d.unit_dim.select("unit_id", F.when(F.col("unit_id") % 7 == 0, F.col("unit_id") + 1)
                              .otherwise(F.col("unit_id")).alias("parent_id"))
    parents = d.population.select(
        F.col("unit_id").alias("parent_id"), F.col("population").alias("parent_population"), "rural_hh", "total_hh",
        nb.mul_div("population", "minority_bp", F.lit(10_000)).alias("minority_population"))
    return lk.apportion(units, parents), parents


@register("apportion", sql("""SELECT unit_id, n_sharing_parent, n_sharing_parent > 1 AS is_apportioned, population_alloc,
    rural_share_bp, minority_share_bp FROM ap""", **APPORTION))
def _(d):
    return apportioned(d)[0].select("unit_id", "n_sharing_parent", "is_apportioned", "population_alloc",
                                    "rural_share_bp", "minority_share_bp")


@register("rural_population", sql("""SELECT unit_id, population_alloc,
    CASE WHEN 2 * r > total_hh OR (2 * r = total_hh AND q % 2 = 1) THEN q + 1 ELSE q END AS rural_population
    FROM (SELECT *, population_alloc * rural_hh // total_hh AS q, population_alloc * rural_hh % total_hh AS r FROM ap)""", **APPORTION))
def _(d):
    return apportioned(d)[0].select("unit_id", "population_alloc", "rural_population")


@register("population_conservation", sql("""SELECT parent_id, CAST(sum(population_alloc) AS BIGINT) AS children_total, count(*) AS n_children,
    any_value(parent_population) AS parent_population, abs(sum(population_alloc) - any_value(parent_population)) <= count(*) AS conserved
    FROM ap WHERE parent_id IS NOT NULL GROUP BY 1""", **APPORTION))
def _(d):
    children, parents = apportioned(d)
    return rp.conservation(children.filter("parent_id is not null and n_sharing_parent > 0")
                           .drop("parent_population"), parents)


# -- from the crosswalk's people to picks -----------------------------------------------------------

_CHAIN = {
    **APPORTION,
    "ch_people": """SELECT unit_id, n_sharing_parent > 1 AS is_apportioned, population_alloc AS population, minority_share_bp AS minority_bp,
        CAST(CASE WHEN 2 * r > total_hh OR (2 * r = total_hh AND q % 2 = 1) THEN q + 1 ELSE q END AS BIGINT) AS rural_population
        FROM (SELECT *, population_alloc * rural_hh // total_hh AS q, population_alloc * rural_hh % total_hh AS r FROM ap)""",
    "ch_unit": f"""SELECT *, CAST(CASE terrain WHEN 'plains' THEN {cfg.PARAMS['catchment_plains']} ELSE {cfg.PARAMS['catchment_other']} END AS BIGINT) AS catchment_norm
        FROM (SELECT u.*, p.* EXCLUDE (unit_id), CASE WHEN grp IN ({', '.join(f"'{g}'" for g in cfg.HILL_GROUPS)}) THEN 'hilly'
          WHEN coalesce(minority_bp, 0) >= {cfg.PARAMS['tribal_share_bp']} THEN 'tribal' ELSE 'plains' END AS terrain FROM fx_unit u LEFT JOIN ch_people p USING (unit_id))""",
    "ch_score": f"""SELECT unit_id, grp, zone, terrain, is_apportioned, population, rural_population, need_e9,
        CAST(need_e9::HUGEINT * rural_population // 1000000000 AS BIGINT) AS at_risk, (rural_population + catchment_norm - 1) // catchment_norm AS required_facilities,
        CAST(need_e9::HUGEINT * least(catchment_norm, rural_population) // catchment_norm AS BIGINT) AS gain
        FROM fx_need JOIN ch_unit USING (unit_id) WHERE scheme = '{cfg.DEFAULT_SCHEME}' AND indicators_present >= {cfg.PARAMS['min_indicators_present']} AND rural_population > 0""",
    **optimal_ctes("ch_opt", "ch_score"),
}
_CHAIN_COLUMNS = ["unit_id", "grp", "zone", "terrain", "is_apportioned", "population", "rural_population", "need_e9", "at_risk", "required_facilities", "gain"]


def chained_score(d):
    """Scores of units whose people come from their parents; units without a parent have none and drop out."""
    units = d._with_terrain(lk.as_population(apportioned(d)[0]))
    need = d.need.filter(F.col("scheme") == cfg.DEFAULT_SCHEME)
    return materialise(ix.choose_objective(ix.district_score(need, units), "gain_neutral").select("scheme", *_CHAIN_COLUMNS), "chained-score")


@register("chain_score", sql(f"SELECT {', '.join(_CHAIN_COLUMNS)} FROM ch_score", **_CHAIN))
def _(d):
    return chained_score(d).drop("scheme")


@register("chain_picks", sql("SELECT unit_id, grp, zone, is_apportioned, need_e9, gain FROM ch_opt", **_CHAIN))
def _(d):
    return al.optimal(chained_score(d), BUDGET, CAP, FLOOR).select("unit_id", "grp", "zone", "is_apportioned", "need_e9", "gain")


@register("chain_effect", sql("""SELECT is_apportioned, count(*) AS units, count(p.unit_id) AS picked, count(o.unit_id) AS picked_before,
    CAST(sum(s.rural_population) AS BIGINT) AS rural_population, CAST(sum(s.at_risk) AS BIGINT) AS at_risk
    FROM ch_score s LEFT JOIN (SELECT unit_id FROM ch_opt) p USING (unit_id) LEFT JOIN (SELECT unit_id FROM opt) o USING (unit_id) GROUP BY 1""",
                              **{**SCENARIOS, **_CHAIN}))
def _(d):
    """Units with own and with shared people: how many, how many are picked, and were by people counted per unit."""
    scored = chained_score(d)
    chosen = al.optimal(scored, BUDGET, CAP, FLOOR).select("unit_id", F.lit(1).alias("p"))
    before = optimal(d).select("unit_id", F.lit(1).alias("o"))
    return (scored.join(chosen, "unit_id", "left").join(before, "unit_id", "left").groupBy("is_apportioned")
            .agg(F.count("*").alias("units"), F.count("p").alias("picked"), F.count("o").alias("picked_before"),
                 F.sum("rural_population").alias("rural_population"), F.sum("at_risk").alias("at_risk")))


@register("unknown_groups", sql("SELECT DISTINCT grp FROM nm_unit WHERE grp NOT IN (SELECT DISTINCT grp FROM nm_block WHERE grp <> 'MEDIUM')", **NAMES))
def _(d):
    """The groups of units that a map without one of them leaves without a parent; a run stops on any."""
    n = Names(d)
    return lk.unknown_groups(n.units, n.group_map.filter("grp <> 'MEDIUM'"))


# -- names that grow with the data ----------------------------------------------------------------

def _word(number):
    return " || ".join(f"{SYLLABLES}[({number}) // {n} % 10 + 1]" for n in (100, 10, 1))


_MANY = {
    "many": f"""SELECT c_custkey AS unit_id, c_nationkey::VARCHAR AS grp, {_word('c_custkey * 7919')} AS w1, {_word('c_custkey * 31 + 7')} AS w2,
        {_word('c_custkey * 13 + 5')} AS w3 FROM customer""",
    "many_left": f"""SELECT unit_id, grp, {pre.sorted_tokens("CASE unit_id % 4 WHEN 0 THEN w2 || ' ' || w1 WHEN 1 THEN left(w1, -1) || ' ' || w2 WHEN 2 THEN w1 || ' ' || w2 || 'x' ELSE w3 END")} AS a
        FROM many""",
    "many_right": f"SELECT unit_id AS parent_code, grp, {pre.sorted_tokens("w1 || ' ' || w2")} AS b FROM many",
    "many_pairs": "SELECT * FROM many_left JOIN many_right USING (grp)",
    **pre.similarity_ctes("many_pairs"),
}


@register("many_names", sql("""SELECT unit_id, grp, parent_code, score_e4 FROM (SELECT *,
    row_number() OVER (PARTITION BY unit_id ORDER BY score_e4 DESC, parent_code) AS k FROM many_pairs JOIN scores USING (a, b)) WHERE k = 1""",
                            recursive=True, **_MANY))
def _(d):
    n = ManyNames(d)
    return lk.best_match(n.units, n.parents, n.blocks).select("unit_id", "grp", "parent_code", "score_e4")
