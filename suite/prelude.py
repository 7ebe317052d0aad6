"""Check SQL for the domain relations: the definitions of FIXTURES.md, in plain windows."""

from equisite.functions.names import NOISE_WORDS
from equisite.functions.numbers import INNER_NUMBER, LEAD_NUMBER
from equisite.plans import settings as cfg

IDS = cfg.INDICATOR_IDS


def _values(rows) -> str:
    def lit(x):
        if isinstance(x, bool):
            return str(x).lower()
        return f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


_WEIGHTS = [(s, i, w) for s, ws in cfg.SCHEMES.items() for i, w in zip(IDS, ws)]
_HILLS = ", ".join(f"'{g}'" for g in cfg.HILL_GROUPS)

CTES = {
    "fx_unit": """SELECT c_custkey AS unit_id, c_name AS unit_name, n_name AS grp, r_name AS zone
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_orders": """SELECT o_orderkey, o_custkey AS unit_id, o_orderstatus AS status,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
        CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders""",
    "fx_population": """SELECT unit_id, population, rural_hh, total_hh, minority_bp,
            CAST(population * rural_hh // total_hh AS BIGINT) AS rural_population
        FROM (SELECT unit_id, CAST(sum(cents) // 100 AS BIGINT) AS population,
                count(*) FILTER (WHERE status <> 'P') AS rural_hh, count(*) AS total_hh,
                CAST(10000 * coalesce(sum(cents) FILTER (WHERE priority = 1), 0) // sum(cents) AS BIGINT) AS minority_bp
              FROM fx_orders GROUP BY unit_id)""",
    "fx_district": f"""SELECT u.*, p.population, p.rural_hh, p.total_hh, p.minority_bp, p.rural_population,
            CASE WHEN grp IN ({_HILLS}) THEN 'hilly'
                 WHEN coalesce(minority_bp, 0) >= {cfg.PARAMS['tribal_share_bp']} THEN 'tribal' ELSE 'plains' END AS terrain,
            CAST(CASE WHEN grp NOT IN ({_HILLS}) AND coalesce(minority_bp, 0) < {cfg.PARAMS['tribal_share_bp']}
                 THEN {cfg.PARAMS['catchment_plains']} ELSE {cfg.PARAMS['catchment_other']} END AS BIGINT) AS catchment_norm
        FROM fx_unit u LEFT JOIN fx_population p USING (unit_id)""",
    "fx_lines": """SELECT o.unit_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, l_returnflag, l_linestatus
        FROM lineitem JOIN fx_orders o ON l_orderkey = o.o_orderkey""",
    "fx_fact": """SELECT unit_id, priority AS indicator_id, count(*) AS n,
            CAST(10000 * coalesce(sum(cents) FILTER (WHERE status = 'F'), 0) // sum(cents) AS BIGINT) AS value_bp
        FROM fx_orders GROUP BY unit_id, priority
        UNION ALL SELECT unit_id, 6, count(*),
            CAST(10000 * coalesce(sum(c) FILTER (WHERE l_returnflag = 'R'), 0) // sum(c) AS BIGINT) FROM fx_lines GROUP BY unit_id
        UNION ALL SELECT unit_id, 7, count(*),
            CAST(10000 * coalesce(sum(c) FILTER (WHERE l_linestatus = 'O'), 0) // sum(c) AS BIGINT) FROM fx_lines GROUP BY unit_id""",
    "fx_indicator": f"""SELECT * FROM (VALUES {_values(cfg.INDICATORS)}) t(indicator_id, indicator_key, domain, higher_is_worse)""",
    "fx_weight": f"""SELECT scheme, indicator_id, CAST(w AS BIGINT) AS w_ppm FROM (VALUES {_values(_WEIGHTS)}) t(scheme, indicator_id, w)""",
    "fx_score": """SELECT f.unit_id, f.indicator_id, f.n, f.value_bp, i.indicator_key, i.domain, i.higher_is_worse,
            CASE WHEN higher_is_worse THEN value_bp ELSE 10000 - value_bp END AS need_bp
        FROM fx_fact f JOIN fx_indicator i USING (indicator_id)""",
    "fx_pct": """SELECT *, CAST(((rank() OVER w)::HUGEINT - 1) * 1000000000
            // greatest(count(*) OVER (PARTITION BY indicator_id) - 1, 1) AS BIGINT) AS pct_e9
        FROM fx_score WINDOW w AS (PARTITION BY indicator_id ORDER BY need_bp)""",
    "fx_need": """SELECT unit_id, scheme, count(*) AS indicators_present, CAST(sum(w_ppm) AS BIGINT) AS weight_covered_ppm,
            CAST(sum(w_ppm * pct_e9) // sum(w_ppm) AS BIGINT) AS need_e9
        FROM fx_pct JOIN fx_weight USING (indicator_id) GROUP BY unit_id, scheme""",
    "fx_scored": f"""SELECT n.unit_id, n.scheme, n.indicators_present, n.weight_covered_ppm, n.need_e9, d.unit_name, d.grp, d.zone,
            d.population, d.terrain, d.catchment_norm, d.rural_population,
            CAST(need_e9::HUGEINT * rural_population // 1000000000 AS BIGINT) AS at_risk,
            (rural_population + catchment_norm - 1) // catchment_norm AS required_facilities,
            CAST(need_e9::HUGEINT * least(catchment_norm, rural_population) // 1000000000 AS BIGINT) AS gain_population,
            CAST(need_e9::HUGEINT * least(catchment_norm, rural_population) // catchment_norm AS BIGINT) AS gain_neutral
        FROM fx_need n JOIN fx_district d USING (unit_id)
        WHERE indicators_present >= {cfg.PARAMS['min_indicators_present']} AND rural_population > 0""",
    "fx_cand": f"""SELECT *, gain_neutral AS gain FROM fx_scored WHERE scheme = '{cfg.DEFAULT_SCHEME}'""",
    "fx_wide": "SELECT unit_id, " + ", ".join(
        f"max(pct_e9) FILTER (WHERE indicator_id = {i}) AS p{i}" for i in IDS) + " FROM fx_pct GROUP BY unit_id",
}


def sql(body: str, recursive: bool = False, **extra: str) -> str:
    """The domain relations, then ``extra`` ones, then the body."""
    ctes = {**CTES, **extra}
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + body


_KEYS = " ".join(f"WHEN {i} THEN '{k}'" for i, k, _, _ in cfg.INDICATORS)

NAMES = {
    "nm_parent": """SELECT min(p_partkey) AS parent_code, p_type AS parent_grp, p_name AS parent_name FROM part GROUP BY 2, 3""",
    "nm_unit": """SELECT min(parent_code) AS unit_id, parent_grp AS grp, CASE parent_code % 7
            WHEN 1 THEN split_part(parent_name, ' ', 2) || ' ' || split_part(parent_name, ' ', 1)
            WHEN 2 THEN upper(parent_name) || ' District'
            WHEN 3 THEN parent_name || right(parent_name, 1)
            WHEN 4 THEN replace(replace(parent_name, 'o', 'ö'), 'e', 'é')
            WHEN 5 THEN (CASE WHEN parent_name LIKE 'hot %' THEN 'cold ' ELSE 'hot ' END) || split_part(parent_name, ' ', 2)
            WHEN 6 THEN 'zqx ' || substr(split_part(parent_name, ' ', 2), 1, 3)
            ELSE parent_name END AS unit_name FROM nm_parent GROUP BY 2, 3""",
    "nm_block": """SELECT DISTINCT parent_grp AS grp, parent_grp FROM nm_parent
        UNION SELECT 'MEDIUM', 'LARGE' WHERE EXISTS (SELECT 1 FROM nm_parent WHERE parent_grp = 'MEDIUM')
          AND EXISTS (SELECT 1 FROM nm_parent WHERE parent_grp = 'LARGE')""",
    "nm_override": """SELECT u.grp, u.unit_name, u.grp AS target_grp, CASE unit_id % 23 WHEN 1 THEN 'Blue Anvil'
            WHEN 3 THEN 'no such name' ELSE parent_name END AS target_name,
            CASE unit_id % 23 WHEN 1 THEN 'child_of' WHEN 2 THEN 'exclude' ELSE 'rename' END AS rule,
            'manual row ' || (unit_id % 23) AS override_note
        FROM nm_unit u JOIN nm_parent p ON parent_code = unit_id WHERE unit_id % 23 IN (0, 1, 2, 3)""",
}


def normalised(x: str) -> str:
    """The normalisation steps in DuckDB's own functions."""
    s = f"lower(strip_accents({x}))"
    s = f"replace(replace(replace({s}, '&', ' and '), '-', ' '), '.', ' ')"
    s = f"regexp_replace({s}, '\\b({'|'.join(NOISE_WORDS)})\\b', ' ', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9 ]', ' ', 'g')"
    return f"trim(regexp_replace({s}, ' +', ' ', 'g'))"


def sorted_tokens(norm: str) -> str:
    return f"array_to_string(list_sort(string_split({norm}, ' ')), ' ')"


def qualifiers(norm: str, words) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_sort(list_distinct(list_filter(string_split({norm}, ' '), lambda t: t IN ({listed}))))"


def similarity_ctes(pairs: str) -> dict:
    """Scores of the distinct (a, b) in ``pairs`` by the textbook table, one row of it per step."""
    return {
        "lcs_run": f"""SELECT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) AS r
                FROM (SELECT DISTINCT a, b FROM {pairs})
            UNION ALL SELECT a, b, i + 1, list_reduce(list_transform(range(1, length(b) + 1), lambda j: [j]),
                lambda acc, j: list_append(acc, CASE WHEN a[i + 1] = b[j[1]] THEN r[j[1]] + 1
                  ELSE greatest(r[j[1] + 1], acc[-1]) END), [0::BIGINT]) FROM lcs_run WHERE i < length(a)""",
        "scores": """SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 1000000
            ELSE r[-1] * 2000000 // (length(a) + length(b)) END AS score_e4 FROM lcs_run WHERE i = length(a)""",
    }


RAW = {
    "fx_label": f"""SELECT u.unit_id, u.unit_name, u.grp, i.indicator_id AS id, coalesce(f.n, 0) AS n, f.value_bp AS v,
            i.indicator_id || '. Share of ' || CASE i.indicator_id {_KEYS} END AS label
        FROM fx_unit u CROSS JOIN fx_indicator i LEFT JOIN fx_fact f ON f.unit_id = u.unit_id AND f.indicator_id = i.indicator_id""",
    "fx_raw_once": """SELECT unit_id, unit_name, grp, CASE WHEN unit_id % 101 = 0 AND id = 7 THEN 'Share without a number'
            WHEN unit_id % 97 = 0 THEN 'Section header ' || label
            WHEN unit_id % 5 = 0 AND id = 5 THEN label || ' (rev)' ELSE label END AS indicator_text,
            CASE WHEN n = 0 THEN 'NA' WHEN n < 2 THEN '*' ELSE CAST(v AS VARCHAR) END AS value_text,
            CASE WHEN unit_id % 10 = 0 THEN 'NA' ELSE CAST(coalesce(v, 0) + unit_id % 100 AS VARCHAR) END AS earlier_text,
            unit_id * 20 + id AS line FROM fx_label""",
    "fx_raw": """SELECT * FROM fx_raw_once UNION ALL
        SELECT unit_id, unit_name, grp, indicator_text, 'NA', earlier_text, line + 10 FROM fx_raw_once WHERE unit_id % 50 = 0""",
    "fx_parsed": f"""SELECT *, CAST(coalesce(nullif(regexp_extract(indicator_text, '{LEAD_NUMBER}', 1), ''),
            nullif(regexp_extract(indicator_text, '{INNER_NUMBER}', 1), '')) AS INTEGER) AS indicator_id FROM fx_raw""",
    "fx_typed": """SELECT u.unit_id, p.indicator_id, try_cast(value_text AS BIGINT) AS value_bp, try_cast(earlier_text AS BIGINT) AS earlier_bp,
            CASE value_text WHEN '*' THEN 'suppressed' WHEN 'NA' THEN 'absent' ELSE 'present' END AS flag
        FROM (SELECT *, row_number() OVER (PARTITION BY grp, unit_name, indicator_id ORDER BY line) AS copy FROM fx_parsed
              WHERE indicator_id BETWEEN 1 AND 104) p JOIN fx_unit u USING (grp, unit_name) WHERE copy = 1""",
}
