"""Method parameters as plain values, and the fail-loud lookup over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The seven index indicators (id, key, domain, higher is worse).
INDICATORS = [
    (1, "anc_4plus_visits", "maternal", False),
    (2, "pnc_within_2_days", "maternal", False),
    (3, "institutional_births", "maternal", False),
    (4, "skilled_birth_attendance", "maternal", False),
    (5, "child_fully_vaccinated", "child", False),
    (6, "child_stunting", "nutrition", True),
    (7, "women_anaemia", "nutrition", True),
]
INDICATOR_IDS = [i[0] for i in INDICATORS]

# Weights in parts per million, by scheme and indicator id.
SCHEMES = {
    "equal_per_indicator": [142857, 142857, 142857, 142857, 142857, 142857, 142858],
    "equal_per_domain": [83333, 83333, 83333, 83333, 333333, 166667, 166668],
    "maternal_priority": [150000, 150000, 150000, 150000, 200000, 100000, 100000],
}
DEFAULT_SCHEME = "equal_per_indicator"

# Method parameters, at the scale of the test tables.
PARAMS = {
    "min_indicators_present": 5,
    "tribal_share_bp": 3500,
    "catchment_plains": 2_000_000,
    "catchment_other": 1_200_000,
    "budget": 25,
    "max_per_group": 2,
    "min_per_zone": 3,
}
HILL_GROUPS = ["NATION_2", "NATION_11", "NATION_20"]
NORMS = {"plains": PARAMS["catchment_plains"], "hilly": PARAMS["catchment_other"],
         "tribal": PARAMS["catchment_other"], "desert": PARAMS["catchment_other"]}
SEED = 42
OBJECTIVES = ("gain_neutral", "gain_population")


def get_param(key: str, params: dict[str, int] | None = None) -> int:
    """Look a parameter up; a missing one is a broken build, never a silent NULL."""
    table = PARAMS if params is None else params
    if table.get(key) is None:
        raise KeyError(f"required parameter is missing: {key}")
    return table[key]


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small literal relation as an inline table: its size is known to the planner."""
    def literal(x) -> str:
        if isinstance(x, str):
            return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(x, list):
            return "array(" + ", ".join(literal(v) for v in x) + ")"
        if isinstance(x, float):
            return f"{x!r}D"
        return "NULL" if x is None else str(x).lower()
    names = [c.strip().split(" ", 1) for c in columns.split(",")]
    table = ", ".join("(" + ", ".join(literal(x) for x in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in names)
    return spark.sql(f"SELECT {casts} FROM VALUES {table} AS t({', '.join(n for n, _ in names)})")


def indicator_relation(spark: SparkSession) -> DataFrame:
    return values(spark, INDICATORS, "indicator_id int, indicator_key string, domain string, higher_is_worse boolean")


def weight_relation(spark: SparkSession, schemes: dict[str, list[int]] | None = None) -> DataFrame:
    rows = [(s, i, w) for s, ws in (schemes or SCHEMES).items() for i, w in zip(INDICATOR_IDS, ws)]
    return values(spark, rows, "scheme string, indicator_id int, w_ppm long")


def param_relation(spark: SparkSession) -> DataFrame:
    return values(spark, list(PARAMS.items()), "key string, value long")
