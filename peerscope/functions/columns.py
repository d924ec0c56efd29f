"""Pure column expressions.

Everything here maps ``Column -> Column`` and compiles to built-in Catalyst
expressions, so it stays inside whole-stage codegen; nothing calls back into
Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

__all__ = [
    "ACCENTED", "UNACCENTED", "POPULATION_BANDS", "PRESENCE_LABELS",
    "SIMILARITY_THRESHOLDS", "SIMILARITY_LABELS", "SENTINELS",
    "col_of", "row_hash", "slug", "normalize_state", "concat_key", "display_label",
    "file_name", "parent_prefix", "day_diff", "month_diff", "yyyymm_to_date",
    "yyyymm_of", "safe_cast", "safe_ratio", "mean_of", "per_capita",
    "sentinel_to_null", "population_band", "presence_band", "on_time_flag",
    "is_present", "with_default", "similarity_label", "utc_today",
    "relative_cutoff", "nested_field", "to_money", "register_sql_functions",
]

# --------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# --------------------------------------------------------------------------
# Slug folding: each accented letter maps to the plain letter at the same
# position; space and hyphen become underscore.  Nothing else is folded
# (apostrophes, n-tilde and repeated spaces stay as they are).
ACCENTED = "áàãâä" "éèêë" "íìîï" "óòõôö" "úùûü" "ç" " -"
UNACCENTED = "aaaaa" "eeee" "iiii" "ooooo" "uuuu" "c" "__"

# Population bands: strict upper bounds and labels; NULL falls in the last.
POPULATION_BANDS = (
    (10000, "Micro (< 10 mil)"),
    (50000, "Pequeno (10–50 mil)"),
    (200000, "Médio (50–200 mil)"),
    (None, "Grande (≥ 200 mil)"),
)
# Presence bands on clients per 10k inhabitants: NULL, < 1, < 3, else.
PRESENCE_LABELS = ("Sem presença", "Baixa", "Média", "Alta")
PRESENCE_BOUNDS = (1, 3)
# Similarity label from distance ratio: < 0.30, < 0.70, else.
SIMILARITY_THRESHOLDS = (0.30, 0.70)
SIMILARITY_LABELS = ("Muito parecido", "Razoavelmente parecido", "Pouco parecido")
# Census values that mean "no value".
SENTINELS = ("-", "...")
# --------------------------------------------------------------------------


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(*cols: str | Column, sep: str = "|") -> Column:
    """md5 fingerprint of the business columns.

    Each value is cast to string, NULL becomes '' and the parts are joined
    by ``sep``.  NULL and '' therefore collide, exactly like the layered
    models expect; the digest is a lowercase hex string.
    """
    parts = [F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def slug(c: str | Column, extended: bool = False) -> Column:
    """Place-name slug (J2): lower case, accents folded, space/hyphen -> '_'.

    ``extended=True`` also trims, collapses repeated spaces and folds 'ñ'
    (T9: the models' own slug keeps all three, so it is off by default).
    """
    x = F.lower(col_of(c))
    if extended:
        x = F.translate(F.regexp_replace(F.trim(x), r"\s+", " "), "ñ", "n")
    return F.translate(x, ACCENTED, UNACCENTED)


def normalize_state(c: str | Column) -> Column:
    """State code comparison key."""
    return F.upper(col_of(c))


def concat_key(*parts: str | Column, sep: str = "-") -> Column:
    """Composite surrogate key (C3): any NULL part gives a NULL key."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(col_of(p).cast("string"))
    return F.concat(*cols)


def display_label(name: str | Column, state: str | Column, sep: str = " - ") -> Column:
    """Display label "name - UF" (J4)."""
    return F.concat(col_of(name), F.lit(sep), col_of(state))


def file_name(path: str | Column) -> Column:
    """Last path component."""
    return F.element_at(F.split(col_of(path), "/"), -1)


def parent_prefix(path: str | Column) -> Column:
    """Path without its last component."""
    p = col_of(path)
    return F.regexp_replace(p, "/[^/]*$", "")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar-day difference (J6): counts date boundaries, not 24h spans."""
    return F.datediff(F.to_date(col_of(end)), F.to_date(col_of(start)))


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar-month difference (J6, MONTH part)."""
    s, e = col_of(start), col_of(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def yyyymm_to_date(c: str | Column, strict: bool = False) -> Column:
    """YYYYMM integer or string -> first day of that month."""
    s = col_of(c).cast("string")
    return F.to_date(s, "yyyyMM") if strict else F.try_to_date(s, "yyyyMM")


def yyyymm_of(ts: str | Column) -> Column:
    """Timestamp -> YYYYMM integer (inverse of J7)."""
    t = col_of(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def safe_cast(c: str | Column, to: str) -> Column:
    """SAFE_CAST (J9): a value that does not parse becomes NULL."""
    return col_of(c).try_cast(to)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; a zero or NULL denominator gives NULL (F8)."""
    if isinstance(num, str) and isinstance(den, str):  # same expression, one driver round trip
        return F.expr(f"CAST(`{num}` AS DOUBLE) / NULLIF(CAST(`{den}` AS DOUBLE), 0D)")
    d = col_of(den).cast("double")
    return col_of(num).cast("double") / F.nullif(d, F.lit(0.0))


def mean_of(c: str | Column) -> Column:
    """Average as sum / count in double (same value in every engine).

    Use it for exact money columns (decimal): the sum is exact, the
    division is one IEEE operation.
    """
    x = col_of(c)
    return F.sum(x).cast("double") / F.nullif(F.count(x).cast("double"), F.lit(0.0))


def per_capita(x: str | Column, population: str | Column, scale: float = 1.0) -> Column:
    """x per inhabitant (J12), optionally per ``scale`` inhabitants."""
    r = safe_ratio(x, population)
    return r * F.lit(float(scale)) if scale != 1.0 else r


def sentinel_to_null(c: str | Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Census sentinels ('-', '...') -> NULL."""
    x = col_of(c)
    return F.when(~x.isin(*sentinels), x)


def population_band(pop: str | Column, bands=POPULATION_BANDS, strict: bool = False) -> Column:
    """Population band (C4).  NULL goes to the last band unless ``strict``."""
    p = col_of(pop)
    expr = None
    for bound, label in bands:
        if bound is None:
            last = F.lit(label)
            if strict:
                last = F.when(p.isNotNull(), F.lit(label))
            expr = expr.otherwise(last) if expr is not None else last
        else:
            cond = p < F.lit(bound)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def presence_band(clients: str | Column, population: str | Column) -> Column:
    """Presence band from clients per 10k inhabitants."""
    rate = safe_ratio(clients, population)
    per10k = rate * F.lit(10000.0)
    none_, low, mid, high = PRESENCE_LABELS
    return (
        F.when(rate.isNull(), F.lit(none_))
        .when(per10k < F.lit(PRESENCE_BOUNDS[0]), F.lit(low))
        .when(per10k < F.lit(PRESENCE_BOUNDS[1]), F.lit(mid))
        .otherwise(F.lit(high))
    )


def on_time_flag(delivered: str | Column, estimated: str | Column) -> Column:
    """Three-valued on-time flag (C6): NULL until delivered."""
    d, e = col_of(delivered), col_of(estimated)
    return F.when(d.isNull(), F.lit(None).cast("boolean")).otherwise(d <= e)


def is_present(c: str | Column) -> Column:
    """Presence flag."""
    return col_of(c).isNotNull()


def with_default(c: str | Column, default=0.0) -> Column:
    """Default for a missing value."""
    return F.coalesce(col_of(c), F.lit(default))


def similarity_label(ratio: str | Column) -> Column:
    """Similarity label from the distance ratio (L4); NULL ratio -> last label."""
    r = col_of(ratio)
    lo, hi = SIMILARITY_THRESHOLDS
    a, b, c = SIMILARITY_LABELS
    return F.when(r < F.lit(lo), F.lit(a)).when(r < F.lit(hi), F.lit(b)).otherwise(F.lit(c))


def utc_today() -> Column:
    """Ingestion date (J13): today's date in the session zone (UTC)."""
    return F.current_date()


def relative_cutoff(days: int, now: Column | None = None) -> Column:
    """``now - INTERVAL days DAYS``."""
    base = now if now is not None else F.current_timestamp()
    return base - F.make_interval(days=F.lit(days))


def nested_field(c: str | Column, *path: str) -> Column:
    """Struct path access (J14): a NULL parent yields NULL."""
    x = col_of(c)
    for p in path:
        x = x.getField(p)
    return x


def to_money(c: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Exact money column: sums of it do not depend on row order."""
    return col_of(c).cast(f"decimal({precision},{scale})")


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the column macros to SQL users as temporary SQL functions (L1)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION place_slug(s STRING) RETURNS STRING "
        f"RETURN translate(lower(s), '{ACCENTED}', '{UNACCENTED}')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calendar_day_diff(s TIMESTAMP, e TIMESTAMP) "
        "RETURNS INT RETURN datediff(to_date(e), to_date(s))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION null_safe_ratio(n DOUBLE, d DOUBLE) "
        "RETURNS DOUBLE RETURN n / nullif(d, 0D)"
    )
