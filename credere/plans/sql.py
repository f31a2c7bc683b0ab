"""DuckDB twins of the Spark plans, generated from the same profile.

They are the correctness oracle: each registered Spark query has an SQL
string built from these common table expressions.
"""

from __future__ import annotations

from ..profile import Profile
from ..sources.tables import RAW_LINEITEM_SQL

_SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE",
              "string": "VARCHAR"}
_INT_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_INT_PART = r"^\s*([+-]?\d+)"


def cast_sql(col: str, t: str) -> str:
    if t == "string":
        return col
    if t in ("int", "bigint"):
        return (f"CASE WHEN regexp_matches({col}, '{_INT_TEXT}') "
                f"THEN TRY_CAST(regexp_extract({col}, '{_INT_PART}', 1) AS {_SQL_TYPES[t]}) END")
    return f"CAST(TRY_CAST({col} AS DOUBLE) AS {_SQL_TYPES[t]})"


def missing_sql(col: str, t: str, nan: bool = True, sentinel: str | None = "NA") -> str:
    parts = [f"{col} IS NULL"]
    if nan and t in ("float", "double"):
        parts.append(f"isnan({col})")
    if sentinel is not None and t == "string":
        parts.append(f"{col} = '{sentinel}'")
    return "(" + " OR ".join(parts) + ")"


def no_nan(col: str, t: str) -> str:
    return f"CASE WHEN isnan({col}) THEN NULL ELSE {col} END" if t in ("float", "double") else col


def ctes(profile: Profile, fit_on: str = "all", train_percent: int = 80) -> dict[str, str]:
    """raw -> typed -> stats/modes -> imputed -> clean, as named CTE bodies."""
    out = {"raw": RAW_LINEITEM_SQL}
    out["typed"] = "SELECT " + ",\n  ".join(
        f"{cast_sql(c, t)} AS {c}" for c, t in profile.columns) + "\nFROM raw"
    filters = []
    for c in profile.nonzero_cols:
        filters.append(f"{c} <> 0")
    for c in profile.sentinel_cols:
        filters.append(f"{c} <> '{profile.sentinel}'")
    where = " AND ".join(filters) if filters else "TRUE"
    if fit_on == "all":
        src = "typed"
    elif fit_on == "filtered":
        src = f"(SELECT * FROM typed WHERE {where})"
    else:
        src = f"(SELECT * FROM typed WHERE {split_bucket_sql(profile.key, 100)} < {train_percent})"
    stats = [f"quantile_disc({no_nan(c, profile.type_of(c))}, 0.5) AS median_{c}" for c in profile.median_cols]
    stats += [f"avg({no_nan(c, profile.type_of(c))}) AS mean_{c}" for c in profile.mean_cols]
    out["stats"] = "SELECT " + ", ".join(stats) + f" FROM {src} s"
    for c in profile.mode_cols:
        out[f"mode_{c}"] = (f"SELECT {c} AS v FROM {src} s GROUP BY {c} "
                            f"ORDER BY count(*) DESC, {c} ASC NULLS FIRST LIMIT 1")
    cols = []
    for c, t in profile.columns:
        if c in profile.median_cols:
            cols.append(f"CAST(COALESCE({no_nan(c, t)}, (SELECT median_{c} FROM stats)) AS {_SQL_TYPES[t]}) AS {c}")
        elif c in profile.mean_cols:
            cols.append(f"CAST(COALESCE({no_nan(c, t)}, (SELECT mean_{c} FROM stats)) AS {_SQL_TYPES[t]}) AS {c}")
        elif c in profile.mode_cols:
            cols.append(f"CASE WHEN {c} IS NULL THEN CAST((SELECT v FROM mode_{c}) AS {_SQL_TYPES[t]}) "
                        f"ELSE {c} END AS {c}")
        else:
            cols.append(c)
    out["imputed"] = "SELECT " + ",\n  ".join(cols) + "\nFROM typed"
    keep = [c for c in profile.names if c != profile.label_code]
    label = (f"CAST(CASE WHEN {profile.label_code} <> {sql_literal(profile.label_positive)} THEN 0 ELSE 1 END "
             f"AS INTEGER) AS {profile.label_out}")
    out["clean"] = f"SELECT {', '.join(keep)}, {label} FROM imputed WHERE {where}"
    return out


def sql_literal(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def split_bucket_sql(key: str, buckets: int) -> str:
    return f"(('0x' || substring(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {buckets})"


def with_ctes(body: str, profile: Profile, upto: str = "clean", extra: dict | None = None,
              fit_on: str = "all") -> str:
    parts = ctes(profile, fit_on=fit_on)
    order = ["raw", "typed", "stats"] + [f"mode_{c}" for c in profile.mode_cols] + ["imputed", "clean"]
    names = order[: order.index(upto) + 1]
    items = [f"{n} AS (\n{parts[n]}\n)" for n in names]
    for n, q in (extra or {}).items():
        items.append(f"{n} AS (\n{q}\n)")
    return "WITH " + ",\n".join(items) + "\n" + body
