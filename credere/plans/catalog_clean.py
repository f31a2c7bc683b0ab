"""Registered queries: sources, column operators, quality, cleaning, splits.

Every query reads the driver's tables (through the dirty ``raw`` view of
``lineitem``) and runs over whole tables. Medians are asked for exactly
(``relative_error=0``), so the DuckDB twins can use ``quantile_disc``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import guarded_cast
from ..functions.codes import AGE_BUCKETS, AGE_TEXT, DTI_BUCKETS, age_bucket, dti_bucket
from ..operators import clean as C
from ..operators import columns as P
from ..operators import quality as Q
from ..operators import split as L
from ..profile import LINEITEM as PR
from ..session import scratch_path
from ..sources import delimited as S
from ..sources.tables import balanced, dirty_lineitem_columns, raw_lineitem, table
from .cleaning import clean_table, typed_table
from .registry import register
from .sql import cast_sql, ctes, missing_sql, no_nan, split_bucket_sql, with_ctes

EXACT = 0.0


def raw(spark, sf):
    return raw_lineitem(spark, sf)


def typed(spark, sf):
    return typed_table(raw(spark, sf), PR)


def typed_spread(spark, sf):
    """``typed`` over a balanced scan, for single-pass aggregates whose per-row work (Expand,
    partial aggregation) dominates; a no-op when the input already has enough splits."""
    return typed_table(dirty_lineitem_columns(balanced(table(spark, sf, "lineitem"))), PR)


def cleaned(spark, sf, fit_on="all"):
    return clean_table(raw(spark, sf), PR, fit_on=fit_on, relative_error=EXACT).df


def _sql(body, upto="clean", **kw):
    return with_ctes(body, PR, upto=upto, **kw)


# ---------------------------------------------------------------- sources
@register("scan_delimited", _sql("SELECT * FROM raw", upto="raw"))
def q_scan_delimited(spark, sf):
    """The raw view written as pipe-delimited text, read back all-string."""
    path = S.write_delimited(raw(spark, sf), scratch_path(spark, "delimited"))
    return S.read_delimited(spark, path, PR.raw_columns)


_LINE = "concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in PR.raw_columns) + ")"


@register("scan_lines", _sql(f"SELECT {_LINE} AS value FROM raw", upto="raw"))
def q_scan_lines(spark, sf):
    """Raw text lines of the delimited file, header lines removed."""
    path = S.write_delimited(raw(spark, sf), scratch_path(spark, "lines"))
    return S.data_lines(spark, path, "|".join(PR.raw_columns))


@register("parquet_roundtrip", _sql("SELECT * FROM clean"))
def q_parquet_roundtrip(spark, sf):
    """The cleaned table written as Parquet (overwrite) and read back."""
    path = S.write_parquet(cleaned(spark, sf), scratch_path(spark, "cleaned"))
    return S.read_parquet(spark, path)


# ---------------------------------------------------------------- columns
_ORDER_GROUP = ["l_shipyear", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"]
_ITEM_GROUP = ["l_partkey", "l_suppkey", "l_discount", "l_tax"]
_STATUS_GROUP = ["l_linestatus"]
_SELECTED = [c for c in _ORDER_GROUP + _ITEM_GROUP + _STATUS_GROUP if c != "l_shipyear"]


@register("feature_select", _sql(f"SELECT {', '.join(_SELECTED)} FROM raw", upto="raw"))
def q_feature_select(spark, sf):
    """Three column groups concatenated, then the year column dropped."""
    df = P.select_groups(raw(spark, sf), _ORDER_GROUP, _ITEM_GROUP, _STATUS_GROUP)
    return P.drop_columns(df, "l_shipyear")


@register("typed_cast", _sql("SELECT * FROM typed", upto="typed"))
def q_typed_cast(spark, sf):
    """Guarded bulk cast in one projection."""
    return typed(spark, sf)


def _profile_sql():
    parts = []
    spark_names = {"int": "int", "bigint": "bigint", "string": "string", "double": "double", "float": "float"}
    for c, t in PR.columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", '{spark_names[t]}' AS type, CAST(count(*) AS BIGINT) AS \"rows\", "
            f"CAST(count_if({missing_sql(c, t)}) AS BIGINT) AS missing, "
            f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS \"distinct\" "
            f"FROM typed")
    return _sql("\nUNION ALL\n".join(parts), upto="typed")


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf):
    """Name, type, rows, missing and distinct per column from one aggregate."""
    return P.column_profile(typed_spread(spark, sf))


@register("label_binarise", _sql(
    "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag <> 'A' THEN 0 ELSE 1 END AS INTEGER) AS label "
    "FROM typed", upto="typed"))
def q_label_binarise(spark, sf):
    """Original rule, NULL code -> 1."""
    df = typed(spark, sf).select("l_orderkey", "l_linenumber", "l_returnflag")
    return P.binarise_label(df, "l_returnflag", "A", "label")


@register("label_binarise_strict", _sql(
    "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag <> 'A' THEN 0 ELSE 1 END AS INTEGER) AS label "
    "FROM typed WHERE l_returnflag IS NOT NULL", upto="typed"))
def q_label_binarise_strict(spark, sf):
    """P6 strict mode: rows with a NULL code are dropped."""
    df = typed(spark, sf).select("l_orderkey", "l_linenumber", "l_returnflag")
    return P.binarise_label(df, "l_returnflag", "A", "label", strict=True)


# Age / debt-to-income texts derived from the order key (every code and the traps).
_AGE_CHOICES = AGE_TEXT + ["8888", "9999", None]
_DTI_CHOICES = list(dict.fromkeys(t for t, _ in DTI_BUCKETS)) + ["NA", ">70%", None]


def _pick(choices, key):
    arr = F.array(*[F.lit(v).cast("string") for v in choices])
    return F.element_at(arr, (F.col(key) % len(choices) + 1).cast("int"))


def _pick_sql(choices, key):
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in choices)
    return f"([{items}]::VARCHAR[])[{key} % {len(choices)} + 1]"


def _case_sql(col, buckets, otherwise):
    keep = otherwise == "keep"
    whens = " ".join(f"WHEN {col} = '{t}' THEN " + (f"'{c}'" if keep else str(c)) for t, c in buckets)
    tail = col if keep else str(otherwise)
    return f"CASE {whens} ELSE {tail} END"


@register("age_bucket", "SELECT l_orderkey, l_linenumber, age_text, "
          + cast_sql("(" + _case_sql("age_text", AGE_BUCKETS, "keep") + ")", "int") + " AS age_code FROM ("
          + f"SELECT l_orderkey, l_linenumber, {_pick_sql(_AGE_CHOICES, 'l_orderkey')} AS age_text FROM lineitem) t")
def q_age_bucket(spark, sf):
    """Age text -> ordinal; unknown text kept, then the guarded int cast."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    df = li.withColumn("age_text", _pick(_AGE_CHOICES, "l_orderkey"))
    return df.withColumn("age_code", guarded_cast(age_bucket("age_text"), PR.spark_type("l_linenumber")))


@register("dti_bucket", "SELECT l_orderkey, l_linenumber, dti_text, "
          + "CAST(" + _case_sql("dti_text", DTI_BUCKETS, 20) + " AS INTEGER) AS dti_code FROM ("
          + f"SELECT l_orderkey, l_linenumber, {_pick_sql(_DTI_CHOICES, 'l_orderkey')} AS dti_text FROM lineitem) t")
def q_dti_bucket(spark, sf):
    """19 texts -> 0..19 (first match wins), anything else and NULL -> 20."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    df = li.withColumn("dti_text", _pick(_DTI_CHOICES, "l_orderkey"))
    return df.withColumn("dti_code", dti_bucket("dti_text").cast("int"))


# ---------------------------------------------------------------- filters
_NONZERO = " AND ".join(f"{c} <> 0" for c in PR.nonzero_cols)


@register("nonzero_filter", _sql(f"SELECT * FROM typed WHERE {_NONZERO}", upto="typed"))
def q_nonzero_filter(spark, sf):
    """F1."""
    return C.nonzero_filter(typed(spark, sf), PR.nonzero_cols)


@register("sentinel_filter", _sql("SELECT * FROM typed WHERE l_suppkey <> 'NA'", upto="typed"))
def q_sentinel_filter(spark, sf):
    """F2."""
    return C.sentinel_filter(typed(spark, sf), PR.sentinel_cols)


_NOTNA = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in PR.dropna_cols)


@register("dropna_any", _sql(f"SELECT * FROM typed WHERE {_NOTNA}", upto="typed"))
def q_dropna_any(spark, sf):
    """F8."""
    return C.dropna_any(typed(spark, sf), PR.dropna_cols)


# ---------------------------------------------------------------- aggregates
def _census_sql(nan, sentinel):
    cols = ", ".join(f"CAST(count_if({missing_sql(c, t, nan, sentinel)}) AS BIGINT) AS {c}" for c, t in PR.columns)
    return _sql(f"SELECT {cols} FROM typed", upto="typed")


@register("missing_census", _census_sql(True, "NA"))
def q_missing_census(spark, sf):
    """A2: NULL, NaN or 'NA' per column, type-aware, one row."""
    return Q.missing_census(typed_spread(spark, sf))


@register("null_census", _census_sql(False, None))
def q_null_census(spark, sf):
    """A3: NULL-only census."""
    return Q.missing_census(typed_spread(spark, sf), nan=False, sentinel=None)


@register("group_count", _sql('SELECT l_linenumber, CAST(count(*) AS BIGINT) AS "count" FROM typed '
                              "GROUP BY l_linenumber", upto="typed"))
def q_group_count(spark, sf):
    """A4."""
    return Q.group_count(typed(spark, sf), "l_linenumber")


@register("column_mode", _sql('SELECT l_tax AS value, CAST(count(*) AS BIGINT) AS "count" FROM typed '
                              "GROUP BY l_tax ORDER BY count(*) DESC, l_tax ASC NULLS FIRST LIMIT 1",
                              upto="typed"))
def q_column_mode(spark, sf):
    """A5: NULL-aware mode (NULL is a group), ties to the lowest value."""
    return Q.mode_frame(typed(spark, sf), "l_tax", null_counts=True)


@register("column_mode_nonnull", _sql('SELECT l_quantity AS value, CAST(count(*) AS BIGINT) AS "count" '
                                      "FROM typed WHERE l_quantity IS NOT NULL GROUP BY l_quantity "
                                      "ORDER BY count(*) DESC, l_quantity ASC LIMIT 1", upto="typed"))
def q_column_mode_nonnull(spark, sf):
    """A5 with NULL skipped (the ``mode()`` meaning)."""
    return Q.mode_frame(typed(spark, sf), "l_quantity", null_counts=False)


@register("distinct_values", _sql("SELECT DISTINCT l_linestatus, l_returnflag FROM typed", upto="typed"))
def q_distinct_values(spark, sf):
    """A6."""
    return Q.distinct_values(typed(spark, sf), "l_linestatus", "l_returnflag")


def _distinct_sql():
    cols = ", ".join(f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
                     for c in PR.names)
    return _sql(f"SELECT {cols} FROM typed", upto="typed")


@register("distinct_counts", _distinct_sql())
def q_distinct_counts(spark, sf):
    """Every column's distinct count (NULL counted as a value) in one aggregate."""
    return Q.distinct_counts(typed_spread(spark, sf))


@register("class_balance", _sql('SELECT label, CAST(count(*) AS BIGINT) AS "count", '
                                'count(*) / sum(count(*)) OVER () AS share FROM clean GROUP BY label'))
def q_class_balance(spark, sf):
    """A10/F3."""
    return Q.class_balance(cleaned(spark, sf), "label")


# ---------------------------------------------------------------- imputation
def _impute_sql(kind, cols):
    exprs = []
    for c, t in PR.columns:
        if c in cols and kind in ("median", "mean"):
            agg = "quantile_disc" if kind == "median" else "avg"
            arg = ", 0.5" if kind == "median" else ""
            exprs.append(f"COALESCE({no_nan(c, t)}, (SELECT {agg}({no_nan(c, t)}{arg}) FROM typed)) AS {c}")
        elif c in cols:
            exprs.append(f"CASE WHEN {c} IS NULL THEN (SELECT {c} FROM typed GROUP BY {c} ORDER BY count(*) DESC, "
                         f"{c} ASC NULLS FIRST LIMIT 1) ELSE {c} END AS {c}")
        else:
            exprs.append(c)
    return _sql("SELECT " + ", ".join(exprs) + " FROM typed", upto="typed")


@register("median_impute", _impute_sql("median", ["l_quantity"]))
def q_median_impute(spark, sf):
    """Exact median (NULL and NaN missing)."""
    df = typed(spark, sf)
    return C.impute(df, median=["l_quantity"], relative_error=EXACT)[0]


@register("mean_impute", _impute_sql("mean", ["l_extendedprice"]))
def q_mean_impute(spark, sf):
    """I2."""
    df = typed(spark, sf)
    return C.impute(df, mean=["l_extendedprice"])[0]


@register("mode_impute", _impute_sql("mode", ["l_tax"]))
def q_mode_impute(spark, sf):
    """I4: NULL-aware mode fills NULLs."""
    df = typed(spark, sf)
    return C.impute(df, mode=["l_tax"])[0]


_MULTI = ["l_quantity", "l_extendedprice", "l_tax"]
_MULTI_DROP = ["l_quantity", "l_discount"]


def _multi_sql():
    dropped = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _MULTI_DROP)
    exprs = [f"COALESCE({no_nan(c, t)}, (SELECT avg({no_nan(c, t)}) FROM d)) AS {c}" if c in _MULTI else c
             for c, t in PR.columns]
    return _sql("SELECT " + ", ".join(exprs) + " FROM d", upto="typed",
                extra={"d": f"SELECT * FROM typed WHERE {dropped}"})


@register("multi_impute", _multi_sql())
def q_multi_impute(spark, sf):
    """Any-NULL drop on two columns, then mean imputation of three in place."""
    df = C.dropna_any(typed(spark, sf), _MULTI_DROP)
    return C.impute(df, mean=_MULTI)[0]


@register("clean_table", _sql("SELECT * FROM clean"))
def q_clean_table(spark, sf):
    """The whole cleaning job in the original order (fit on all typed rows)."""
    return cleaned(spark, sf)


def _train_only_sql():
    parts = ctes(PR, fit_on="train")
    order = ["raw", "typed", "stats"] + [f"mode_{c}" for c in PR.mode_cols] + ["imputed", "clean"]
    return "WITH " + ",\n".join(f"{n} AS (\n{parts[n]}\n)" for n in order) + "\nSELECT * FROM clean"


@register("impute_train_only", _train_only_sql())
def q_impute_train_only(spark, sf):
    """Statistics fitted on the training side of the stable split only."""
    return cleaned(spark, sf, fit_on="train")


# ---------------------------------------------------------------- sort / sample / split
@register("top_k", _sql('SELECT l_suppkey, CAST(count(*) AS BIGINT) AS "count" FROM clean GROUP BY l_suppkey '
                        "ORDER BY count(*) DESC, l_suppkey LIMIT 10"))
def q_top_k(spark, sf):
    """L1-L3: the ten busiest suppliers (a top-k report), ties by key."""
    counts = Q.group_count(cleaned(spark, sf), "l_suppkey")
    return L.top_k(counts, [F.desc("count"), F.asc("l_suppkey")], 10)


@register("hash_sample", _sql(f"SELECT * FROM clean WHERE {split_bucket_sql('l_orderkey', 10000)} < 1000"))
def q_hash_sample(spark, sf):
    """10% of orders by stable hash (the sampling operator itself)."""
    return L.hash_sample(cleaned(spark, sf), "l_orderkey", 0.10)


@register("hash_split", _sql(f"SELECT *, CASE WHEN {split_bucket_sql('l_orderkey', 100)} < 80 THEN 'train' "
                             "ELSE 'test' END AS split FROM clean"))
def q_hash_split(spark, sf):
    """80/20 split by stable hash of the order key."""
    return L.hash_split(cleaned(spark, sf), "l_orderkey", 80, column="split")


@register("random_split")
def q_random_split(spark, sf):
    """Native seeded 80/20 split, training side (rows-only check)."""
    sides = L.random_split(cleaned(spark, sf), (0.8, 0.2), seed=100)
    train, test = (df.withColumn("split", F.lit(name)) for df, name in zip(sides, ("train", "test"), strict=True))
    return train.unionByName(test)


# ---------------------------------------------------------------- sketches and samples
_STATS_COLS = ("l_quantity", "l_extendedprice", "l_discount")
_ERROR = 0.001


def _certificate_sql():
    parts = []
    for c in _STATS_COLS:
        v = no_nan(c, PR.type_of(c))
        parts.append(f"SELECT '{c}' AS \"column\", count({v}) AS rows, CAST(quantile_disc({v}, {0.5 - _ERROR}) AS DOUBLE) AS low, "
                     f"CAST(quantile_disc({v}, {0.5 + _ERROR}) AS DOUBLE) AS high, TRUE AS certified FROM typed")
    return _sql(" UNION ALL ".join(parts), upto="typed")


@register("median_sketch", _certificate_sql())
def q_median_sketch(spark, sf):
    """A8/I1 by the sketch, as the job takes them: each sketched median lies between the exact values at the ranks
    0.5 - error and 0.5 + error, which are returned with the verdict."""
    df = typed(spark, sf)
    return C.sketch_certificate(df, C.fit_impute(df, median=_STATS_COLS, relative_error=_ERROR).median, _ERROR)


@register("distinct_sketch", _sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n, TRUE AS within FROM typed" for c in PR.names), upto="typed"))
def q_distinct_sketch(spark, sf):
    """A7 by sketches: each column's exact count, and whether the sketch of two halves of the table, merged,
    is within four standard errors of it."""
    df = typed_spread(spark, sf)
    half = F.pmod(F.hash("l_orderkey"), F.lit(2)) == 0
    parts = Q.distinct_sketches(df.filter(half)).unionByName(Q.distinct_sketches(df.filter(~half)))
    guess = Q.sketch_counts(Q.merge_sketches(parts)).withColumnRenamed("n", "guess")
    exact = Q.distinct_by_column(df, null_as_value=False)
    near = F.abs(F.col("guess") - F.col("n")) <= F.greatest(F.lit(1.0), 4 * Q.SKETCH_ERROR * F.col("n"))
    return exact.join(F.broadcast(guess), "column").select("column", "n", near.alias("within"))


SAMPLE_ROWS = 1000


@register("sample_rows", f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT {SAMPLE_ROWS}")
def q_sample_rows(spark, sf):
    """L5 to a row count: exactly 1000 orders, the same under any partitioning (the sampling operator itself)."""
    return L.bottom_k(table(spark, sf, "orders"), "o_orderkey", SAMPLE_ROWS).select("o_orderkey", "o_custkey", "o_orderstatus")


@register("scan_rejects", """
SELECT kind, count(*) AS lines, sum(l_orderkey) AS keys FROM (
  SELECT l_orderkey, CASE WHEN l_orderkey % 97 = 0 THEN 'short' WHEN l_orderkey % 89 = 0 THEN 'long' ELSE 'good' END AS kind FROM lineitem) GROUP BY kind""")
def q_scan_rejects(spark, sf):
    """Lineitem as delimited text in which some lines lost a field and some gained one; good rows and quarantined
    lines are counted, with the sum of their keys."""
    text = raw(spark, sf)
    names = text.columns
    key = F.col("l_orderkey").cast("bigint")
    fields = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in names])
    short = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in names[:-1]])
    path = f"{scratch_path(spark, 'lines')}"
    text.select(F.when(key % 97 == 0, short).when(key % 89 == 0, F.concat(fields, F.lit("|more"))).otherwise(fields).alias("value")).write.text(path)
    checked = S.read_checked(spark, path, names, header=False)
    bad = S.rejects(checked).select("kind", "l_orderkey")
    good = checked.filter(F.col(S.BAD_LINE).isNull()).select(F.lit("good").alias("kind"), "l_orderkey")
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_orderkey").cast("bigint")).alias("keys"))
