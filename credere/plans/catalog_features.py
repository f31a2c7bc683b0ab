"""Registered queries: indexing, one-hot, scaling, assembly, evaluation, tracking, scoring checks.

Training side = stable 80% of orders; statistics of every stage are fitted
on it and applied to the held-out side, as the original job did.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import features as T
from ..operators import score as X
from ..operators.split import hash_split
from ..operators.tracking import Tracker, leaderboard
from ..profile import LINEITEM as PR
from ..session import scratch_path
from ..sources.tables import balanced, dirty_lineitem_columns, table
from .catalog_clean import EXACT, _sql, cleaned, typed
from .cleaning import clean_typed, typed_table
from .registry import register
from .sql import split_bucket_sql

LOW = list(PR.low_card)
HIGH = list(PR.high_card)
CATS = LOW + HIGH
NUM = list(PR.numeric)
ARITY_DOMAIN = {"l_linestatus": 2, "l_linenumber": 7}   # fixed by the data's domain


def staged_clean(spark, sf):
    """Cleaned table: the statistics are fitted on pruned scans, before the filters, and applied
    as literals in one narrow plan. Nothing is written."""
    scan = balanced(table(spark, sf, "lineitem"))
    return clean_typed(typed_table(dirty_lineitem_columns(scan), PR), PR, relative_error=EXACT).df


def train_test(spark, sf, staged=None):
    """Stable 80/20 split of the staged cleaned table."""
    return hash_split(staged if staged is not None else staged_clean(spark, sf), "l_orderkey", 80)


# ------------------------------------------------------------ SQL building blocks
_B = split_bucket_sql("l_orderkey", 100)
SPLIT = {"train": f"SELECT * FROM clean WHERE {_B} < 80", "test": f"SELECT * FROM clean WHERE {_B} >= 80"}


def _lab_sql(cols, src="train"):
    cnt = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS cname, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {src} "
        f"WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)
    return {"cnt": cnt,
            "lab": "SELECT cname, value, CAST(row_number() OVER (PARTITION BY cname ORDER BY n DESC, value) - 1 "
                   "AS DOUBLE) AS idx FROM cnt"}


def _joins(alias_src, cols, kind="JOIN"):
    out = []
    for i, c in enumerate(cols):
        out.append(f"{kind} lab j{i} ON j{i}.cname = '{c}' AND j{i}.value = CAST({alias_src}.{c} AS VARCHAR)")
    return "\n".join(out)


def _indexed_sql(src, cols, name):
    sel = ", ".join(f"j{i}.idx AS {c}_index" for i, c in enumerate(cols))
    return {name: f"SELECT t.*, {sel} FROM {src} t\n{_joins('t', cols)}"}


def _feature_ctes():
    """train/test -> label table -> indexed (skip) -> scaled + one-hot slots."""
    ex = dict(SPLIT)
    ex.update(_lab_sql(CATS))
    ex.update(_indexed_sql("train", CATS, "itrain"))
    ex.update(_indexed_sql("test", CATS, "itest"))
    ex["sd"] = "SELECT " + ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in NUM) + " FROM itrain"
    return ex


def _slots_sql(src):
    parts = [f"CASE WHEN (SELECT sd_{c} FROM sd) = 0 THEN CAST(0 AS DOUBLE) ELSE {c} / (SELECT sd_{c} FROM sd) END "
             f"AS {c}_scaled" for c in NUM]
    for c in LOW:
        parts += [f"CAST(CASE WHEN {c}_index = {j} THEN 1 ELSE 0 END AS DOUBLE) AS {c}_ohe_{j}"
                  for j in range(ARITY_DOMAIN[c] - 1)]
    parts += [f"{c}_index" for c in HIGH]
    return f"SELECT s.*, {', '.join(parts)} FROM {src} s"


def _slot_names():
    names = [f"{c}_scaled" for c in NUM]
    for c in LOW:
        names += [f"{c}_ohe_{j}" for j in range(ARITY_DOMAIN[c] - 1)]
    return names + [f"{c}_index" for c in HIGH]


def _round_list(names):
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# ------------------------------------------------------------ index / one-hot / scale / assemble
def _index_query(cols, name):
    ex = dict(SPLIT)
    ex.update(_lab_sql(cols))
    ex.update(_indexed_sql("train", cols, "itrain"))
    outs = ", ".join(f"{c}, {c}_index" for c in cols)
    return _sql(f"SELECT l_orderkey, l_linenumber AS line, {outs} FROM itrain", extra=ex)


def _index_spark(spark, sf, cols):
    train, _ = train_test(spark, sf)
    idx = T.fit_label_index(train, cols)
    out = T.apply_label_index(train, idx, cols, "skip")
    return out.select("l_orderkey", F.col("l_linenumber").alias("line"),
                      *[x for c in cols for x in (F.col(c), F.col(c + "_index"))])


@register("index_low", _index_query(LOW, "index_low"))
def q_index_low(spark, sf):
    """Frequency-descending index of the low-cardinality columns (skip policy)."""
    return _index_spark(spark, sf, LOW)


@register("index_high", _index_query(HIGH, "index_high"))
def q_index_high(spark, sf):
    """The same for the high-cardinality columns (label tables, joined back)."""
    return _index_spark(spark, sf, HIGH)


def _ohe_names():
    return [f"{c}_ohe_{j}" for c in LOW for j in range(ARITY_DOMAIN[c] - 1)]


def _ohe_sql():
    ex = dict(SPLIT)
    ex.update(_lab_sql(LOW))
    ex.update(_indexed_sql("train", LOW, "itrain"))
    parts = [f"CAST(CASE WHEN {c}_index = {j} THEN 1 ELSE 0 END AS DOUBLE) AS {c}_ohe_{j}"
             for c in LOW for j in range(ARITY_DOMAIN[c] - 1)]
    return _sql(f"SELECT l_orderkey, l_linenumber AS line, {', '.join(parts)} FROM itrain", extra=ex)


@register("one_hot", _ohe_sql())
def q_one_hot(spark, sf):
    """One-hot with the last category dropped, expanded slot-wise."""
    train, _ = train_test(spark, sf)
    idx = T.fit_label_index(train, LOW)
    indexed = T.apply_label_index(train, idx, LOW, "skip")
    enc = OneHotEncoder(inputCols=[c + "_index" for c in LOW], outputCols=[c + "_OHE" for c in LOW],
                        dropLast=True).fit(indexed)
    out = enc.transform(indexed)
    keep = [F.col("l_orderkey"), F.col("l_linenumber").alias("line")]
    from pyspark.ml.functions import vector_to_array
    cols = []
    for c in LOW:
        arr = vector_to_array(F.col(c + "_OHE"))
        cols += [arr[j].alias(f"{c}_ohe_{j}") for j in range(idx.arity[c] - 1)]
    return out.select(*keep, *cols)


def _scale_sql():
    ex = dict(SPLIT)
    ex["sd"] = "SELECT " + ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in NUM) + " FROM train"
    parts = [f"round(CASE WHEN (SELECT sd_{c} FROM sd) = 0 THEN CAST(0 AS DOUBLE) ELSE {c} / (SELECT sd_{c} FROM sd) END, 6) "
             f"AS {c}_scaled" for c in NUM]
    return _sql(f"SELECT l_orderkey, l_linenumber AS line, {', '.join(parts)} FROM train", extra=ex)


@register("scale", _scale_sql())
def q_scale(spark, sf):
    """T4/T5: numeric assemble, then divide by the sample standard deviation (no centring)."""
    train, _ = train_test(spark, sf)
    vec = VectorAssembler(inputCols=NUM, outputCol="num_vector").transform(train)
    scaled = StandardScaler(inputCol="num_vector", outputCol="num_scaled", withMean=False,
                            withStd=True).fit(vec).transform(vec)
    return T.vector_columns(scaled.withColumn("line", F.col("l_linenumber")), "num_scaled",
                            [f"{c}_scaled" for c in NUM], ["l_orderkey", "line"])


def _assemble_sql(split="train"):
    ex = _feature_ctes()
    ex["slots"] = _slots_sql("itrain" if split == "train" else "itest")
    return ex


@register("assemble", _sql(f"SELECT l_orderkey, l_linenumber AS line, label, {_round_list(_slot_names())} "
                           "FROM slots", extra=_assemble_sql("train")))
def q_assemble(spark, sf):
    """Fitted feature model (index, one-hot, scale, assemble) on the training side."""
    train, _ = train_test(spark, sf)
    fm = T.FeatureBuilder(PR).fit(train)
    out = fm.transform(train).withColumn("line", F.col("l_linenumber"))
    return T.vector_columns(out, "features", fm.feature_names(), ["l_orderkey", "line", "label"])


@register("assemble_test", _sql(f"SELECT l_orderkey, l_linenumber AS line, label, {_round_list(_slot_names())} "
                                "FROM slots", extra=_assemble_sql("test")))
def q_assemble_test(spark, sf):
    """The training-side feature model applied to the held-out side (unseen rows skipped)."""
    train, test = train_test(spark, sf)
    fm = T.FeatureBuilder(PR).fit(train)
    out = fm.transform(test).withColumn("line", F.col("l_linenumber"))
    return T.vector_columns(out, "features", fm.feature_names(), ["l_orderkey", "line", "label"])


def _flags_sql():
    ex = dict(SPLIT)
    ex.update(_lab_sql(CATS))
    flags = ", ".join(f"(j{i}.idx IS NULL) AS f{i}" for i, _ in enumerate(CATS))
    ex["flags"] = f"SELECT t.*, {flags} FROM test t\n{_joins('t', CATS, 'LEFT JOIN')}"
    return ex


def _unseen_sql():
    parts = [f"SELECT '{c}' AS \"column\", CAST(count_if(f{i}) AS BIGINT) AS rows_lost FROM flags"
             for i, c in enumerate(CATS)]
    anyf = " OR ".join(f"f{i}" for i in range(len(CATS)))
    parts.append(f"SELECT '*' AS \"column\", CAST(count_if({anyf}) AS BIGINT) AS rows_lost FROM flags")
    return _sql("\nUNION ALL\n".join(parts), extra=_flags_sql())


@register("unseen_report", _unseen_sql())
def q_unseen_report(spark, sf):
    """Held-out rows the skip policy drops, per categorical column and in total."""
    train, test = train_test(spark, sf)
    idx = T.fit_label_index(train, CATS)
    return T.unseen_report(test, idx, CATS)


_TEST_COLS = [c for c in PR.names if c != PR.label_code] + [PR.label_out]


@register("rejected_rows", _sql(f"SELECT {', '.join('t.' + c for c in _TEST_COLS)} FROM flags t WHERE "
                                + " OR ".join(f"f{i}" for i in range(len(CATS))), extra=_flags_sql()))
def q_rejected_rows(spark, sf):
    """Held-out rows that get no score, flagged in one pass."""
    train, test = train_test(spark, sf)
    return X.rejected_rows(test, T.fit_label_index(train, CATS), CATS)


_ROLES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'rank' if c in PR.rank_encoded else 'nominal'}' AS treatment, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS categories, CAST({PR.tree_bins} AS INTEGER) AS bins FROM train" for c in CATS)


@register("feature_roles", _sql(_ROLES_SQL, extra=dict(SPLIT)))
def q_feature_roles(spark, sf):
    """How trees see each categorical column, as declared, with its categories on the training side."""
    train, _ = train_test(spark, sf)
    fm = T.FeatureBuilder(PR).fit(train)
    fm.check_bins(PR.tree_bins)
    nominal = fm.nominal_columns()
    rows = [(c, "nominal" if c in nominal else "rank", fm.index.arity[c], PR.tree_bins) for c in CATS]
    return spark.createDataFrame(rows, "`column` string, treatment string, categories bigint, bins int")


# ------------------------------------------------------------ evaluation over a rule-based prediction
_PRED_SQL = ("SELECT CAST(label AS DOUBLE) AS label, "
             "CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
             "CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) + l_discount / 100.0 AS score FROM test")


def rule_predictions(spark, sf):
    _, test = train_test(spark, sf)
    pred = F.when(F.col("l_linestatus") == F.lit("F"), F.lit(1.0)).otherwise(F.lit(0.0))
    return test.select(F.col("label").cast("double").alias("label"), pred.alias("prediction"),
                       (pred + F.col("l_discount") / 100.0).alias("score"))


def _metric_ctes():
    ex = dict(SPLIT)
    ex["p"] = _PRED_SQL
    ex["cm"] = "SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction"
    ex["bl"] = ("SELECT label, sum(n) AS n_true, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp "
                "FROM cm GROUP BY label")
    ex["bp"] = "SELECT prediction AS label, sum(n) AS n_pred FROM cm GROUP BY prediction"
    ex["pr"] = ("SELECT n_true, tp, CASE WHEN COALESCE(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS pp, "
                "tp / n_true AS rr FROM bl LEFT JOIN bp USING (label)")
    ex["m"] = ("SELECT sum(tp) / sum(n_true) AS accuracy, sum(n_true * pp) / sum(n_true) AS wp, "
               "sum(n_true * rr) / sum(n_true) AS wr, "
               "sum(n_true * CASE WHEN pp + rr > 0 THEN 2 * pp * rr / (pp + rr) ELSE 0.0 END) / sum(n_true) AS f1 "
               "FROM pr")
    ex["g"] = "SELECT score AS s, sum(CAST(label AS BIGINT)) AS pos, count(*) AS n FROM p GROUP BY score"
    ex["r"] = ("SELECT *, COALESCE(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
               "AS below FROM g")
    ex["a"] = ("SELECT (sum(pos * (below + (n + 1) / 2.0)) - sum(pos) * (sum(pos) + 1) / 2.0) / "
               "(sum(pos) * (sum(n) - sum(pos))) AS auc FROM r")
    return ex


@register("confusion", _sql('SELECT label, prediction, CAST(count(*) AS BIGINT) AS "count" FROM p '
                            "GROUP BY label, prediction", extra=_metric_ctes()))
def q_confusion(spark, sf):
    """A9."""
    return E.confusion(rule_predictions(spark, sf))


@register("metric_bundle", _sql(
    "SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM m UNION ALL "
    "SELECT 'weightedPrecision', round(wp, 6) FROM m UNION ALL "
    "SELECT 'weightedRecall', round(wr, 6) FROM m UNION ALL "
    "SELECT 'f1', round(f1, 6) FROM m UNION ALL "
    "SELECT 'areaUnderROC', round(auc, 6) FROM a", extra=_metric_ctes()))
def q_metric_bundle(spark, sf):
    """Accuracy, weighted precision/recall/F1 and exact AUC as (metric, value)."""
    return E.metric_bundle(rule_predictions(spark, sf), digits=6)


@register("auc_exact", _sql("SELECT round(auc, 6) AS areaUnderROC FROM a", extra=_metric_ctes()))
def q_auc_exact(spark, sf):
    """E5: exact area under ROC (mid-rank, distributed prefix sum)."""
    return E.auc_exact(rule_predictions(spark, sf)).select(F.round("areaUnderROC", 6).alias("areaUnderROC"))


# ------------------------------------------------------------ linear score with fixed weights
def _weights(n):
    return [((-1) ** i) / (i + 1) for i in range(n)], -0.5


@register("linear_score", None)
def q_linear_score(spark, sf):
    """M9 for a linear model with given weights: features . w + b, prediction = score > 0."""
    train, test = train_test(spark, sf)
    fm = T.FeatureBuilder(PR).fit(train)
    from pyspark.ml.functions import vector_to_array
    out = fm.transform(test)
    arr = vector_to_array(F.col("features"))
    w, b = _weights(len(fm.feature_names()))
    score = F.lit(b)
    for i, wi in enumerate(w):
        score = score + arr[i] * F.lit(wi)
    return out.select("l_orderkey", F.col("l_linenumber").alias("line"), "label",
                      F.round(score, 6).alias("score"),
                      F.when(score > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


def _linear_sql():
    ex = _assemble_sql("test")
    names = _slot_names()
    w, b = _weights(len(names))
    expr = f"{b!r}" + "".join(f" + {n} * {wi!r}" for n, wi in zip(names, w))
    ex["sc"] = f"SELECT l_orderkey, l_linenumber AS line, label, {expr} AS sc FROM slots"
    return _sql("SELECT l_orderkey, line, label, round(sc, 6) AS score, "
                "CAST(CASE WHEN sc > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM sc", extra=ex)


from .registry import ORACLE as _ORACLE  # noqa: E402

_ORACLE["linear_score"] = _linear_sql()


# ------------------------------------------------------------ tracking: rule sweep -> runs -> leaderboard
RULE_RUNS = ([("discount_rule", f"l_discount>={t}", "l_discount", t) for t in (2, 4, 6, 8)]
             + [("tax_rule", f"l_tax>={t}", "l_tax", t) for t in (2, 4, 6)]
             + [("quantity_rule", f"l_quantity>={t}", "l_quantity", t) for t in (10, 25, 40)])


@register("leaderboard")
def q_leaderboard(spark, sf):
    """R1-R3 + R5: a sweep of threshold rules evaluated in ONE aggregate over the held-out
    side, recorded as run/metric tables, then the best run per experiment."""
    _, test = train_test(spark, sf)
    tracker = Tracker(spark, scratch_path(spark, "tracking"))
    ids = {name: f"run-{i:03d}" for i, (_, name, _, _) in enumerate(RULE_RUNS)}
    accs = [F.avg(F.when((F.col(c) >= F.lit(t)).cast("int") == F.col("label"), 1.0).otherwise(0.0)).alias(ids[n])
            for _, n, c, t in RULE_RUNS]
    wide = test.agg(*accs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(ids[n]).alias("run_id"), F.lit("accuracy").alias("key"), F.col(f"`{ids[n]}`").alias("value"),
                 F.lit(0).cast("long").alias("ts"), F.lit(0).cast("long").alias("step")) for _, n, _, _ in RULE_RUNS])))
    tracker.log_metric_frame(long)
    runs = spark.createDataFrame([(ids[n], e, n, 0, 0, 3, "") for e, n, _, _ in RULE_RUNS],
                                 "run_id string, experiment string, name string, start_ts long, end_ts long, "
                                 "status int, artifact_path string")
    tracker.log_run_frame(runs)
    board = leaderboard(tracker.runs(), tracker.metrics(), "accuracy", top=1)
    return board.select("experiment", "name", F.round("accuracy", 6).alias("accuracy"), "rank")


def _leaderboard_sql():
    ex = dict(SPLIT)
    sel = " UNION ALL ".join(
        f"SELECT '{e}' AS experiment, '{n}' AS name, avg(CASE WHEN CAST({c} >= {t} AS INTEGER) = label "
        f"THEN 1.0 ELSE 0.0 END) AS accuracy FROM test" for e, n, c, t in RULE_RUNS)
    ex["acc"] = sel
    ex["rk"] = ("SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY accuracy DESC, name) AS rank "
                "FROM acc")
    return _sql("SELECT experiment, name, round(accuracy, 6) AS accuracy, CAST(rank AS INTEGER) AS rank "
                "FROM rk WHERE rank <= 1", extra=ex)


_ORACLE["leaderboard"] = _leaderboard_sql()


# ------------------------------------------------------------ input domain check and decode
LINEITEM_DOMAINS = {
    "l_linenumber": {"range": (1, 7)},
    "l_linestatus": {"in": ["O", "F"]},
    "l_returnflag": {"in": ["A", "N", "R"]},
    "l_quantity": {"range": (1.0, 45.0)},
    "l_discount": {"range": (0.0, 10.0)},
    "l_tax": {"range": (0.0, 8.0)},
}


def _domain_sql():
    parts = []
    for c, rule in LINEITEM_DOMAINS.items():
        if "in" in rule:
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in rule["in"])
            bad = f"{c} NOT IN ({vals})"
        else:
            lo, hi = rule["range"]
            bad = f"({c} < {lo} OR {c} > {hi})"
        t = PR.type_of(c)
        val = f"CAST({c} AS VARCHAR)" if t != "double" else f"CAST({c} AS VARCHAR)"
        parts.append(f"SELECT l_orderkey, l_linenumber AS line, '{c}' AS \"column\", {val} AS value, "
                     f"CASE WHEN {c} IS NULL THEN 'missing' ELSE 'out_of_domain' END AS reason "
                     f"FROM typed WHERE {c} IS NULL OR {bad}")
    return _sql("\nUNION ALL\n".join(parts), upto="typed")


@register("domain_violations", _domain_sql())
def q_domain_violations(spark, sf):
    """Rule table -> one row per missing or out-of-domain value, single pass."""
    df = typed(spark, sf).withColumn("line", F.col("l_linenumber"))
    return X.domain_violations(df, LINEITEM_DOMAINS, ["l_orderkey", "line"])


DECODE_MAPS = {"l_returnflag": {"A": "accepted", "N": "none", "R": "returned"},
               "l_linestatus": {"O": "open", "F": "fulfilled"}}


def _decode_sql():
    exprs = []
    for c, m in DECODE_MAPS.items():
        whens = " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in m.items())
        exprs.append(f"CASE {whens} ELSE 'unknown' END AS {c}_text")
    return _sql(f"SELECT l_orderkey, l_linenumber AS line, l_returnflag, l_linestatus, {', '.join(exprs)} "
                "FROM typed", upto="typed")


@register("decode_codes", _decode_sql())
def q_decode_codes(spark, sf):
    """Code -> text through literal maps."""
    df = typed(spark, sf).select("l_orderkey", F.col("l_linenumber").alias("line"), "l_returnflag", "l_linestatus")
    return X.decode_codes(df, DECODE_MAPS, default="unknown")


# ------------------------------------------------------------ A1: row counts at each stage of the job
def _row_counts_sql():
    ex = dict(SPLIT)
    body = " UNION ALL ".join([
        "SELECT 'raw' AS stage, CAST(count(*) AS BIGINT) AS \"rows\" FROM raw",
        "SELECT 'typed', CAST(count(*) AS BIGINT) FROM typed",
        "SELECT 'cleaned', CAST(count(*) AS BIGINT) FROM clean",
        "SELECT 'train', CAST(count(*) AS BIGINT) FROM train",
        "SELECT 'test', CAST(count(*) AS BIGINT) FROM test"])
    return _sql(body, extra=ex)


@register("row_counts", _row_counts_sql())
def q_row_counts(spark, sf):
    """A1: rows after each stage (raw, typed, cleaned, train, test) - the counts the original
    notebooks checked by eye, as one table."""
    from ..operators.quality import row_count
    from .catalog_clean import raw
    staged = staged_clean(spark, sf)
    train, test = train_test(spark, sf, staged)
    parts = [(row_count(raw(spark, sf)), "raw"), (row_count(typed(spark, sf)), "typed"),
             (row_count(staged), "cleaned"), (row_count(train), "train"), (row_count(test), "test")]
    out = None
    for df, stage in parts:
        df = df.select(F.lit(stage).alias("stage"), "rows")
        out = df if out is None else out.unionByName(df)
    return out


# ------------------------------------------------------------ T7: exploration assemble + scale
_EXPLORE_DROP = ["l_quantity", "l_discount"]
_EXPLORE_MEAN = ["l_quantity", "l_extendedprice", "l_tax"]


@register("explore_scale", None)
def q_explore_scale(spark, sf):
    """T7 (+F8, I3): any-NULL drop, mean imputation in place, then a second numeric
    assemble + standard scale fitted on all remaining rows."""
    from ..operators import clean as C
    df = C.dropna_any(typed(spark, sf), _EXPLORE_DROP)
    df = C.impute(df, mean=_EXPLORE_MEAN)[0]
    vec = VectorAssembler(inputCols=NUM, outputCol="features").transform(df)
    scaled = StandardScaler(inputCol="features", outputCol="scaled_features").fit(vec).transform(vec)
    return T.vector_columns(scaled.withColumn("line", F.col("l_linenumber")), "scaled_features",
                            [f"{c}_scaled" for c in NUM], ["l_orderkey", "line"])


def _explore_sql():
    from .sql import no_nan
    dropped = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _EXPLORE_DROP)
    exprs = [f"COALESCE({no_nan(c, t)}, (SELECT avg({no_nan(c, t)}) FROM d)) AS {c}" if c in _EXPLORE_MEAN else c
             for c, t in PR.columns]
    ex = {"d": f"SELECT * FROM typed WHERE {dropped}", "m": "SELECT " + ", ".join(exprs) + " FROM d"}
    ex["sd"] = "SELECT " + ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in NUM) + " FROM m"
    parts = [f"round(CASE WHEN (SELECT sd_{c} FROM sd) = 0 THEN CAST(0 AS DOUBLE) ELSE {c} / (SELECT sd_{c} FROM sd) "
             f"END, 6) AS {c}_scaled" for c in NUM]
    return _sql(f"SELECT l_orderkey, l_linenumber AS line, {', '.join(parts)} FROM m", upto="typed", extra=ex)


_ORACLE["explore_scale"] = _explore_sql()
