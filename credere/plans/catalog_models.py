"""Registered queries for trainers, tuning and scoring jobs.

Predictions of most fits depend on MLlib's numeric optimisers and have no SQL twin;
the driver checks their row counts and schemas. Naive Bayes has a closed form, and the
scoring jobs run a second time with given weights: those have twins. Every fit is seeded.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import functions as F

from ..operators import features as T
from ..operators import score as X
from ..operators import train as M
from ..operators.evaluate import metric_bundle
from ..operators.tracking import Tracker
from ..profile import LINEITEM as PR
from ..session import scratch_path
from ..sources.delimited import stage_table
from ..sources.tables import balanced, dirty_lineitem_columns, evenly_read, path_bytes, table, table_path
from ..streaming.score_stream import score_stream
from .catalog_clean import EXACT
from .catalog_features import SPLIT, _feature_ctes, _lab_sql, _slot_names, _slots_sql, _sql, staged_clean, train_test
from .cleaning import clean_table, row_filters, typed_table
from .job import DEFAULT_GRID
from .registry import register

KEEP = ["l_orderkey", "l_linenumber", "label"]
STREAM_FILE = 128 << 20   # bytes of a Parquet table in one file of a stream
STREAM_GROUP = 8 << 20    # bytes of a row group there: a batch's tasks share a file by its row groups


def _features(spark, sf, staged=None, vectors=lambda fm: ["features"], store=True):
    """Fitted feature model and the two feature frames, with the vectors that the trainers take. The training frame
    is persisted for the trainers' repeated passes (MEMORY_AND_DISK: lost blocks are recomputed from lineage) if they don't
    ``store`` its rows themselves; callers release it after fitting. The held-out frame is read once and not cached."""
    train, test = train_test(spark, sf, staged)
    fm = T.FeatureBuilder(PR).fit(train)
    cols = KEEP + list(dict.fromkeys(vectors(fm)))
    ftrain = _dealt(spark, sf, fm, fm.transform(train).select(*cols))
    if store:
        ftrain = ftrain.persist(StorageLevel.MEMORY_AND_DISK)
    ftest = fm.transform(test).select(*cols)
    return fm, ftrain, ftest


def _dealt(spark, sf, fm, rows):
    """``rows`` on all cores for the trainers' passes: dealt by key where a few tasks would read most of the table, unless
    a lookup through a shuffle join has dealt them already."""
    if any(n > T.BROADCAST_LABELS for n in fm.index.arity.values()) or evenly_read(table(spark, sf, "lineitem")):
        return rows
    return rows.repartition(spark.sparkContext.defaultParallelism, *KEEP[:2])


def _tree_vector(fm):
    return [fm.tree_col]


def _gbt(fm, **overrides):
    return M.estimator("Gradient Boosting Trees", features_col=fm.tree_col, max_bins=fm.check_bins(PR.tree_bins), n_features=fm.tree_width(), **overrides)


def _fit_query(name):
    def q(spark, sf):
        tree = name in M.TREES
        fm, train, test = _features(spark, sf, vectors=_tree_vector if tree else lambda fm: ["features"], store=name not in M.BLOCKWISE)
        est = M.estimator(name, **({"features_col": fm.tree_col, "max_bins": fm.check_bins(PR.tree_bins), "n_features": fm.tree_width()} if tree else {}))
        model = est.fit(train)
        train.unpersist()
        return M.predict(model, test, KEEP)
    q.__doc__ = f"{name}: fit on the training side, score the held-out side."
    return q


for _key, _name in [("fit_lr", "Logistic Regression"), ("fit_svm", "Support Vector Machine"),
                    ("fit_fm", "Factorization Machine"), ("fit_dt", "Decision Tree"),
                    ("fit_rf", "Random Forest"), ("fit_gbt", "Gradient Boosting Trees")]:
    register(_key)(_fit_query(_name))


def _nb_sql():
    """Multinomial naive Bayes in closed form: class counts and per-slot sums, smoothed by one."""
    names = _slot_names()
    ex = _feature_ctes()
    ex["strain"], ex["stest"] = _slots_sql("itrain"), _slots_sql("itest")
    ex["cls"] = "SELECT label, count(*) AS n, " + ", ".join(f"sum({x}) AS s_{x}" for x in names) + " FROM strain GROUP BY label"
    total = " + ".join(f"s_{x}" for x in names)
    ex["m"] = (f"SELECT label, ln(n + 1.0) - ln((SELECT sum(n) + count(*) FROM cls)) AS pi, "
               + ", ".join(f"ln(s_{x} + 1.0) - ln({total} + {len(names)}.0) AS t_{x}" for x in names) + " FROM cls")
    raw = {i: f"{m}.pi + " + " + ".join(f"x.{n} * {m}.t_{n}" for n in names) for i, m in ((0, "a"), (1, "b"))}
    ex["r"] = f"SELECT x.l_orderkey, x.l_linenumber, x.label, {raw[0]} AS r0, {raw[1]} AS r1 FROM stest x, (SELECT * FROM m WHERE label = 0) a, (SELECT * FROM m WHERE label = 1) b"
    return _sql("SELECT l_orderkey, l_linenumber, label, CAST(CASE WHEN r1 > r0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, round(r1, 4) AS score FROM r", extra=ex)


@register("fit_nb", _nb_sql())
def q_fit_nb(spark, sf):
    """Naive Bayes: fit on the training side, score the held-out side; the score is the log joint of label 1, to 4 digits."""
    fm, train, test = _features(spark, sf)
    model = M.estimator("Naive Bayes").fit(train)
    train.unpersist()
    return M.predict(model, test, KEEP).withColumn("score", F.round("score", 4))


@register("model_sweep")
def q_model_sweep(spark, sf):
    """M8 + R1-R4: all six trainers on one persisted feature pair, each run tracked;
    returns the run_metrics table (run, metric, value)."""
    fm, train, test = _features(spark, sf, vectors=lambda fm: ["features", fm.tree_col])
    tracker = Tracker(spark, scratch_path(spark, "sweep"))
    M.sweep(train, test, label_col="label", max_bins=fm.check_bins(PR.tree_bins), n_features=fm.tree_width(),
            tracker=tracker, experiment="lineitem", keep=KEEP, tree_col=fm.tree_col)
    train.unpersist()
    runs = tracker.runs().select("run_id", "name")
    return tracker.metrics().join(runs, "run_id").select("name", "key", "value")


@register("tune_gbt")
def q_tune_gbt(spark, sf, max_iter: int | None = None):
    """train/validation split tuning of GBT over all 27 points of the original grid, the best
    refitted; (metric, value) of the held-out side. Each point has the estimator's own 20 trees;
    tests alone ask for fewer by ``max_iter``."""
    fm, train, test = _features(spark, sf, vectors=_tree_vector)
    gbt = _gbt(fm, **({} if max_iter is None else {"maxIter": max_iter}))
    tuned = M.tune(gbt, M.param_grid(gbt, DEFAULT_GRID), train, parallelism=4)
    train.unpersist()
    return metric_bundle(M.predict(tuned.bestModel, test, ["label"]))


@register("bulk_score")
def q_bulk_score(spark, sf):
    """X1 + S6/S7: save the feature model and classifier, load both, score the whole cleaned table
    and write the scores as Parquet. The cleaned table is written once, beside them: four passes read it."""
    root = scratch_path(spark, "models")
    staged = stage_table(staged_clean(spark, sf), f"{root}/cleaned")
    fm, train, _ = _features(spark, sf, staged)
    lr = M.estimator("Logistic Regression").fit(train)
    train.unpersist()
    fm.save(f"{root}/features")
    lr.write().overwrite().save(f"{root}/lr")
    fm2 = T.FeatureModel.load(spark, f"{root}/features")
    lr2 = LogisticRegressionModel.load(f"{root}/lr")
    return X.bulk_score(staged, fm2, lr2, KEEP, out_path=f"{root}/scored")


@register("stream_score")
def q_stream_score(spark, sf):
    """The raw lineitem file read as a stream, cleaned with the fitted statistics, featurised
    with the fitted model and scored by GBT; availableNow trigger, checkpointed, Parquet sink."""
    cleaned = clean_table(balanced(table(spark, sf, "lineitem")).transform(dirty_lineitem_columns), PR, relative_error=EXACT)
    fm, train, _ = _features(spark, sf, cleaned.df, _tree_vector)
    gbt = _gbt(fm).fit(train)
    train.unpersist()
    root = scratch_path(spark, "stream")
    gbt.write().overwrite().save(f"{root}/gbt")
    model = GBTClassificationModel.load(f"{root}/gbt")
    impute = cleaned.impute
    schema = table(spark, sf, "lineitem").schema

    def prepare(stream):
        typed = typed_table(dirty_lineitem_columns(stream), PR)
        return row_filters(impute.transform(typed), PR)   # scoring needs no outcome

    score_stream(spark, f"{sf.rstrip('/')}/lineitem.parquet", schema, prepare, fm, model, KEEP[:2],
                 f"{root}/scored", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/scored")


@register("score_rows")
def q_score_rows(spark, sf):
    """X2 in bulk: held-out rows with the label defaulted to 0, scored, rejected rows included."""
    staged = staged_clean(spark, sf)
    fm, train, _ = _features(spark, sf, staged)
    lr = M.estimator("Logistic Regression").fit(train)
    train.unpersist()
    _, test = train_test(spark, sf, staged)
    schema_cols = [c for c in PR.names if c != PR.label_code]
    rows = test.select(*schema_cols, F.lit(None).cast("int").alias("label"))
    rows = rows.withColumn("label", F.coalesce(F.col("label"), F.lit(0)))
    return X.flagged_predictions(rows, fm, lr, KEEP)


# ------------------------------------------------------------ jobs that load a model with given weights
_GIVEN = {**{c: 0.5 / (i + 1) ** 2 for i, c in enumerate(PR.numeric)}, **{f"{c}_index": (-1) ** i * 0.25 / (i + 2) for i, c in enumerate(PR.categorical)}}
_GIVEN_AT = -3.0


def _given_sql(src: str, label: str | None):
    """Every row of ``src``: rejected where a category is NULL or unseen on the training side, else scored."""
    ex = dict(SPLIT)
    ex.update(_lab_sql(PR.categorical))
    joins = "\n".join(f"LEFT JOIN lab j{i} ON j{i}.cname = '{c}' AND j{i}.value = CAST(t.{c} AS VARCHAR)" for i, c in enumerate(PR.categorical))
    terms = [f"CAST(t.{c} AS DOUBLE) * {_GIVEN[c]!r}" for c in PR.numeric] + [f"j{i}.idx * {_GIVEN[c + '_index']!r}" for i, c in enumerate(PR.categorical)]
    bad = " OR ".join(f"j{i}.idx IS NULL" for i in range(len(PR.categorical)))
    ex["g"] = f"SELECT t.*, ({bad}) AS rejected, {_GIVEN_AT!r} + {' + '.join(terms)} AS sc FROM {src} t\n{joins}"
    keep = "l_orderkey, l_linenumber" + (f", {label} AS label" if label else "")
    return _sql(f"SELECT {keep}, rejected, CASE WHEN NOT rejected THEN round(sc, 6) END AS score, "
                "CASE WHEN NOT rejected THEN CAST(CASE WHEN sc > 0 THEN 1 ELSE 0 END AS DOUBLE) END AS prediction FROM g", extra=ex)


def _given_jobs(spark, sf, name):
    """(cleaned, feature model and given classifier, both saved and loaded again, root of the job's files)."""
    clean = clean_table(balanced(table(spark, sf, "lineitem")).transform(dirty_lineitem_columns), PR, relative_error=EXACT)
    train, _ = train_test(spark, sf, clean.df)
    root = scratch_path(spark, name)
    T.FeatureBuilder(PR).fit(train).save(f"{root}/features")
    X.given_linear_model(_GIVEN, _GIVEN_AT).write().overwrite().save(f"{root}/given")
    return clean, T.FeatureModel.load(spark, f"{root}/features"), PipelineModel.load(f"{root}/given"), root


def _told(scored, keep):
    return scored.select(*keep, "rejected", F.round("score", 6).alias("score"), "prediction")


@register("bulk_score_given", _given_sql("clean", "label"))
def q_bulk_score_given(spark, sf):
    """X1 with given weights: feature model and classifier saved, loaded and applied to the whole cleaned table, rejected rows included."""
    clean, fm, model, root = _given_jobs(spark, sf, "given")
    return _told(X.bulk_score(clean.df, fm, model, KEEP, out_path=f"{root}/scored"), KEEP)


@register("score_rows_given", _given_sql("(SELECT * FROM test)", "0"))
def q_score_rows_given(spark, sf):
    """X2 with given weights: held-out rows without an outcome, the label defaulted to 0."""
    clean, fm, model, _ = _given_jobs(spark, sf, "given")
    _, test = train_test(spark, sf, clean.df)
    rows = test.withColumn("label", F.coalesce(F.lit(None).cast("int"), F.lit(0)))
    return _told(X.flagged_predictions(rows, fm, model, KEEP), KEEP)


def stream_files(size: int) -> int:
    """How many files a table of ``size`` bytes is dealt to: three, or more, so that no task writes more than STREAM_FILE bytes of it."""
    return max(3, -(-size // STREAM_FILE))


@register("stream_score_given", _given_sql("clean", None))
def q_stream_score_given(spark, sf):
    """X3 with given weights: the raw table dealt to several files, read as a stream of one file a batch, cleaned with the
    fitted statistics, scored, written; started a second time, it finds nothing new."""
    clean, fm, model, root = _given_jobs(spark, sf, "given")
    lines = table(spark, sf, "lineitem")
    dealt = lines.repartition(stream_files(path_bytes(spark, table_path(sf, "lineitem"))))
    dealt.write.option("parquet.block.size", STREAM_GROUP).parquet(f"{root}/in")

    def prepare(stream):
        return row_filters(clean.impute.transform(typed_table(dirty_lineitem_columns(stream), PR)), PR)

    for _ in range(2):
        score_stream(spark, f"{root}/in", lines.schema, prepare, fm, model, KEEP[:2], f"{root}/scored", f"{root}/checkpoint", max_files_per_trigger=1)
    return _told(spark.read.parquet(f"{root}/scored"), KEEP[:2])


@register("feature_hash")
def q_feature_hash(spark, sf):
    """All categorical columns hashed (no fitted table) beside the numeric ones, feeding logistic regression."""
    train, test = train_test(spark, sf)
    train, test = (df.dropna(subset=list(PR.numeric)) for df in (train, test))
    model = M.estimator("Logistic Regression").fit(T.hashed_features(train, PR.categorical, PR.numeric))
    return M.predict(model, T.hashed_features(test, PR.categorical, PR.numeric), KEEP)
