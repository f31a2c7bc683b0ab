"""Feature transformers.

Categorical indexing is a *label table* - DataFrame(column, value, count,
index) - instead of an in-driver label array: counts come from one
aggregation over all categorical columns (partial aggregation absorbs hot
values), positions from a distributed sort (no single-partition window). The
index is applied heavy-light: the most frequent values of a column are a literal
map in the projection and never move; only other rows look their value up, in a
broadcast table of checked size, or beyond that size through a shuffle join that
the heavy rows pass under salted keys. Ordering equals
``StringIndexer(stringOrderType="frequencyDesc")``: most frequent first,
ties by text ascending, values indexed as text.

Numeric assembly, scaling and one-hot use the MLlib stages, so the fitted
feature model saves and loads with ML persistence and scores streams.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import global_position
from ..profile import Profile

POLICIES = ("skip", "keep", "error")
HEAVY = 64               # values of a column kept as a literal map
BROADCAST_LABELS = 200_000  # further values of a column that are broadcast: a few MB
SALTS = 1024


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, count) for every non-NULL value of every column, one aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    stacked = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    return stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


@dataclass
class LabelIndex:
    labels: DataFrame            # column, value, count, index (double)
    arity: dict[str, int]
    _heavy: dict[str, dict[str, float]] | None = None

    def heavy(self) -> dict[str, dict[str, float]]:
        """The HEAVY most frequent values of each column: a bounded number of rows, read once."""
        if self._heavy is None:
            self._heavy = {c: {} for c in self.arity}
            for r in self.labels.filter(F.col("index") < HEAVY).select("column", "value", "index").collect():
                self._heavy.setdefault(r["column"], {})[r["value"]] = r["index"]
        return self._heavy

    def light(self, col: str) -> DataFrame | None:
        """The other values of a column, if it has any."""
        return self.table(col).filter(F.col("index") >= HEAVY) if self.arity.get(col, 0) > HEAVY else None

    def table(self, col: str) -> DataFrame:
        return self.labels.filter(F.col("column") == F.lit(col)).select("value", "index")


def fit_label_index(df: DataFrame, cols: list[str]) -> LabelIndex:
    """T1/T2 fit: frequency-descending index per column, ties by text.

    The (column, value, count) table is one aggregation; its distributed
    positions are the ranks, so no task ever sorts a whole column. The sorted
    table is checkpointed and is the model: its lineage ends there.
    """
    ordered = global_position(category_counts(df, cols), [F.col("column"), F.desc("count"), F.asc("value")], "pos")
    # one row per categorical column: bounded, safe to collect
    spans = {r["column"]: (r["start"], int(r["n"])) for r in ordered.groupBy("column").agg(
        F.min("pos").alias("start"), F.count(F.lit(1)).alias("n")).collect()}
    start = F.lit(0).cast("bigint")
    for c, (first, _) in spans.items():
        start = F.when(F.col("column") == F.lit(c), F.lit(first)).otherwise(start)
    labels = ordered.select("column", "value", "count", (F.col("pos") - start).cast("double").alias("index"))
    return LabelIndex(labels, {c: spans.get(c, (0, 0))[1] for c in cols})


def nominal(col: str | Column, name: str, num_vals: int):
    """Attach ML nominal metadata so tree learners split the index as a category."""
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(num_vals), "name": name}}
    return (F.col(col) if isinstance(col, str) else col).alias(name, metadata=meta)


def digits(arity: int, bins: int) -> list[tuple[int, int]]:
    """(stride, categories) of the digits that tell ``arity`` categories apart with at most ``bins``
    categories a digit: one, the index itself, if it fits, else groups of adjacent indexes, then the place in
    the group. A digit is the quotient by its stride; the remainder goes to the next."""
    if bins < 2:
        raise ValueError(f"at least 2 bins are needed, not {bins}")
    out, span = [], max(arity, 1)
    while span > bins:
        stride = -(-span // bins)
        out.append((stride, -(-span // stride)))
        span = stride
    return out + [(1, span)]


def look_up(df: DataFrame, index: LabelIndex, col: str, out: str) -> DataFrame:
    """``df`` with ``out``: the index of ``col``'s value, null for a NULL or unseen one."""
    text, heavy, light = F.col(col).cast("string"), index.heavy().get(col, {}), index.light(col)
    known = F.create_map(*[F.lit(x) for kv in heavy.items() for x in kv])[text] if heavy else F.lit(None).cast("double")
    if light is None:
        return df.withColumn(out, known)
    k, v, h = (f"_{n}_{col}" for n in ("k", "v", "h"))
    df = df.withColumn(h, known)
    if index.arity[col] <= BROADCAST_LABELS:
        lab = F.broadcast(light.select(F.col("value").alias(k), F.col("index").alias(v)))
        met = df.withColumn(k, F.when(F.col(h).isNull(), text)).join(lab, k, "left")
    else:
        # heavy and NULL rows meet nothing: their keys only spread them over the tasks
        spread = F.concat(F.lit("s"), F.pmod(F.xxhash64(*[c for c in df.columns if c != h]), F.lit(SALTS)).cast("string"))
        moved = df.withColumn(k, F.when(F.col(h).isNull() & text.isNotNull(), F.concat(F.lit("v"), text)).otherwise(spread))
        met = moved.join(light.select(F.concat(F.lit("v"), "value").alias(k), F.col("index").alias(v)), k, "left")
    return met.withColumn(out, F.coalesce(F.col(h), F.col(v))).drop(k, v, h)


def apply_label_index(df: DataFrame, index: LabelIndex, cols: list[str], policy: str = "skip",
                      suffix: str = "_index", attach_metadata: bool = True, rank_encoded=()) -> DataFrame:
    """T1/T2/T10 apply: one lookup per column; ``rank_encoded`` columns carry no nominal metadata.

    ``skip`` drops rows with a NULL or unseen value in any column (the
    original behaviour), ``keep`` gives them the extra index ``arity``,
    ``error`` fails the job on the first such row.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    for c in cols:
        out_col = c + suffix
        df = look_up(df, index, c, out_col)
        found = F.col(out_col)
        if policy == "keep":
            df = df.withColumn(out_col, F.coalesce(found, F.lit(float(index.arity[c]))))
        elif policy == "error":
            df = df.withColumn(out_col, F.when(found.isNull(), F.raise_error(
                F.concat(F.lit(f"unseen or NULL category in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
            )).otherwise(found).cast("double"))
        arity = index.arity[c] + (1 if policy == "keep" else 0)
        if attach_metadata and c not in rank_encoded:
            df = df.withColumn(out_col, nominal(out_col, out_col, max(arity, 1)))
    # One test of all columns above the lookups: a filter a column would be pushed below them, each with a copy of its
    # column's whole expression, and the scan's generated method would outgrow what the JVM compiles.
    return df.dropna(how="any", subset=[c + suffix for c in cols]) if policy == "skip" else df


def unseen_report(df: DataFrame, index: LabelIndex, cols: list[str]) -> DataFrame:
    """Rows that ``skip`` would drop, per column and in total (column ``*``)."""
    kept = apply_label_index(df, index, cols, policy="keep", suffix="_idx", attach_metadata=False)
    flags = {c: F.col(c + "_idx") == F.lit(float(index.arity[c])) for c in cols}
    any_flag = None
    for f in flags.values():
        any_flag = f if any_flag is None else (any_flag | f)
    aggs = [F.count_if(f).alias(c) for c, f in flags.items()] + [F.count_if(any_flag).alias("*")]
    wide = kept.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("rows_lost"))
                     for c in list(cols) + ["*"]])
    return wide.select(F.inline(rows))


def unseen_flagged(df: DataFrame, index: LabelIndex, cols: list[str], flag: str = "rejected") -> DataFrame:
    """All rows, in one pass, with whether the ``skip`` policy would drop them."""
    kept = apply_label_index(df, index, cols, policy="keep", suffix="_idx", attach_metadata=False)
    out = F.lit(False)
    for c in cols:
        out = out | (F.col(c + "_idx") == F.lit(float(index.arity[c])))
    return kept.withColumn(flag, out).drop(*[c + "_idx" for c in cols])


def check_one_hot_columns(index: LabelIndex, cols: list[str]) -> list[str]:
    """T3 limit: a column with a single category cannot be one-hot encoded with dropLast."""
    return [c for c in cols if index.arity[c] < 2]


def vector_columns(df: DataFrame, vec: str, names: list[str], keep: list[str], digits: int | None = 6) -> DataFrame:
    """Expand a vector into named double columns (slot-wise comparison)."""
    arr = vector_to_array(F.col(vec))
    outs = []
    for i, n in enumerate(names):
        v = arr[i]
        outs.append((F.round(v, digits) if digits is not None else v).alias(n))
    return df.select(*keep, *outs)


@dataclass
class FeatureModel:
    profile_name: str
    low_card: list[str]
    high_card: list[str]
    numeric: list[str]
    index: LabelIndex
    stages: PipelineModel
    policy: str = "skip"
    rank_encoded: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)
    tree_bins: int | None = None   # categories that trees see in one slot at most; None: all of a column's

    @property
    def categorical(self) -> list[str]:
        return self.low_card + self.high_card

    def nominal_columns(self) -> list[str]:
        """Columns that trees see as categories: declared, whatever the data's size."""
        return [c for c in self.categorical if c not in self.rank_encoded]

    def tree_digits(self, col: str) -> list[tuple[int, int]]:
        """How trees see a nominal column: its index, or with more categories than ``tree_bins`` its digits.
        Every category has digits of its own."""
        n = self.index.arity[col] + (1 if self.policy == "keep" else 0)
        return digits(n, self.tree_bins if self.tree_bins and col in self.high_card else max(n, 2))

    def wide_columns(self) -> list[str]:
        """Nominal columns that trees see as several digits."""
        return [c for c in self.high_card if c not in self.rank_encoded and len(self.tree_digits(c)) > 1]

    @property
    def tree_col(self) -> str:
        """The vector column for trees; linear learners take ``features``, where a column is one slot."""
        return "tree_features" if self.wide_columns() else "features"

    def tree_width(self) -> int:
        """Slots of ``tree_col``."""
        return len(self.feature_names()) + sum(len(self.tree_digits(c)) - 1 for c in self.wide_columns())

    def check_bins(self, max_bins: int) -> int:
        """``max_bins`` if it holds the categories of every nominal column, or of its widest digit, else an error naming the columns."""
        most = {c: max(n for _, n in self.tree_digits(c)) for c in self.nominal_columns()}
        over = {c: n for c, n in most.items() if n > max_bins}
        if over:
            raise ValueError(f"maxBins {max_bins} is below the number of categories of {over}: raise it, or declare them rank_encoded")
        return max_bins

    def feature_names(self) -> list[str]:
        names = [f"{c}_scaled" for c in self.numeric]
        for c in self.low_card:
            width = self.index.arity[c] + (1 if self.policy == "keep" else 0) - 1
            names += [f"{c}_ohe_{j}" for j in range(width)]
        names += [f"{c}_index" for c in self.high_card]
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        return self._vectors(apply_label_index(df, self.index, self.categorical, self.policy, rank_encoded=self.rank_encoded))

    def _vectors(self, indexed: DataFrame) -> DataFrame:
        """``features``, and ``tree_features`` where a nominal column needs digits: the same slots with the digits in its place."""
        out, wide = self.stages.transform(indexed), self.wide_columns()
        if not wide:
            return out
        slots = []
        for c in self.high_card:
            if c not in wide:
                slots.append(c + "_index")
                continue
            left = F.col(c + "_index").cast("bigint")
            for i, (stride, n) in enumerate(self.tree_digits(c)):
                name = f"{c}_digit_{i}"
                out = out.withColumn(name, nominal(F.floor(left / F.lit(stride)).cast("double"), name, n))
                left = left % F.lit(stride)
                slots.append(name)
        parts = ["num_scaled_vector", *[c + "_OHE" for c in self.low_card], *slots]
        return VectorAssembler(inputCols=parts, outputCol=self.tree_col).transform(out)

    def transform_flagged(self, df: DataFrame, flag: str = "rejected") -> DataFrame:
        """All rows of ``df``: ``flag`` marks those with a NULL or unseen category, whose features stand at index 0."""
        seen = apply_label_index(df, self.index, self.categorical, "keep", attach_metadata=False)
        unseen = F.lit(False)
        for c in self.categorical:
            unseen = unseen | (F.col(c + "_index") == F.lit(float(self.index.arity[c])))
        seen = seen.withColumn(flag, unseen)
        for c in self.categorical:
            i = c + "_index"
            known = F.when(F.col(i) == F.lit(float(self.index.arity[c])), F.lit(0.0)).otherwise(F.col(i))
            seen = seen.withColumn(i, known if c in self.rank_encoded else nominal(known, i, max(self.index.arity[c], 1)))
        return self._vectors(seen)

    def save(self, path: str) -> None:
        self.index.labels.write.mode("overwrite").parquet(f"{path}/labels")
        self.stages.write().overwrite().save(f"{path}/stages")
        meta = {"profile": self.profile_name, "low_card": self.low_card, "high_card": self.high_card,
                "numeric": self.numeric, "arity": self.index.arity, "policy": self.policy,
                "rank_encoded": list(self.rank_encoded), "tree_bins": self.tree_bins}
        spark = self.index.labels.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> FeatureModel:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        labels = spark.read.parquet(f"{path}/labels")
        return cls(meta["profile"], meta["low_card"], meta["high_card"], meta["numeric"],
                   LabelIndex(labels, {k: int(v) for k, v in meta["arity"].items()}),
                   PipelineModel.load(f"{path}/stages"), meta["policy"], tuple(meta["rank_encoded"]), tree_bins=meta.get("tree_bins"))


class FeatureBuilder:
    """Index (label tables) -> one-hot -> numeric assemble -> scale -> final assemble."""

    def __init__(self, profile: Profile | None = None, low_card=None, high_card=None, numeric=None,
                 policy: str = "skip", features_col: str = "features", rank_encoded=None, tree_bins: int | None = None):
        self.profile_name = profile.name if profile else "custom"
        self.low_card = list(low_card if low_card is not None else profile.low_card)
        self.high_card = list(high_card if high_card is not None else profile.high_card)
        self.numeric = list(numeric if numeric is not None else profile.numeric)
        self.policy = policy
        self.features_col = features_col
        self.rank_encoded = tuple(rank_encoded if rank_encoded is not None else profile.rank_encoded if profile else ())
        self.tree_bins = tree_bins if tree_bins is not None else profile.tree_bins if profile else None

    def fit(self, train: DataFrame) -> FeatureModel:
        index = fit_label_index(train, self.low_card + self.high_card)
        single = check_one_hot_columns(index, self.low_card)
        if single:
            raise ValueError(f"columns with one category cannot be one-hot encoded: {single}")
        cats = self.low_card + self.high_card
        extra = 1 if self.policy == "keep" else 0
        # On the side that fitted the index, only NULL categories are unseen; the encoder reads its
        # widths from metadata and the scaler the numeric columns alone, so no index is joined here.
        kept = train if self.policy == "keep" else train.dropna(how="any", subset=cats)
        indexed = kept.select(*self.numeric, *[nominal(F.lit(0.0), c + "_index", max(index.arity[c] + extra, 1)) for c in cats])
        low_idx = [c + "_index" for c in self.low_card]
        low_ohe = [c + "_OHE" for c in self.low_card]
        stages = [
            OneHotEncoder(inputCols=low_idx, outputCols=low_ohe, dropLast=True),
            VectorAssembler(inputCols=self.numeric, outputCol="num_vector"),
            StandardScaler(inputCol="num_vector", outputCol="num_scaled_vector", withMean=False, withStd=True),
            VectorAssembler(inputCols=["num_scaled_vector"] + low_ohe + [c + "_index" for c in self.high_card],
                            outputCol=self.features_col),
        ]
        model = Pipeline(stages=stages).fit(indexed)
        return FeatureModel(self.profile_name, self.low_card, self.high_card, self.numeric, index, model,
                            self.policy, self.rank_encoded, tree_bins=self.tree_bins)


def hashed_features(df: DataFrame, categorical: list[str], numeric: list[str] = (), num_features: int = 1 << 18,
                    out: str = "features") -> DataFrame:
    """The hashing alternative for very high-cardinality columns (no fit, no table)."""
    return FeatureHasher(inputCols=[*categorical, *numeric], outputCol=out, numFeatures=num_features,
                         categoricalCols=list(categorical)).transform(df)
