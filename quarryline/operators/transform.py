"""Feature transformers: fitted on the train rows, applied anywhere.

Fitting is one aggregate over all numeric columns (plus a rank lookup for medians, a count per
value for modes, and the MLlib fits). The fitted steps form a ``PipelineModel`` of JVM-side stages,
so scoring is a projection and the model can be saved and loaded.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    PCA,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.scalars import MISSING, fill_missing
from quarryline.operators.edit import non_numeric_columns, numeric_columns
from quarryline.operators.ordered import exact_quantiles
from quarryline.operators.profile import most_frequent, value_counts
from quarryline.operators.steps import NamedStep
from quarryline.session import stored

# fixed values: the order of the savings levels
SAVINGS_LEVELS = ("no known savings", "<100", "100<=X<500", "500<=X<1000", ">=1000")

MEAN = "SimpleImputer()"
MEDIAN = "SimpleImputer(strategy='median')"
MODE = "SimpleImputer(strategy='most_frequent')"
STANDARD = "StandardScaler()"
MIN_MAX = "MinMaxScaler()"
PCA_MLE = "PCA(n_components='mle')"
ONE_HOT = "OneHotEncoder(handle_unknown='ignore')"
SAVINGS_ORDER = "SavingsStatusEncoder()"
LEARNED_ORDER = "CustomOrdinalEncoder()"
NONE = "None"


# --- numeric columns: impute, then scale -------------------------------------------------------


@dataclass(frozen=True)
class NumericFit:
    """Per column: the value for missing entries, and x -> (x - centre) / scale afterwards."""

    column: str
    fill: float | None = None
    centre: float = 0.0
    scale: float = 1.0

    def sql(self) -> str:
        x = f"CAST(`{self.column}` AS DOUBLE)"
        x = f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"
        if self.fill is not None:
            x = f"coalesce({x}, {_double(self.fill)})"
        if self.scale == 0.0:  # a constant column
            return f"CASE WHEN ({x}) IS NOT NULL THEN 0D END"
        if self.centre or self.scale != 1.0:
            x = f"(({x}) - {_double(self.centre)}) / {_double(self.scale)}"
        return x

    def column_expression(self) -> Column:
        return F.expr(self.sql())


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


class Once:
    """What several feature pipelines over the same train rows need is found by the first of them."""

    def __init__(self):
        self._lock, self._locks, self._found = threading.Lock(), {}, {}

    def get(self, name: Hashable, find: Callable):
        with self._lock:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._found:
                self._found[name] = find()
            return self._found[name]


def fit_numeric(
    df: DataFrame, columns: Sequence[str], imputer: str = MEAN, scaler: str = NONE, once: Once | None = None
) -> list[NumericFit]:
    """Fill values and scaling of the imputed columns, from one pass over the train rows; medians and
    modes take more, over their written columns."""
    columns, once = list(columns), once or Once()
    if not columns:
        return []
    if imputer in (MEDIAN, MODE):  # more than one pass: compute the input once
        df = once.get("numbers", lambda: stored(df.select(*columns), "numbers"))
    fills = once.get(("fills", imputer), lambda: _fills(df, columns, imputer))
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggregates += [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.var_pop(x).alias(f"var_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    seen = once.get("moments", lambda: df.agg(*aggregates).first())
    fits = []
    for i, c in enumerate(columns):
        count, n = seen[f"count_{i}"], seen["n"]
        mean = seen[f"mean_{i}"] if count else 0.0
        fill = None
        if imputer != NONE:
            fill = mean if imputer == MEAN else fills.get(c)
            fill = 0.0 if fill is None else float(fill)
        centre, scale = 0.0, 1.0
        blanks = n - count if fill is not None else 0
        if scaler == STANDARD and count + blanks:
            total = count + blanks
            whole_mean = (mean * count + (fill or 0.0) * blanks) / total
            spread = count * ((seen[f"var_{i}"] or 0.0) + (mean - whole_mean) ** 2)
            spread += blanks * ((fill or 0.0) - whole_mean) ** 2
            centre, scale = whole_mean, math.sqrt(spread / total)
        elif scaler == MIN_MAX and count + blanks:
            ends = [seen[f"min_{i}"], seen[f"max_{i}"]] if count else []
            ends += [fill] if blanks else []
            centre, scale = min(ends), max(ends) - min(ends)
        elif scaler not in (NONE, STANDARD, MIN_MAX):
            raise ValueError(f"unknown scaler {scaler!r}")
        fits.append(NumericFit(c, fill, centre, scale))
    return fits


def _fills(df: DataFrame, columns: list[str], imputer: str) -> dict[str, float | None]:
    if imputer in (NONE, MEAN):
        return {}
    if imputer == MEDIAN:
        clean = df.select(
            *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns]
        )
        return {c: q[0] for c, q in exact_quantiles(clean, columns, [0.5]).items()}
    if imputer == MODE:
        counts = value_counts(df, columns, "double").filter("NOT isnan(value) OR value IS NULL")
        modes = counts.groupBy("column").agg(most_frequent(counts).alias("value"))
        return {line["column"]: line["value"] for line in modes.collect()}  # one per column
    raise ValueError(f"unknown imputer {imputer!r}")


def apply_numeric(df: DataFrame, fits: Sequence[NumericFit]) -> DataFrame:
    return df.withColumns({fit.column: fit.column_expression() for fit in fits})


# --- categories --------------------------------------------------------------------------------


def savings_code(savings: Column) -> Column:
    """Position of the level in its fixed order; an unknown level is an error."""
    code = F.when(F.lit(False), F.lit(0.0))
    for i, level in enumerate(SAVINGS_LEVELS):
        code = code.when(savings == level, F.lit(float(i)))
    problem = F.concat(F.lit("unknown savings status: "), F.coalesce(savings, F.lit("NULL")))
    return code.otherwise(F.raise_error(problem).cast("double"))


def _savings_code_sql(column: str) -> str:
    levels = " ".join(
        f"WHEN `{column}` = '{level}' THEN {i}D" for i, level in enumerate(SAVINGS_LEVELS)
    )
    return (
        f"CASE {levels} ELSE CAST(raise_error(concat('unknown savings status: ', "
        f"coalesce(`{column}`, 'NULL'))) AS DOUBLE) END"
    )


def _indexer(columns: Sequence[str], outputs: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=list(outputs),
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )


def _as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fill_missing(F.col(c).cast("string")) for c in columns})


def fit_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, level, code): the levels of each category with their place in sorted order from 0,
    the missing one included when train rows lack a value.

    The levels stay a table, as many as they are: they are dealt to ranges, numbered there, and the
    sizes of the ranges before are added.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = value_counts(_as_text(df.select(*columns), columns), columns)
    levels = found.select("column", F.col("value").alias("level"))
    dealt = levels.repartitionByRange(parts, "column", "level")
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "levels")
    inside = Window.partitionBy("column", "part").orderBy("level")
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("column", "part")
        .count()
        .select("column", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    code = F.col("first") + F.row_number().over(inside) - 1
    numbered = dealt.join(firsts, ["column", "part"])
    return stored(numbered.select("column", "level", code.cast("double").alias("code")), "codes")


def ordinal_encode(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each category as the code of its level; -1 for a level not seen in train."""
    for c in columns:
        known = levels.filter(F.col("column") == c).select(
            F.col("level").alias("_level"), F.col("code").alias("_code")
        )
        coded = df.join(known, fill_missing(F.col(c).cast("string")) == F.col("_level"), "left")
        df = coded.withColumn(c, F.coalesce("_code", F.lit(-1.0))).drop("_level", "_code")
    return df


def one_hot_long(
    df: DataFrame, key: str, levels: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """One row (key, feature, 1.0) per category value known from train; an unseen one has none."""
    entries = [
        F.struct(F.lit(c).alias("column"), fill_missing(F.col(c).cast("string")).alias("level"))
        for c in columns
    ]
    return (
        df.select(key, F.inline(F.array(*entries)))
        .join(levels.select("column", "level"), ["column", "level"])
        .select(key, F.concat_ws("_", "column", "level").alias("feature"), F.lit(1.0).alias("value"))
    )


# --- PCA ---------------------------------------------------------------------------------------


def covariance_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population covariances of all column pairs, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = df.agg(*[F.covar_pop(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    lines = F.array(
        *[
            F.struct(
                F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"c{k}").alias("cov")
            )
            for k, (a, b) in enumerate(pairs)
        ]
    )
    return cells.select(F.inline(lines))


def mle_dimension(eigenvalues: Sequence[float], n: int) -> int:
    """Number of components with the largest Bayesian evidence (Minka 2000)."""
    lam = np.sort(np.asarray(eigenvalues, dtype=float))[::-1]
    floor = max(lam[0], 0.0) * 1e-12 if len(lam) else 0.0
    lam = lam[lam > floor]  # a direction without variance adds no evidence
    d = len(lam)
    if d <= 1:
        return max(d, 1)
    best, best_evidence = 1, -math.inf
    for k in range(1, d):
        noise = float(lam[k:].mean())
        head, tail = lam[:k], lam[k:]
        log_pu = -k * math.log(2) + sum(
            math.lgamma((d - i) / 2) - (d - i) / 2 * math.log(math.pi) for i in range(k)
        )
        smoothed = np.concatenate([head, np.full(len(tail), noise)])
        log_az = 0.0
        for i in range(k):
            gaps = (1 / smoothed[i + 1 :] - 1 / lam[i]) * (lam[i] - lam[i + 1 :])
            log_az += float(np.log(np.maximum(gaps, 1e-300)).sum()) + (d - i - 1) * math.log(n)
        m = d * k - k * (k + 1) / 2
        evidence = (
            log_pu
            - n / 2 * float(np.log(head).sum())
            - n * (d - k) / 2 * math.log(noise)
            + (m + k) / 2 * math.log(2 * math.pi)
            - log_az / 2
            - k / 2 * math.log(n)
        )
        if evidence > best_evidence:
            best, best_evidence = k, evidence
    return best


def fit_pca(df: DataFrame, vector: str, output: str) -> list[Transformer]:
    """Principal components with the dimension chosen by evidence: [PCA on all, first k]."""
    seen = df.agg(Summarizer.metrics("count", "variance").summary(F.col(vector)).alias("s")).first()
    n, variances = seen["s"]["count"], seen["s"]["variance"].toArray()
    full = PCA(k=len(variances), inputCol=vector, outputCol=f"{output}_all").fit(df)
    total = float(variances.sum())
    k = mle_dimension([share * total for share in full.explainedVariance.toArray()], n)
    first = VectorSlicer(inputCol=f"{output}_all", outputCol=output, indices=list(range(k)))
    return [full, first]


# --- user functions ----------------------------------------------------------------------------


@dataclass
class FunctionStep:
    """A user function over a table as a pipeline step, with a function for its output names."""

    function: Callable[[DataFrame], DataFrame]
    names: Callable[[list[str]], list[str]] | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return df.transform(self.function)

    def feature_names(self, inputs: Sequence[str]) -> list[str]:
        return self.names(list(inputs)) if self.names else list(inputs)


def choose(df: DataFrame, fit: Callable[[DataFrame], Transformer] | None) -> DataFrame:
    """A swappable step: the fitted transformer's output, or the input as it is for None."""
    return df if fit is None else fit(df).transform(df)


# --- the whole feature pipeline ----------------------------------------------------------------


@dataclass(frozen=True)
class Prep:
    """Settings of the feature pipeline; trials that share them share the fitted features."""

    imputer: str = MEAN
    scaler: str = NONE
    pca: str = NONE
    savings: str = ONE_HOT
    encoder: str = ONE_HOT


@dataclass(frozen=True)
class Columns:
    """Column groups of a table, found by type."""

    numeric: tuple[str, ...]
    categories: tuple[str, ...]
    savings: str | None = None
    drop: tuple[str, ...] = field(default=())

    @staticmethod
    def of(df: DataFrame, leave_out: Sequence[str], savings: str = "savings_status") -> Columns:
        numeric = tuple(c for c in numeric_columns(df) if c not in leave_out)
        rest = tuple(non_numeric_columns(df, leave_out=[*leave_out, savings]))
        return Columns(numeric, rest, savings if savings in df.columns else None)


def fit_features(
    train: DataFrame, columns: Columns, prep: Prep, steps: Sequence[NamedStep] = (), once: Once | None = None
) -> PipelineModel:
    """Numeric, category and savings groups side by side, assembled into ``features``.

    ``steps`` come first, one after another. What they add are numeric columns, which take the place
    of the numeric ones that the step reads. Calls with the same train rows, columns and steps may share ``once``.
    """
    once = once or Once()
    numbers = list(columns.numeric)
    stages: list[Transformer] = []
    for step in steps:
        stages.append(step)
        train = step.transform(train)
        numbers = [c for c in numbers if c not in step.reads()]
        numbers += [c for c in step.outputs() if c not in numbers]
    if not (numbers or columns.categories or columns.savings):
        raise ValueError("the table has no feature columns")
    fits = fit_numeric(train, numbers, prep.imputer, prep.scaler, once)
    numeric = (prep.imputer, prep.scaler)
    numeric_outputs = [f"numeric__{fit.column}" for fit in fits]
    centred = fits
    if prep.pca != NONE and len(fits) > 1:
        means = once.get(("means", numeric), lambda: _means(train, fits))
        centred = [_centred(fit, mean) for fit, mean in zip(fits, means)]
    selected = [f"{fit.sql()} AS `numeric__{fit.column}`" for fit in centred]

    one_hot = {c: f"non_numeric__{c}" for c in columns.categories if prep.encoder == ONE_HOT}
    ordinal = {c: f"non_numeric__{c}" for c in columns.categories if prep.encoder == LEARNED_ORDER}
    savings_output = f"savings_status__{columns.savings}"
    if columns.savings and prep.savings == ONE_HOT:
        one_hot[columns.savings] = savings_output
    elif columns.savings:
        selected.append(f"{_savings_code_sql(columns.savings)} AS `{savings_output}`")
    text = {c: f"_text_{c}" for c in (*one_hot, *ordinal)}
    selected += [
        f"coalesce(CAST(`{c}` AS STRING), '{MISSING}') AS `{t}`" for c, t in text.items()
    ]
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(selected)} FROM __THIS__"))
    current = stages[-1].transform(train)

    def add(stage: Transformer) -> None:
        nonlocal current
        stages.append(stage)
        current = stage.transform(current)

    groups: list[str] = []
    if numeric_outputs and centred is not fits:
        add(VectorAssembler(inputCols=numeric_outputs, outputCol="_numeric"))
        for stage in once.get(("pca", numeric), lambda: fit_pca(current, "_numeric", "numeric__pca")):
            add(stage)
        groups.append("numeric__pca")
    else:
        groups += numeric_outputs
    if text:
        codes = {c: f"_code_{c}" for c in text}
        indexer = _indexer(list(text.values()), list(codes.values()))
        add(once.get(("levels", *text), lambda: indexer.fit(current)))
        levels = dict(zip(text, stages[-1].labelsArray))
        if one_hot:
            add(
                OneHotEncoder(
                    inputCols=[codes[c] for c in one_hot],
                    outputCols=list(one_hot.values()),
                    dropLast=True,
                ).fit(current)
            )
        if ordinal:
            known = ", ".join(
                f"CASE WHEN `{codes[c]}` = {len(levels[c])} THEN -1D ELSE `{codes[c]}` END "
                f"AS `{output}`"
                for c, output in ordinal.items()
            )
            add(SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__"))
    groups += [f"non_numeric__{c}" for c in columns.categories]
    if columns.savings:
        groups.append(savings_output)
    add(VectorAssembler(inputCols=groups, outputCol="features"))
    return PipelineModel(stages)


def _means(train: DataFrame, fits: Sequence[NumericFit]) -> list[float]:
    means = train.agg(
        *[F.avg(fit.column_expression()).alias(f"m{i}") for i, fit in enumerate(fits)]
    ).first()
    return [means[i] or 0.0 for i in range(len(fits))]


def _centred(fit: NumericFit, mean: float) -> NumericFit:
    """The same fit shifted so that the train mean is 0."""
    if fit.scale == 0.0:
        return fit
    return NumericFit(fit.column, fit.fill, fit.centre + mean * fit.scale, fit.scale)


def feature_names(transformed: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector entries, in order, from the column's ML attributes."""
    attributes = transformed.schema[vector].metadata["ml_attr"]
    groups = attributes.get("attrs", {})
    named = {a["idx"]: a.get("name") for group in groups.values() for a in group}
    return [named.get(i) or f"feature_{i}" for i in range(attributes["num_attrs"])]
