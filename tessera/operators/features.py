"""Feature pipeline (index -> one-hot -> assemble -> normalise) and F-test selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    UnivariateFeatureSelectorModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import plain_names, present
from tessera.operators.dictionary import label_dictionary
from tessera.operators.moments import collected, comoments
from tessera.session import Scratch, quoted

# --- fixed values: output names that users of the original read by name --------
INDEXED_SUFFIX = "Indexed"
ENCODED_SUFFIX = "Cat"
FEATURES_COL = "features"
NORM_COL = "normFeatures"
SELECTED_COL = "selectedFeatures"
SELECTION_MODES = ("fdr", "fwe")
# ---------------------------------------------------------------------------


def indexer_stage(cols: Sequence[str], handle_invalid: str = "error", order: str = "frequencyDesc") -> StringIndexer:
    """Multi-column StringIndexer: most frequent label -> 0.0, ties alphabetical."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[c + INDEXED_SUFFIX for c in cols],
        handleInvalid=handle_invalid,
        stringOrderType=order,
    )


def encoder_stage(cols: Sequence[str], drop_last: bool = True, handle_invalid: str = "error") -> OneHotEncoder:
    """One-hot of indexed columns: n categories -> n-1 slots (last is all zero)."""
    return OneHotEncoder(
        inputCols=[c + INDEXED_SUFFIX for c in cols],
        outputCols=[c + ENCODED_SUFFIX for c in cols],
        dropLast=drop_last,
        handleInvalid=handle_invalid,
    )


def string_index(df: DataFrame, cols: Sequence[str], handle_invalid: str = "error") -> tuple[DataFrame, object]:
    """Fit and apply the indexer. The fit is one aggregation job; labels go to the model."""
    cols = present(df, cols)
    model = indexer_stage(cols, handle_invalid).fit(df)
    return model.transform(df), model


def _fit_indexer(df: DataFrame, cols: Sequence[str], handle_invalid: str):
    """Fit the indexer once; split the columns into encodable ones and those with a
    single label (one category carries no information: its one-hot vector with
    the last slot dropped has size 0, which the encoder refuses to build)."""
    model = indexer_stage(cols, handle_invalid).fit(df)
    sizes = [len(labels) for labels in model.labelsArray]
    extra = 1 if handle_invalid == "keep" else 0
    multi = [c for c, n in zip(cols, sizes) if n + extra > 1]
    single = [c for c, n in zip(cols, sizes) if n + extra <= 1]
    return model, multi, single


def one_hot(df: DataFrame, cols: Sequence[str], drop_last: bool = True) -> tuple[DataFrame, object]:
    """Index then one-hot encode ``cols`` (outputs ``<c>Cat`` vectors); a
    single-category column gets an empty ``<c>Cat`` vector."""
    cols = present(df, cols)
    idx, multi, single = _fit_indexer(df, cols, "error")
    stages = [idx] + ([encoder_stage(multi, drop_last)] if multi else [])
    model = Pipeline(stages=stages).fit(df)
    out = model.transform(df)
    if single:
        from pyspark.ml.functions import array_to_vector

        out = out.withColumns({c + ENCODED_SUFFIX: array_to_vector(F.array().cast("array<double>")) for c in single})
    return out, model


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Concatenate numeric columns and vectors into one vector (stateless)."""
    return VectorAssembler(inputCols=present(df, cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def l1_normalize(df: DataFrame, in_col: str = "features", out: str = "normFeatures", p: float = 1.0) -> DataFrame:
    """Divide each row vector by its p-norm (p=1: sum of |x|); a zero row stays zero."""
    return Normalizer(inputCol=in_col, outputCol=out, p=p).transform(df)


def build_features(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    normalize: str | None = "l1",
    indexer_invalid: str = "error",
    features_col: str = NORM_COL,
    keep: Sequence[str] = (),
    fit_filter=None,
    indexer: str = "driver",
    scratch: Scratch | None = None,
) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Fit and apply StringIndexer -> OneHotEncoder -> VectorAssembler -> normaliser.

    Assembled order: numeric columns first, then the encoded categoricals.
    Returns the frame reduced to ``keep + [target, features_col]``, the fitted
    ``PipelineModel`` and the assembled input names. ``indexer_invalid`` says
    what the indexer does with labels the fit did not see: ``error`` (the
    original) or ``keep`` (an index of their own). A NULL numeric always raises:
    it must not become a NaN slot. ``fit_filter`` (a boolean Column) fits the
    stages on those rows only, which needs ``keep``; every row is transformed.
    ``indexer="distributed"`` indexes the categories by ``dictionary`` (no label reaches
    the driver; the same indices) ahead of the pipeline, for columns of very many labels.
    """
    if indexer not in ("driver", "distributed"):
        raise ValueError("indexer must be 'driver' or 'distributed'")
    if fit_filter is not None and indexer_invalid == "error":
        indexer_invalid = "keep"
    numeric = present(df, numeric)
    categorical = present(df, categorical)
    plain = plain_names(df, numeric + categorical)
    named = {v: k for k, v in plain.items()}
    df = df.withColumnsRenamed(plain)
    numeric, categorical = [plain.get(c, c) for c in numeric], [plain.get(c, c) for c in categorical]
    fit_df = df if fit_filter is None else df.filter(fit_filter)
    stages = []
    if categorical and indexer == "distributed":
        dictionaries = {c: label_dictionary(fit_df, c, scratch) for c in categorical}
        for c, d in dictionaries.items():
            df = d.transform(df, c + INDEXED_SUFFIX, indexer_invalid)
        fit_df = df if fit_filter is None else df.filter(fit_filter)
        categorical = [c for c, d in dictionaries.items() if d.size + (indexer_invalid == "keep") > 1]
        if categorical:
            stages.append(encoder_stage(categorical))
    elif categorical:
        idx, categorical, _single = _fit_indexer(fit_df, categorical, indexer_invalid)
        stages.append(idx)
        if categorical:
            stages.append(encoder_stage(categorical))
    ass_cols = numeric + [c + ENCODED_SUFFIX for c in categorical]
    if not ass_cols:
        raise ValueError("no feature column left to assemble")
    raw = FEATURES_COL if normalize else features_col
    stages.append(VectorAssembler(inputCols=ass_cols, outputCol=raw, handleInvalid="error"))
    if normalize == "l1":
        stages.append(Normalizer(inputCol=raw, outputCol=features_col, p=1.0))
    elif normalize == "standard":
        stages.append(StandardScaler(inputCol=raw, outputCol=features_col))
    elif normalize is not None:
        raise ValueError("normalize must be None, 'l1' or 'standard'")
    model = Pipeline(stages=stages).fit(fit_df)
    kept = [quoted(plain.get(c, c)).alias(c) for c in present(df.withColumnsRenamed(named), keep)]
    out = model.transform(df).select(*kept, quoted(target), features_col)
    ass_cols = [named.get(c, c) for c in numeric] + [named.get(c, c) + ENCODED_SUFFIX for c in categorical]
    return out, model, ass_cols


def feature_count(df: DataFrame, vec_col: str) -> int:
    """Vector size from ML attribute metadata; one-row read only if it is missing."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    if "attrs" in meta:
        return sum(len(v) for v in meta["attrs"].values())
    row = df.select(F.size(vector_to_array(F.col(vec_col))).alias("n")).first()
    return int(row["n"]) if row else 0


@dataclass(frozen=True)
class FScores:
    """The univariate F-test of every slot of a vector column: one table for all selections."""

    n: int
    r: np.ndarray
    f: np.ndarray
    p: np.ndarray

    def picked(self, mode: str, threshold: float = 0.05) -> list[int]:
        """Slots that pass. ``fdr`` (Benjamini-Hochberg, step-up): all up to the last rank j, by
        falling significance, with p <= threshold * j / k; ``fwe``: p < threshold / k. A slot
        without variance has no p-value and never passes."""
        k = len(self.p)
        if mode == "fwe":
            return np.flatnonzero(self.p < threshold / k).tolist()
        if mode != "fdr":
            raise ValueError(f"mode must be one of {SELECTION_MODES}")
        order = np.argsort(self.p, kind="stable")  # NaN last
        passing = np.flatnonzero(self.p[order] <= threshold * np.arange(1, k + 1) / k)
        return sorted(order[: passing[-1] + 1].tolist()) if len(passing) else []


def f_scores(df: DataFrame, features_col: str, label: str, fit_filter=None) -> FScores:
    """F-test of every slot against the label, in one pass that holds a few numbers per slot
    (the label's row of the co-moment matrix). Rows without a label are left out."""
    k = feature_count(df, features_col)
    rows = df if fit_filter is None else df.filter(fit_filter)
    y = quoted(label).cast("double")
    values = F.concat(vector_to_array(quoted(features_col)), F.array(y))
    found = collected(comoments(rows.where(y.isNotNull()), values, k + 1, parts=[(k, k + 1, 0)]), k + 1).get(0)
    if found is None:
        return FScores(0, np.full(k, np.nan), np.full(k, np.nan), np.full(k, np.nan))
    n, r = int(found.n[0, 0]), found.correlations()[0, :k]
    freedom = n - 2
    with np.errstate(divide="ignore", invalid="ignore"):
        f = r * r / (1.0 - r * r) * freedom
    p = np.full(k, np.nan)
    if freedom > 0:
        fisher = df.sparkSession._jvm.org.apache.commons.math3.distribution.FDistribution(1.0, float(freedom))
        for i in np.flatnonzero(~np.isnan(f)):
            p[i] = 0.0 if np.isinf(f[i]) else 1.0 - fisher.cumulativeProbability(float(f[i]))
    return FScores(n, r, f, p)


def _selector(df: DataFrame, features_col: str, label: str, mode: str, threshold: float, out: str, picked: list[int]) -> UnivariateFeatureSelectorModel:
    """Spark's selector model that keeps the slots ``picked``."""
    sel = UnivariateFeatureSelector(featuresCol=features_col, labelCol=label, outputCol=out, selectionMode=mode)
    sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(threshold)
    gateway = df.sparkSession.sparkContext._gateway
    slots = gateway.new_array(gateway.jvm.int, len(picked))
    for at, slot in enumerate(picked):
        slots[at] = slot
    java = gateway.jvm.org.apache.spark.ml.feature.UnivariateFeatureSelectorModel(sel.uid, slots)
    return sel._copyValues(UnivariateFeatureSelectorModel(java))


def select_features(
    df: DataFrame,
    features_col: str,
    label: str,
    mode: str,
    threshold: float = 0.05,
    on_empty: str = "error",
    out: str = SELECTED_COL,
    fit_filter=None,
    scores: FScores | None = None,
) -> tuple[DataFrame, list[int], UnivariateFeatureSelectorModel]:
    """Univariate F-test selection (continuous features, continuous label).

    ``mode="fdr"``: Benjamini-Hochberg at ``threshold``; ``"fwe"``: p < threshold/k.
    The test is one pass over the data (``f_scores``); give its ``scores`` to make
    several selections from it. The slots are those of ``UnivariateFeatureSelector``,
    and the returned model is its own. An empty selection gives a
    size-0 vector on which tree models fail, so it raises; ``on_empty="all"``
    passes all features through instead, and the returned indices are then
    all of them, so that the caller sees what was used.
    """
    scores = scores or f_scores(df, features_col, label, fit_filter)
    picked = scores.picked(mode, threshold)
    model = _selector(df, features_col, label, mode, threshold, out, picked)
    if not picked:
        if on_empty != "all":
            raise ValueError(f"{mode} selection at {threshold} kept no feature")
        return df.withColumn(out, F.col(features_col)), list(range(len(scores.p))), model
    return model.transform(df), picked, model


def selection_report(df: DataFrame, features_col: str, label: str, mode: str, threshold: float = 0.05) -> DataFrame:
    """Rows (slot, f, p, selected) of an F-test selection, one for each slot (NULL without
    variance); an empty selection has no selected row."""
    scores = f_scores(df, features_col, label)
    picked = set(scores.picked(mode, threshold))
    value = lambda v: None if np.isnan(v) else float(v)
    rows = [(i, value(f), value(p), i in picked) for i, (f, p) in enumerate(zip(scores.f, scores.p))]
    return df.sparkSession.createDataFrame(rows, "slot int, f double, p double, selected boolean")
