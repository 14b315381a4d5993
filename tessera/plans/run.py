"""End-to-end run: prepare -> features -> select -> split -> cross-validated models -> report.

Jobs, in order (each a single pass unless noted): key gate (1 global
aggregate over the key column), materialisation of the joined table (1), the
single-valued test and the mean surrogates in one aggregate over it (1), mode surrogates (2), indexer fit (1), materialisation of the feature table (1),
F-test of both selections (1), the shared cross-validation table (1), then the
model fits (the linear one from one more pass). The correlation profile runs only
when its frame is asked for (one aggregate each for the target and the matrix). Materialising means a
Parquet table (or, for vectors, a reliable checkpoint) in the shared folder when
the cluster names one, else a persist; ``RunReport.close()`` releases all of it.
All metrics come out of one aggregate over one scan of the test rows.

The split and the folds are columns computed from the raw key once, before any
cleaning, and carried along: a row is on the same side at every stage.
"""

from __future__ import annotations

import time
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import NA_SENTINELS, hash_bucket, to_int_typed
from tessera.operators import clean, profile
from tessera.operators.evaluate import evaluate_many
from tessera.operators.features import NORM_COL, build_features, f_scores, feature_count, select_features
from tessera.operators.impute import impute
from tessera.operators.join import entity_age, gated_join
from tessera.operators.models import MODEL_KINDS, PREDICTION_COLS, best_params, cv_table, fit_cv, split_cut
from tessera.operators.surrogates import modes
from tessera.plans.progress import Progress, input_fingerprint
from tessera.session import Scratch, ensure_parallelism, materialize, materialize_observed, quoted
from tessera.spec import CARRIED, PrepResult, RunReport, TableSpec, derive_roles

DATE_SENTINELS = ("None", "NA")


def prepare(
    fact: DataFrame,
    dim: DataFrame | None,
    spec: TableSpec,
    materialize_how: str = "auto",
    age_null: str = "drop",
    keep_double_mean: bool = False,
    null_policy: str = "zero",
    collinear_threshold: float | None = None,
    fit_filter=None,
    carry: dict | None = None,
    scratch: Scratch | None = None,
    progress: Progress | None = None,
    **join_options,
) -> PrepResult:
    """Clean a fact table (and join its dimension) into a model-ready frame.

    Names in ``spec`` match columns whatever their case; a missing target or key
    is an error. ``fit_filter`` (a boolean Column over carried columns) makes the
    imputers learn from those rows only; by default they see every row, as the
    original did. ``carry``: columns (name -> expression over the raw fact) that
    pass through untouched. ``progress``: finished parts (the joined table with its
    observed values, the mode surrogates) are read from there, others kept there."""
    # The dimension's columns take part in the spelling, but the target and the
    # keys must be the fact's.
    spec.resolve(fact.columns)
    spec = spec.resolve([*(dim.columns if dim is not None else ()), *fact.columns])
    t = spec.target
    carry = {f"{CARRIED}{name}": c for name, c in (carry or {}).items()}
    df = fact.withColumns(carry) if carry else fact
    df = clean.drop_columns(df, spec.leak)
    df = clean.drop_missing_target(df, t, NA_SENTINELS)
    if spec.flag:
        df = clean.filter_flag(df, spec.flag, spec.flag_value)
        df = clean.drop_columns(df, (spec.flag,) + spec.flag_drop)

    done = progress.values("joined") if progress else None
    included = bool(done and done["included"])
    if done is None and dim is not None and spec.join_key:
        d = clean.drop_columns(dim, spec.dim_drop)
        # Dimension-only predicates go to the dimension before the join (same
        # result for an inner join, fewer rows to broadcast or shuffle).
        if spec.date_col:
            d = clean.require_columns(d, [spec.date_col], DATE_SENTINELS)
        d = clean.require_columns(d, spec.dim_required)
        df, included = gated_join(df, d, spec.join_key, **join_options)
    drop_ids = spec.ids + ((spec.join_key,) if spec.join_key else ())
    df = clean.drop_columns(df, drop_ids)
    if included:
        spec = replace(spec, categorical=spec.categorical + spec.dim_categorical)
    else:
        spec = replace(spec, date_col=None)

    if done is not None:
        df = progress.table("joined")
    # Sentinel text -> NULL on every column but the target.
    df = clean.sentinel_to_null(df, [c for c in df.columns if c != t and c not in carry], NA_SENTINELS)

    # Materialise once (the joined, cleaned table is read by every later job);
    # the single-valued test is one aggregate over what was stored. Dropping the columns is then a projection.
    roles = set(spec.all_roles())
    keys = {k for k in spec.key_cols if k not in roles} | set(carry)
    cols, metrics = profile.informative_metrics(df, [c for c in df.columns if c not in keys])
    # The mean surrogates come out of it too: the average of each mean-imputed
    # column, cast as below, over the rows whose target casts to a value (the
    # rows the imputer would see; with ``fit_filter`` only those rows).
    types = dict(df.dtypes)
    t_ok = to_int_typed(t, types[t]).isNotNull()
    if fit_filter is not None:
        t_ok = t_ok & fit_filter
    mean_cols = clean.present(df, spec.numeric_mean)
    for i, c in enumerate(mean_cols):
        metrics[f"mean_{i}"] = F.avg(F.when(t_ok, to_int_typed(c, types[c]).cast("double")))
    if done is not None:
        values = done["values"]
    else:
        df, values = materialize_observed(df, metrics, materialize_how, scratch, progress.path("joined") if progress else None)
        if progress:
            progress.finish("joined", {"included": included, "values": values})
    means = {c: values[f"mean_{i}"] for i, c in enumerate(mean_cols)}
    constant = profile.constant_from_metrics(cols, values, spec.exempt_constant)
    df = df.drop(*constant)
    spec = spec.without(constant)
    if spec.date_col and spec.date_col.lower() in {c.lower() for c in constant}:
        spec = replace(spec, date_col=None)

    df = clean.cast_numeric(df, spec.numeric + (t,))
    df = df.filter(quoted(t).isNotNull())

    numeric = clean.present(df, spec.numeric)
    profiled = None
    if numeric:
        at = df

        def profiled() -> DataFrame:
            return profile.corr_target(at, t, numeric, null_policy).unionByName(profile.corr_matrix(at, numeric, null_policy))

    df, spec, collinear = profile.drop_collinear(
        df, spec, columns=spec.collinear, threshold=collinear_threshold, cols=numeric, null_policy=null_policy
    )

    surrogates = None
    if progress:
        rows, mode_cols = df if fit_filter is None else df.filter(fit_filter), clean.present(df, spec.numeric_mode)
        surrogates = progress.remembered("modes", lambda: modes(rows, mode_cols))
    df, _ = impute(df, spec.numeric_mode, "mode", fit_filter=fit_filter, surrogates=surrogates)
    df = _fill_means(df, clean.present(df, spec.numeric_mean), means, keep_double_mean)

    extra_numeric: tuple[str, ...] = ()
    if included and spec.date_col and spec.age_year_col:
        # age_null: "drop" rows whose date does not parse (default), or
        # "impute" the age like the other mean-imputed columns.
        df = entity_age(
            df, spec.age_year_col, spec.date_col, spec.age_col, spec.date_format,
            "keep" if age_null == "impute" else age_null,
        )
        if age_null == "impute":
            df, _ = impute(df, [spec.age_col], "mean", keep_double=keep_double_mean, fit_filter=fit_filter)
        extra_numeric = (spec.age_col,)

    cats = [c for c in clean.present(df, spec.categorical) if c not in spec.hhmm_cols]
    df = clean.null_to_unknown(df, cats)
    hhmm = clean.present(df, spec.hhmm_cols)
    df = clean.filter_upper(df, {c: spec.hhmm_max for c in hhmm})
    df = clean.day_parts(df, hhmm)
    spec = replace(
        spec.without(hhmm),
        numeric_mean=tuple(c for c in spec.numeric_mean if c not in hhmm) + extra_numeric,
        categorical=tuple(spec.categorical) + tuple(hhmm),
    )
    return PrepResult(
        df=df,
        spec=spec,
        included=included,
        constant_dropped=constant,
        collinear_dropped=collinear,
        profile=profiled,
    )


def _fill_means(df: DataFrame, cols: list[str], means: dict, keep_double: bool) -> DataFrame:
    """Apply mean surrogates the way ``Imputer`` does: NULL -> surrogate, cast to
    the column's type (an int column truncates, 12.75 -> 12)."""
    missing = [c for c in cols if means.get(c) is None]
    if missing:
        raise ValueError(f"no value to impute from in {missing}")
    if keep_double:
        return df.withColumns({c: F.coalesce(quoted(c).cast("double"), F.lit(means[c])) for c in cols})
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(means[c]).cast(types[c])) for c in cols})


def run(
    fact: DataFrame,
    dim: DataFrame | None,
    spec: TableSpec,
    features: str = "selected",
    kinds=MODEL_KINDS,
    folds: int = 5,
    seed: int = 10,
    fraction: float = 0.7,
    parallelism: int | None = None,
    normalize: str | None = "l1",
    materialize_how: str = "auto",
    concurrent_kinds: bool = False,
    fit_on: str = "all",
    on_empty: str = "error",
    indexer_invalid: str = "error",
    indexer: str = "driver",
    restart: bool = False,
    **prep_options,
) -> RunReport:
    """Full comparison: 3 models x {FDR, FWE} selections, k-fold CV each.

    ``features="selected"`` trains on the selected slots; ``"normFeatures"``
    trains every model on all normalised features as the original did, which
    makes the FDR and FWE rows the same experiment. Whenever both selections
    pick the same slots, the FWE fits reuse the FDR models (identical inputs
    and seeds give identical models), so the work is not done twice. A selection
    that keeps nothing is an error, or all slots with ``on_empty="all"``
    (``RunReport.selected`` then lists all).

    The split and the folds come from a hash of ``spec.key_cols``, which may also
    be id columns or features; without key columns they are random numbers, drawn
    once and stored with the rows. ``fit_on="all"`` fits imputers, encoders and
    selectors on every row before the split, as the original did (test rows
    leak into them); ``fit_on="train"`` fits them on the training rows only.

    ``parallelism`` fits run at a time, one model kind after another: a tree fit
    persists its own copy of the rows, so by default there are as many as the
    executors' free memory holds (``models.fits_at_a_time``).

    ``restart=True`` keeps the joined and the feature table, with the values learned
    on the way, in the shared folder until the report is closed: if the run ends before
    (the driver is lost, a fit fails), the same call goes on behind the last finished
    table. Other inputs, spec, options or code share nothing with it (``progress``).
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    clock = _Clock()
    scratch = Scratch()
    spec = spec.resolve(fact.columns)
    keys = list(spec.key_cols)
    buckets = 1000 if abs(fraction * 1000 - round(fraction * 1000)) < 1e-9 else 1_000_000
    cut = split_cut(fraction, buckets)
    if keys:
        carry = {"split": hash_bucket(keys, seed, buckets), "fold": hash_bucket(keys, f"fold{seed}", folds).cast("int")}
        carry |= {f"key_{i}": quoted(k) for i, k in enumerate(keys)}
    else:
        carry = {
            "split": F.floor(F.rand(seed) * buckets).cast("bigint"), "fold": F.floor(F.rand(seed + 1) * folds).cast("int"),
        }
    progress = None
    if restart:
        options = dict(seed=seed, fraction=fraction, folds=folds, normalize=normalize, fit_on=fit_on, indexer_invalid=indexer_invalid)
        progress = Progress(
            fact.sparkSession, input_fingerprint(fact), input_fingerprint(dim) if dim is not None else "", repr(spec),
            repr(sorted({**options, **prep_options}.items(), key=str)),
        )
    in_train = F.col(f"{CARRIED}split") < cut
    train_rows = in_train if fit_on == "train" else None
    try:
        prep = prepare(
            fact, dim, spec, materialize_how=materialize_how, fit_filter=train_rows, carry=carry, scratch=scratch,
            progress=progress, **prep_options,
        )
        clock.lap("prepare")
        s = prep.spec
        numeric, categorical = derive_roles(prep.df.columns, s)
        if progress and progress.values("features") is not None:
            feats = progress.table("features")
        else:
            feats, _, _ = build_features(
                prep.df, numeric, categorical, s.target, normalize=normalize, keep=[CARRIED + c for c in carry],
                fit_filter=train_rows, indexer_invalid=indexer_invalid, indexer=indexer, scratch=scratch,
            )
            # ``feats`` reads the materialised prepared table through narrow steps only,
            # so counting its partitions runs no job.
            spread = feats if indexer == "distributed" else ensure_parallelism(feats)
            feats = materialize(spread, materialize_how, scratch=scratch, path=progress.path("features") if progress else None)
            if progress:
                progress.finish("features")
        n_features = feature_count(feats, NORM_COL)
        clock.lap("features")

        # Both selections from one table of p-values.
        scores = f_scores(feats, NORM_COL, s.target, train_rows)
        fdr_df, fdr_idx, _ = select_features(feats, NORM_COL, s.target, "fdr", on_empty=on_empty, out="sel_fdr", scores=scores)
        both, fwe_idx, _ = select_features(fdr_df, NORM_COL, s.target, "fwe", on_empty=on_empty, out="sel_fwe", scores=scores)
        selected = {"fdr": fdr_idx, "fwe": fwe_idx}
        clock.lap("select")

        train, test = both.filter(in_train), both.filter(~in_train)
        train = train.withColumnRenamed(f"{CARRIED}fold", "fold")
        feature_cols = [NORM_COL] if features == NORM_COL else ["sel_fdr", "sel_fwe"]
        same = features == NORM_COL or fdr_idx == fwe_idx
        if same:
            feature_cols = feature_cols[:1]
        table = cv_table(train, feature_cols, s.target, "fold", scratch=scratch)
        test = test.withColumn(s.target, quoted(s.target).cast("double"))

        def fit_kind(kind):
            # FWE reuses the FDR model when both selections keep the same slots:
            # identical inputs and seeds give an identical model.
            out = {}
            for sel in ("fdr", "fwe"):
                col = NORM_COL if features == NORM_COL else f"sel_{sel}"
                if sel == "fwe" and same:
                    out[sel] = out["fdr"]
                    continue
                out[sel] = fit_cv(
                    table, kind, col, s.target, folds=folds, seed=seed, parallelism=parallelism,
                    fold_col="fold", pred_col=f"{PREDICTION_COLS[kind]}_{sel}", materialize_how="none",
                )
            return kind, out

        wrap = inheritable_thread_target(feats.sparkSession)
        with ThreadPool(len(kinds) if concurrent_kinds else 1) as pool:
            fitted = dict(pool.imap(wrap(fit_kind), kinds))
        clock.lap("cv")
    except BaseException:
        scratch.close()
        raise

    # Every fitted model adds its own prediction column to ONE test frame, and
    # all metrics come from one aggregate over it: one scan of the test rows.
    scored = test
    params, preds, columns = {}, {}, []
    for kind in kinds:
        for sel in ("fdr", "fwe"):
            model = fitted[kind][sel]
            pcol = model.bestModel.getPredictionCol()
            if pcol not in scored.columns:
                scored = model.transform(scored)
            name = f"{kind}_{sel}"
            params[name] = best_params(model, feats.sparkSession)
            columns.append((kind, sel, pcol))
    own = [F.col(f"{CARRIED}key_{i}").alias(k) for i, k in enumerate(keys)]
    for kind, sel, pcol in columns:
        preds[f"{kind}_{sel}"] = scored.select(*own, quoted(s.target), F.col(pcol).alias(PREDICTION_COLS[kind]))
    summary = evaluate_many(scored, s.target, columns)
    if progress:
        progress.release(scratch)
    return RunReport(
        summary=summary,
        prep=prep,
        n_features=n_features,
        selected=selected,
        best_params=params,
        predictions=preds,
        timings=clock.laps,
        scratch=scratch,
    )


class _Clock:
    """Driver wall-clock per phase (each phase ends with an action)."""

    def __init__(self):
        self.laps: dict[str, float] = {}
        self._t = time.perf_counter()

    def lap(self, name: str) -> None:
        now = time.perf_counter()
        self.laps[name] = round(now - self._t, 3)
        self._t = now
