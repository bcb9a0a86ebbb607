"""Cleaning as fit / transform: a driver-side spec of bounded size, then a static projection.

The fit reads the data a fixed number of times whatever the number of columns; nothing loops over columns with jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import sentinel_to_null
from ..session import materialize
from .guards import normalize_missing, numeric_columns, require_columns, string_columns
from .profiling import level_counts
from .quantiles import exact_quantiles
from .scaling import ScalerSpec, fit_scaler
from .splitting import PartitionSpec, fit_stratified_split


def fix_sentinel(df: DataFrame, col: str = "DAYS_EMPLOYED", sentinel: int = K.EMPLOYED_SENTINEL) -> DataFrame:
    return df.withColumn(col, sentinel_to_null(col, sentinel)) if col in df.columns else df


def missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return row["_n"], {c: row[c] for c in df.columns}


def fit_sparse_columns(df: DataFrame, threshold: float = K.DROP_MISSING_ABOVE) -> dict[str, float]:
    """{column: missing fraction} of the columns above the threshold."""
    n, nulls = missing_counts(df)
    return {c: k / n for c, k in nulls.items() if n and k / n > threshold}


def fit_medians(df: DataFrame, cols: Sequence[str], sizes: dict[str, int] | None = None) -> dict[str, float]:
    return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5], sizes=sizes).items()}


def impute(df: DataFrame, medians: dict[str, float], labels: Sequence[str] = ()) -> DataFrame:
    """Median for numbers, a fixed label for strings."""
    out = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(m))) for c, m in medians.items()}
    out |= {c: F.coalesce(F.col(f"`{c}`"), F.lit(K.MISSING_LABEL)) for c in labels}
    return df.withColumns(out) if out else df


@dataclass(frozen=True)
class EncodingSpec:
    """One-hot levels (at most ``max_levels`` per column) and the columns to encode by frequency."""

    one_hot: dict[str, list[str]]
    frequency: list[str]


def route_cardinality(df: DataFrame, cols: Sequence[str], max_levels: int = K.ONE_HOT_MAX_LEVELS) -> DataFrame:
    """(column, n_levels, encoding); a NULL counts as a level."""
    counted = level_counts(df, cols).groupBy("column").agg(F.count("*").alias("n_levels"))
    return counted.withColumn("encoding", F.when(F.col("n_levels") > max_levels, "frequency").otherwise("one_hot"))


def fit_encoding(df: DataFrame, cols: Sequence[str], max_levels: int = K.ONE_HOT_MAX_LEVELS) -> EncodingSpec:
    """Route by cardinality and fetch the levels of the one-hot columns in one job.

    Only the first ``max_levels + 1`` levels per column are kept (limited map-side too): enough to see that a column has
    too many.
    """
    if not cols:
        return EncodingSpec({}, [])
    nth = F.row_number().over(Window.partitionBy("column").orderBy("level"))
    found: dict[str, list] = {c: [] for c in cols}
    for r in level_counts(df, cols).withColumn("nth", nth).where(F.col("nth") <= max_levels + 1).collect():
        found[r.column].append(r.level)
    low = {c: sorted(v for v in vs if v is not None) for c, vs in found.items() if len(vs) <= max_levels}
    return EncodingSpec(low, [c for c in cols if c not in low])


def one_hot(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """Named indicator columns ``COL_level``; the first sorted level is the baseline."""
    added = {
        f"{c}_{lv}": F.when(F.col(f"`{c}`") == lv, 1.0).otherwise(0.0)
        for c, lvs in levels.items() for lv in lvs[1 if drop_first else 0:]
    }
    return (df.withColumns(added) if added else df).drop(*levels)


def fit_frequencies(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """Count table (_level, _freq) per column, written once, so that the planner knows its size.

    A small table is then broadcast without shuffling the data at all; one above the broadcast threshold is sort-merge joined,
    where adaptive execution splits a hot level.
    """
    return {
        c: materialize(df.groupBy(F.col(f"`{c}`").alias("_level")).agg(F.count("*").cast("double").alias("_freq")))
        for c in cols
    }


def frequency_encode(
    df: DataFrame, cols: Sequence[str], population: DataFrame | None = None, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Replace a category by its number of occurrences in ``population`` (default: ``df``); an unseen level counts 0."""
    tables = tables or fit_frequencies(df if population is None else population, cols)
    for c in cols:
        order = df.columns
        df = df.join(tables[c], F.col(f"`{c}`").eqNullSafe(F.col("_level")), "left").drop("_level", c)
        df = df.withColumn(c, F.coalesce("_freq", F.lit(0.0))).select([f"`{x}`" for x in order])
    return df


@dataclass
class CleaningSpec:
    """Everything fitted by :func:`fit_cleaning`; its size depends on the columns, not on the rows.

    Only ``frequencies`` can grow (one row per level of a high-cardinality column), so those are stored tables.
    """

    n_rows: int
    n_cols: int
    sentinel_replaced: int
    dropped: dict[str, float]
    medians: dict[str, float]
    labels: list[str]
    fill_counts: dict[str, int]
    encoding: EncodingSpec
    split: PartitionSpec
    scaler: ScalerSpec = field(default_factory=lambda: ScalerSpec({}))
    frequencies: dict[str, DataFrame] = field(default_factory=dict)
    id_col: str = K.ID
    target: str = K.TARGET

    def prepare(self, df: DataFrame) -> DataFrame:
        """Sentinel, sparse columns and missing values."""
        df = fix_sentinel(normalize_missing(df)).drop(*self.dropped)
        return impute(df, self.medians, self.labels)

    def encode(self, df: DataFrame) -> DataFrame:
        return frequency_encode(one_hot(df, self.encoding.one_hot), self.encoding.frequency, tables=self.frequencies)

    def transform(self, df: DataFrame) -> DataFrame:
        """Clean ``df``, the fitted table or new rows, with the fitted values."""
        tagged = self.split.transform(self.encode(self.prepare(df)), K.SPLIT)
        return self.scaler.transform(tagged)

    def summary_rows(self) -> list[tuple[str, float]]:
        sizes = {p: sum(s[i] for s in self.split.sizes.values()) for i, p in enumerate(self.split.parts)}
        rows = {
            "rows_in": self.n_rows,
            "cols_in": self.n_cols,
            "sentinel_replaced": self.sentinel_replaced,
            "columns_dropped": len(self.dropped),
            "columns_filled": len(self.fill_counts),
            "values_filled": sum(self.fill_counts.values()),
            "one_hot_columns": len(self.encoding.one_hot),
            "frequency_columns": len(self.encoding.frequency),
            "feature_count": len(self.scaler.stats),
            **{f"rows_{p}": n for p, n in sizes.items()},
            "rows_out": sum(sizes.values()),
            "cols_out": len(self.scaler.stats) + 3,
        }
        return [(k, float(v)) for k, v in rows.items()]


def fit_cleaning(
    df: DataFrame,
    drop_threshold: float = K.DROP_MISSING_ABOVE,
    max_levels: int = K.ONE_HOT_MAX_LEVELS,
    fractions: dict[str, float] | None = None,
    seed: int = K.SEED,
    fit_on: str = "all",
    id_col: str = K.ID,
    target: str = K.TARGET,
    split: PartitionSpec | None = None,
) -> CleaningSpec:
    """Fit the cleaning steps.  Medians use all rows, or with ``fit_on="train"`` only the train split.

    A ``split`` fitted before is used as it is; otherwise ``fractions`` and ``seed`` define one.
    """
    require_columns(df, [id_col, target])
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    raw = normalize_missing(df)
    fixed = fix_sentinel(raw)
    sentinels = F.count_if(F.col("DAYS_EMPLOYED") == K.EMPLOYED_SENTINEL) if "DAYS_EMPLOYED" in raw.columns else F.lit(0)
    holes_in = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in raw.columns}
    if "DAYS_EMPLOYED" in raw.columns:
        holes_in["DAYS_EMPLOYED"] = F.count_if(sentinel_to_null("DAYS_EMPLOYED").isNull())
    row = raw.agg(F.count("*").alias("_n"), sentinels.alias("_s"), *[e.alias(c) for c, e in holes_in.items()]).first()
    n = row["_n"]
    nulls = {c: row[c] for c in fixed.columns}
    dropped = {c: k / n for c, k in nulls.items() if n and k / n > drop_threshold}
    kept = fixed.drop(*dropped)
    if split is None:
        split = fit_stratified_split(df, id_col, target, fractions, seed)
    holes = {c: nulls[c] for c in kept.columns if nulls[c] and c not in (id_col, target)}
    numbers = [c for c in numeric_columns(kept) if c in holes]
    if fit_on == "all":
        medians = fit_medians(kept, numbers, {c: n - nulls[c] for c in numbers})
    else:
        medians = fit_medians(kept.where(split.part() == "train"), numbers)
    labels = [c for c in string_columns(kept) if c in holes]
    spec = CleaningSpec(
        n, len(df.columns), row["_s"], dropped, medians, labels, holes, EncodingSpec({}, []), split,
        id_col=id_col, target=target,
    )
    prepared = spec.prepare(df)
    spec.encoding = fit_encoding(prepared, string_columns(prepared, (K.SPLIT,)), max_levels)
    spec.frequencies = fit_frequencies(prepared, spec.encoding.frequency)
    encoded = split.transform(spec.encode(prepared), K.SPLIT)
    spec.scaler = fit_scaler(encoded.where(F.col(K.SPLIT) == "train"), numeric_columns(encoded, (id_col, target)))
    return spec


def clean(df: DataFrame, **options) -> tuple[DataFrame, CleaningSpec]:
    """Fit and transform in one call."""
    spec = fit_cleaning(df, **options)
    return spec.transform(df), spec
