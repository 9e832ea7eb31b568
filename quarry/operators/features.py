"""Label derivation and feature preparation.

Fitted transformations (indexing, scaling) use ``pyspark.ml`` stages: their
``fit`` is one distributed aggregate whose small result (labels, means,
standard deviations) is applied row by row on the JVM.  The long-form
helpers return the same numbers as tables, for checking and reporting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import numbered
from quarry.sources.worktables import WorkTables


def claim_labels(df: DataFrame, count_col: str = "claim_nb", flag_col: str = "nz_claim",
                 shifted_col: str = "pp_claim_nb", log_col: str = "log_claim_nb",
                 zero_value: float = 0.5, drop_source: bool = True) -> DataFrame:
    """Claim-frequency labels in one projection.

    * ``flag``: 1.0 when the count is > 0, else 0.0 (NULL counts give 0.0);
    * ``shifted``: the count with 0 replaced by ``zero_value`` (NULL stays NULL);
    * ``log``: natural log of ``shifted``.
    """
    cnt = F.col(count_col).try_cast("double")
    shifted = F.when(cnt == 0, F.lit(zero_value)).otherwise(cnt)
    out = df.withColumns({
        flag_col: F.when(cnt > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        shifted_col: shifted,
        log_col: F.ln(shifted),
    })
    return out.drop(count_col) if drop_source else out


def category_index(df: DataFrame, col: str, n_col: str = "n", idx_col: str = "idx") -> DataFrame:
    """Frequency index of a categorical column, as ``StringIndexer`` orders it.

    Most frequent value first; ties alphabetical.  The distinct values are
    numbered over ranges, so their number is not bounded by one task or by the
    driver (as that of a fitted indexer's labels is).
    """
    counts = (df.filter(F.col(col).isNotNull())
              .groupBy(col).agg(F.count(F.lit(1)).alias(n_col)))
    work = WorkTables(df.sparkSession, "index")
    placed = numbered(counts, [F.col(n_col).desc(), F.col(col)], "_place", work)
    return placed.select(col, n_col, (F.col("_place") - 1).cast("int").alias(idx_col))


def indexed(df: DataFrame, col: str, n_col: str = "n", idx_col: str = "idx") -> DataFrame:
    """(value, n, idx) of a column as the models' own indexing stage numbers it."""
    indexer = indexer_encoder([col])[0]
    rows = df.filter(F.col(col).isNotNull()).select(col)
    out = indexer.fit(rows).transform(rows)
    return (out.groupBy(col, f"{col}_idx").agg(F.count(F.lit(1)).alias(n_col))
            .select(col, n_col, F.col(f"{col}_idx").cast("int").alias(idx_col)))


def one_hot_sparse(df: DataFrame, col: str, key: str, slot_col: str = "slot", width_col: str = "width") -> DataFrame:
    """(key, value, slot, width): where the models' one-hot vector of each row has its 1.

    ``slot`` is NULL for the dropped last category.
    """
    model = Pipeline(stages=indexer_encoder([col])).fit(df.select(col))
    vec = model.transform(df.select(key, col)).withColumn("_v", vector_to_array(f"{col}_ohe"))
    slot = F.array_position("_v", 1.0).cast("int")
    return vec.select(key, col, F.when(slot > 0, slot - 1).alias(slot_col), F.size("_v").alias(width_col))


def indexer_encoder(categorical: Sequence[str]) -> list:
    """``StringIndexer`` + ``OneHotEncoder`` stages for categorical columns.

    The last (rarest) category is the dropped baseline; a NULL or unseen
    category fails the job, as an invalid numeric feature does."""
    idx = [f"{c}_idx" for c in categorical]
    ohe = [f"{c}_ohe" for c in categorical]
    return [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="error"),
            OneHotEncoder(inputCols=idx, outputCols=ohe)]


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (),
                     with_mean: bool = False, out_col: str = "features",
                     handle_invalid: str = "error") -> Pipeline:
    """Numeric columns assembled and scaled by their sample std (no centring
    by default), categorical ones indexed and one-hot coded, all assembled
    into ``out_col``.  Fit it once and reuse the model for every estimator.

    A NULL/NaN numeric feature fails the job by default rather than silently
    dropping the row; pass ``handle_invalid="skip"`` to drop such rows."""
    stages = []
    if categorical:
        stages += indexer_encoder(categorical)
    stages += [VectorAssembler(inputCols=list(numeric), outputCol="_num",
                               handleInvalid=handle_invalid),
               StandardScaler(inputCol="_num", outputCol="_num_scaled", withStd=True,
                              withMean=with_mean)]
    parts = ["_num_scaled"] + [f"{c}_ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol=out_col))
    return Pipeline(stages=stages)


def scale_columns(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled",
                  with_mean: bool = False) -> DataFrame:
    """Divide each column by its sample standard deviation (as ``StandardScaler``).

    Mean and deviation are taken over the non-NULL, non-NaN values, so one
    missing value touches its own row only: NULL stays NULL, NaN stays NaN.  A
    constant column scales to 0.
    """
    if not cols:
        return df
    value = {c: F.col(c).cast("double") for c in cols}
    real = {c: F.when(~F.isnan(v), v) for c, v in value.items()}
    stats = df.agg(*[f(real[c]) for c in cols for f in (F.avg, F.stddev_samp)]).first()
    out = {}
    for i, c in enumerate(cols):
        mean, std = stats[2 * i], stats[2 * i + 1]
        shifted = value[c] - F.lit(mean) if with_mean else value[c]
        out[f"{c}{suffix}"] = shifted / F.lit(std) if std else shifted * F.lit(0.0)
    return df.withColumns(out)


def model_scaled(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``df`` with each column as the models' own assembling and scaling stages give it.

    A NULL or NaN fails the job, as it does when a model is fitted.
    """
    model = feature_pipeline(cols, out_col="_scaled").fit(df)
    out = model.transform(df).withColumn("_a", vector_to_array("_scaled"))
    return out.select(*df.columns, *[F.col("_a")[i].alias(f"{c}{suffix}") for i, c in enumerate(cols)])


def standardise_array(df: DataFrame, array_col: str, out_col: str = "z",
                      with_mean: bool = True) -> tuple[DataFrame, PipelineModel]:
    """Standardise an ``array<float|double>`` column per position.

    Parquet arrays are nullable-element arrays, which ML stages reject, so
    the array is turned into a vector with ``array_to_vector`` first.
    """
    vec = df.withColumn("_v", array_to_vector(F.col(array_col).cast("array<double>")))
    model = Pipeline(stages=[StandardScaler(inputCol="_v", outputCol="_z", withStd=True,
                                            withMean=with_mean)]).fit(vec)
    out = model.transform(vec).withColumn(out_col, vector_to_array("_z")).drop("_v", "_z")
    return out, model


def dense_ids(df: DataFrame, col: str, out_col: str) -> DataFrame:
    """Map each distinct value of ``col`` to an int in 0..n-1 (for ALS).

    ALS needs int ids; keys of a large table may not fit in an int.  Values are
    numbered in their order over ranges, and the numbered table is written, so
    ids do not change if a partition is recomputed.
    """
    work = WorkTables(df.sparkSession, "ids")
    placed = numbered(df.select(col).filter(F.col(col).isNotNull()).distinct(), [F.col(col)], "_place", work)
    total = placed.count()
    if total > 2 ** 31 - 1:
        raise ValueError(f"{total} distinct values of {col} do not fit in an int id")
    return placed.select(col, (F.col("_place") - 1).cast("int").alias(out_col))
