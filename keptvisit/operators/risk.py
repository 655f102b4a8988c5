"""Risk bands of scored appointments.

A band asks whether a probability's percent rank reaches a share. That is a
comparison with the lowest probability that reaches it, so each batch and each
site needs one cut-off per band and no row needs its own rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.operators import ranks
from keptvisit.operators.timeline import same_keys
from keptvisit.session import write_out

HORIZONS = ["1day", "7day"]
SITE = "location_id"


def _cutoffs(table: DataFrame, groups: list[str], prefix: str) -> DataFrame:
    """Lowest probability per horizon that reaches the high and the medium share."""
    share = F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1)).otherwise(0.0)
    cell = lambda horizon, at: F.min(
        F.when((F.col("horizon") == horizon) & (share >= at), F.col("prob"))
    )
    columns = []
    for horizon in HORIZONS:
        columns.append(cell(horizon, fixed.HIGH_SHARE).alias(f"{prefix}_high_{horizon}"))
        columns.append(cell(horizon, fixed.MEDIUM_SHARE).alias(f"{prefix}_medium_{horizon}"))
    return table.groupBy(*groups).agg(*columns)


def _banded(prob: Column, high: Column, medium: Column) -> Column:
    return F.when(prob >= high, fixed.HIGH_RISK).when(prob >= medium, fixed.MEDIUM_RISK)


def _rank_cutoffs(rows: DataFrame, batch: list[str]) -> DataFrame:
    """Per batch and site, the cut-offs of the site and the batch and the batch's `_size`.

    The rows are counted per value once; both ranks and the sizes come from the counts.
    """
    long = rows.select(
        *batch, SITE, *[F.col(f"prob_{h}").alias(h) for h in HORIZONS]
    ).unpivot([*batch, SITE], HORIZONS, "horizon", "prob")
    by_site, by_batch = [*batch, SITE, "horizon"], [*batch, "horizon"]
    counts = write_out(
        long.groupBy(*by_site, "prob").agg(F.count(F.lit(1)).alias("n")), "values")
    known = counts.filter("prob is not null")
    site = ranks.cumulate(known, by_site, "prob", ["n"])
    whole = ranks.cumulate(
        known.groupBy(*by_batch, "prob").agg(F.sum("n").alias("n")), by_batch, "prob", ["n"])
    sites = counts.filter(F.col("horizon") == HORIZONS[0]).groupBy(*batch, SITE).agg(
        F.sum("n").alias("_site_rows"))
    batches = sites.groupBy(*batch).agg(F.sum("_site_rows").alias("_size"))
    batches = same_keys(batches, _cutoffs(whole, batch, "_batch"), batch, "left")
    sites = same_keys(sites, _cutoffs(site, [*batch, SITE], "_site"), [*batch, SITE], "left")
    return same_keys(sites, batches, batch).drop("_site_rows")


def _rank_band(horizon: str) -> Column:
    """The site's bands come first; a row below them keeps the band of the whole batch."""
    prob = F.col(f"prob_{horizon}")
    overall = _banded(
        prob, F.col(f"_batch_high_{horizon}"), F.col(f"_batch_medium_{horizon}"))
    not_high = overall.isNull() | (overall != fixed.HIGH_RISK)
    return (
        F.when(prob >= F.col(f"_site_high_{horizon}"), fixed.HIGH_RISK)
        .when((prob >= F.col(f"_site_medium_{horizon}")) & not_high, fixed.MEDIUM_RISK)
        .otherwise(overall)
    )


def _recorded_cutoffs(cutoffs: DataFrame, batch: list[str]) -> DataFrame:
    """The output of `reports.risk_cutoffs` with one row per batch and site."""
    cell = lambda model, level: F.min(
        F.when((F.col("model_type") == model) & (F.col("risk") == level),
               F.col("probability_threshold"))
    )
    models = {"1day": "1 day", "7day": "7 day"}
    return cutoffs.groupBy(*batch, SITE).agg(*[
        cell(model, level).alias(f"_{name}_{horizon}")
        for horizon, model in models.items()
        for name, level in (("high", fixed.HIGH_RISK), ("medium", fixed.MEDIUM_RISK))
    ])


def _recorded_band(horizon: str) -> Column:
    return _banded(
        F.col(f"prob_{horizon}"), F.col(f"_high_{horizon}"), F.col(f"_medium_{horizon}"))


def _with_bands(rows: DataFrame, table: DataFrame, batch: list[str], band) -> DataFrame:
    """`rows` with `risk_1day` and `risk_7day` from one join with a table of sites."""
    risks = {f"risk_{h}": band(h) for h in HORIZONS}
    kept = [name for name in rows.columns if name not in risks]
    return same_keys(rows, table, [*batch, SITE], "left").select(
        *kept, *[value.alias(name) for name, value in risks.items()]
    )


def percentile_bands(rows: DataFrame, batch: list[str]) -> DataFrame:
    """`rows` with their bands from the ranks in the batch and in its site."""
    return _with_bands(rows, _rank_cutoffs(rows, batch), batch, _rank_band)


def cutoff_bands(rows: DataFrame, cutoffs: DataFrame, batch: list[str]) -> DataFrame:
    """`rows` with the bands of the cut-offs on record for their batch and site.

    `cutoffs` is the output of `reports.risk_cutoffs`. A site without a cut-off
    gets no band.
    """
    return _with_bands(rows, _recorded_cutoffs(cutoffs, batch), batch, _recorded_band)


def banded_by_batch_size(
    rows: DataFrame, cutoffs: DataFrame, batch: list[str], small: int = fixed.SMALL_BATCH
) -> DataFrame:
    """Bands from the cut-offs on record for small batches that have some, else from ranks."""
    recorded = write_out(_recorded_cutoffs(cutoffs, batch), "recorded")
    on_record = recorded.select(*batch).distinct().withColumn("_on_record", F.lit(True))
    table = same_keys(_rank_cutoffs(rows, batch), on_record, batch, "left")
    table = same_keys(table, recorded, [*batch, SITE], "left")
    use_cutoffs = (F.col("_size") < small) & F.coalesce("_on_record", F.lit(False))
    return _with_bands(
        rows, table, batch,
        lambda h: F.when(use_cutoffs, _recorded_band(h)).otherwise(_rank_band(h)))


def by_probability(rows: DataFrame, prob: str, n: int | None = None) -> DataFrame:
    """All rows by falling probability, then encounter; the first `n` only if asked for."""
    ordered = rows.orderBy(F.col(prob).desc(), "encounter_id")
    return ordered if n is None else ordered.limit(n)
