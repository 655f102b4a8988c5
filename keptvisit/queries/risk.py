"""Risk bands, sorts, set operations, reshapes and quality of given scores."""

from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.operators import filters, folds, metrics, profiles, reports, risk
from keptvisit.queries.book import query
from keptvisit.queries.reporting import ACTUAL, AGED, scored
from keptvisit.queries.steps import FOLD, age_sql

col = F.col


def aged(clinic):
    """Ledger rows with their age band; rows of unknown age are in no band."""
    age = dates.years_between(col("birthdate"), col("rtc_date"))
    rows = clinic.ledger.join(clinic.person.select("person_id", "birthdate"), "person_id")
    return rows.withColumn("band", clinical.age_band(age)).filter("band is not null").drop("birthdate")


BANDED = "select *, case when age >= 18 then 'adult' else 'minor' end as band from {aged} where age is not null"


def percentile_sql(batch: str, source: str) -> str:
    def steps(horizon):
        return f"""
  percent_rank() over (partition by {batch} order by prob_{horizon}) as whole_{horizon},
  percent_rank() over (partition by {batch}, location_id order by prob_{horizon}) as site_{horizon}"""

    def risk_case(horizon):
        return f"""
  case when site_{horizon} >= 0.9 then 'High Risk'
    when site_{horizon} >= 0.8 and not whole_{horizon} >= 0.9 then 'Medium Risk'
    when whole_{horizon} >= 0.9 then 'High Risk'
    when whole_{horizon} >= 0.8 then 'Medium Risk' end as risk_{horizon}"""

    return f"""
select encounter_id, {batch}, location_id, {risk_case("1day")}, {risk_case("7day")}
from (select encounter_id, {batch}, location_id, {steps("1day")}, {steps("7day")} from {{{source}}})"""


@query("risk_band_percentile", percentile_sql("band", "banded"), aged=AGED, banded=BANDED)
def risk_band_percentile(clinic):
    return risk.percentile_bands(aged(clinic), ["band"]).select(
        "encounter_id", "band", "location_id", "risk_1day", "risk_7day")


def late_rows(clinic):
    """Appointments of the newer model version, as late arrivals of each week."""
    return aged(clinic).filter("model_version = 'V11'")


def recorded_cutoffs(clinic):
    earlier = clinic.ledger.filter("model_version = 'V10'")
    return reports.risk_cutoffs(earlier, clinic.person, ["week"])


def recorded_sql(horizon: str, level: str) -> str:
    return (f"min(prob_{horizon}) filter (risk_{horizon} = '{level} Risk') "
            f"as {level.lower()}_{horizon}")


LATE = {
    "aged": AGED,
    "banded": BANDED,
    "late": "select * from {banded} where model_version = 'V11'",
    "recorded": "select week, band, location_id, " + ", ".join(
        recorded_sql(h, level) for h in ("1day", "7day") for level in ("High", "Medium"))
    + " from {banded} where model_version = 'V10' group by week, band, location_id",
    "by_cutoff": "select l.encounter_id, l.week, l.band, l.location_id, " + ", ".join(f"""
  case when prob_{h} >= high_{h} then 'High Risk' when prob_{h} >= medium_{h} then 'Medium Risk' end
    as risk_{h}""" for h in ("1day", "7day")) + """
from {late} l left join {recorded} r
  on r.week = l.week and r.band = l.band and r.location_id = l.location_id""",
    "by_rank": percentile_sql("week, band", "late"),
}


@query("risk_band_cutoffs", "select * from {by_cutoff}", **LATE)
def risk_band_cutoffs(clinic):
    return risk.cutoff_bands(late_rows(clinic), recorded_cutoffs(clinic), ["week", "band"]).select(
        "encounter_id", "week", "band", "location_id", "risk_1day", "risk_7day")


@query("batch_size_switch", """
select r.encounter_id, r.week, r.band, r.location_id,
  case when small and on_record then c.risk_1day else r.risk_1day end as risk_1day,
  case when small and on_record then c.risk_7day else r.risk_7day end as risk_7day
from {by_rank} r join {by_cutoff} c using (encounter_id)
join (select week, band, count(*) < 50 as small from {late} group by week, band) s
  on s.week = r.week and s.band = r.band
join (select week, band, (week, band) in (select week, band from {recorded}
    where high_1day is not null or medium_1day is not null or high_7day is not null
      or medium_7day is not null) as on_record
  from {late} group by week, band) o on o.week = r.week and o.band = r.band""", **LATE)
def batch_size_switch(clinic):
    return risk.banded_by_batch_size(
        late_rows(clinic), recorded_cutoffs(clinic), ["week", "band"]
    ).select("encounter_id", "week", "band", "location_id", "risk_1day", "risk_7day")


@query("ordered_extract", """
select person_id, encounter_datetime, encounter_id, rtc_date from {encounter}
order by person_id, encounter_datetime, encounter_id""")
def ordered_extract(clinic):
    return clinic.encounter.select(
        "person_id", "encounter_datetime", "encounter_id", "rtc_date"
    ).orderBy("person_id", "encounter_datetime", "encounter_id")


@query("rank_by_probability", """
select encounter_id, person_id, round(prob_1day, 6) as prob_1day from {ledger}
order by {ledger}.prob_1day desc, encounter_id""")
def rank_by_probability(clinic):
    return risk.by_probability(clinic.ledger, "prob_1day").select("encounter_id", "person_id", F.round("prob_1day", 6).alias("prob_1day"))


@query("union_distinct", """
select location_id, risk_1day as risk from {ledger} union select location_id, risk_7day from {ledger}
union select location_id, 'High Risk' from {location}""")
def union_distinct(clinic):
    one = clinic.ledger.selectExpr("location_id", "risk_1day as risk")
    seven = clinic.ledger.selectExpr("location_id", "risk_7day as risk")
    sites = clinic.location.select("location_id", F.lit(fixed.HIGH_RISK).alias("risk"))
    return one.union(seven).union(sites).distinct()


@query("stack_bands", """
select encounter_id, band, round(prob_1day, 6) as prob_1day from {banded} where band = 'adult'
union all
select encounter_id, band, round(prob_1day, 6) as prob_1day from {banded} where band = 'minor'""",
       aged=AGED, banded=BANDED)
def stack_bands(clinic):
    rows = aged(clinic).withColumn("prob_1day", F.round("prob_1day", 6))
    adults = rows.filter("band = 'adult'").select("encounter_id", "band", "prob_1day")
    minors = rows.filter("band = 'minor'").select("prob_1day", "band", "encounter_id")
    return adults.unionByName(minors)


LONG = ["weight", "height", "vl_resulted", "cd4_resulted"]


@query("wide_to_long", " union all ".join(
    f"select encounter_id, '{name}' as variable, cast({name} as double) as value from {{encounter}}"
    for name in LONG))
def wide_to_long(clinic):
    return profiles.wide_to_long(clinic.encounter, LONG, ["encounter_id"])


@query("assign_folds", """
select e.person_id, e.encounter_id, f.fold_id from {encounter} e join {fold} f using (person_id)""",
       fold=FOLD)
def assign_folds(clinic):
    return folds.assign_folds(clinic.encounter.select("person_id", "encounter_id"))


@query("holdout_split", f"""
select encounter_id, fold_id, case when fold_id = 11 then 'test' else 'train' end as part
from (select encounter_id, person_id, {ACTUAL} as actual, band from {{banded}})
join {{fold}} using (person_id) where band = 'adult' and actual is not null""",
       aged=AGED, banded=BANDED, fold=FOLD)
def holdout_split(clinic):
    people = folds.person_folds(clinic.encounter)
    rows = aged(clinic).filter("band = 'adult'").join(people, "person_id")
    train, test = filters.holdout_split(rows)
    part = lambda frame, name: frame.select(
        "encounter_id", "fold_id", F.lit(name).alias("part"))
    return part(train, "train").unionByName(part(test, "test"))


def positive():
    return col("actual") == fixed.DISENGAGED


QUALITY = {
    "outcomes": f"select *, {ACTUAL} = 'Disengaged' as late, prob_1day as p from {{ledger}}",
    "folded": """
select o.*, f.fold_id from {outcomes} o join {fold} f using (person_id)""",
    "fold": FOLD,
}


def quality_sql(groups: str, source: str) -> str:
    keys = f"{groups}," if groups else ""
    part = f"partition by {groups}" if groups else ""
    within = f"partition by {groups}, p" if groups else "partition by p"
    tail = f"group by {groups}" if groups else ""
    return f"""
select {keys}
  avg(case when (p >= 0.5) = late then 1.0 else 0.0 end) as accuracy,
  (sum(case when late then midrank end) - count(*) filter (late) * (count(*) filter (late) + 1) / 2)
    / (count(*) filter (late) * count(*) filter (not late)) as auc,
  count(*) filter (p >= 0.5 and late) / nullif(count(*) filter (p >= 0.5), 0) as precision,
  count(*) filter (p >= 0.5 and late) / nullif(count(*) filter (late), 0) as recall,
  count(*) filter (p < 0.5 and not late) / nullif(count(*) filter (not late), 0) as specificity,
  -avg(ln(case when late then greatest(p, 1e-15) else greatest(1 - p, 1e-15) end)) as logloss
from (select *, rank() over ({part} order by p) + (count(*) over ({within}) - 1) / 2 as midrank
  from {{{source}}}) {tail}"""


def rounded_sql(inner: str, keys: list[str], names: list[str]) -> str:
    return "select " + ", ".join([*keys, *[f"round({n}, 6) as {n}" for n in names]]) + f" from ({inner})"


def rounded(frame, names):
    return frame.withColumns({name: F.round(name, 6) for name in names})


@query("binary_metrics", rounded_sql(
    quality_sql("model_version", "outcomes"), ["model_version"], metrics.METRICS)
    + " union all " + rounded_sql(quality_sql("", "outcomes"), ["'all' as model_version"], metrics.METRICS),
    **QUALITY)
def binary_metrics(clinic):
    rows = scored(clinic)
    each = metrics.binary_metrics(rows, ["model_version"], "prob_1day", positive())
    whole = metrics.binary_metrics(rows, [], "prob_1day", positive())
    both = each.unionByName(whole.withColumn("model_version", F.lit("all")))
    return rounded(both, metrics.METRICS)


SUMMARY = [f"{name}_{part}" for name in metrics.METRICS for part in ("mean", "sd")]


@query("cv_metric_summary", rounded_sql(
    "select model_version, count(*) as folds, " + ", ".join(
        f"avg({name}) as {name}_mean, stddev_samp({name}) as {name}_sd" for name in metrics.METRICS)
    + " from {per_fold} group by model_version", ["model_version", "folds"], SUMMARY),
    **QUALITY, per_fold=quality_sql("model_version, fold_id", "folded"))
def cv_metric_summary(clinic):
    people = folds.person_folds(clinic.encounter)
    rows = scored(clinic).join(people, "person_id")
    return rounded(
        metrics.cv_summary(rows, "model_version", "fold_id", "prob_1day", positive()), SUMMARY)


@query("auc_confidence_interval", """
select model_version, round(area, 6) as auc, round(greatest(area - 1.959963984540054 * err, 0), 6) as lower,
  round(least(area + 1.959963984540054 * err, 1), 6) as upper
from (
  select model_version, avg(place) filter (late) as area,
    sqrt(var_samp(place) filter (late) / count(*) filter (late)
      + var_samp(place) filter (not late) / count(*) filter (not late)) as err
  from (
    select model_version, late, case when late
      then (sum(case when late then 0 else 1 end) over (partition by model_version order by p)
        - sum(case when late then 0 else 1 end) over (partition by model_version, p) / 2)
        / sum(case when late then 0 else 1 end) over (partition by model_version)
      else (sum(case when late then 1 else 0 end) over (partition by model_version order by p desc)
        - sum(case when late then 1 else 0 end) over (partition by model_version, p) / 2)
        / sum(case when late then 1 else 0 end) over (partition by model_version) end as place
    from {outcomes})
  group by model_version)""", **QUALITY)
def auc_confidence_interval(clinic):
    table = metrics.auc_interval(scored(clinic), ["model_version"], "prob_1day", positive())
    return rounded(table, ["auc", "lower", "upper"])
