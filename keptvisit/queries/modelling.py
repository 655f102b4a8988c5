"""Modelling: category codes, training, scoring, explanation and the weekly run."""

from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.models import explain, features, registry, score, train
from keptvisit.operators import history, joins, timeline
from keptvisit.plans import training, weekly
from keptvisit.queries.book import query
from keptvisit.queries.filtering import active_sql
from keptvisit.queries.reporting import AGED, as_of
from keptvisit.queries.risk import BANDED, percentile_sql, recorded_sql
from keptvisit.queries.scalars import sql_list
from keptvisit.queries.steps import HISTORY, age_sql
from keptvisit.session import scratch_path, together, write_out
from keptvisit.sources import ledger as ledgers
from keptvisit.sources.tables import save_snapshot

col = F.col

FOLDS = fixed.FOLDS
CELLS = [(band, horizon) for band in score.BANDS for horizon in score.HORIZONS]
# Days after an appointment at which its 7-day outcome is settled.
SETTLED = 8


def programs(clinic):
    return joins.first_programs(clinic.view("program_map"), clinic.view("program"))


def matrix(clinic, start=None):
    """The model matrix of all visits, written to the shared folder once per `clinic`.

    It has the appointments whose 7-day outcome is settled on the last day on
    record. With a `start`, as it could be known then: visits before it only, and
    open ones measured at it.
    """
    if start not in clinic.written:
        facility = clinic.view("facility").drop("prediction_endpoint")
        visits, end = clinic.visit, as_of(clinic)
        if start:
            known = clinic.encounter.filter(col("encounter_datetime") < F.lit(start))
            visits = timeline.with_neighbours(known, clinic.hot_persons)
            end = F.lit(start)
        rows = training.model_matrix(
            visits, clinic.person, facility, programs(clinic), clinic.hot_persons,
            end, None, F.date_sub(end, SETTLED), FOLDS)
        clinic.written[start] = write_out(rows, "matrix")
    return clinic.written[start]


def cells(rows):
    """The age bands and horizons that have labelled rows."""
    labelled = rows.groupBy("cohort").agg(
        *[F.count(f"y_{name}").alias(horizon) for horizon, name in score.HORIZONS.items()])
    counts = {row["cohort"]: row for row in labelled.filter("cohort is not null").collect()}
    return [(band, horizon) for band, horizon in CELLS if band in counts and counts[band][horizon] > 0]


def union(parts):
    return reduce(DataFrame.unionByName, parts)


def trained_cells(clinic) -> list[train.Cell]:
    rows = matrix(clinic)
    return train.train_cells(
        rows, [(band, horizon, score.HORIZONS[horizon]) for band, horizon in cells(rows)], FOLDS,
        train.LINEAR, train.BOOSTED, train.MOST_TREES)


def save_run(clinic, folder: str) -> list[dict]:
    """Train all cells and write models and tables to the folder; one row per saved model."""

    def finish(cell: train.Cell) -> tuple[dict[str, DataFrame], list[dict]]:
        own = lambda frame: frame.select(
            F.lit(cell.band).alias("cohort"), F.lit(cell.horizon).alias("horizon"), "*")
        meta, holdout = train.stack(cell)
        weights = {t.name: explain.importance(t.model, cell.split.train) for t in cell.trained}
        weights["stacked"] = explain.meta_importance(meta, [t.name for t in cell.trained], cell.holdout)
        made = {
            "leaderboard": train.leaderboard(cell), "learning_curve": train.learning_curve(cell),
            "stacked": holdout.drop("weight"),
            "importance": union(table.withColumn("model", F.lit(name)) for name, table in weights.items()),
        }
        models = train.ranked(cell, meta, holdout)
        paths = train.save_ranked(models, f"{folder}/models/{cell.band}_{cell.horizon}")
        cell.split.release()
        return {name: own(table) for name, table in made.items()}, [
            {"cohort": cell.band, "horizon": cell.horizon, "rank": place, "name": path.rsplit("/", 1)[1], "auc": auc}
            for place, (path, (_, auc, _)) in enumerate(zip(paths, models), start=1)]

    done = together(clinic.spark, [partial(finish, cell) for cell in trained_cells(clinic)])
    together(clinic.spark, [partial(union([tables[name] for tables, _ in done]).write.parquet, f"{folder}/{name}")
              for name in done[0][0]])
    return [model for _, saved in done for model in saved]


def training_run(clinic) -> registry.Run:
    """The finished run on this data; trained and kept if there is none yet."""
    settings = [train.VERSION, FOLDS, train.LINEAR, train.BOOSTED, train.MOST_TREES]
    print_ = registry.fingerprint(matrix(clinic), settings)
    return registry.train_once(
        clinic.spark, registry.home(clinic.spark), print_, lambda folder: save_run(clinic, folder))


def linear_models(rows):
    """A model per age band and horizon that has labelled rows."""
    return {
        (band, horizon): train.fit_linear(rows, band, score.HORIZONS[horizon], iterations=10)
        for band, horizon in cells(rows)
    }


@query("index_categories", """
select encounter_id, tb.code as tb_test_result_code, di.code as disclosure_code
from (select encounter_id, coalesce(tb_test_result, 'Unknown') as t,
    coalesce(disclosure, 'Not Done') as d from {encounter})
join (select coalesce(tb_test_result, 'Unknown') as t,
    cast(row_number() over (order by count(*) desc, coalesce(tb_test_result, 'Unknown')) - 1 as double)
      as code from {encounter} group by 1) tb using (t)
join (select coalesce(disclosure, 'Not Done') as d,
    cast(row_number() over (order by count(*) desc, coalesce(disclosure, 'Not Done')) - 1 as double)
      as code from {encounter} group by 1) di using (d)""")
def index_categories(clinic):
    rows = clinic.encounter.select("encounter_id", "tb_test_result", "disclosure").fillna(
        {"tb_test_result": "Unknown", "disclosure": "Not Done"})
    coded = features.indexer(["tb_test_result", "disclosure"]).fit(rows).transform(rows)
    return coded.select("encounter_id", "tb_test_result_code", "disclosure_code")


@query("train_leaderboard")
def train_leaderboard(clinic):
    return training_run(clinic).table("leaderboard")


@query("stacked_ensemble")
def stacked_ensemble(clinic):
    return training_run(clinic).table("stacked")


@query("save_ranked_models")
def save_ranked_models(clinic):
    rows = [(m["cohort"], m["horizon"], m["rank"], m["name"]) for m in training_run(clinic).models]
    return clinic.spark.createDataFrame(rows, "cohort string, horizon string, rank int, name string")


@query("batch_score")
def batch_score(clinic):
    """Scores by the best saved model of every cell."""
    banded = matrix(clinic).withColumn("band", col("cohort")).filter("band is not null")
    return score.score(banded, training_run(clinic).best()).select(
        "person_id", "encounter_id", "band", "prob_1day", "prob_7day")


@query("score_snapshot")
def score_snapshot(clinic):
    rows, kept = matrix(clinic), ["person_id", "encounter_id", "visit_date", "cohort"]
    scored = []
    for (band, horizon), model in training_run(clinic).best().items():
        part = train.probability(model.transform(rows.filter(col("cohort") == band)), "p")
        scored.append(part.select(
            *kept, F.lit(horizon).alias("horizon"),
            col(f"y_{score.HORIZONS[horizon]}").alias("outcome"), "p",
            F.when(col("p") >= 0.5, fixed.DISENGAGED).otherwise(fixed.ACTIVE).alias("predicted")))
    return save_snapshot(union(scored), scratch_path(clinic.spark, "scores"))


@query("score_keyed_rows")
def score_keyed_rows(clinic):
    rows = matrix(clinic)
    models = linear_models(rows)
    banded = rows.withColumn("band", col("cohort")).filter("band is not null")
    return score.score(banded, models).select(
        "person_id", "encounter_id", "location_id", "rtc_date", "prob_1day", "prob_7day")


@query("variable_importance")
def variable_importance(clinic):
    return training_run(clinic).table("importance")


@query("partial_dependence")
def partial_dependence(clinic):
    rows = matrix(clinic)

    def curve(band: str, horizon: str, model, name: str) -> DataFrame:
        return explain.partial_dependence(model, rows.filter(col("cohort") == band), name).select(
            F.lit(band).alias("cohort"), F.lit(horizon).alias("horizon"), "*")

    return union(together(clinic.spark, [
        partial(curve, *cell, model, name) for cell, model in training_run(clinic).best().items()
        for name in ("log_days_defaulted", "viral_load_log10")]))


@query("learning_curve")
def learning_curve(clinic):
    return training_run(clinic).table("learning_curve")


START, WEEKS, VERSION = date(1998, 3, 2), 8, "linear"


def weekly_inputs(clinic):
    past = history.days_defaulted_history(clinic.visit, clinic.hot_persons, history.SINCE)
    past = ledgers.rebuild_table(past, scratch_path(clinic.spark, "days-defaulted"))
    return weekly.Inputs(
        visits=clinic.visit, person=clinic.person, past=past,
        facility=clinic.view("facility").drop("prediction_endpoint"), programs=programs(clinic),
        ledger=clinic.ledger, hot=clinic.hot_persons)


@query("weekly_risk_run")
def weekly_risk_run(clinic):
    """Train on what was known before the week, then run the week as a retrospective test."""
    models = linear_models(matrix(clinic, start=START))
    return weekly.weekly_risk_run(
        weekly_inputs(clinic), models, START, WEEKS, retrospective=True, version=VERSION)


END = weekly.week_of(START, WEEKS)[1]


def rule_scorer(rows):
    """Scores by plain arithmetic over predictors, in place of models, to compare a whole run."""
    one = col("encounter_id") * 7919 + col("visit_number") * 131 + col(
        "num_1day_defaults_last_3visits") * 577
    seven = col("encounter_id") * 6007 + col("age") * 59 + col("num_7days_defaults_last_3visits") * 613
    return rows.withColumns({
        "prob_1day": (one % 10007).cast("double") / 10007,
        "prob_7day": (seven % 10009).cast("double") / 10009})


def due_sql(ledger: str | None) -> str:
    """The run's appointments; without those of a `ledger`, if there is one."""
    skipped = f"and v.encounter_id not in (select encounter_id from {{{ledger}}})" if ledger else ""
    return f"""
select v.* from {{visit}} v
where v.encounter_id in (select encounter_id from ({active_sql(str(START), str(END), True)}))
  and coalesce(transfer_out_location_id, location_id) in ({sql_list(fixed.TARGET_SITES)}) {skipped}"""


def run_steps(known: str, live: bool) -> dict[str, str]:
    """The weekly run with `rule_scorer` as named SQL steps, beside the ledger rows of `known`."""
    late = lambda days: (
        f"case when days_defaulted_last_encounter >= {days} then 1"
        f" when days_defaulted_last_encounter < {days} then 0 end")
    three = lambda name: (
        f"{name} + lag({name}, 1) over w + lag({name}, 2) over w")
    return {
        **HISTORY,
        "known": known,
        "flags": f"select *, {late(1)} as one, {late(7)} as seven from {{history}}",
        "counts": f"""
select person_id, encounter_id, visit_number, {three("one")} as one, {three("seven")} as seven
from {{flags}} window w as (partition by person_id order by visit_number)""",
        "due": due_sql("known" if live else None),
        "predictors": f"""
select d.person_id, d.encounter_id, rtc_date,
  coalesce(transfer_out_location_id, location_id) as location_id,
  {age_sql("birthdate", "encounter_datetime")} as age, coalesce(visit_number, 1) as visit_number,
  coalesce(one, 0) as one, coalesce(seven, 0) as seven
from {{due}} d join {{person}} p on p.person_id = d.person_id
left join {{counts}} c on c.person_id = d.person_id and c.encounter_id = d.encounter_id
where birthdate is not null""",
        "scores": """
select *, case when age >= 18 then 'adult' else 'minor' end as band,
  cast((encounter_id * 7919 + visit_number * 131 + one * 577) % 10007 as double) / 10007 as prob_1day,
  cast((encounter_id * 6007 + age * 59 + seven * 613) % 10009 as double) / 10009 as prob_7day
from {predictors}""",
        "aged": AGED.replace("{ledger}", "{known}"),
        "recorded": "select band, location_id, " + ", ".join(
            recorded_sql(h, level) for h in ("1day", "7day") for level in ("High", "Medium"))
        + f""" from ({BANDED}) where week = strftime(date '{START}' - interval 7 day, '%G-W%V')
group by band, location_id""",
        "by_rank": percentile_sql("band", "scores"),
        "by_cutoff": "select s.encounter_id, " + ", ".join(f"""
  case when prob_{h} >= high_{h} then 'High Risk' when prob_{h} >= medium_{h} then 'Medium Risk' end
    as risk_{h}""" for h in ("1day", "7day")) + """
from {scores} s left join {recorded} r on r.band = s.band and r.location_id = s.location_id""",
        "batches": """
select band, count(*) < 50 and band in (select band from {recorded}
    where high_1day is not null or medium_1day is not null or high_7day is not null
      or medium_7day is not null) as by_record
from {scores} group by band""",
        "run": f"""
select s.person_id, s.encounter_id, s.location_id, s.rtc_date, s.band, s.prob_1day, s.prob_7day,
  case when by_record then c.risk_1day else r.risk_1day end as risk_1day,
  case when by_record then c.risk_7day else r.risk_7day end as risk_7day,
  date '{START}' as prediction_generated_date, 'rule' as model_version,
  date '{START}' as start_date, date '{END}' as end_date,
  strftime(date_trunc('week', rtc_date) - interval 7 day, '%G-W%V') as week
from {{scores}} s join {{batches}} b on b.band = s.band
join {{by_rank}} r on r.encounter_id = s.encounter_id
join {{by_cutoff}} c on c.encounter_id = s.encounter_id""",
    }


@query("weekly_rule_run", "select * from {run}", **run_steps("select * from {ledger}", live=False))
def weekly_rule_run(clinic):
    """The weekly run as a retrospective test, with scores that SQL can give as well."""
    return weekly.weekly_risk_run(
        weekly_inputs(clinic), rule_scorer, START, WEEKS, retrospective=True,
        generated=START, version="rule")


LEDGER_COLUMNS = ["person_id", "encounter_id", "location_id", "rtc_date", "prob_1day", "prob_7day",
                  "risk_1day", "risk_7day", "model_version", "start_date", "end_date",
                  "prediction_generated_date", "week"]


@query("weekly_live_cycle", f"""
select {", ".join(LEDGER_COLUMNS)} from {{known}} union all select {", ".join(LEDGER_COLUMNS)} from {{run}}""",
       **run_steps("select * from {ledger} where model_version = 'V10'", live=True))
def weekly_live_cycle(clinic):
    """Two live runs on a ledger that knows the older model's rows; the second adds nothing."""
    known = clinic.ledger.filter("model_version = 'V10'")
    path = scratch_path(clinic.spark, "ledger")
    ledgers.append_predictions(known, path)
    inputs = weekly_inputs(clinic)
    for _ in range(2):
        weekly.run_and_append(
            inputs, rule_scorer, START, path, known.schema, weeks=WEEKS, retrospective=True,
            generated=START, version="rule")
    return ledgers.read_ledger(clinic.spark, path, known.schema).select(*LEDGER_COLUMNS)
