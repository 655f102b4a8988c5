"""Attribute pivots and the operational reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates

YES, NO = 1065, 1066

# yes/no attributes of a visit, by concept.
YES_NO_CONCEPTS = {
    "tb": [10591], "art_toxicity": [6836], "mental_health": [7684, 10280],
    "adherence_counselling": [9771], "hospitalization": [6419],
}
SUBSTANCE_ANSWERED, SUBSTANCE_NAMED, INFECTION = 6474, 1685, 6903
YES_NO_CODES = sorted({code for codes in YES_NO_CONCEPTS.values() for code in codes}
                      | {SUBSTANCE_ANSWERED, SUBSTANCE_NAMED, INFECTION})

# Named attributes of a visit, by concept.
VISIT_CONCEPTS = {"health_status": 11124, "social_support": 10012, "regimen_line": 6744}


def preferred_names(names: DataFrame, locale: str | None = None, preferred: bool = False,
                    live: bool = False) -> DataFrame:
    """One name per coded value, the greatest of those that pass.

    The attributes take the greatest name, so that choosing it before the join gives
    the same result and a value with several names does not multiply its observations.
    """
    if locale is not None:
        names = names.filter(F.col("locale") == locale)
    if preferred:
        names = names.filter(F.col("locale_preferred") == 1)
    if live:
        names = names.filter(F.col("voided") == 0)
    return names.groupBy(F.col("concept_id").alias("value_coded")).agg(
        F.max("name").alias("value_name"))


def named_observations(
    encounters: DataFrame, obs: DataFrame, names: DataFrame, concepts: list[int],
    named_only: bool = True, span: tuple[date, date] | None = None,
    encounter_site: int | None = None, obs_site: int | None = None,
) -> DataFrame:
    """Observations of the concepts in live encounters, with the visit and the value's name.

    Void encounters and observations are left out, and so is any other concept before
    the shuffle. `names` comes from `preferred_names`; with `named_only` a value
    without a name goes. `span` bounds the day of the encounter, the two sites the
    place of the encounter and of the observation.
    """
    held = encounters.filter("voided = 0")
    if span is not None:
        held = held.filter(F.to_date("encounter_datetime").between(*map(F.lit, span)))
    if encounter_site is not None:
        held = held.filter(F.col("location_id") == encounter_site)
    asked = obs.filter((F.col("voided") == 0) & F.col("concept_id").isin(concepts))
    if obs_site is not None:
        asked = asked.filter(F.col("location_id") == obs_site)
    rows = asked.select("person_id", "encounter_id", "concept_id", "value_coded").join(
        held.select("encounter_id", "visit_id"), "encounter_id")
    return rows.join(names, "value_coded", "inner" if named_only else "left")


def codes_of(concepts: dict[str, list[int]]) -> list[int]:
    return sorted({code for codes in concepts.values() for code in codes})


def pivot_values(named: DataFrame, keys: list[str], concepts: dict[str, list[int]]) -> DataFrame:
    """One row per key, one column per attribute: the greatest name of its concepts."""
    return (
        named.filter(F.col("concept_id").isin(codes_of(concepts)))
        .groupBy(*keys)
        .agg(*[
            F.max(F.when(F.col("concept_id").isin(codes), F.col("value_name"))).alias(name)
            for name, codes in concepts.items()
        ])
    )


def yes_no_per_visit(named: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with Yes/No attributes; Yes wins over No. `alcohol` is the greatest name."""
    concept, coded = F.col("concept_id"), F.col("value_coded")

    def answer(codes: list[int]) -> Column:
        asked = concept.isin(codes)
        return F.when(asked & (coded == YES), "Yes").when(asked & (coded == NO), "No")

    substance = F.when((concept == SUBSTANCE_NAMED) & coded.isNotNull(), "Yes").otherwise(
        answer([SUBSTANCE_ANSWERED])
    )
    return (
        named.filter(concept.isin(YES_NO_CODES))
        .groupBy(*keys)
        .agg(
            *[F.max(answer(codes)).alias(name) for name, codes in YES_NO_CONCEPTS.items()],
            F.max(substance).alias("substance_use"),
            F.max(F.when(concept == INFECTION, "Yes")).alias("oi"),
            F.max("value_name").alias("alcohol"),
        )
    )


def late_or_missing(observed: Column, due: Column) -> Column:
    return observed.isNull() | (observed > due)


def performance(ledger: DataFrame, location: DataFrame, as_of: Column, since) -> DataFrame:
    """Returns and the 2x2 table per model version, week and clinic, with sub-totals.

    Rows whose location has no name are left out, as are future appointments.
    """
    due, seen = F.col("rtc_date"), F.col("observed_rtc_date")
    flagged = F.col("risk_1day").isNotNull()
    on_time, late = seen <= due, late_or_missing(seen, due)
    count = lambda test, name: F.count(F.when(test, 1)).alias(name)
    names = location.filter(F.col("name").isNotNull() & (F.col("name") != "Location Test"))
    return (
        ledger.filter((due <= as_of) & (F.col("start_date") >= F.lit(since)))
        .join(names.select("location_id", F.col("name").alias("clinic")), "location_id")
        .rollup("model_version", "week", "clinic")
        .agg(
            F.count(F.lit(1)).alias("appointments"),
            count(flagged, "predicted"),
            count(seen.isNotNull(), "returned"),
            count(seen < due, "early"),
            count(seen == due, "on_time"),
            count(seen > due, "late"),
            count((as_of > due) & seen.isNull(), "non_returners"),
            count(~flagged & on_time, "true_negative"),
            count(~flagged & late, "false_negative"),
            count(flagged & on_time, "false_positive"),
            count(flagged & late, "true_positive"),
        )
    )


def with_ratios(table: DataFrame) -> DataFrame:
    """The 2x2 table's four ratios to 4 decimals; 0 where the base is empty."""
    tp, tn, fp, fn = (
        F.col(name)
        for name in ("true_positive", "true_negative", "false_positive", "false_negative")
    )
    share = lambda part, rest: F.round(
        F.coalesce(F.try_divide(part, part + rest), F.lit(0.0)), 4
    )
    return table.withColumns({
        "ppv": share(tp, fp), "npv": share(tn, fn),
        "sensitivity": share(tp, fn), "specificity": share(tn, fp),
    })


def contact_flags(outreach: DataFrame) -> DataFrame:
    """One row per person: what the outreach log holds for the person."""
    phone, home = F.col("phone_ok"), F.col("home_visit")
    success = F.coalesce((phone == "YES") | (home == "YES"), F.lit(False))
    failed = F.coalesce((phone == "NO") & home.isNull(), F.lit(False))
    return outreach.groupBy("person_id").agg(
        F.bool_or(phone.isNotNull() | home.isNotNull()).alias("contacted"),
        F.bool_or(phone.isNotNull()).alias("phoned"),
        F.bool_or(home.isNotNull()).alias("visited"),
        F.bool_or(success).alias("success"),
        F.bool_or(success & F.col("rescheduled").isNull()).alias("success_as_planned"),
        F.bool_or(failed).alias("failed"),
        F.bool_or(phone.isNull() & home.isNull()).alias("blank"),
        F.bool_or(F.col("rescheduled").isNotNull()).alias("rescheduled"),
        F.max(phone).alias("best_phone"),
    )


def last_clinical_visits(encounters: DataFrame) -> DataFrame:
    """The person's last clinical visit; other visits after it do not count."""
    return (
        encounters.filter("is_clinical_encounter = 1")
        .groupBy("person_id")
        .agg(F.to_date(F.max("encounter_datetime")).alias("last_visit"))
    )


def outreach_cascade(
    ledger: DataFrame, location: DataFrame, outreach: DataFrame, encounters: DataFrame
) -> DataFrame:
    """Distinct flagged patients per week and clinic at each step of the outreach.

    All twelve counts come from one join. Each side is reduced to one row per
    person before it, so the log's repeats do not multiply.
    """
    flagged = ledger.filter("risk_1day is not null").select(
        "week", "location_id", "person_id", "prediction_generated_date", "end_date"
    ).distinct()
    joined = flagged.join(contact_flags(outreach), "person_id", "left").join(
        last_clinical_visits(encounters), "person_id", "left"
    )
    kept = F.col("last_visit").between(F.col("prediction_generated_date"), F.col("end_date"))
    never_yes = F.col("failed") & (F.col("best_phone") == "NO")
    steps = {
        "high_risk_client": F.lit(True),
        "high_risk_client_contacted": F.col("contacted"),
        "phone_follow_up": F.col("phoned"),
        "home_follow_up": F.col("visited"),
        "successful_contact_attempts": F.col("success"),
        "successful_contact_attempts_kept_appointment": F.col("success_as_planned") & kept,
        "successful_contact_attempts_missed_appointment": F.col("success") & ~kept,
        "unsuccessful_contact_attempts": never_yes,
        "no_contact_attempts": F.coalesce("blank", F.lit(True)),
        "no_contact_attempts_kept_appointment": F.col("failed") & kept,
        "rescheduled_appointment": F.col("rescheduled"),
        "unsuccessful_kept_appointment": never_yes & kept,
    }
    persons = joined.groupBy("week", "location_id", "person_id").agg(
        *[F.max(F.coalesce(test, F.lit(False))).alias(name) for name, test in steps.items()]
    )
    counts = persons.groupBy("week", "location_id").agg(
        *[F.count(F.when(F.col(name), 1)).alias(name) for name in steps]
    )
    return counts.join(location.select("location_id", "name"), "location_id")


def best_contact_outcome(outreach: DataFrame) -> DataFrame:
    """Per person, YES if any call succeeded, NO if all that are known failed."""
    return outreach.groupBy("person_id").agg(F.max("phone_ok").alias("outcome"))


def return_timeliness(
    visit: Column, due: Column, later_due: Column, split_early: bool = True
) -> Column:
    """How the return visit relates to the appointment.

    `visit` is the return visit's time, `due` the appointment it answers and
    `later_due` the next appointment it was given.
    """
    day = F.to_date(visit)
    early = dates.full_days_between(visit, due)
    late = dates.full_days_between(due, visit)
    early_text = F.lit("EARLY")
    if split_early:
        early_text = _by_length(early, "EARLY", "EARLY: MORE THAN 90 DAYS")
    beyond = "LATE: OVER 90 DAYS" if split_early else "LATE OVER 90 DAYS"
    return (
        F.when(later_due.isNull(), "NON-RETURNER")
        .when(due == day, "ON-TIME")
        .when(due > day, early_text)
        .when(due < day, _by_length(late, "LATE", beyond))
        .otherwise("????")
    )


def _by_length(days: Column, word: str, beyond: str) -> Column:
    text = F.when(days <= 7, f"{word}: UP TO 7 DAYS")
    for limit in (14, 28, 90):
        text = text.when(days <= limit, f"{word}: UP TO {limit} DAYS")
    return text.otherwise(beyond)


def predicted_vs_observed(ledger: DataFrame, visits: DataFrame, week_offset: int = 17) -> DataFrame:
    """Scored appointments with the visit that answered them and its timeliness.

    Only answered appointments remain. A visit whose new appointment lies after
    the visit but not after the old appointment counts as no return.
    """
    seen, due, later = F.col("encounter_datetime"), F.col("prev_rtc_date"), F.col("rtc_date")
    day = F.to_date(seen)
    not_moved = (later > day) & (later <= due)
    answers = visits.filter(
        (F.col("is_clinical_encounter") == 1)
        & ~F.col("encounter_type").isin(fixed.NON_VISIT_TYPES)
    ).select(
        "person_id", "encounter_type", "rtc_date", "encounter_datetime", "prev_rtc_date",
        (F.weekofyear(due) - week_offset).alias("week_number"),
        F.when(not_moved, "NON-RETURNER")
        .otherwise(return_timeliness(seen, due, later, split_early=False))
        .alias("timeliness"),
    )
    scored = ledger.select("person_id", F.col("rtc_date").alias("prev_rtc_date"), "prob_1day")
    return scored.join(answers, ["person_id", "prev_rtc_date"])


def risk_cutoffs(
    ledger: DataFrame, person: DataFrame, groups: list[str], compat: bool = False
) -> DataFrame:
    """Lowest probability per risk level and horizon, by age band, location and `groups`.

    One pass instead of a scan per level. With `compat` the 7-day cut-offs are
    taken among rows flagged by the 1-day risk.
    """
    age = dates.years_between(F.col("birthdate"), F.col("rtc_date"))
    rows = (
        ledger.join(person.select("person_id", "birthdate"), "person_id")
        .withColumn("band", clinical.age_band(age))
        .filter("band is not null")
    )
    risk_7day = "risk_1day" if compat else "risk_7day"
    lowest = lambda risk, level, prob: F.min(
        F.when(F.col(risk) == level, F.col(prob))
    )
    cells = {
        ("1 day", fixed.MEDIUM_RISK): lowest("risk_1day", fixed.MEDIUM_RISK, "prob_1day"),
        ("1 day", fixed.HIGH_RISK): lowest("risk_1day", fixed.HIGH_RISK, "prob_1day"),
        ("7 day", fixed.MEDIUM_RISK): lowest(risk_7day, fixed.MEDIUM_RISK, "prob_7day"),
        ("7 day", fixed.HIGH_RISK): lowest(risk_7day, fixed.HIGH_RISK, "prob_7day"),
    }
    keys = [*groups, "band", "location_id"]
    wide = rows.groupBy(*keys).agg(*[
        value.alias(f"{model}|{level}") for (model, level), value in cells.items()
    ])
    long = wide.unpivot(keys, [f"{m}|{r}" for m, r in cells], "cell", "probability_threshold")
    part = F.split("cell", r"\|")
    return long.filter("probability_threshold is not null").select(
        *keys, part[0].alias("model_type"), part[1].alias("risk"), "probability_threshold"
    )
