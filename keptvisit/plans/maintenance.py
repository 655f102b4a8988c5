"""The daily refresh of the derived tables, in the order in which they depend on each other."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from keptvisit.operators import history
from keptvisit.operators.timeline import HotKeys
from keptvisit.sources import ledger as ledgers


def daily_refresh(
    ledger_path: str, ledger_schema, visits: DataFrame, person: DataFrame, location: DataFrame,
    hot: HotKeys, folder: str, baseline_since: date, history_since: date,
) -> dict[str, DataFrame]:
    """Fill the ledger's appointment dates and observed returns in place, rebuild the derived tables."""
    def fill(rows: DataFrame, known: DataFrame) -> DataFrame:
        return ledgers.backfill_observed_return(ledgers.backfill_rtc_date(rows, known), known)

    baseline = history.baseline_visit(visits, person, location, baseline_since)
    missed = history.days_defaulted_history(visits, hot, history_since)
    return {
        "baseline_visit": ledgers.rebuild_table(baseline, f"{folder}/baseline_visit"),
        "days_defaulted": ledgers.rebuild_table(missed, f"{folder}/days_defaulted"),
        "ledger": ledgers.refresh_ledger(
            visits.sparkSession, ledger_path, ledger_schema, fill, visits),
    }
