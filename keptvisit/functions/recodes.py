"""Recodes from small fixed tables, as literal map lookups inside the scan stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed


def literal_map(table: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])


def look_up(value: Column, table: Mapping) -> Column:
    """The table's entry for the value, else null."""
    return F.try_element_at(literal_map(table), value)


def grouped(value: Column, groups: Mapping, keep_unmapped: bool = False) -> Column:
    """Group label of a raw answer; unmapped answers become null or pass through."""
    label = look_up(value, {raw: name for name, raws in groups.items() for raw in raws})
    return F.coalesce(label, value) if keep_unmapped else label


def encounter_class(type_name: Column, null_is_other: bool = True) -> Column:
    label = F.coalesce(grouped(type_name, fixed.ENCOUNTER_CLASSES), F.lit("Other"))
    return label if null_is_other else F.when(type_name.isNotNull(), label)


def regimen_line(label: Column, regimen: Column) -> Column:
    """Treatment line from its label, else from the regimen, else the line for others."""
    return F.coalesce(
        grouped(label, fixed.LINE_LABELS),
        grouped(regimen, fixed.REGIMENS_BY_LINE),
        F.lit(fixed.OTHER_LINE),
    )


def valid_regimen(regimen: Column) -> Column:
    known = [name for names in fixed.REGIMENS_BY_LINE.values() for name in names]
    return F.when(regimen.isin(known), regimen).otherwise("Invalid Regimen")


def regimen_names(codes: Column, names: Mapping[str, str], joiner: str = " + ") -> Column:
    """'628##630' as '3TC + AZT'; a code without a name stays a code."""
    table = literal_map(names)
    parts = F.transform(
        F.split(codes, "##"), lambda code: F.coalesce(F.try_element_at(table, code), code)
    )
    return F.array_join(parts, joiner)


def urban_rural(location: Column) -> Column:
    return F.when(location.isin(fixed.URBAN_SITES), "Urban").when(
        location.isin(fixed.RURAL_SITES), "Rural"
    )


def care_status(code: Column) -> Column:
    return look_up(code, fixed.CARE_STATUS)


def ever_disengaged(code: Column) -> Column:
    return F.when(code.isin(fixed.DISENGAGED_STATUS), "Yes").when(
        code.isin(fixed.ENGAGED_STATUS), "No"
    )


def pregnancy(flag: Column) -> Column:
    return F.when(flag == 1, "Pregnant").when(flag == 0, "Not Pregnant")


def likert(answer: Column) -> Column:
    return look_up(answer, fixed.LIKERT)


def checked(box: Column) -> Column:
    return F.when(box == "Checked", "Yes").when(box == "Unchecked", "No")


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").when(flag == 0, "No")
