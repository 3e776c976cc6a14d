"""Plan table with 200 and more columns, and its dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import label
from ..operators.infer import convert, infer_types, logical_to_text
from ..sources.sinks import with_note

# Classifier columns, their codes and labels, and the dictionary's
# column names.
CLASSIFIERS = {
    "planf": ("PlanType", [1, 2, 3, 4, 5],
              ["General-S&L", "Teachers", "Safety", "General-State", "General-Local"]),
    "adminf": ("AdministeringGovt", [0, 1, 2, 5], ["State", "County", "City", "School"]),
    "pctdollf": ("FundingMethCode1_GASB", [1, 0], ["levpercent", "levdollar"]),
    "openclosedf": ("FundingMethCode2_GASB", [1, 2, 3], ["open", "fixed", "closed"]),
    "assetmethf": ("AssetValMethCode_GASB", [1, 0], ["market", "smoothed"]),
}
DICTIONARY_NAMES = {"Table Name": "tabname", "Variable Name": "vname", "Variable Label": "vlabel",
                    "Format/Unit of measure": "units", "Code": "code"}


def dictionary(table: DataFrame, note: str | None = None) -> DataFrame:
    out = table.withColumnsRenamed(DICTIONARY_NAMES)
    return with_note(out, note) if note else out


def plans_raw(text: DataFrame, note: str | None = None) -> DataFrame:
    """All-text table with inferred types. Empty and logical columns are text again."""
    out = logical_to_text(convert(text, infer_types(text)))
    return with_note(out, note) if note else out


def plans_labelled(raw: DataFrame) -> DataFrame:
    """Raw table with a label column per classifier; an unknown code has no label."""
    return raw.withColumns({
        new: label(F.col(old).try_cast("double"), [float(c) for c in codes], labels)
        for new, (old, codes, labels) in CLASSIFIERS.items()
    })
