"""Readable names of the predicted delay classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording shown to users, by class number.
POLLING_LABELS = {
    0: "Early (15+ Minutes Early)",
    1: "Slightly Early (0-15 Minute Early)",
    2: "Slightly Late (0-30 Minute Delay)",
    3: "Very Late (30+ Minutes Late)",
}
BATCH_LABELS = {
    0: "On Time (0-15 Minute Delay)",
    1: "Slightly Late (15-60 Minute Delay)",
    2: "Very Late (60+ Minute Delay)",
}
LABEL_SETS = {"polling": POLLING_LABELS, "batch": BATCH_LABELS}


def delay_label(prediction: Column | str, wording: str = "polling") -> Column:
    """Class number to wording; NULL for a class the wording does not name."""
    c = F.col(prediction) if isinstance(prediction, str) else prediction
    number = c.try_cast("double")
    chosen = None
    for value, text in LABEL_SETS[wording].items():
        test = number == float(value)
        chosen = F.when(test, text) if chosen is None else chosen.when(test, text)
    return chosen
