"""The job queue's rules: which services are ready, what a claim decides, and how states change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States in which a claim is refused, with what it answers.
REFUSED = {"Complete": "already_complete", "Processing": "already_processing", "Void": "voided"}


def ready(services: DataFrame) -> DataFrame:
    """Paid services whose conditions are met and whose id is a manuscript's."""
    return services.where((F.col("status") == "Paid") & (F.col("met") == 1) & F.col("service_instance_id").contains("-MANUSCRIPT"))


def claim_decision(status: Column) -> Column:
    found = F
    for state, answer in REFUSED.items():
        found = found.when(status == state, answer)
    return found.otherwise("claim")


def final_state(c_faults: Column, r_faults: Column) -> Column:
    """Any rejection fault or more than three classification faults fail a run."""
    return F.when((r_faults > 0) | (c_faults > 3), "Failed").otherwise("Complete")
