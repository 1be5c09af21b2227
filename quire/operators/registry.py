"""The rules as a table, by phase and order, and a run of them over blocks."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from quire.operators import blocks, records, structure
from quire.sources import docx


class Rule(NamedTuple):
    id: str
    phase: str
    order: int
    apply: Callable | None


#: Phases in order, and the rules of each in theirs. V-003 needs a dictionary of the corpus and is applied by its query.
PHASES: dict[str, dict[str, Callable | None]] = {
    "ingest": {"R-001": docx.rejection},
    "strip": {"N-001": lambda rows: blocks.drop_empty_runs(blocks.collapse_space_runs(rows)), "N-003": blocks.drop_zero_width, "N-005": blocks.drop_licence},
    "classify": {
        "C-007": structure.source_contents, "C-001": lambda rows: blocks.classify_landmarks(blocks.with_strata(rows)), "C-008": structure.promote_patterns, "C-002": structure.repeated_titles, "C-006": structure.subtitles,
        "C-004": structure.front_matter, "C-005": structure.back_matter, "C-009": structure.front_shapes, "C-003": structure.title_page,
    },
    "normalize": {"N-004": blocks.curl_quotes},
    "validate": {"V-001": blocks.chapter_continuity, "V-002": blocks.signature_deviants, "V-003": None, "V-004": blocks.revision_residue, "V-005": blocks.zero_structure, "V-006": structure.pattern_warnings},
    "emit": {"H-001": records.intake_conflicts},
}
RULES = [Rule(name, phase, k, apply) for phase, rules in PHASES.items() for k, (name, apply) in enumerate(rules.items(), 1)]


def rules_for_phase(phase: str) -> list[Rule]:
    return [rule for rule in RULES if rule.phase == phase]


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r.id, r.phase, r.order) for r in RULES], "rule string, phase string, place int")


def run(rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Blocks stripped, classified and normalised, and what each validating rule finds in them."""
    for phase in ("strip", "classify"):
        for rule in rules_for_phase(phase):
            rows = rule.apply(rows)
    rows = blocks.default_roles(rows)
    for rule in rules_for_phase("normalize"):
        rows = rule.apply(rows)
    return rows, {rule.id: rule.apply(rows) for rule in rules_for_phase("validate") if rule.apply}
