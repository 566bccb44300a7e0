"""Named, labelled, versioned prompt templates as a small table.

Placeholders use ``{{name}}``.  The texts below are this project's own
defaults; a deployment passes its own table (same columns) instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE_SCHEMA = "name string, label string, version int, role string, seq int, text string"

MAPPING_SYSTEM = (
    "You assign codes of the 2025 activity nomenclature to business activity descriptions. "
    "Reply with one JSON object: codable (bool), nace2025 (string), nace08_valid (bool)."
)
MAPPING_USER = (
    "Activity description:\n{{activity}}\n\n"
    "Code in the former nomenclature: {{nace_old}}\n\n"
    "Candidate codes:\n\n{{proposed_codes}}\n\n"
    "Choose one of {{list_proposed_codes}}, or set codable to false when the description is too vague."
)
RETRIEVAL_SYSTEM = (
    "You assign codes of the 2025 activity nomenclature to business activity descriptions. "
    "Reply with one JSON object: codable (bool), nace2025 (string)."
)
RETRIEVAL_USER = (
    "Activity description:\n{{activity}}\n\n"
    "Closest codes:\n\n{{proposed_codes}}\n\n"
    "Choose one of {{list_proposed_codes}}, or set codable to false when the description is too vague."
)
RETRIEVER_USER = "Business activity: {{activity_description}}"

DEFAULT_TEMPLATES = [
    ("mapping-classifier", "production", 1, "system", 0, MAPPING_SYSTEM),
    ("mapping-classifier", "production", 1, "user", 1, MAPPING_USER),
    ("retrieval-classifier", "production", 1, "system", 0, RETRIEVAL_SYSTEM),
    ("retrieval-classifier", "production", 1, "user", 1, RETRIEVAL_USER),
    ("retriever", "production", 1, "user", 0, RETRIEVER_USER),
]


def prompt_templates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The template table: read from ``path`` when given, else the defaults above."""
    if path:
        return spark.read.schema(TEMPLATE_SCHEMA).parquet(path)
    return spark.createDataFrame(DEFAULT_TEMPLATES, TEMPLATE_SCHEMA)


def load_template(templates: DataFrame | None, name: str, label: str = "production") -> dict[str, str]:
    """The newest version of one template as ``{role: text}`` (a handful of rows).

    ``templates=None`` uses the built-in defaults without running a Spark job.
    """
    if templates is None:
        rows = [dict(zip(("name", "label", "version", "role", "seq", "text"), t)) for t in DEFAULT_TEMPLATES]
        rows = [r for r in rows if r["name"] == name and r["label"] == label]
    else:
        # a handful of configuration rows: filtered in Spark, the newest version picked here
        rows = templates.filter((F.col("name") == name) & (F.col("label") == label)).select("role", "version", "text").collect()
    if not rows:
        raise KeyError(f"no template {name!r} with label {label!r}")
    newest: dict[str, tuple[int, str]] = {}
    for r in rows:
        if r["role"] not in newest or r["version"] > newest[r["role"]][0]:
            newest[r["role"]] = (r["version"], r["text"])
    return {role: text for role, (_, text) in newest.items()}
