"""Gold models: one SELECT per file, ``<models>/<project>/<model>.sql``, each building one table.

The text names tables through ``identifier(:silver || '.<project>_<name>')`` (also ``:bronze``,
``:gold``) and may use ``:at``, a fixed load time or NULL.
"""

from __future__ import annotations

import warnings
from importlib.resources import files
from importlib.resources.abc import Traversable

from pyspark.sql import SparkSession

from strata.catalog import register_table, run_sql
from strata.errors import ModelNotFound
from strata.lake import LAYERS, DatasetRef, Lake, check_identifier
from strata.sinks import JobResult, write_layer

MODELS = files("strata.plans") / "models"


def list_models(project: str, models: Traversable = MODELS) -> list[str]:
    folder = models / check_identifier(project)
    if not folder.is_dir():
        return []
    found = [p.name for p in folder.iterdir()]
    return sorted(name.removesuffix(".sql") for name in found if name.endswith(".sql"))


def model_text(project: str, model: str, models: Traversable = MODELS) -> str:
    if model not in list_models(project, models):
        raise ModelNotFound(f"{project}/{model}")
    return (models / project / f"{model}.sql").read_text(encoding="utf-8")


def model_args(lake: Lake, at: str | None = None) -> dict[str, object]:
    """Values for the named parameters of a model."""
    return {**{layer: lake.schema(layer) for layer in LAYERS}, "at": at}


def build_model(
    spark: SparkSession,
    lake: Lake,
    project: str,
    model: str,
    at: str | None = None,
    models: Traversable = MODELS,
) -> JobResult:
    """Run one model, replace its files and register its table. Safe to run again."""
    rows = run_sql(spark, model_text(project, model, models), model_args(lake, at))
    ref = DatasetRef("gold", project, model)
    result = write_layer(rows, lake.path(ref))
    register_table(spark, lake, ref)
    return result


def build_all(
    spark: SparkSession,
    lake: Lake,
    project: str,
    at: str | None = None,
    models: Traversable = MODELS,
) -> dict[str, JobResult]:
    """Build a project's models by name order; a project without models only warns."""
    names = list_models(project, models)
    if not names:
        warnings.warn(f"no gold models for project {project}", stacklevel=2)
    return {name: build_model(spark, lake, project, name, at, models) for name in names}
