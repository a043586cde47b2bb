"""Save and load fitted pipelines (primary path with a fallback)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel

log = logging.getLogger(__name__)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(paths: Sequence[str]) -> tuple[PipelineModel | None, str | None]:
    """Load from the first path that holds a model -> (model, source); both
    None when no path works (callers then refuse to score).  The source says
    whether it is the primary path or a fallback; why a path failed is
    logged."""
    for k, p in enumerate(paths):
        try:
            return PipelineModel.load(p), f"{'fallback' if k else 'primary'}:{p}"
        except (Py4JJavaError, PySparkException, OSError, ValueError) as error:
            log.warning("no model at %s: %s", p, str(error).splitlines()[0])
    return None, None
