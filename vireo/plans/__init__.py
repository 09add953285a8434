"""plans: the registered queries over the provided tables and their SQL twins."""

from __future__ import annotations


def load_all() -> None:
    """Import every query module so its ``@query`` registrations run."""
    import importlib

    for mod in ("profile_queries", "feature_queries", "sampling_queries",
                "eval_queries", "model_queries", "scaling_queries", "io_queries", "time_queries", "bucket_queries"):
        try:
            importlib.import_module(f"vireo.plans.{mod}")
        except ModuleNotFoundError as e:  # modules land one by one
            if e.name != f"vireo.plans.{mod}":
                raise
