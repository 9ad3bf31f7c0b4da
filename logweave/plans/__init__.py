"""Named queries over the test tables (``REGISTRY``) and the composite jobs."""

from .registry import REGISTRY, Query, query  # noqa: F401


def load_all() -> dict:
    """Import every query module so that its queries register themselves."""
    from . import q_features, q_files, q_learn, q_logs, q_mining, q_models, q_records, q_series, q_split  # noqa: F401
    return REGISTRY
