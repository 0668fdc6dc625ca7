"""The registered queries: every operator bound to the driver's tables, with an independent DuckDB statement."""
from . import registry


def load_all() -> tuple[dict, dict]:
    """Import every binding module and return (queries, oracle SQL)."""
    import importlib
    import pkgutil
    for m in pkgutil.iter_modules(__path__):
        if m.name not in ("registry", "bind"):
            importlib.import_module(f"{__name__}.{m.name}")
    return registry.QUERIES, registry.ORACLES
