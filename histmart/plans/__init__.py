"""Driver query plans over the given tables, each with an SQL twin."""

from histmart.plans.registry import ORACLE, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every plan module so its queries register."""
    from histmart.plans import (  # noqa: F401
        q_history, q_lookup, q_facts, q_cdc, q_scalar, q_sources, q_quality, q_audit,
        q_warehouse,
    )
