"""Stage plans and the registry of checked queries."""


def load_registry():
    """Import every query module so that the registry is complete."""
    from kindred.plans import catalog
    from kindred.plans import checks_features, checks_sources, checks_compare, checks_learn, checks_rolling, checks_states, checks_stored  # noqa: F401
    return catalog.QUERIES, catalog.ORACLES
