"""Plans: the end-to-end run, the flagship configuration, fixtures and the query catalog."""

from tessera.plans.run import prepare, run

__all__ = ["prepare", "run"]
