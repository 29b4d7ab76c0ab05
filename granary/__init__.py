"""granary: stock, supply and donation analytics expressed as Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``) function that takes a
:class:`~granary.policy.Policy` for its vocabularies and thresholds. Nothing here creates a
session or collects data to the driver, and no business rule reads the wall clock.
"""

from granary.policy import DEFAULT_POLICY, Policy, Scale

__all__ = ["DEFAULT_POLICY", "Policy", "Scale"]
