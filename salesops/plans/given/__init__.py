"""Every operator applied to the given TPC-H-like tables, next to the SQL that
must give the same rows. Importing the modules fills the registry."""

from salesops.plans.given import cleaning, expressions, integrity, reports, storage  # noqa: F401
from salesops.plans.given.registry import ORACLES, QUERIES, GivenTables  # noqa: F401
