"""Named queries over the driver tables, one per operator of the survey.

Importing this package registers every query in ``registry.QUERIES``.
"""

from tidemill.plans import registry  # noqa: F401
from tidemill.plans import (  # noqa: F401
    q_named,
    q_transforms,
    q_relational,
    q_ordering,
    q_windows,
    q_cells,
    q_udf,
    q_variants,
)

__all__ = ["registry"]
