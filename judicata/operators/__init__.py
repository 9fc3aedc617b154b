"""DataFrame -> DataFrame operators.  None of them collects data to the driver."""

from judicata.operators import aggregate, audit, clean, identity, match, sets, topk, windows  # noqa: F401
