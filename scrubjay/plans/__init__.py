"""End-to-end batch jobs: read -> operators -> write, with run summaries
gathered by ``observe`` during the write (no second pass over the data)."""

from .clean import clean  # noqa: F401
from .enrich import enrich  # noqa: F401
