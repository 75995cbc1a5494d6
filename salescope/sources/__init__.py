"""Sources: CRM files in their own shape, and the star-schema test mapping."""

from salescope.sources.crm import load_crm, model_from_frames, read_table
from salescope.sources.star import from_star

__all__ = ["from_star", "load_crm", "model_from_frames", "read_table"]
