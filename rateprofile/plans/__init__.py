"""End-to-end pipelines (L1, L2) composed from the operators."""

from .family_profiles import family_profiles, write_family_outputs
from .global_profiles import apply_profiles, global_profiles, write_global_outputs

__all__ = ["apply_profiles", "family_profiles", "global_profiles", "write_family_outputs", "write_global_outputs"]
