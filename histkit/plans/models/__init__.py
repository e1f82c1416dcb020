"""The 32 table descriptions, by name."""

from .feedback import FEEDBACK
from .icims import ICIMS
from .workday import WORKDAY

MODELS = {spec.name: spec for spec in (*FEEDBACK, *WORKDAY, *ICIMS)}

__all__ = ["FEEDBACK", "ICIMS", "MODELS", "WORKDAY"]
