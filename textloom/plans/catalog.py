"""Imports every query module so that the registry is complete."""

from textloom.plans import text_queries  # noqa: F401
from textloom.plans import sampling_queries  # noqa: F401
from textloom.plans import profile_queries  # noqa: F401
from textloom.plans import lexicon_queries  # noqa: F401
from textloom.plans import annotate_queries  # noqa: F401
from textloom.plans import feature_queries  # noqa: F401
from textloom.plans import eval_queries  # noqa: F401
from textloom.plans import source_queries  # noqa: F401
from textloom.plans import mlm_queries  # noqa: F401
from textloom.plans import subword_queries  # noqa: F401
from textloom.plans import stream_queries  # noqa: F401
from textloom.plans import ml_queries  # noqa: F401
