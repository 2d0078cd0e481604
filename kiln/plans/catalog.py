"""Imports every query module so its queries register themselves."""

from kiln.plans import q_checks, q_kmeans, q_learners, q_models, q_prep, q_stream, q_subwords, q_synth, q_text, q_words  # noqa: F401
from kiln.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
